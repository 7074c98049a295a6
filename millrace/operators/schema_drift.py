"""Schemas that drift between the files of a feed: a list of every change and one consistent table.

Each field of each file is profiled (type, number of values, names); records of neighbouring files are aligned by the
distinctive values that they share, whatever the fields are called; fields gone are then matched with fields new by a
bipartite matching over the agreement of their values, name similarity breaking ties.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import cut_lineage

#: Share of the records both files hold, beyond what chance gives, in which a renamed field carries its old value.
MIN_AGREEMENT = 0.6
#: The one table's columns are the fields' names, so there can't be any number of them.
MAX_FIELDS = 5000

CHANGES = "feed_id bigint, file_id bigint, as_of timestamp_ntz, change_kind string, field_name string, new_name string, old_type string, new_type string"


def _json_type(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("BOOLEAN"), "boolean")
        .when(kind.startswith("STRING"), "string")
        .when(kind.startswith("VOID"), None)
        .otherwise("number")
    )


def _canonical(value: Column, kind: Column) -> Column:
    """The value without what a change of type changes: punctuation, case, array brackets, keys, leading zeros and
    the letters before a number of four digits or more."""
    text = F.to_json(value)
    bare = F.when(kind == "object", F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"\s*:', "")).otherwise(text)
    bare = F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", "")
    digits = F.regexp_replace(bare, r"[^0-9]+", "")
    return F.when(F.length(digits) >= 4, F.regexp_replace(digits, r"^0+(?=.)", "")).otherwise(bare)


def json_fields(lines: DataFrame) -> DataFrame:
    """feed_id, file_id, as_of, row, field (lower case), kind, value (strings as they are, else JSON), canon: one row per
    non-null field.

    A line sent twice (same file_id and row) counts once, the last to arrive. Lines that are no JSON object give none.
    """
    latest = (
        lines.groupBy("feed_id", "file_id", "row")
        .agg(F.max_by(F.struct("as_of", "line"), F.struct("arrived_at", "line_id")).alias("_last"))
        .select("feed_id", "file_id", "row", "_last.as_of", "_last.line")
    )
    record = F.from_json("line", "map<string,variant>", {"mode": "PERMISSIVE"})
    exploded = latest.select("feed_id", "file_id", "as_of", "row", F.explode(record).alias("name", "v"))
    return (
        exploded.withColumn("kind", _json_type(F.col("v")))
        .filter("kind is not null")
        .select("feed_id", "file_id", "as_of", "row", F.lower("name").alias("field"), "kind", F.when(F.col("kind") == "string", F.variant_get("v", "$", "string")).otherwise(F.to_json("v")).alias("value"), _canonical(F.col("v"), F.col("kind")).alias("canon"))
    )


def _file_order(lines: DataFrame) -> DataFrame:
    """file_id with the file before it in its feed; one row a file. A feed may hold a third of all lines, but its
    files are few against its lines."""
    files = lines.groupBy("feed_id", "file_id").agg(F.min("as_of").alias("as_of"))
    order = Window.partitionBy("feed_id").orderBy("as_of", "file_id")
    return files.withColumn("prev_file", F.lag("file_id").over(order))


def _profiles(fields: DataFrame) -> DataFrame:
    """One row per file and field: the type of most values (the first in the alphabet on a tie)."""
    counts = fields.groupBy("feed_id", "file_id", "field", "kind").agg(F.count("*").alias("n"))
    return counts.groupBy("feed_id", "file_id", "field").agg(F.min_by("kind", F.struct(-F.col("n"), F.col("kind"))).alias("kind"), F.sum("n").alias("n"))


def _differences(fields: DataFrame, files: DataFrame) -> DataFrame:
    """Per file with one before it and per field of either: the types before and after."""
    own = _profiles(fields)
    pairs = files.filter("prev_file is not null").select("feed_id", "file_id", "as_of", "prev_file")
    new = pairs.join(own, ["feed_id", "file_id"]).select("feed_id", "file_id", "as_of", "field", F.col("kind").alias("new_type"))
    before = own.select(F.col("feed_id"), F.col("file_id").alias("prev_file"), "field", F.col("kind").alias("old_type"))
    old = pairs.join(before, ["feed_id", "prev_file"]).select("feed_id", "file_id", "as_of", "field", "old_type")
    return old.join(new, ["feed_id", "file_id", "as_of", "field"], "full")


def _evidence(fields: DataFrame, files: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """feed_id, file_id, old, new, both, agree, chance: over the aligned records of a file and the one before it."""
    # Only files where a field has gone and another has come need their records aligned.
    wanted = gone.select("feed_id", "file_id").distinct().join(come.select("feed_id", "file_id").distinct(), ["feed_id", "file_id"])
    pairs = files.join(wanted, ["feed_id", "file_id"]).select("feed_id", "file_id", "prev_file")
    roles = pairs.select("feed_id", F.col("file_id").alias("of"), F.explode(F.array(F.struct(F.col("file_id").alias("source"), F.lit(True).alias("after")), F.struct(F.col("prev_file").alias("source"), F.lit(False).alias("after")))).alias("r")).select("feed_id", "of", "r.*")
    sides = fields.withColumnRenamed("file_id", "source").join(roles, ["feed_id", "source"]).select("feed_id", F.col("of").alias("file_id"), "after", "row", "field", "canon")
    sides = cut_lineage(sides, "sides")
    after, before = sides.filter("after").drop("after"), sides.filter("not after").drop("after")

    def distinctive(side: DataFrame) -> DataFrame:
        """Values that one record of the file alone holds."""
        return side.groupBy("feed_id", "file_id", "canon").agg(F.min("row").alias("row"), F.countDistinct("row").alias("n")).filter("n = 1 and length(canon) > 2").drop("n")

    votes = cut_lineage(
        distinctive(before).withColumnRenamed("row", "old_row").join(distinctive(after).withColumnRenamed("row", "new_row"), ["feed_id", "file_id", "canon"]).groupBy("feed_id", "file_id", "old_row", "new_row").agg(F.count("*").alias("votes")),
        "votes",
    )
    best_old = Window.partitionBy("feed_id", "file_id", "old_row").orderBy(F.desc("votes"), "new_row")
    best_new = Window.partitionBy("feed_id", "file_id", "new_row").orderBy(F.desc("votes"), "old_row")
    aligned = votes.withColumns({"a": F.row_number().over(best_old), "b": F.row_number().over(best_new)}).filter("a = 1 and b = 1").select("feed_id", "file_id", "old_row", "new_row")

    o = before.join(gone, ["feed_id", "file_id", "field"]).select("feed_id", "file_id", F.col("row").alias("old_row"), F.col("field").alias("old"), F.col("canon").alias("old_value"))
    n = after.join(come, ["feed_id", "file_id", "field"]).select("feed_id", "file_id", F.col("row").alias("new_row"), F.col("field").alias("new"), F.col("canon").alias("new_value"))
    # Each step is a job of its own, so that the driver holds one small plan at a time.
    aligned, o, n = cut_lineage(aligned, "aligned"), cut_lineage(o, "old"), cut_lineage(n, "new")
    both = aligned.join(o, ["feed_id", "file_id", "old_row"]).join(n, ["feed_id", "file_id", "new_row"])
    same = (F.col("old_value") == F.col("new_value")) | ((F.least(F.length("old_value"), F.length("new_value")) >= 4) & (F.contains("old_value", "new_value") | F.contains("new_value", "old_value")))
    totals = both.groupBy("feed_id", "file_id", "old", "new").agg(F.count("*").alias("both"), F.sum(same.cast("int")).alias("agree"))

    # Agreement that equal value frequencies alone would give (two flags agree often by chance).
    share = lambda side, f, v: side.groupBy("feed_id", "file_id", f, v).agg(F.count("*").alias("k")).withColumn("p", F.col("k") / F.sum("k").over(Window.partitionBy("feed_id", "file_id", f)))
    po = share(o, "old", "old_value").select("feed_id", "file_id", "old", F.col("old_value").alias("v"), F.col("p").alias("po"))
    pn = share(n, "new", "new_value").select("feed_id", "file_id", "new", F.col("new_value").alias("v"), F.col("p").alias("pn"))
    chance = po.join(pn, ["feed_id", "file_id", "v"]).groupBy("feed_id", "file_id", "old", "new").agg(F.sum(F.col("po") * F.col("pn")).alias("chance"))
    return cut_lineage(totals, "totals").join(chance, ["feed_id", "file_id", "old", "new"], "left").withColumn("chance", F.coalesce("chance", F.lit(0.0)))


def best_matching(edges: list[tuple[str, str, float]]) -> list[tuple[str, str]]:
    """The one-to-one matching of greatest total weight (Kuhn-Munkres); fields of one file, so a small graph."""
    left, right = sorted({e[0] for e in edges}), sorted({e[1] for e in edges})
    size = max(len(left), len(right))
    weight = {(a, b): w for a, b, w in edges}
    cost = [[-weight.get((left[i], right[j]), 0.0) if i < len(left) and j < len(right) else 0.0 for j in range(size)] for i in range(size)]
    u, v, match = [0.0] * (size + 1), [0.0] * (size + 1), [0] * (size + 1)
    for i in range(1, size + 1):
        match[0], j0 = i, 0
        least, way, done = [float("inf")] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        while True:
            done[j0] = True
            i0, delta, j1 = match[j0], float("inf"), 0
            for j in range(1, size + 1):
                if not done[j]:
                    slack = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if slack < least[j]:
                        least[j], way[j] = slack, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(size + 1):
                if done[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    pairs = ((left[match[j] - 1], right[j - 1]) for j in range(1, size + 1) if match[j] - 1 < len(left) and j - 1 < len(right))
    return sorted(p for p in pairs if p in weight)


_RENAMES = T.ArrayType(T.StructType([T.StructField("old", T.StringType()), T.StructField("new", T.StringType())]))


@F.arrow_udf(returnType=_RENAMES)
def _matched(edges: pa.Array) -> pa.Array:
    out = [[{"old": a, "new": b} for a, b in best_matching([(e["old"], e["new"], e["w"]) for e in group])] for group in edges.to_pylist()]
    return pa.array(out, type=pa.list_(pa.struct([("old", pa.string()), ("new", pa.string())])))


def schema_changes(lines: DataFrame) -> DataFrame:
    """Every change of a file against the file before it in its feed by `as_of` (ties by file_id).

    change_kind is added, removed, renamed or retyped; new_name is an empty string unless renamed. Lines sent twice
    count once, lines that are no JSON object and null lines give no fields, the first file of a feed no change, an
    empty table no rows. A field that only holds nulls in a file isn't in it. Other columns are ignored.
    """
    # Written once: what follows reads the fields several times, and no plan carries the lines' along.
    fields, files = cut_lineage(json_fields(lines).drop("value"), "fields"), cut_lineage(_file_order(lines), "files")
    diff = cut_lineage(_differences(fields, files).filter("old_type is null or new_type is null or old_type <> new_type"), "differences")
    gone = diff.filter("new_type is null").select("feed_id", "file_id", "field")
    come = diff.filter("old_type is null").select("feed_id", "file_id", "field")
    score = (F.col("agree") / F.col("both") - F.col("chance")) / (1 - F.least("chance", F.lit(0.999)))
    alike = 1 - F.levenshtein("old", "new") / F.greatest(F.length("old"), F.length("new"))
    edges = _evidence(fields, files, gone, come).withColumn("score", score).filter((F.col("score") >= MIN_AGREEMENT) & ((F.col("agree") > 1) | (F.col("both") == 1)))
    renames = (
        edges.groupBy("feed_id", "file_id")
        .agg(F.array_sort(F.collect_list(F.struct("old", "new", (F.col("score") + 0.01 * alike).alias("w")))).alias("edges"))
        .select("feed_id", "file_id", F.explode(_matched("edges")).alias("m"))
        .select("feed_id", "file_id", F.col("m.old").alias("field"), F.col("m.new").alias("new_name"))
    )
    renames = cut_lineage(renames, "renames")
    marked = diff.join(renames, ["feed_id", "file_id", "field"], "left")
    taken = renames.select("feed_id", "file_id", F.col("new_name").alias("field"), F.lit(True).alias("taken"))
    marked = marked.join(taken, ["feed_id", "file_id", "field"], "left").filter("not (old_type is null and taken is not null)")
    kind = F.when(F.col("new_name").isNotNull(), "renamed").when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").otherwise("retyped")
    return marked.select("feed_id", "file_id", "as_of", kind.alias("change_kind"), F.col("field").alias("field_name"), F.coalesce("new_name", F.lit("")).alias("new_name"), "old_type", "new_type")


def first_names(changes: DataFrame) -> DataFrame:
    """feed_id, file_id, field, first_name: for each renaming, the name its field had at first. Follows chains of
    renamings by doubling; each round is a join over the renamings alone."""
    edges = changes.filter("change_kind = 'renamed'").select("feed_id", "file_id", "as_of", F.col("field_name").alias("first"), F.col("new_name").alias("field"))
    chain = cut_lineage(edges.select("feed_id", "file_id", "as_of", "field", "first", F.col("as_of").alias("since"), F.col("file_id").alias("since_file")))
    for _ in range(40):
        earlier = chain.select("feed_id", F.col("field").alias("first"), F.col("as_of").alias("e_of"), F.col("file_id").alias("e_file"), F.col("first").alias("e_first"), F.col("since").alias("e_since"), F.col("since_file").alias("e_since_file"))
        found = chain.join(earlier, ["feed_id", "first"], "left")
        usable = F.expr("e_of is not null and struct(e_of, e_file) < struct(since, since_file)")
        stepped = found.groupBy("feed_id", "file_id", "as_of", "field").agg(
            F.max_by(F.struct("first", "since", "since_file"), F.lit(1)).alias("own"),
            F.max(F.when(usable, F.struct("e_of", "e_file", "e_first", "e_since", "e_since_file"))).alias("e"),
        )
        if stepped.filter("e is not null").isEmpty():
            break
        chain = stepped.select(
            "feed_id", "file_id", "as_of", "field",
            F.coalesce("e.e_first", "own.first").alias("first"), F.coalesce("e.e_since", "own.since").alias("since"), F.coalesce("e.e_since_file", "own.since_file").alias("since_file"),
        )
    return chain.select("feed_id", "file_id", "as_of", "field", F.col("first").alias("first_name"))


def profiles(lines: DataFrame) -> DataFrame:
    """feed_id, file_id, field, kind, n: every field of every file with the type of most of its values (the first in the
    alphabet of equals) and their number."""
    return _profiles(json_fields(lines))


def _column_types(named: DataFrame) -> dict[str, str]:
    """The type that holds all values of a column whole: boolean, bigint, double, else string."""
    whole = F.col("value").rlike(r"^-?\d{1,18}$")
    kind = F.when(F.col("kind") == "boolean", 1).when((F.col("kind") == "number") & whole, 2).when(F.col("kind") == "number", 4).otherwise(8)
    rows = named.groupBy("name").agg(F.bit_or(kind).alias("kinds")).limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"the files have more than {MAX_FIELDS} fields")
    types = {1: "boolean", 2: "bigint", 4: "double", 6: "double"}
    return {r["name"]: types.get(r["kinds"], "string") for r in sorted(rows)}


def unified_table(lines: DataFrame) -> DataFrame:
    """All records of all files in one table: feed_id, file_id, row and a column per field under the first name it
    had in its feed.

    A column is boolean, bigint or double if all its values in all files are (and none stands twice in a record), else
    text: strings as they are, anything else as JSON. Names that differ only in case are one field; a record that holds
    such a field twice with different values has both, sorted, as a JSON array. Lines sent twice come out once, lines
    that are no JSON object not at all; a field that a record lacks or holds as null is null; an empty table gives no
    rows and only the three columns first named."""
    fields = json_fields(lines)
    names = first_names(schema_changes(lines))
    # First the name of each field of each file, of which there are few; then one join to the records by that.
    held = fields.select("feed_id", "file_id", "as_of", "field").distinct()
    since = names.select(F.col("feed_id").alias("_feed"), F.col("field").alias("_field"), F.col("as_of").alias("since"), F.col("file_id").alias("since_file"), "first_name")
    usable = F.col("feed_id").eqNullSafe(F.col("_feed")) & (F.col("field") == F.col("_field")) & (F.struct("since", "since_file") <= F.struct("as_of", "file_id"))
    known = held.join(since, usable).groupBy("feed_id", "file_id", "field").agg(F.max_by("first_name", F.struct("since", "since_file")).alias("first_name"))
    known = known.select(F.col("feed_id").alias("_feed"), F.col("file_id").alias("_file"), F.col("field").alias("_field"), "first_name")
    here = F.col("feed_id").eqNullSafe(F.col("_feed")) & F.col("file_id").eqNullSafe(F.col("_file")) & (F.col("field") == F.col("_field"))
    named = fields.join(known, here, "left").groupBy("feed_id", "file_id", "row", F.coalesce("first_name", "field").alias("name")).agg(F.array_sort(F.collect_set("value")).alias("values"), F.min("kind").alias("kind"))
    several = F.size("values") > 1
    named = named.select("feed_id", "file_id", "row", "name", F.when(several, F.to_json("values")).otherwise(F.col("values")[0]).alias("value"), F.when(several, "array").otherwise(F.col("kind")).alias("kind"))
    named = cut_lineage(named, "named")
    types = _column_types(named)
    wide = named.groupBy("feed_id", "file_id", "row").pivot("name", list(types)).agg(F.first("value"))
    return wide.select("feed_id", "file_id", "row", *[F.col(f"`{n}`").try_cast(kind).alias(n) for n, kind in types.items()])
