"""Tables out of mixed records: splitting, collapsing, joining by key, and looking at keys."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNUSED = "unused_records"


def label_tables(records: DataFrame, rules: dict[str, Column], label: str = "table_name") -> DataFrame:
    """Each record with the name of the first rule that claims it, in the rules' order; the rest are unused records."""
    out = functools.reduce(lambda case, rule: case.when(F.coalesce(rule[1], F.lit(False)), rule[0]), rules.items(), F)
    return records.withColumn(label, out.otherwise(UNUSED) if rules else F.lit(UNUSED))


def split_tables(records: DataFrame, rules: dict[str, Column], renames: dict[str, dict[str, str]] | None = None) -> dict[str, DataFrame]:
    """A table for each rule, and what none claims; each reads its records in one filtered pass."""
    labelled = label_tables(records, rules, "_table")
    return {name: labelled.filter(F.col("_table") == name).drop("_table").withColumnsRenamed((renames or {}).get(name, {})) for name in [*rules, UNUSED]}


def collapse_by_key(table: DataFrame, key: str) -> DataFrame:
    """One row a key with the sorted set of the values of every other column; values in more than one row count once
    before the rows of a key are brought together."""
    return table.groupBy(key).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in table.columns if c != key])


def collapse_records(table: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row a key with the sorted list of its records."""
    rest = [c for c in table.columns if c != key]
    record = F.struct(*order, *[c for c in rest if c not in order])
    return table.groupBy(key).agg(F.array_sort(F.collect_list(record)).alias("records"))


def as_text(value: Column, kind: str) -> Column:
    """Strings as they are, anything else as JSON; null stays null."""
    if kind == "string":
        return value
    if kind.startswith(("array", "map", "struct")):
        return F.to_json(value)
    whole = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(whole, F.lit(2), F.length(whole) - 2))


def without_empty(fields: Column) -> Column:
    """A map without the entries whose value is null, empty or blank."""
    return F.map_filter(fields, lambda _, v: v.isNotNull() & (F.trim(v.cast("string")) != ""))


def key_by(table: DataFrame, name: str, key: str) -> DataFrame:
    """<name>_key and the whole row as a map of strings, <name>_records."""
    kinds = dict(table.dtypes)
    pairs = [x for c in table.columns for x in (F.lit(c), as_text(F.col(c), kinds[c]))]
    return table.select(F.col(key).alias(f"{name}_key"), F.create_map(*pairs).alias(f"{name}_records"))


def join_by_key(tables: dict[str, tuple[DataFrame, str]]) -> tuple[DataFrame, DataFrame]:
    """Full outer joins of each table to the first, by key: (rows that lack a key, rows that have all)."""
    keyed = [(name, key_by(df, name, key)) for name, (df, key) in tables.items()]
    first, joined = keyed[0]
    for name, other in keyed[1:]:
        joined = joined.join(other, F.col(f"{first}_key") == F.col(f"{name}_key"), "full")
    complete = functools.reduce(lambda a, b: a & b, [F.col(f"{name}_key").isNotNull() for name, _ in keyed])
    return joined.filter(~complete), joined.filter(complete)


def key_overlap(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """tables (sorted names), keys: how many distinct keys are held by exactly these tables."""
    parts = [df.select(F.col(key).cast("string").alias("key"), F.lit(name).alias("name")).filter("key is not null").distinct() for name, (df, key) in tables.items()]
    every = functools.reduce(DataFrame.unionByName, parts)
    return every.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("tables")).groupBy("tables").agg(F.count("*").alias("keys"))


def key_overlap_shares(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """tables, keys and, for each table, share_<name>: those keys over all rows of the table; null for a table that
    doesn't hold them or has no rows."""
    sizes = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows") for name, (df, _) in tables.items()]
    rows = functools.reduce(DataFrame.unionByName, sizes).agg(F.map_from_entries(F.collect_list(F.struct("name", "rows"))).alias("rows"))
    held = lambda name: F.array_contains(F.split("tables", ","), name)
    share = lambda name: F.when(held(name), F.col("keys") / F.nullif(F.col("rows")[name], F.lit(0)))
    return key_overlap(tables).join(F.broadcast(rows)).select("tables", "keys", *[share(name).alias(f"share_{name}") for name in tables])


def heaviest_key(table: DataFrame, key: str) -> DataFrame:
    """The key with the most rows and their number; the least of equals."""
    counts = table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), key).limit(1)


def describe_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n, columns of each table."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n", F.lit(",".join(df.columns)).alias("columns")) for name, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def value_stats(records: DataFrame, fields: list[str]) -> DataFrame:
    """field, value, n over several fields in one pass; values of arrays count each for itself."""
    kinds = dict(records.dtypes)

    def named(f: str) -> Column:
        held = F.col(f).cast("array<string>") if kinds[f].startswith("array") else F.array(F.col(f).cast("string"))
        return F.transform(F.coalesce(held, F.array().cast("array<string>")), lambda v: F.struct(F.lit(f).alias("field"), v.alias("value")))

    pairs = [named(f) for f in fields]
    return records.select(F.explode(F.concat(*pairs)).alias("p")).select("p.*").filter("value is not null").groupBy("field", "value").agg(F.count("*").alias("n"))


def error_counts(records: DataFrame, error: str = "_load_error") -> DataFrame:
    return records.filter(F.col(error).isNotNull()).groupBy(error).agg(F.count("*").alias("n"))
