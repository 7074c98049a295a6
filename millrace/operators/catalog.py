"""The file catalogue: filters, duplicates, totals, updates, and the layout of outputs."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes that a compressed output file should have at least, and how much raw text that is taken to be.
OUTPUT_BYTES, RATIO = 512 << 20, 15


def full_path(path: str = "path", file: str = "file") -> Column:
    return F.concat_ws("/", path, file)


def pair_filter(expression: str, columns: list[str]) -> Column:
    """Whether some `column=value` of a record matches a regular expression, anywhere and in any case; with a leading
    `!` whether none does. Null values give no pair."""
    negated, pattern = expression.startswith("!"), expression.lstrip("!") if expression.startswith("!") else expression
    hits = [F.coalesce(F.concat(F.lit(f"{c}="), F.col(c).cast("string")).rlike(f"(?i){pattern}"), F.lit(False)) for c in columns]
    found = functools.reduce(lambda a, b: a | b, hits, F.lit(False))
    return ~found if negated else found


def filter_catalog(catalog: DataFrame, expressions: list[str]) -> DataFrame:
    """Records that satisfy every expression."""
    columns = [c for c, kind in catalog.dtypes if not kind.startswith(("array", "struct", "map"))]
    return functools.reduce(lambda df, e: df.filter(pair_filter(e, columns)), expressions, catalog)


def first_of_each(catalog: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """One record of each key, the first in order; records whose key is null are kept, and spread by what orders them."""
    spread = F.when(F.col(key).isNull(), F.xxhash64(*order))
    rank = F.row_number().over(Window.partitionBy(key, spread).orderBy(*order))
    return catalog.withColumn("_rank", rank).filter(F.col(key).isNull() | (F.col("_rank") == 1)).drop("_rank")


def duplicates(catalog: DataFrame, key: str, name: Column) -> DataFrame:
    """key, names (sorted), n of every key held by more than one record."""
    return catalog.filter(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(name)).alias("names"), F.count("*").alias("n")).filter("n > 1")


def totals(catalog: DataFrame, size: str) -> DataFrame:
    return catalog.agg(F.count("*").alias("files"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("bytes"))


def exact_match(catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records at the wanted full paths (column full_path), with the number of records found there."""
    located = catalog.withColumn("full_path", full_path())
    counted = located.withColumn("found", F.count("*").over(Window.partitionBy("full_path")))
    return wanted.select("full_path").distinct().join(counted, "full_path", "left").withColumn("found", F.coalesce("found", F.lit(0)))


def members_of(catalog: DataFrame, container: str) -> DataFrame:
    """Records that lie under a full path."""
    return catalog.filter(full_path().startswith(container + "/"))


def layout(files: DataFrame, size: str = "bytes", tie: list[str] | None = None, threshold: int = OUTPUT_BYTES * RATIO, group: list[str] | None = None) -> DataFrame:
    """bucket (from 0) of each file: in order of size, a new bucket begins once the running one exceeds the threshold.

    The sum with resets depends on all smaller files, so each group (a dataset) is folded in order in one pass of
    constant memory over its sorted rows; groups are independent.
    """
    import pandas as pd

    group = group or []
    order = [size, *(tie or [])]

    def fold(batches):
        current, filled, bucket = object(), 0, 0
        for batch in batches:
            keys = list(zip(*[batch[g] for g in group])) if group else [()] * len(batch)
            out = []
            for key, n in zip(keys, batch[size]):
                if key != current:
                    current, filled, bucket = key, 0, 0
                elif filled > threshold:
                    filled, bucket = 0, bucket + 1
                filled += 0 if pd.isna(n) else int(n)
                out.append(bucket)
            yield batch.assign(bucket=out)

    placed = files.repartition(*group) if group else files.coalesce(1)
    schema = ", ".join(f"`{c}` {k}" for c, k in files.dtypes) + ", bucket bigint"
    return placed.sortWithinPartitions(*group, *order).mapInPandas(fold, schema)


def merge_update(scanned: DataFrame, known: DataFrame) -> DataFrame:
    """A new scan over the catalogue before it: what is unchanged in size and time keeps its checksum and line count,
    what is new or changed is marked for a full scan, what is gone is left out. Where both have an access path, the members
    of archives that haven't changed are carried over from before, as they are not opened again."""
    old = known.select("path", "file", F.col("bytes").alias("_bytes"), F.col("mtime").alias("_mtime"), F.col("sha256").alias("_sha256"), F.col("est_lines").alias("_est_lines"))
    joined = scanned.drop("sha256", "est_lines").join(old, ["path", "file"], "left")
    same = F.col("bytes").eqNullSafe(F.col("_bytes")) & F.col("mtime").eqNullSafe(F.col("_mtime")) & F.col("_sha256").isNotNull()
    out = joined.withColumns({"sha256": F.when(same, F.col("_sha256")), "est_lines": F.when(same, F.col("_est_lines")), "rescan": ~same}).drop("_bytes", "_mtime", "_sha256", "_est_lines")
    if "access_path" not in scanned.columns or "access_path" not in known.columns:
        return out
    unchanged = out.filter("not rescan").select(full_path().alias("_container"))
    members = known.filter("size(access_path) > 1").withColumn("_container", F.col("access_path")[0]["member"]).join(unchanged, "_container", "left_semi").drop("_container")
    fresh = members.join(scanned.select("path", "file"), ["path", "file"], "left_anti").withColumn("rescan", F.lit(False))
    return out.unionByName(fresh.select(*[c for c in out.columns if c in fresh.columns]), allowMissingColumns=True)


def merge_catalogs(first: DataFrame, second: DataFrame, order: list[str]) -> DataFrame:
    """Both catalogues as one; of equal checksums the first record in order stays."""
    return first_of_each(first.unionByName(second, allowMissingColumns=True), "sha256", order)


def valid_column_names(names: list[str]) -> list[str]:
    """The names that can't be used: anything but lower-case letters, digits and underscores."""
    return [n for n in names if not re.fullmatch("[a-z0-9_]+", n)]
