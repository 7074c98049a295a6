"""Loading delimited records with the rows that fail set apart."""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.grammar import RecordGrammar

PARSED = T.StructType(
    [
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
        T.StructField("at", T.IntegerType()),
    ]
)
_ARROW = pa.struct([("cells", pa.list_(pa.string())), ("error", pa.string()), ("at", pa.int32())])
SPARK_TYPES = {"text": "string", "bigint": "bigint", "decimal": "decimal(38,10)", "date": "date", "boolean": "boolean"}
#: The layouts' column names become the columns of the result, so there can't be any number of them.
MAX_COLUMNS = 5000


@functools.lru_cache(maxsize=4096)
def grammar_of(spec: str) -> RecordGrammar:
    return RecordGrammar.from_spec(spec)


@F.arrow_udf(returnType=PARSED)
def parse_record(line: pa.Array, spec: pa.Array) -> pa.Array:
    out = []
    for text, layout in zip(line.to_pylist(), spec.to_pylist()):
        if layout is None:
            out.append({"cells": None, "error": "unknown layout", "at": 0})
            continue
        record = grammar_of(layout).line(text)
        out.append({"cells": record.cells, "error": record.error, "at": record.at})
    return pa.array(out, type=_ARROW)


def layout_specs(layouts: DataFrame) -> DataFrame:
    """One row per layout_id: its grammar as JSON, and the column names in order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "column_name", "col_type", F.coalesce("required", F.lit(False)).alias("required"))))
    return (
        layouts.groupBy("layout_id")
        .agg(F.min("sep").alias("sep"), F.min("quotechar").alias("quotechar"), ordered.alias("cols"))
    )


def _spec() -> Column:
    """[sep, quotechar, [[name, type, required], ...]] as JSON text."""
    text = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    columns = F.transform("cols", lambda c: F.concat(F.lit("["), text(c["column_name"]), F.lit(","), text(c["col_type"]), F.lit(","), c["required"].cast("string"), F.lit("]")))
    return F.concat(F.lit("["), text(F.col("sep")), F.lit(","), text(F.coalesce("quotechar", F.lit(""))), F.lit(",["), F.array_join(columns, ","), F.lit("]]"))


def parse_lines(lines: DataFrame, layouts: DataFrame) -> DataFrame:
    """lines with `_names` and `_parsed` (cells or error and its position); one pass, no shuffle of the lines
    while the layouts are small enough to be broadcast, else a join on layout_id."""
    specs = layout_specs(layouts).select(
        F.col("layout_id").alias("_layout"), _spec().alias("_spec"), F.transform("cols", lambda c: c["column_name"]).alias("_names")
    )
    joined = lines.join(specs, lines["layout_id"].eqNullSafe(specs["_layout"]), "left").drop("_layout")
    return joined.withColumn("_parsed", parse_record("line", "_spec")).drop("_spec")


def load_lines(lines: DataFrame, layouts: DataFrame) -> DataFrame:
    """Every line as a row: the layouts' columns, typed, where it is valid; `_load_error`, `_line_b64encoded` and
    `_error_at` (character position from 0) where it fails. `row` is kept for both.

    The columns are the union of all layouts' columns; one name with different types becomes a string. A layout's
    column that is named like one of the input's (except `line`, which is replaced) is put in, and the input's
    comes out as `in_<name>`. Null and blank lines fail with "Zero length line", lines of an unknown or null
    layout with "unknown layout"; repeated lines come out as often as they came in; no lines give no rows.
    """
    kinds: dict[str, set[str]] = {}
    for name, kind in layouts.select("column_name", "col_type").distinct().limit(MAX_COLUMNS + 1).collect():
        kinds.setdefault(name, set()).add(kind)
    if len(kinds) > MAX_COLUMNS:
        raise ValueError(f"the layouts name more than {MAX_COLUMNS} columns")
    parsed = parse_lines(lines, layouts)
    cells = F.map_from_arrays("_names", "_parsed.cells")
    reserved = {n.lower() for n in kinds} | {"_load_error", "_line_b64encoded", "_error_at"}
    kept = [F.col(f"`{c}`").alias(f"in_{c}" if c.lower() in reserved else c) for c in lines.columns if c != "line"]
    columns = []
    for name in sorted(kinds):
        kind = SPARK_TYPES.get(next(iter(kinds[name])), "string") if len(kinds[name]) == 1 else "string"
        cell = F.try_element_at(F.col("_cells"), F.lit(name))
        columns.append((cell if kind == "string" else F.nullif(F.trim(cell), F.lit("")).try_cast(kind)).alias(name))
    failed = F.col("_parsed.error").isNotNull()
    return (
        parsed.withColumn("_cells", F.when(~failed, cells))
        .select(
            *kept,
            *columns,
            F.col("_parsed.error").alias("_load_error"),
            F.when(failed, F.base64(F.encode(F.coalesce("line", F.lit("")), "utf-8"))).alias("_line_b64encoded"),
            F.when(failed, F.col("_parsed.at")).alias("_error_at"),
        )
    )


def failed_lines(lines: DataFrame, layouts: DataFrame) -> DataFrame:
    """Only the lines that fail, with the reason and the place."""
    parsed = parse_lines(lines, layouts)
    return parsed.filter(F.col("_parsed.error").isNotNull()).withColumns({"_load_error": F.col("_parsed.error"), "_error_at": F.col("_parsed.at")}).drop("_parsed", "_names")


def failed_in_files(lines: DataFrame, layouts: DataFrame, rows_at_once: int = 20_000) -> DataFrame:
    """line_id, file_id, row, _load_error of what fails when files are read whole: their lines (in order of row) are put
    together and go through the file grammar, which after broken quoting resumes at the next validated record start.

    A file is read in stretches of so many rows, each by one task, so no file is too long for one. A record that runs on
    into the lines that follow takes these with it: each of them fails with it, or none.
    """
    specs = layout_specs(layouts).select(F.col("layout_id").alias("_layout"), _spec().alias("spec"))
    joined = lines.select("line_id", "file_id", "layout_id", "row", "line").join(specs, lines["layout_id"].eqNullSafe(specs["_layout"]), "left").drop("_layout")
    schema = "line_id bigint, file_id bigint, row bigint, _load_error string"

    def parse(group):
        import bisect

        import pandas as pd

        group = group.sort_values(["row", "line_id"], kind="stable")
        ids, rows, texts, spec = group["line_id"].tolist(), group["row"].tolist(), [t or "" for t in group["line"].tolist()], group["spec"].iloc[0]
        file = group["file_id"].iloc[0]
        if spec is None:
            return pd.DataFrame([(i, file, r, "unknown layout") for i, r in zip(ids, rows)], columns=[f.split()[0] for f in schema.split(", ")])
        starts, at = [], 0
        for text in texts:
            starts.append(at)
            at += len(text) + 1
        out = []
        for record in RecordGrammar.from_spec(spec).file("\n".join(texts) + "\n"):
            if record.error:
                first, last = bisect.bisect_right(starts, record.start) - 1, bisect.bisect_right(starts, record.end)
                out += [(ids[n], file, rows[n], record.error) for n in range(first, last)]
        return pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])

    return joined.groupBy("file_id", "layout_id", F.floor(F.col("row") / rows_at_once).alias("stretch")).applyInPandas(parse, schema)


def read_delimited_files(spark: SparkSession, path: str, layout: RecordGrammar, encoding: str = "utf-8") -> DataFrame:
    """Raw files, whole, one task each, through the file grammar: file, row (from 1), cells or the error.

    After broken quoting the parser resumes at the next validated record start; what it skipped is one failed row.
    """
    schema = "file string, row bigint, cells map<string,string>, _load_error string, _line_b64encoded string, _error_at bigint"

    def parse(batches):
        import base64

        import pandas as pd

        names = [c[0] for c in layout.columns]
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                text = bytes(content).decode(encoding, errors="replace")
                rows = []
                for n, r in enumerate(layout.file(text), 1):
                    raw = base64.b64encode(text[r.start : r.end].encode()).decode() if r.error else None
                    rows.append((file, n, dict(zip(names, r.cells)) if r.cells else None, r.error, raw, None if r.at is None else r.at - r.start))
                    if len(rows) >= 10_000:
                        yield pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])
                        rows = []
                yield pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(parse, schema)
