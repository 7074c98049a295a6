"""Queries over the file catalogue and the manifest of what has been loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.analyzers import path_ancestors
from millrace.functions.values import human_size
from millrace.operators import catalog, manifest
from millrace.session import table

#: Raw bytes of a test output; production outputs are far larger (catalog.OUTPUT_BYTES * RATIO).
BUCKET = 64 << 20


def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "meta")


def catalog_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.first_of_each(_meta(spark, sf_dir), "sha256", [catalog.full_path(), "meta_id"]).select("meta_id", "sha256")


def catalog_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.duplicates(_meta(spark, sf_dir), "sha256", catalog.full_path()).select("sha256", F.array_join("names", "|").alias("names"), "n")


def catalog_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.totals(_meta(spark, sf_dir), "bytes")


def catalog_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.filter_catalog(_meta(spark, sf_dir), ["mime=text/.*", "!est_lines=0"]).select("meta_id", "mime", "est_lines")


def catalog_filter_negated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.filter_catalog(_meta(spark, sf_dir), ["!enc=utf-?8"]).select("meta_id", "enc")


def catalog_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meta(spark, sf_dir).select("meta_id", human_size(F.col("bytes")).alias("human"))


def catalog_path_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _meta(spark, sf_dir).select(F.explode(path_ancestors(F.col("path"))).alias("ancestor"), "bytes").groupBy("ancestor").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def catalog_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = _meta(spark, sf_dir).select("cid", "meta_id", "bytes")
    return catalog.layout(todo, "bytes", ["meta_id"], BUCKET, ["cid"]).select("cid", "meta_id", "bucket")


def catalog_size_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of files by extension, and their share of all."""
    by = _meta(spark, sf_dir).groupBy(F.lower(F.regexp_extract("file", r"\.([A-Za-z0-9]+)$", 1)).alias("extension")).agg(F.sum("bytes").alias("bytes"))
    # One row an extension is left here, so one task can total them.
    total = F.sum("bytes").over(Window.partitionBy(F.lit(1)))
    return by.select("extension", "bytes", F.round(F.col("bytes") / total, 6).alias("share"))


def manifest_not_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.not_loaded(_meta(spark, sf_dir), table(spark, sf_dir, "manifest")).select("meta_id")


def manifest_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.loaded(_meta(spark, sf_dir), table(spark, sf_dir, "manifest")).select("meta_id")


def manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.latest_file(table(spark, sf_dir, "manifest")).select("sha256", "filename")


def manifest_update_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs with a checksum that the history (batch 0) doesn't have."""
    return manifest.files_to_update(table(spark, sf_dir, "manifest"), _meta(spark, sf_dir).filter("batch = 0"))


def manifest_superseded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.superseded_files(table(spark, sf_dir, "manifest"))


QUERIES = {
    f.__name__: f
    for f in [
        catalog_dedupe, catalog_duplicates, catalog_totals, catalog_filter, catalog_filter_negated, catalog_sizes, catalog_path_hierarchy, catalog_layout,
        catalog_size_by_type, manifest_not_loaded, manifest_loaded, manifest_latest, manifest_update_files, manifest_superseded,
    ]
}

_FULL = "concat_ws('/', path, file)"
_TENTH = "printf('%.1f', floor(x * 10 + 0.5) / 10.0)"
SQL = {
    "catalog_dedupe": f"""
        SELECT meta_id, sha256 FROM (
            SELECT meta_id, sha256, row_number() OVER (PARTITION BY sha256 ORDER BY {_FULL}, meta_id) AS r FROM meta)
        WHERE sha256 IS NULL OR r = 1""",
    "catalog_duplicates": f"""
        SELECT sha256, string_agg({_FULL}, '|' ORDER BY {_FULL}) AS names, count(*) AS n
        FROM meta WHERE sha256 IS NOT NULL GROUP BY sha256 HAVING count(*) > 1""",
    "catalog_totals": "SELECT count(*) AS files, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM meta",
    "catalog_filter": "SELECT meta_id, mime, est_lines FROM meta WHERE regexp_matches(mime, 'text/.*', 'i') AND NOT coalesce(CAST(est_lines AS VARCHAR) LIKE '0%', false)",
    "catalog_filter_negated": "SELECT meta_id, enc FROM meta WHERE NOT coalesce(regexp_matches(enc, '^utf-?8', 'i'), false)",
    "catalog_sizes": f"""
        SELECT meta_id, CASE
            WHEN bytes / 1024.0 / 1024 / 1024 / 1024 / 1024 > 0.5 THEN {_TENTH.replace('x', '(bytes / 1024.0 / 1024 / 1024 / 1024 / 1024)')} || 'Pb'
            WHEN bytes / 1024.0 / 1024 / 1024 / 1024 > 0.5 THEN {_TENTH.replace('x', '(bytes / 1024.0 / 1024 / 1024 / 1024)')} || 'Tb'
            WHEN bytes / 1024.0 / 1024 / 1024 > 0.5 THEN {_TENTH.replace('x', '(bytes / 1024.0 / 1024 / 1024)')} || 'Gb'
            WHEN bytes / 1024.0 / 1024 > 0.5 THEN {_TENTH.replace('x', '(bytes / 1024.0 / 1024)')} || 'Mb'
            WHEN bytes / 1024.0 > 0.5 THEN {_TENTH.replace('x', '(bytes / 1024.0)')} || 'Kb'
            ELSE {_TENTH.replace('x', '(bytes * 1.0)')} || 'b' END AS human FROM meta""",
    "catalog_path_hierarchy": """
        SELECT array_to_string(parts[1:i], '/') AS ancestor, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes
        FROM (SELECT string_split(path, '/') AS parts, bytes, unnest(range(1, len(string_split(path, '/')) + 1)) AS i FROM meta) GROUP BY 1""",
    "catalog_layout": f"""
        WITH RECURSIVE ordered AS (SELECT cid, meta_id, bytes, row_number() OVER (PARTITION BY cid ORDER BY bytes, meta_id) AS r FROM meta),
        placed AS (
            SELECT cid, meta_id, r, CAST(0 AS BIGINT) AS bucket, bytes AS filled FROM ordered WHERE r = 1
            UNION ALL
            SELECT o.cid, o.meta_id, o.r, CASE WHEN p.filled > {BUCKET} THEN p.bucket + 1 ELSE p.bucket END, CASE WHEN p.filled > {BUCKET} THEN o.bytes ELSE p.filled + o.bytes END
            FROM placed p JOIN ordered o ON o.cid = p.cid AND o.r = p.r + 1)
        SELECT cid, meta_id, bucket FROM placed""",
    "catalog_size_by_type": r"""
        SELECT extension, bytes, round(bytes / sum(bytes) OVER (), 6) AS share FROM (
            SELECT lower(regexp_extract(file, '\.([A-Za-z0-9]+)$', 1)) AS extension, CAST(sum(bytes) AS BIGINT) AS bytes FROM meta GROUP BY 1)""",
    "manifest_not_loaded": "SELECT meta_id FROM meta WHERE sha256 IS NULL OR sha256 NOT IN (SELECT sha256 FROM manifest WHERE sha256 IS NOT NULL)",
    "manifest_loaded": "SELECT meta_id FROM meta WHERE sha256 IN (SELECT sha256 FROM manifest)",
    "manifest_latest": "SELECT sha256, max(filename) AS filename FROM manifest WHERE sha256 IS NOT NULL GROUP BY sha256",
    "manifest_update_files": "SELECT DISTINCT filename FROM manifest WHERE sha256 IS NOT NULL AND sha256 NOT IN (SELECT sha256 FROM meta WHERE batch = 0 AND sha256 IS NOT NULL)",
    "manifest_superseded": """
        SELECT DISTINCT filename FROM manifest WHERE filename NOT IN (
            SELECT max(filename) FROM manifest WHERE sha256 IS NOT NULL GROUP BY sha256)""",
}
