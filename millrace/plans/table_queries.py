"""Queries over record tables: splitting, collapsing, joining by key, counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import short_marking
from millrace.operators import search, tables
from millrace.session import table
from millrace.streaming.incremental import windowed_counts


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"large": F.col("value") > 90, "purchases": F.col("event_type") == "purchase", "clicks": F.col("event_type") == "click"}
    return tables.label_tables(table(spark, sf_dir, "events"), rules).groupBy("table_name").agg(F.count("*").alias("n"))


def collapse_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tables.collapse_by_key(table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus"), "o_custkey")
    return out.select("o_custkey", F.array_join("o_orderpriority", "|").alias("priorities"), F.array_join("o_orderstatus", "|").alias("statuses"))


def collapse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    out = tables.collapse_records(rows, "l_orderkey", ["l_linenumber", "l_partkey"])
    text = F.transform("records", lambda r: F.concat_ws(":", r["l_linenumber"].cast("string"), r["l_partkey"].cast("string")))
    return out.select("l_orderkey", F.array_join(text, ",").alias("records"))


def _keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return tables.join_by_key({"customer": (table(spark, sf_dir, "customer"), "c_custkey"), "orders": (table(spark, sf_dir, "orders"), "o_custkey")})


def outer_join_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers whose key the other table doesn't have."""
    keyed = {"supplier": (table(spark, sf_dir, "supplier"), "s_suppkey"), "customer": (table(spark, sf_dir, "customer"), "c_custkey")}
    return tables.join_by_key(keyed)[0].select("supplier_key", "customer_key")


def outer_join_all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir)[1].select("customer_key", F.col("orders_records")["o_orderkey"].cast("bigint").alias("o_orderkey"), F.col("customer_records")["c_name"].alias("c_name"))


def key_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.key_overlap({"part": (table(spark, sf_dir, "part"), "p_partkey"), "lineitem": (table(spark, sf_dir, "lineitem"), "l_partkey"), "supplier": (table(spark, sf_dir, "supplier"), "s_suppkey")})


def key_overlap_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.key_overlap_shares({"part": (table(spark, sf_dir, "part"), "p_partkey"), "supplier": (table(spark, sf_dir, "supplier"), "s_suppkey")})


def heaviest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.heaviest_key(table(spark, sf_dir, "lineitem"), "l_partkey")


def describe_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.describe_tables({n: table(spark, sf_dir, n) for n in ("nation", "region", "supplier")})


def result_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.value_stats(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def facet_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facets(table(spark, sf_dir, "documents"), F.col("lang"))


def facet_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facets(table(spark, sf_dir, "events"), F.col("event_type"))


def load_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.error_counts(table(spark, sf_dir, "loaded"))


def unloaded_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed rows with the line that they were, decoded."""
    failed = table(spark, sf_dir, "loaded").filter("_load_error is not null")
    return failed.select("src_file_rec", "_load_error", F.decode(F.unbase64("_line_b64encoded"), "utf-8").alias("raw_line"))


def markings_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register rows with the marking of their dataset; an owner of 32 characters or more is no marking."""
    owner = short_marking(F.col("owner_external"))
    markings = table(spark, sf_dir, "cat_markings").select("cid", owner["value"].alias("src_file_src"))
    return table(spark, sf_dir, "testdata").join(markings, "cid", "left").groupBy("src_file_src").agg(F.count("*").alias("n"))


def events_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type")


QUERIES = {
    f.__name__: f
    for f in [
        split_counts, collapse_by_key, collapse_records, outer_join_missing, outer_join_all_keys, key_overlap, key_overlap_shares, heaviest_key, describe_tables, result_stats, facet_lang, facet_event_type,
        load_error_counts, unloaded_records, markings_join, events_by_hour,
    ]
}

_FACET = "SELECT {0} AS value, count(*) AS n FROM {1} WHERE {0} IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 100"
SQL = {
    "split_counts": """
        SELECT CASE WHEN value > 90 THEN 'large' WHEN event_type = 'purchase' THEN 'purchases' WHEN event_type = 'click' THEN 'clicks' ELSE 'unused_records' END AS table_name, count(*) AS n
        FROM events GROUP BY 1""",
    "collapse_by_key": """
        SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS priorities, array_to_string(list_sort(list(DISTINCT o_orderstatus)), '|') AS statuses
        FROM orders GROUP BY o_custkey""",
    "collapse_records": "SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS records FROM lineitem GROUP BY l_orderkey",
    "outer_join_missing": "SELECT s_suppkey AS supplier_key, c_custkey AS customer_key FROM supplier FULL JOIN customer ON s_suppkey = c_custkey WHERE s_suppkey IS NULL OR c_custkey IS NULL",
    "key_overlap_shares": """
        WITH k AS (SELECT DISTINCT p_partkey AS key, 'part' AS name FROM part UNION SELECT DISTINCT s_suppkey, 'supplier' FROM supplier),
        t AS (SELECT string_agg(name, ',' ORDER BY name) AS tables FROM k GROUP BY key),
        c AS (SELECT tables, count(*) AS keys FROM t GROUP BY tables)
        SELECT tables, keys, CASE WHEN tables LIKE '%part%' THEN keys / (SELECT count(*) FROM part) END AS share_part, CASE WHEN tables LIKE '%supplier%' THEN keys / (SELECT count(*) FROM supplier) END AS share_supplier FROM c""",
    "outer_join_all_keys": "SELECT c_custkey AS customer_key, o_orderkey, c_name FROM customer JOIN orders ON c_custkey = o_custkey",
    "key_overlap": """
        SELECT tables, count(*) AS keys FROM (
            SELECT key, string_agg(DISTINCT name, ',' ORDER BY name) AS tables FROM (
                SELECT p_partkey AS key, 'part' AS name FROM part UNION ALL SELECT l_partkey, 'lineitem' FROM lineitem UNION ALL SELECT s_suppkey, 'supplier' FROM supplier)
            WHERE key IS NOT NULL GROUP BY key) GROUP BY tables""",
    "heaviest_key": "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 1",
    "describe_tables": """
        SELECT 'nation' AS name, count(*) AS n, 'n_nationkey,n_name,n_regionkey' AS columns FROM nation
        UNION ALL SELECT 'region', count(*), 'r_regionkey,r_name' FROM region
        UNION ALL SELECT 'supplier', count(*), 's_suppkey,s_name,s_nationkey,s_acctbal' FROM supplier""",
    "result_stats": """
        SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 2""",
    "facet_lang": _FACET.format("lang", "documents"),
    "facet_event_type": _FACET.format("event_type", "events"),
    "load_error_counts": "SELECT _load_error, count(*) AS n FROM loaded WHERE _load_error IS NOT NULL GROUP BY 1",
    "unloaded_records": "SELECT src_file_rec, _load_error, decode(from_base64(_line_b64encoded)) AS raw_line FROM loaded WHERE _load_error IS NOT NULL",
    "markings_join": """
        SELECT src_file_src, count(*) AS n FROM testdata LEFT JOIN (
            SELECT cid, CASE WHEN length(upper(trim(owner_external))) < 32 THEN upper(trim(owner_external)) END AS src_file_src FROM cat_markings) USING (cid) GROUP BY 1""",
    "events_by_hour": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
