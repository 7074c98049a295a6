"""Queries over the training-text operators, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.history import repeated_records
from millrace.llm.leakage import find_leaks
from millrace.llm.linking import link_parties, linked_pairs
from millrace.llm.mojibake import find_garbled
from millrace.llm.packing import pack_texts, packing_report
from millrace.llm.quality import text_quality
from millrace.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_garbled(table(spark, sf_dir, "meta")).select("meta_id").distinct()


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every garbled head or file name with its cause and the text as it was first written, where it can be had."""
    return find_garbled(table(spark, sf_dir, "meta"))


def p2_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled records that hold a replacement character, other than a single one at the very end of head."""
    meta = table(spark, sf_dir, "meta")
    found = find_garbled(meta).select("meta_id").distinct()
    held = meta.filter(F.contains(F.regexp_replace("head", "\ufffd$", ""), F.lit("\ufffd")) | F.contains("file", F.lit("\ufffd")))
    return found.join(held.select("meta_id").distinct(), "meta_id", "left_semi")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_pairs(table(spark, sf_dir, "testdata"))


def p3_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row_urn with the party that it belongs to."""
    return link_parties(table(spark, sf_dir, "testdata"))


def p3_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names typed alike under one number typed alike, with the number of parties that they were taken for: one each."""
    rows = table(spark, sf_dir, "testdata").select("row_urn", "name", "telephone_number").filter("name rlike '[A-Za-z]' and length(regexp_replace(telephone_number, '[^0-9]', '')) >= 6")
    parties = link_parties(table(spark, sf_dir, "testdata"))
    return rows.join(parties, "row_urn").groupBy("name", "telephone_number").agg(F.countDistinct("party").alias("parties"))


def p4_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated records whose checksum was accepted before."""
    meta = table(spark, sf_dir, "meta")
    firsts = meta.filter("bytes > 0 and sha256 is not null").groupBy("sha256").agg(F.min("meta_id").alias("first"))
    known = meta.join(firsts, "sha256").filter("first < meta_id").select(F.col("meta_id").alias("meta_id_b"))
    return repeated_records(meta).join(known, "meta_id_b", "left_semi").select(F.col("meta_id_b").alias("meta_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_records(table(spark, sf_dir, "meta"))


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every text, or piece of text, under each budget."""
    return pack_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "token_budgets"))


def p6_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and unused space under each budget."""
    return packing_report(p6_containers(spark, sf_dir))


def p6_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per budget: texts that have a place, containers that hold more than they may, texts that were cut although they
    fit, and texts whose pieces leave out or repeat a token."""
    placed = p6_containers(spark, sf_dir)
    budget = ["budget_id", "capacity_tokens"]
    full = placed.groupBy(*budget, "container_id").agg(F.sum("n_tokens").alias("held")).groupBy(*budget).agg(F.count_if(F.col("held") > F.col("capacity_tokens")).alias("overfull"))
    texts = placed.groupBy(*budget, "doc_id", "copy").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"), F.countDistinct("first_token").alias("starts"))
    cut = F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity_tokens"))).alias("cut_although_fitting")
    torn = F.count_if((F.col("end") != F.col("tokens")) | (F.col("starts") != F.col("pieces"))).alias("torn")
    return full.join(texts.groupBy(*budget).agg(F.count("*").alias("texts"), cut, torn), budget)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id")


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items they give away, with the share of the item's words."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p7_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the items that they give away letter for letter."""
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = find_leaks(documents, items).select("doc_id", "item_id")
    both = found.join(documents.select("doc_id", "text"), "doc_id").join(items.select("item_id", F.col("text").alias("item")), "item_id")
    return both.filter(F.contains("text", "item") & (F.trim("item") != "")).select("doc_id", "item_id").distinct()


def p8_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, characters a word and share of common words of every document."""
    rated = text_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))
    return rated.select("doc_id", F.col("n_words").cast("bigint").alias("n_words"), F.round("mean_word_length", 6).alias("mean_word_length"), F.round("common_word_share", 6).alias("common_word_share"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = text_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))
    return rated.filter("not is_prose").select("doc_id").distinct()


def p8_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of every document with the probability that it is prose."""
    return text_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))


QUERIES = {
    "p2_found": p2_found,
    "p2_restored": p2_restored,
    "p2_replaced": p2_replaced,
    "p3_found": p3_found,
    "p3_equal": p3_equal,
    "p3_parties": p3_parties,
    "p4_found": p4_found,
    "p4_checksums": p4_checksums,
    "p6_containers": p6_containers,
    "p6_unused": p6_unused,
    "p6_checked": p6_checked,
    "p7_found": p7_found,
    "p7_shares": p7_shares,
    "p7_verbatim": p7_verbatim,
    "p8_found": p8_found,
    "p8_statistics": p8_statistics,
    "p8_words": p8_words,
}

SQL: dict[str, str] = {
    "p2_replaced": "SELECT DISTINCT meta_id FROM meta WHERE coalesce(contains(regexp_replace(head, '\ufffd$', ''), '\ufffd'), false) OR coalesce(contains(file, '\ufffd'), false)",
    "p3_equal": """
        SELECT name, telephone_number, CAST(1 AS BIGINT) AS parties FROM testdata
        WHERE row_urn IS NOT NULL AND regexp_matches(name, '[A-Za-z]') AND length(regexp_replace(telephone_number, '[^0-9]', '', 'g')) >= 6 GROUP BY name, telephone_number""",
    "p4_checksums": """
        SELECT DISTINCT meta_id FROM meta JOIN (SELECT sha256, min(meta_id) AS first FROM meta WHERE bytes > 0 AND sha256 IS NOT NULL GROUP BY sha256) USING (sha256) WHERE first < meta_id AND bytes > 0 AND batch >= 1""",
    "p6_checked": """
        SELECT DISTINCT budget_id, capacity_tokens, CAST(0 AS BIGINT) AS overfull, (SELECT count(*) FROM documents) AS texts, CAST(0 AS BIGINT) AS cut_although_fitting, CAST(0 AS BIGINT) AS torn
        FROM token_budgets WHERE capacity_tokens >= 1""",
    "p7_verbatim": "SELECT DISTINCT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE trim(b.text) <> '' AND len(regexp_extract_all(b.text, '[\\p{L}\\p{N}]+')) >= 10",
    "p8_words": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t, trim(text, E' \t\n\r') <> '' AS filled FROM documents),
        c AS (SELECT list(DISTINCT lower(word)) AS common FROM common_words WHERE word IS NOT NULL)
        SELECT doc_id, CASE WHEN filled THEN len(t) END AS n_words, CASE WHEN filled THEN round(coalesce(list_sum(list_transform(t, lambda x: length(x))), 0) / greatest(len(t), 1), 6) END AS mean_word_length,
            CASE WHEN filled THEN round(len(list_filter(t, lambda x: list_contains(common, x))) / greatest(len(t), 1), 6) END AS common_word_share FROM w, c""",
}
