"""Queries over single values: checks, normal forms, identifiers, and matching by n-grams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import values
from millrace.functions.analyzers import char_ngrams, text_general
from millrace.operators import fuzzy, validation
from millrace.operators.ontology import document_id
from millrace.session import table


def _testdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "testdata")


def validate_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = values.digits(F.col("telephone_number"))
    return _testdata(spark, sf_dir).select("src_file_rec", checked["value"].alias("value"), checked["error"].alias("error"))


def validate_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses made of names; those with spaces, accents and the like are none."""
    checked = values.email(F.concat(F.lower("name"), F.lit("@example.com")))
    return _testdata(spark, sf_dir).select("src_file_rec", checked["value"].alias("value"), checked["error"].alias("error"))


def validate_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = values.gender(F.left("name", F.lit(1)))
    return _testdata(spark, sf_dir).select("src_file_rec", checked["value"].alias("value"), checked["error"].alias("error"))


def validate_geoloc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates made of keys, some of them out of range."""
    point = F.concat_ws(",", (F.col("c_custkey") % 200 - 100).cast("string"), (F.col("c_custkey") % 400 - 200).cast("string"))
    checked = values.geoloc(point)
    return table(spark, sf_dir, "customer").select("c_custkey", checked["value"]["lat"].alias("lat"), checked["value"]["lon"].alias("lon"), checked["error"].alias("error"))


def person_name_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _testdata(spark, sf_dir).select("src_file_rec", values.surname(F.col("name")).alias("label"))


def person_name_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as given names and brands as family names."""
    name = values.person_name(F.col("p_name"), F.col("p_brand"), F.lit(None).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", name["value"].alias("label"), name["error"].alias("error"))


def csv_clean_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _testdata(spark, sf_dir).select("src_file_rec", values.blank_to_null(F.col("name")).alias("name"), values.blank_to_null(F.col("region")).alias("region"))


def quotes_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "testdata_lines").select("line_id", values.strip_quotes(F.col("line")).alias("line"))


def addresses_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    address = F.concat(F.coalesce("name", F.lit("")), F.lit(",  , "), F.coalesce("region", F.lit("")), F.lit(" , "))
    return _testdata(spark, sf_dir).select("src_file_rec", values.address_clean(address).alias("address"))


def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _testdata(spark, sf_dir).select("src_file_rec", document_id(F.col("cid"), F.array("src_file_rec")).alias("id"))


def edit_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.levenshtein("p_name", "p_type").alias("distance"))


def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = _testdata(spark, sf_dir).filter("region is not null").select(F.explode(char_ngrams(F.col("region"), 1, 3)).alias("gram"))
    return grams.groupBy("gram").agg(F.count("*").alias("n"))


def tfidf_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as typed, without their second letter, matched to the regions in lower case."""
    regions = _testdata(spark, sf_dir).filter("trim(region) <> ''")
    known = regions.select(F.lower(F.trim("region")).alias("name")).distinct().withColumn("output", F.col("name"))
    return fuzzy.best_match(regions.select(F.concat(F.left("region", F.lit(1)), F.substring("region", 3, 1000)).alias("query")), known)


def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions taken for countries, looked up by name as typed, by code, or by a former name."""
    regions = _testdata(spark, sf_dir)
    name = F.lower(F.trim("region"))
    dimension = regions.filter("trim(region) <> ''").select(name.alias("name")).distinct()
    dimension = dimension.select(F.upper(F.left(F.md5(F.encode("name", "utf-8")), F.lit(8))).alias("code"), F.lit(None).cast("string").alias("alpha3"), "name", F.array(F.concat(F.lit("former "), "name")).alias("aliases"))
    typed = F.when(F.col("cid") % 3 == 0, F.concat(F.lit("Former "), "region")).otherwise(F.col("region"))
    found = validation.country_of(regions.withColumn("typed", typed), "typed", dimension, fuzzy=False)
    return found.select("src_file_rec", "country_code", "country_error")


def spell_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the markings' titles without their second letter, corrected by those titles."""
    titles = table(spark, sf_dir, "cat_markings")
    known = fuzzy.vocabulary(titles, text_general(F.col("title")))
    broken = known.select(F.concat(F.left("word", F.lit(1)), F.substring("word", 3, 100)).alias("word"))
    return fuzzy.spelling(broken, known)


QUERIES = {
    f.__name__: f
    for f in [
        validate_digits, validate_email, validate_gender, validate_geoloc, person_name_unknown, person_name_known, csv_clean_values, quotes_stripped, addresses_cleaned, doc_ids,
        edit_distances, ngram_counts, tfidf_match, country_names, spell_correct,
    ]
}

_EMAIL = r"^[A-Za-z0-9.!#$%&''*+/=?^_`{|}~-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+$"


def _checked(value: str, ok: str, message: str, source: str = "testdata", key: str = "src_file_rec") -> str:
    return f"SELECT {key}, CASE WHEN coalesce({ok}, false) THEN v END AS value, CASE WHEN v IS NOT NULL AND NOT coalesce({ok}, false) THEN '{message}' END AS error FROM (SELECT {key}, {value} AS v FROM {source})"


SQL = {
    "validate_digits": _checked("telephone_number", "regexp_full_match(v, '[0-9]*')", "not all digits"),
    "validate_email": _checked("lower(name) || '@example.com'", f"regexp_matches(v, '{_EMAIL}')", "not an email address"),
    "validate_gender": _checked("upper(left(name, 1))", "v IN ('M', 'F')", "not a gender"),
    "validate_geoloc": """
        SELECT c_custkey, CASE WHEN ok THEN lat END AS lat, CASE WHEN ok THEN lon END AS lon, CASE WHEN NOT ok THEN 'not a latitude and longitude' END AS error
        FROM (SELECT *, lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AS ok FROM (
            SELECT c_custkey, CAST(c_custkey % 200 - 100 AS DOUBLE) AS lat, CAST(c_custkey % 400 - 200 AS DOUBLE) AS lon FROM customer))""",
    "person_name_unknown": r"SELECT src_file_rec, upper(trim(regexp_replace(name, '[^\p{L}\p{N}_]+', ' ', 'g'))) AS label FROM testdata",
    "person_name_known": r"""
        SELECT p_partkey, nullif(trim(concat_ws(' ', nullif(array_to_string(list_transform(list_filter(regexp_split_to_array(p_name, '[[:punct:]\s]+'), lambda w: w <> ''), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' '), ''),
            nullif(upper(trim(regexp_replace(p_brand, '[^\p{L}\p{N}_]+', ' ', 'g'))), ''))), '') AS label, CAST(NULL AS VARCHAR) AS error FROM part""",
    "csv_clean_values": r"""
        SELECT src_file_rec, CASE WHEN regexp_replace(name, '^[\s''"]+|[\s''"]+$', '', 'g') <> '' THEN name END AS name,
            CASE WHEN regexp_replace(region, '^[\s''"]+|[\s''"]+$', '', 'g') <> '' THEN region END AS region FROM testdata""",
    "quotes_stripped": """
        SELECT line_id, CASE WHEN length(line) >= 2 AND left(line, 1) = right(line, 1) AND left(line, 1) IN ('''', '"') THEN substr(line, 2, length(line) - 2) ELSE line END AS line
        FROM testdata_lines""",
    "addresses_cleaned": r"""
        SELECT src_file_rec, regexp_replace(regexp_replace(regexp_replace(coalesce(name, '') || ',  , ' || coalesce(region, '') || ' , ', '\s+', ' ', 'g'), '(?:\s*,)+', ',', 'g'), '[,\s]+$', '') AS address
        FROM testdata""",
    "doc_ids": "SELECT src_file_rec, sha256(cid || src_file_rec) AS id FROM testdata",
    "edit_distances": "SELECT p_partkey, CAST(levenshtein(p_name, p_type) AS INTEGER) AS distance FROM part",
    "country_names": """
        SELECT src_file_rec, CASE WHEN trim(region) <> '' THEN upper(left(md5(lower(trim(region))), 8)) WHEN cid % 3 = 0 THEN NULL END AS country_code,
            CASE WHEN trim(region) = '' AND cid % 3 = 0 THEN 'not a country' END AS country_error FROM testdata""",
    "ngram_counts": """
        SELECT substr(region, i, n) AS gram, count(*) AS n FROM (
            SELECT region, n, unnest(range(1, length(region) - n + 2)) AS i FROM testdata, (SELECT unnest([1, 2, 3]) AS n) WHERE region IS NOT NULL) GROUP BY 1""",
    "tfidf_match": r"""
        WITH q AS (SELECT DISTINCT left(region, 1) || substr(region, 3) AS query FROM testdata WHERE trim(region) <> ''),
        k AS (SELECT DISTINCT lower(trim(region)) AS output FROM testdata WHERE trim(region) <> ''),
        sizes AS (SELECT unnest([2, 3]) AS n),
        qg AS (SELECT query, substr(s, i, n) AS gram, count(*) AS asked FROM (SELECT query, s, n, unnest(range(1, length(s) - n + 2)) AS i FROM (SELECT query, regexp_replace(lower(query), '\s+', '', 'g') AS s FROM q), sizes) GROUP BY ALL),
        ng AS (SELECT output, substr(s, i, n) AS gram FROM (SELECT output, s, n, unnest(range(1, length(s) - n + 2)) AS i FROM (SELECT output, regexp_replace(output, '\s+', '', 'g') AS s FROM k), sizes)),
        p AS (SELECT *, count(*) OVER (PARTITION BY gram) AS postings FROM ng),
        scored AS (SELECT query, output, round(sum(asked * length(gram) / postings) / greatest(1, levenshtein(regexp_replace(lower(query), '\s+', '', 'g'), regexp_replace(output, '\s+', '', 'g'))), 9) AS score
            FROM qg JOIN p USING (gram) GROUP BY query, output)
        SELECT query, output, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, output) AS r FROM scored) WHERE r = 1""",
    "spell_correct": r"""
        WITH known AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(title), '[\p{L}\p{N}_'']+')) AS word FROM cat_markings) GROUP BY word),
        asked AS (SELECT DISTINCT left(word, 1) || substr(word, 3) AS word FROM known),
        near AS (SELECT a.word, k.word AS candidate, k.n FROM asked a JOIN known k ON damerau_levenshtein(a.word, k.word) <= 1),
        best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY candidate = word DESC, n DESC, candidate) AS r FROM near)
        SELECT a.word, CASE WHEN b.candidate <> a.word THEN b.candidate END AS correction FROM asked a LEFT JOIN best b ON a.word = b.word AND b.r = 1""",
}
