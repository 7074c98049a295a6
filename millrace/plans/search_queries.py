"""Queries in the search language over the decisions, restricted by who asks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.analyzers import ENGLISH_STOP, text_general, text_language, text_ws
from millrace.operators import access, index, search
from millrace.operators.ontology import flatten
from millrace.operators.tables import value_stats
from millrace.plans.ontology_queries import register_graphs
from millrace.session import table

#: Query texts, under the name of the query that runs them.
TEXTS = {
    "search_term": "schedule AND lang:en",
    "search_phrase": '"careful witness"',
    "search_wildcard": "mortg?ge OR inspec*",
    "search_fuzzy": "recept~1",
    "search_proximity": '"evidence was notice"~8',
    "search_bool": "(lease OR charter) AND NOT source:bulk_scan",
    "search_not": "*:* -guarantee",
    "search_required": "+deposit trust -warranty",
    "search_range": "n_chars:[1000 TO 2000}",
    "search_text_range": "court:[District TO High}",
    "search_date": "decided_on:2015-11",
    "search_date_range": "decided_on:[2016 TO 2017-03-15]",
    "search_exclusion_only": "-lang:en -lang:de",
    "search_escaped": r"ruling_no:\[20?8\]\ HCV*",
}
TERMS = ["guarantee", "trust", "deposit"]


def schema() -> search.Schema:
    fields = {
        "text": search.Field(F.col("text")),
        "lang": search.Field(F.col("lang"), "exact"),
        "source": search.Field(F.col("source"), "exact"),
        "court": search.Field(F.col("court"), "exact"),
        "ruling_no": search.Field(F.col("ruling_no"), "exact"),
        "n_chars": search.Field(F.col("n_chars"), "number"),
        "decided_on": search.Field(F.col("decided_on"), "date"),
    }
    return search.Schema(fields, ["text"])


def _run(text: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return search.search(table(spark, sf_dir, "documents"), text, schema()).select("doc_id", "lang")

    return run


def search_topk_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = search.bm25(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), TERMS)
    return search.top(scored.withColumn("score", F.round("score", 6)), 100, "doc_id")


BOOSTED = '(deposit^2 OR trust) "careful witness"^4 -charter'


def search_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query with boosts, answered from the index and scored."""
    built = index.TextIndex.build(table(spark, sf_dir, "documents"), "doc_id", F.col("text"))
    return built.search(BOOSTED).select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


def search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, a pattern and an exclusion, answered from the index."""
    built = index.TextIndex.build(table(spark, sf_dir, "documents"), "doc_id", F.col("text"))
    return built.search("(lease OR mortg?ge) AND NOT guarantee").select(F.col("id").alias("doc_id"))


def search_field_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.scored_fields(table(spark, sf_dir, "documents"), "lang:en^2 n_chars:[1000 TO 2000}^0.5", schema()).select("doc_id", "score")


def search_object_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened documents that have an address and a link of association."""
    flat = flatten(*register_graphs(spark, sf_dir))
    fields = {"object_types": search.Field(F.col("object_types"), "exact", multi=True), "link_types": search.Field(F.col("link_types"), "exact", multi=True)}
    return search.search(flat, "+object_types:Address +link_types:AssociatedWith", search.Schema(fields, ["object_types"])).select("doc_id")


def geo_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points made of keys within 3,000 km of one of them."""
    point = F.struct((F.col("c_custkey") % 170 - 85).cast("double").alias("lat"), (F.col("c_custkey") * 7 % 360 - 180).cast("double").alias("lon"))
    return index.within_distance(table(spark, sf_dir, "customer"), point, -33.0, 175.0, 3000.0).select("c_custkey", F.round("distance_km", 3).alias("km"))


def analyze_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each word of the English decisions occurs that is no stop word."""
    words = F.filter(text_general(F.col("text")), lambda w: ~w.isin(ENGLISH_STOP))
    return table(spark, sf_dir, "documents").filter("lang = 'en'").select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def analyze_german(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each stem of the German decisions occurs, without the common words of the language."""
    common = table(spark, sf_dir, "common_words").filter("lang = 'de'").select(F.lower("word")).distinct()
    stop = sorted(r[0] for r in common.collect())
    stems = table(spark, sf_dir, "documents").filter("lang = 'de'").select(F.explode(text_language(F.col("text"), "de", stop)).alias("stem"))
    return stems.groupBy("stem").agg(F.count("*").alias("n"))


def search_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = schema()
    widened = search.Schema(known.fields, known.default, {"tender": ["mortgage", "easement"]})
    return search.search(table(spark, sf_dir, "documents"), "tender", widened).select("doc_id", "lang")


def delete_by_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.without_matches(table(spark, sf_dir, "documents"), "lang:fr OR source:legacy_cd", schema()).select("doc_id", "lang")


def analyze_general(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text_general(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("distinct_words"))


def analyze_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "meta").filter("file is not null").select("meta_id", F.array_join(text_ws(F.col("file")), "|").alias("parts"))


def analyze_english(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each stemmed word of the English decisions occurs."""
    stems = table(spark, sf_dir, "documents").filter("lang = 'en'").select(F.explode(text_language(F.col("text"), "en")).alias("stem"))
    return stems.groupBy("stem").agg(F.count("*").alias("n"))


RULES = [access.Rule("blocked_sources", "sources", "deny_all"), access.Rule("languages", "langs", "require_one"), access.Rule("courts", "courts", "require_all")]
USERS = {
    "abac_deny_all": access.User("a", {"blocked_sources": ["bulk_scan", "legacy_cd"]}),
    "abac_require_one": access.User("b", {"languages": ["en", "fr"]}),
    "abac_require_all": access.User("c", {"courts": ["HCV"]}),
    "abac_unrestricted": access.User("d", {}),
}


def _restricted(user: access.User):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        held = docs.select("doc_id", F.array("source").alias("sources"), F.filter(F.array("lang"), lambda v: v.isNotNull()).alias("langs"), F.filter(F.array("court"), lambda v: v.isNotNull()).alias("courts"))
        return access.visible(held, user, RULES).select("doc_id")

    return run


def search_restricted_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user who may see English and French finds under a query, counted by language and source."""
    docs = table(spark, sf_dir, "documents").withColumn("langs", F.filter(F.array("lang"), lambda v: v.isNotNull()))
    seen = access.visible(docs, USERS["abac_require_one"], RULES[1:2])
    return value_stats(search.search(seen, TEXTS["search_bool"], schema()), ["lang", "source"])


QUERIES = {
    **{name: _run(text) for name, text in TEXTS.items()},
    **{name: _restricted(user) for name, user in USERS.items()},
    "search_topk_bm25": search_topk_bm25,
    "search_restricted_stats": search_restricted_stats,
    "search_synonyms": search_synonyms,
    "search_boosted": search_boosted,
    "search_indexed": search_indexed,
    "search_field_scores": search_field_scores,
    "search_object_types": search_object_types,
    "geo_near": geo_near,
    "analyze_words": analyze_words,
    "analyze_german": analyze_german,
    "delete_by_query": delete_by_query,
    "analyze_general": analyze_general,
    "analyze_whitespace": analyze_whitespace,
    "analyze_english": analyze_english,
}

_T = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_'']+')"


def _where(condition: str) -> str:
    return f"SELECT doc_id, lang FROM (SELECT *, {_T} AS t FROM documents) WHERE {condition}"


def _has(word: str) -> str:
    return f"coalesce(list_contains(t, '{word}'), false)"


_MOVES = "coalesce(list_min(list_transform(list_filter(range(1, len(t) + 1), lambda q: t[q] = '{0}'), lambda q: abs(q - (p + {1})))), 1048576)"
_STOPPED = ", ".join(f"'{w}'" for w in ENGLISH_STOP)
_IDF = "ln(1 + (n - {0} + 0.5) / ({0} + 0.5)) * {1} * 2.2 / ({1} + 1.2 * (0.25 + 0.75 * dl / av))"
_ADJACENT = "len(list_filter(range(1, len(t)), lambda i: t[i] = 'careful' AND t[i + 1] = 'witness'))"
SQL = {
    "search_boosted": f"""
        WITH d AS (SELECT doc_id, coalesce({_T}, []) AS t FROM documents),
        c AS (SELECT doc_id, len(t) AS dl, {", ".join(f"len(list_filter(t, lambda w: w = '{w}')) AS {w}" for w in ('deposit', 'trust', 'careful', 'witness', 'charter'))}, {_ADJACENT} AS phrase FROM d),
        a AS (SELECT count(*) AS n, avg(dl) AS av, {", ".join(f"count(*) FILTER ({w} > 0) AS df_{w}" for w in ('deposit', 'trust', 'careful', 'witness'))} FROM c)
        SELECT doc_id, round(CASE WHEN deposit > 0 THEN 2 * {_IDF.format('df_deposit', 'deposit')} ELSE 0 END + CASE WHEN trust > 0 THEN {_IDF.format('df_trust', 'trust')} ELSE 0 END
            + CASE WHEN phrase > 0 THEN 4 * {_IDF.format('least(df_careful, df_witness)', 'phrase')} ELSE 0 END, 6) AS score
        FROM c, a WHERE (deposit > 0 OR trust > 0 OR phrase > 0) AND charter = 0""",
    "search_indexed": f"SELECT doc_id FROM (SELECT *, {_T} AS t FROM documents) WHERE ({_has('lease')} OR len(list_filter(t, lambda w: regexp_full_match(w, 'mortg.ge'))) > 0) AND NOT {_has('guarantee')}",
    "search_field_scores": "SELECT doc_id, CASE WHEN lang = 'en' THEN 2.0 ELSE 0 END + CASE WHEN n_chars >= 1000 AND n_chars < 2000 THEN 0.5 ELSE 0 END AS score FROM documents WHERE coalesce(lang = 'en', false) OR coalesce(n_chars >= 1000 AND n_chars < 2000, false)",
    "search_object_types": "SELECT DISTINCT src_file_rec AS doc_id FROM testdata GROUP BY src_file_rec HAVING bool_or(nullif(trim(region), '') IS NOT NULL) AND bool_or(nullif(regexp_replace(telephone_number, '[^0-9]', '', 'g'), '') IS NOT NULL)",
    "geo_near": """
        WITH p AS (SELECT c_custkey, radians(c_custkey % 170 - 85) AS a, radians(c_custkey * 7 % 360 - 180) AS b FROM customer),
        d AS (SELECT c_custkey, 2 * 6371.0087714 * asin(sqrt(least(1, pow(sin((a - radians(-33)) / 2), 2) + cos(a) * cos(radians(-33)) * pow(sin((b - radians(175)) / 2), 2)))) AS km FROM p)
        SELECT c_custkey, round(km, 3) AS km FROM d WHERE km <= 3000""",
    "analyze_words": f"SELECT word, count(*) AS n FROM (SELECT unnest({_T}) AS word FROM documents WHERE lang = 'en') WHERE word NOT IN ({_STOPPED}) GROUP BY word",
    "analyze_german": f"""
        WITH w AS (SELECT unnest({_T}) AS word FROM documents WHERE lang = 'de'),
        k AS (SELECT replace(translate(word, 'äöü', 'aou'), 'ß', 'ss') AS word FROM w WHERE word NOT IN (SELECT lower(word) FROM common_words WHERE lang = 'de'))
        SELECT regexp_replace(word, '^(.{{4,}}?)(?:ern|em|er|en|es|e|s|n)$', '\\1') AS stem, count(*) AS n FROM k GROUP BY 1""",
    "search_synonyms": _where(f"{_has('tender')} OR {_has('mortgage')} OR {_has('easement')}"),
    "delete_by_query": "SELECT doc_id, lang FROM documents WHERE NOT coalesce(lang = 'fr', false) AND NOT coalesce(source = 'legacy_cd', false)",
    "analyze_general": f"SELECT doc_id, CAST(len({_T}) AS INTEGER) AS words, CAST(len(list_distinct({_T})) AS INTEGER) AS distinct_words FROM documents",
    "analyze_whitespace": r"SELECT meta_id, array_to_string(list_filter(regexp_split_to_array(file, '\s+'), lambda t: t <> ''), '|') AS parts FROM meta WHERE file IS NOT NULL",
    "search_term": _where(f"{_has('schedule')} AND lang = 'en'"),
    "search_phrase": _where("contains(' ' || array_to_string(t, ' ') || ' ', ' careful witness ')"),
    "search_wildcard": _where("len(list_filter(t, lambda w: regexp_full_match(w, 'mortg.ge|inspec.*'))) > 0"),
    "search_fuzzy": _where("len(list_filter(t, lambda w: abs(length(w) - 6) <= 1 AND octet_length(encode(w)) = length(w) AND levenshtein(w, 'recept') <= 1)) > 0"),
    "search_proximity": _where(f"len(list_filter(list_filter(range(1, len(t) + 1), lambda p: t[p] = 'evidence'), lambda p: {_MOVES.format('was', 1)} + {_MOVES.format('notice', 2)} <= 8)) > 0"),
    "search_bool": _where(f"({_has('lease')} OR {_has('charter')}) AND NOT coalesce(source = 'bulk_scan', false)"),
    "search_not": _where(f"NOT {_has('guarantee')}"),
    "search_required": _where(f"{_has('deposit')} AND NOT {_has('warranty')}"),
    "search_range": _where("n_chars >= 1000 AND n_chars < 2000"),
    "search_text_range": _where("court >= 'District' AND court < 'High'"),
    "search_date": _where("decided_on >= TIMESTAMP '2015-11-01' AND decided_on < TIMESTAMP '2015-12-01'"),
    "search_date_range": _where("decided_on >= TIMESTAMP '2016-01-01' AND decided_on < TIMESTAMP '2017-03-16'"),
    "search_exclusion_only": _where("NOT coalesce(lang = 'en', false) AND NOT coalesce(lang = 'de', false)"),
    "search_escaped": _where(r"regexp_full_match(ruling_no, '\[20.8\] HCV.*')"),
    "abac_deny_all": "SELECT doc_id FROM documents WHERE source IS NULL OR source NOT IN ('bulk_scan', 'legacy_cd')",
    "abac_require_one": "SELECT doc_id FROM documents WHERE lang IN ('en', 'fr')",
    "abac_require_all": "SELECT doc_id FROM documents WHERE court = 'HCV'",
    "abac_unrestricted": "SELECT doc_id FROM documents",
    "search_topk_bm25": f"""
        WITH d AS (SELECT doc_id, coalesce({_T}, []) AS t FROM documents),
        c AS (SELECT doc_id, len(t) AS dl, {', '.join(f"len(list_filter(t, lambda w: w = '{w}')) AS tf{i}" for i, w in enumerate(sorted(TERMS)))} FROM d),
        a AS (SELECT count(*) AS n, avg(dl) AS av, {', '.join(f'count(*) FILTER (tf{i} > 0) AS df{i}' for i in range(len(TERMS)))} FROM c)
        SELECT doc_id, round({' + '.join(f'ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * dl / av))' for i in range(len(TERMS)))}, 6) AS score
        FROM c, a WHERE {' OR '.join(f'tf{i} > 0' for i in range(len(TERMS)))} ORDER BY score DESC, doc_id LIMIT 100""",
    "search_restricted_stats": f"""
        WITH m AS ({_where(f"lang IN ('en', 'fr') AND ({_has('lease')} OR {_has('charter')}) AND NOT coalesce(source = 'bulk_scan', false)").replace('SELECT doc_id, lang', 'SELECT lang, source', 1)})
        SELECT 'lang' AS field, lang AS value, count(*) AS n FROM m WHERE lang IS NOT NULL GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM m WHERE source IS NOT NULL GROUP BY 2""",
}
