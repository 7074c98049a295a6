import math
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions import search_parser as sp
from millrace.operators import access, index, search

TEXTS = {1: "The quick brown fox jumps", 2: "quick quick dog", 3: "a brown dog, a brown fox and the quick end", 4: None, 5: "", 6: "foxes roam"}


@pytest.fixture(scope="module")
def built(spark):
    rows = spark.createDataFrame([*TEXTS.items(), (None, "fox")], "id bigint, text string")
    return index.TextIndex.build(rows, "id", F.col("text"), buckets=4)


def bm25(n, df, tf, length, mean):
    return math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))


@pytest.mark.parametrize(
    ("query", "ids"),
    [
        ("fox", {1, 3}), ("quick AND dog", {2, 3}), ('"brown fox"', {1, 3}), ('"fox brown"', set()), ('"quick fox"~2', {1}), ("dog -fox", {2}), ("fox*", {1, 3, 6}), ("roa~1", {6}),
        ("(fox OR dog) AND brown", {1, 3}), ("*:* -quick", {4, 5, 6}), ("nothing", set()), ("roam^3 fox", {1, 3, 6}), ("qu?ck dog~1", {1, 2, 3, 6} - {6}),
    ],
)
def test_same_as_the_scan(spark, built, query, ids):
    assert {r.id for r in built.search(query).collect()} == ids
    rows = spark.createDataFrame(list(TEXTS.items()), "id bigint, text string")
    scanned = search.search(rows, query, search.Schema({"text": search.Field(F.col("text"))}, ["text"]))
    assert {r.id for r in scanned.collect()} == ids


def test_scores_and_boosts(built):
    mean = (5 + 3 + 10 + 0 + 0 + 2) / 6
    plain = {r.id: r.score for r in built.search("quick dog").collect()}
    boosted = {r.id: r.score for r in built.search("quick dog^2.5").collect()}
    quick, dog = bm25(6, 3, 2, 3, mean), bm25(6, 2, 1, 3, mean)
    assert plain[2] == pytest.approx(quick + dog) and boosted[2] == pytest.approx(quick + 2.5 * dog) and boosted[1] == pytest.approx(plain[1])
    nested = {r.id: r.score for r in built.search("(quick dog)^2").collect()}
    assert nested[2] == pytest.approx(2 * plain[2])


def test_only_the_words_files_are_read(built):
    plan = built.postings(["fox"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "[bucket") or "bucket" in plan and "In(term" in plan or "EqualTo(term" in plan


def test_guard():
    for text in ("-fox", "NOT a", "name:*", ""):
        with pytest.raises(sp.QueryError):
            index.check_query(text)
    index.check_query("fox -dog")


def test_scores_of_fields(spark):
    rows = spark.createDataFrame([(1, "en", 5), (2, "fr", 5), (3, "en", 9)], "id int, lang string, n int")
    schema = search.Schema({"lang": search.Field(F.col("lang"), "exact"), "n": search.Field(F.col("n"), "number")}, ["lang"])
    got = {r.id: r.score for r in index.scored_fields(rows, "lang:en^2 n:[1 TO 6]^0.5", schema).collect()}
    assert got == {1: 2.5, 2: 0.5, 3: 2.0}


def test_geo(spark):
    rows = spark.createDataFrame([(1, (-33.946, 151.177)), (2, (-37.008, 174.79)), (3, (0.0, 179.9)), (4, (0.0, -179.9)), (5, None), (6, (89.9, 10.0))], "id int, p struct<lat:double,lon:double>")
    near = lambda *a: {r.id for r in index.within_distance(rows, F.col("p"), *a).collect()}
    assert near(-33.9, 151.2, 50) == {1} and near(-33.9, 151.2, 2300) == {1, 2} and near(0.0, 180.0, 30) == {3, 4} and near(89.9, -170.0, 40) == {6}


def test_synonyms_and_elevation():
    known = index.read_synonyms(["# words", "Couch, sofa", "tv => television", "", "a,b => b, c"])
    assert known == {"couch": ["sofa"], "sofa": ["couch"], "tv": ["television"], "a": ["b", "c"], "b": ["c"]}
    xml = '<elevate><query text="Foo bar"><doc id="1"/><doc id="2" exclude="true"/></query></elevate>'
    assert index.read_elevation(xml) == {"foo bar": (["1"], ["2"])}


def test_time_limit_and_log(spark):
    assert access.within_time(spark, 60, lambda: spark.range(10).count()) == 10
    with pytest.raises(access.Refused, match="took longer"):
        access.within_time(spark, 0.5, lambda: spark.range(1 << 38, numPartitions=4).agg(F.sum(F.sin("id"))).collect())
    rows = spark.createDataFrame([("en",), ("en",), (None,)], "lang string")
    log = access.response_log(rows, rows.limit(2), "u", "q", ["lang"], time.time()).first()
    assert (log.found, log.returned, log.user) == (3, 2, "u") and log.millis >= 0
    twice = spark.createDataFrame([("u", "a", ["x"], 1), ("u", "a", ["y"], 2)], "user string, attr string, values array<string>, entry int")
    with pytest.raises(access.Refused, match="more than one"):
        access.load_user(twice, "u")
