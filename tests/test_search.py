import datetime

import pytest

from millrace.functions import search_parser as sp
from millrace.functions.analyzers import path_ancestors, text_cjk, text_general, text_language, word_parts
from millrace.functions.stemming import stem
from millrace.operators import access, search
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, ["Brad Pitt", "test text"], [datetime.datetime(2000, 11, 30, 23, 59)], 5.0, "red"),
        (2, ["Bradley Cooper", "terrorist tempest"], [datetime.datetime(2014, 12, 1, 12)], 15.0, "blue"),
        (3, ["foam roams"], [datetime.datetime(2015, 1, 1)], None, "red"),
        (4, ["a b", "c d"], None, 25.0, None),
        (5, None, None, None, "foams"),
    ]
    return spark.createDataFrame(rows, "id int, Person_ss array<string>, seen_dts array<timestamp_ntz>, n double, colour string")


def schema(**synonyms):
    fields = {"Person_ss": search.Field(F.col("Person_ss"), "text", True), "seen_dts": search.Field(F.col("seen_dts"), "date", True), "n": search.Field(F.col("n"), "number"), "colour": search.Field(F.col("colour"), "exact")}
    return search.Schema(fields, ["Person_ss"], synonyms)


def ids(docs, query, **synonyms):
    return sorted(r.id for r in search.search(docs, query, schema(**synonyms)).collect())


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("te?t", [1]), ("te*t", [1, 2]), ("*est", [1, 2]), ("roam~1", [3]), ("Person:Brad", [1]), ("Person:Brad*", [1, 2]),
        ("seen:2000-11", [1]), ("seen:[2014 TO 2014-12-01]", [2]), ("seen:{2014 TO *]", [3]), ("seen:2016", []),
        ("n:[5 TO 15]", [1, 2]), ("n:{5 TO 15]", [2]), ("colour:red", [1, 3]), ("colour:r*", [1, 3]),
        ('"a b"', [4]), ('"b c"', []), ('"b a"~2', [4]), ('"b a"~1', []),
        ("brad OR foam", [1, 3]), ("brad foam", [1, 3]), ("+brad foam", [1]), ("brad AND pitt", [1]), ("bradley AND foam OR brad", []),
        ("*:* -colour:red", [2, 4, 5]), ("-colour:red", [2, 4, 5]), ("NOT colour:red", [2, 4, 5]), ("foam (-roams)", [3]), ("(brad OR foam) AND !pitt", [3]),
        ("test^2 foam", [1, 3]), ("", []), ("nothing", []), (r"Person:\(brad\)", [1]), ("Person:(brad foam)", [1, 3]),
    ],
)
def test_queries(docs, query, expected):
    assert ids(docs, query) == expected


def test_synonyms(docs):
    assert ids(docs, "froth", froth=["foam"]) == [3]


@pytest.mark.parametrize("query", ["(a", "a)", '"a', "AND a", "a OR", "f:", "[a TO", "missing:x"])
def test_errors(docs, query):
    with pytest.raises(sp.QueryError):
        ids(docs, query)


def test_facets_and_delete(docs):
    assert [tuple(r) for r in search.facets(docs, F.col("colour")).collect()] == [("red", 2), ("blue", 1), ("foams", 1)]
    assert sorted(r.id for r in search.without_matches(docs, "colour:red", schema()).collect()) == [2, 4, 5]


def test_top_pins_and_excludes(spark):
    scored = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 2.0), (4, 3.0)], "id int, score double")
    assert [r.id for r in search.top(scored, 3, "id", pinned=[1], excluded=[2]).collect()] == [1, 4, 3]


def test_params_and_users(spark):
    ok = access.parse_params("q=a%3Db&rows=10&wt=json&facet=")
    assert access.check_params(ok) == {"q": ["a=b"], "rows": ["10"], "wt": ["json"]}
    for bad in ("q=a", "q=a&wt=json&fq=x", "wt=json&rows=30000", "wt=json&rows=x"):
        with pytest.raises(access.Refused):
            access.check_params(access.parse_params(bad))
    table = spark.createDataFrame([("u", "a", [" x ", "Y", "y"]), ("v", "a", [])], "user string, attr string, values array<string>")
    assert access.load_user(table, "u").attributes == {"a": ["X", "Y"]}
    with pytest.raises(access.Refused):
        access.load_user(table, "nobody")


def test_restrictions(spark):
    df = spark.createDataFrame([(1, ["A", "B"]), (2, ["B"]), (3, None)], "id int, f array<string>")
    run = lambda kind, values: sorted(r.id for r in access.visible(df, access.User("u", {"a": values}), [access.Rule("a", "f", kind)]).collect())
    assert run("deny_all", ["A"]) == [2, 3] and run("require_one", ["A", "Z"]) == [1] and run("require_all", ["A", "B"]) == [1]
    assert run("require_all", []) == [1, 2, 3]


def test_analyzers(spark):
    df = spark.createDataFrame([("L'eau des Plongeurs",), ("running Dogs' PowerShot-500",), ("東京都 ABC",), (None,)], "t string")
    out = df.select(text_general("t").alias("g"), text_language(F.col("t"), "fr", {"des"}).alias("fr"), text_language(F.col("t"), "en").alias("en"), word_parts(F.col("t")).alias("w"), text_cjk(F.col("t")).alias("c")).collect()
    assert out[0].g == ["l'eau", "des", "plongeurs"] and out[0].fr == ["eau", "plongeur"]
    assert out[1].en[:2] == ["run", "dog"] and out[1].w == ["running", "dogs", "power", "shot", "500", "powershot500"]
    assert out[2].c == ["東京", "京都", "abc"] and out[3].g is None
    assert spark.range(1).select(path_ancestors(F.lit("a/b/c")).alias("p")).first().p == ["a", "a/b", "a/b/c"]


def test_stemmer():
    pairs = {"caresses": "caress", "ponies": "poni", "hopping": "hop", "relational": "relat", "conflated": "conflat", "happy": "happi", "sky": "sky", "controlling": "control", "adjustable": "adjust", "probate": "probat", "rate": "rate", "feed": "feed", "agreed": "agre", "generalizations": "gener", "vietnamization": "vietnam"}
    assert {w: stem(w) for w in pairs} == pairs
