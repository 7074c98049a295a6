import pytest
from pyspark.sql import functions as F

from millrace.operators import documents, fuzzy, ontology, tables, validation

NODES = "doc_id string, node_id int, type string, label string, attrs map<string,array<string>>"


def test_values_by_type(spark):
    rows = [
        ("a", 1, "Person", "BART", {"dob": ["1979-04-17", "17/04/1979"], "gender": ["m", None, " "], "platform": ["x"]}), ("b", 1, "Email", "1234@domain.com@really", {}), ("c", 1, "Email", "bart.simpson@provider.com", None),
        ("d", 1, "Airport", "SYD", {"geoloc": ["-33.9, 151.2", "95,0"], "city": ["Sydney"]}), ("e", 1, "Person", " ", {"dob": ["yesterday"]}), ("f", 1, "Nothing", "x", {"a": ["b"]}),
    ]
    got = {r.doc_id: r for r in validation.validated(spark.createDataFrame(rows, NODES)).collect()}
    assert got["a"].attrs == {"dob": ["1979-04-17T00:00:00Z"], "gender": ["M"]} and [(e.field, e.error) for e in got["a"].errors] == [("platform", "no such attribute")]
    assert got["b"].label is None and got["b"].errors[0].error == "not an email address" and got["c"].errors == [] and got["c"].attrs == {}
    assert got["d"].attrs == {"geoloc": ["-33.9,151.2"], "city": ["Sydney"]} and got["d"].errors[0].value == "95,0"
    assert [(e.field, e.error) for e in got["e"].errors] == [("label", "no label"), ("dob", "not a date")] and got["f"].errors[0].error == "no such attribute"
    assert validation.validated(spark.createDataFrame([], NODES)).count() == 0


COUNTRIES = [("AU", "AUS", "Australia", []), ("NZ", "NZL", "New Zealand", ["Aotearoa"]), ("MM", "MMR", "Myanmar", ["Burma"]), ("TL", "TLS", "Timor-Leste", None)]


def test_countries(spark):
    dimension = spark.createDataFrame(COUNTRIES, "code string, alpha3 string, name string, aliases array<string>")
    rows = spark.createDataFrame([("Australian",), ("  new   ZEALAND ",), ("burma",), ("aus",), ("tl",), ("oz",), ("qqq",), (None,), (" ",)], "c string")
    got = {r.c: (r.country_code, r.country_error) for r in validation.country_of(rows, "c", dimension, {"OZ": "AU"}).collect()}
    assert got == {
        "Australian": ("AU", None), "  new   ZEALAND ": ("NZ", None), "burma": ("MM", None), "aus": ("AU", None), "tl": ("TL", None), "oz": ("AU", None), "qqq": (None, "not a country"), None: (None, None), " ": (None, None),
    }
    assert validation.country_of(rows, "c", dimension, fuzzy=False).filter("c = 'Australian'").first().country_error == "not a country"
    nodes = spark.createDataFrame([("a", 1, "Country", "Australia", {}), ("b", 1, "Person", "Australia", {"dob": ["x"]})], NODES)
    assert {r.doc_id: r.attrs for r in validation.enrich_countries(nodes, dimension).collect()} == {"a": {"country": ["AU"]}, "b": {"dob": ["x"]}}


def test_addresses(spark):
    nodes = spark.createDataFrame([("a", 1, "Address", "1 Main St, Sydney, nsw 2000", {}), ("b", 1, "Address", "somewhere", {"state": ["x"]}), ("c", 1, "Person", "a, NSW 2000", {}), ("d", 1, "Address", None, {})], NODES)
    got = {r.doc_id: (r.label, r.attrs) for r in validation.enrich_addresses(nodes, {"NSW": "New South Wales"}).collect()}
    assert got["a"] == ("1 MAIN ST, SYDNEY", {"state": ["New South Wales"], "postcode": ["2000"]}) and got["b"] == ("SOMEWHERE", {"state": ["x"]}) and got["c"][0] == "a, NSW 2000" and got["d"] == (None, {})


def test_repeated_grams_count(spark):
    """aaaa holds aa three times; each place of the query meets each place of the name."""
    names = spark.createDataFrame([("aaaa", "aaaa"), ("xx", "other")], "name string, output string")
    got = fuzzy.best_match(spark.createDataFrame([("aaa",)], "query string"), names).first()
    assert (got.output, got.score) == ("aaaa", pytest.approx(2 * 3 * 2 / 3 + 1 * 2 * 3 / 2))
    alias = fuzzy.best_match(spark.createDataFrame([("xx",)], "query string"), names).first()
    assert (alias.output, alias.score) == ("other", pytest.approx(2 / 5))


def test_long_chains_and_deep_objects(spark):
    n = 130
    nodes = spark.createDataFrame([("a", i, "Object", f"o{i}", {}) for i in range(1, 10)], NODES)
    edges = "doc_id string, src int, link_type string, reversed boolean, attrs map<string,array<string>>, dst int"
    chain = spark.createDataFrame([("a", i, "Located", False, {}, i + 1) for i in range(1, n)], edges)
    assert ontology.acyclic(chain.filter("src < 12"))
    data = documents.compact_graph(nodes, chain.filter("dst < 10")).first().data
    assert data.count("Located") == 8 and "o9" in data
    with pytest.raises(ValueError, match="circle"):
        documents.compact_graph(nodes, spark.createDataFrame([("a", 1, "Located", False, {}, 2), ("a", 2, "Located", False, {}, 1)], edges))


def test_hooks(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n{"x": 0}\n')
    read = documents.load_dataset(spark, [str(tmp_path)], preprocess=lambda df: df.filter("x is not null"))
    assert read.count() == 2 and documents.load_dataset(spark, [], lambda s, paths: s.range(3)).count() == 3
    made = documents.built_by(read, lambda r: {"y": 1 / r["x"]}, "y double", debug=True)
    assert sorted((r.y or 0, r.build_error) for r in made.collect()) == [(0, "ZeroDivisionError: division by zero"), (1.0, None)]
    with pytest.raises(Exception, match="division by zero"):
        documents.built_by(read, lambda r: {"y": 1 / r["x"]}, "y double").collect()
    nodes, _ = documents.name_graphs(spark.createDataFrame([("1", "homer"), ("2", " ")], "id string, n string"), F.col("id"), F.col("n"))
    assert {(r.doc_id, r.type, r.label) for r in nodes.collect()} == {("1", "Person", "HOMER"), ("2", "Entity", "UNKNOWN")}


def test_text_of_values(spark):
    row = spark.createDataFrame([("a", 1, [1, 2], None, True)], "s string, i int, l array<int>, n int, b boolean")
    assert tables.key_by(row, "t", "s").first().t_records == {"s": "a", "i": "1", "l": "[1,2]", "n": None, "b": "true"}
    assert spark.createDataFrame([({"a": "x", "b": "", "c": None, "d": " "},)], "m map<string,string>").select(tables.without_empty(F.col("m"))).first()[0] == {"a": "x"}


def test_flattening_within_the_row_is_the_same(spark):
    rows = spark.createDataFrame([("1", "a", "2020-01-01T00:00:00Z", "1,2"), ("1", "b", None, None), ("2", "", None, "3,4"), ("3", None, None, None)], "id string, n string, t string, g string")
    nodes = [
        ontology.node(1, "Person", F.nullif(F.col("n"), F.lit("")), dob=ontology.one(F.col("t"))), ontology.node(2, "Airport", F.col("g"), geoloc=ontology.one(F.col("g")), country=ontology.one(F.lit("AU"))),
    ]
    links = [ontology.link(1, "Located", 2, timestamp=ontology.one(F.col("t")))]
    plain = lambda df: sorted((r.doc_id, r.object_types, r.link_types, r.attr_types, sorted(r.fields.items())) for r in df.collect())
    here = plain(ontology.flatten_rows(ontology.graph_rows(rows, F.col("id"), nodes, links)))
    assert here == plain(ontology.flatten(*ontology.build_graphs(rows, F.col("id"), nodes, links))) and len(here) == 2
    assert ontology.flatten_rows(ontology.graph_rows(rows.limit(0), F.col("id"), nodes, [])).count() == 0
