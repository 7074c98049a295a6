import base64
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import documents, ontology
from millrace.sources import processors


def test_separators():
    lines = ["ROW-1,a b,x", "ROW-2,c,y"]
    assert processors.detect_separator(lines) == "," and processors.detect_separator(lines, "ngram") == "ROW"
    assert processors.detect_separator(["a||b||c", "d||||e"]) == "||" and processors.detect_separator(["a#b", "c#d"]) == "#"
    assert processors.detect_separator(["abc", "de"]) is None and processors.detect_separator([]) is None
    assert processors.parse_header('Column_A;"b"\r\n', ";") == ["column_a", "b"]
    for bad in ("a b;c", "a;A"):
        with pytest.raises(ValueError):
            processors.parse_header(bad, ";")


def test_load_files(spark, tmp_path):
    (tmp_path / "00000001").mkdir()
    text = 'COLUMN_A,COLUMN_B,COLUMN_C\npen,red,4291\npencil,graphite\n\npen,"blue",100,more\n'
    (tmp_path / "00000001" / "t.csv").write_text(text)
    generic = processors.load_files(spark, str(tmp_path)).orderBy("src_file_row").collect()
    assert [(r.src_file_rec, r._load_error) for r in generic] == [
        ("00000001/t.csv:0", None), ("00000001/t.csv:1", None), ("00000001/t.csv:2", "Zero length line"), ("00000001/t.csv:3", "expecting 3 cells but got 4"),
    ]
    assert generic[1].cells == {"column_a": "pencil", "column_b": "graphite"} and base64.b64decode(generic[3]._line_b64encoded).decode() == 'pen,"blue",100,more'
    strict = processors.load_files(spark, str(tmp_path), "csv").orderBy("src_file_row").collect()
    assert [r._load_error for r in strict] == [None, "expecting 3 cells but got 2", "expecting 3 cells but got 4"]
    wide = processors.to_columns(processors.load_files(spark, str(tmp_path)), ["column_a", "column_c"])
    assert wide.filter("row is null").count() == 2 and wide.filter("column_c = '4291'").count() == 1
    (tmp_path / "00000001" / "u.csv").write_text("just\nwords")
    assert processors.load_files(spark, str(tmp_path)).filter("_load_error = 'no separator found'").count() == 1


def test_metadata(spark):
    registry = documents.MetadataRegistry()
    df = spark.createDataFrame([("r1", [7], " "), (None, [1], "x"), ("r3", [1, 2], "x")], "src_file_rec string, src_file_cid array<bigint>, src_file_src string")
    out = registry.validated(df).collect()
    assert out[0].src_file_rec == ["r1"] and out[0].src_file_cid == 7 and out[0].metadata_error == "src_file_src is empty"
    assert out[1].metadata_error == "src_file_rec is missing" and out[2].metadata_error == "src_file_cid has more than one value"
    assert [f.name for f in registry.schema()] == list(registry.example()) and not registry.schema()["src_file_rec"].nullable
    markings = spark.createDataFrame([(7, " Owner "), (8, "x" * 40)], "cid int, owner_external string")
    records = spark.createDataFrame([(7, "own"), (8, "own"), (9, None)], "src_file_cid int, src_file_src string")
    assert sorted((r.src_file_cid, r.src_file_src) for r in registry.with_markings(records, markings).collect()) == [(7, "OWNER"), (8, "own"), (9, None)]


def test_documents(spark):
    records = spark.createDataFrame([(["10/a:1"], 10, "Ann Lee", "5"), (["10/a:2"], 10, None, "6")], "src_file_rec array<string>, src_file_cid bigint, name string, n string")

    def build(df, doc_id):
        return ontology.build_graphs(df, doc_id, [ontology.node(1, "Person", F.upper("name"), surname=ontology.one(F.lower("name"))), ontology.node(2, "PhoneNumber", F.when(F.col("name").isNotNull(), F.col("n")))], [ontology.link(1, "AssociatedWith", 2)])

    out = {r.src_file_rec[0]: r for r in documents.search_documents(records, build).collect()}
    first, second = out["10/a:1"], out["10/a:2"]
    assert first.fields["Person_ss"] == ["ANN LEE"] and json.loads(first.raw) == {"n": "5", "name": "Ann Lee"} and first.link_types == ["AssociatedWith"] and len(first.id) == 64
    assert second.object_types == ["Unknown"] and second.fields["Unknown_ss"] == [second.id]
    nodes, edges = build(records, F.col("src_file_rec")[0])
    data = documents.compact_graph(nodes, edges).first().data
    assert json.loads(data) == ["Person", "ANN LEE", [["surname", "ann lee"]], [["AssociatedWith", [], ["PhoneNumber", "5", [], []]]]]
    failed = spark.createDataFrame([("bad", base64.b64encode("a;ü".encode()).decode())], "_load_error string, _line_b64encoded string")
    assert documents.failed_lines_as_unknown(failed).first().raw_line == "a;ü"
