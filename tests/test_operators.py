import bz2
import gzip
import io
import json
import tarfile
import zipfile

from pyspark.sql import functions as F

from millrace.functions import values
from millrace.operators import catalog, fuzzy, manifest, ontology, tables
from millrace.sources import scan
from millrace.streaming.incremental import load_stream


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_manifest_case(spark):
    df = spark.createDataFrame([("a", "h1"), ("a", "h2"), ("b", "h2"), ("b", "h3"), ("c", "h1"), ("c", "h2"), ("d", None)], "filename string, sha256 string")
    indexed = spark.createDataFrame([("h1",), ("h2",)], "sha256 string")
    assert {tuple(r) for r in manifest.latest_file(df).collect()} == {("h1", "c"), ("h2", "c"), ("h3", "b")}
    assert {r[0] for r in manifest.current_files(df).collect()} == {"b", "c"}
    assert {r[0] for r in manifest.superseded_files(df).collect()} == {"a", "d"}
    assert {r[0] for r in manifest.files_to_update(df, indexed).collect()} == {"b"}


def test_layout(spark):
    sizes = [5, 1, 2, 9, 3, None, 4]
    df = spark.createDataFrame([("x", i, s) for i, s in enumerate(sizes)] + [("y", 0, 7)], "g string, i int, bytes bigint")
    got = {(r.g, r.i): r.bucket for r in catalog.layout(df, "bytes", ["i"], 4, ["g"]).collect()}
    assert got == {("x", 5): 0, ("x", 1): 0, ("x", 2): 0, ("x", 4): 0, ("x", 6): 1, ("x", 0): 1, ("x", 3): 2, ("y", 0): 0}
    assert catalog.layout(df.limit(0), "bytes").count() == 0


def test_pair_filter(spark):
    df = spark.createDataFrame([(1, "text/csv", None), (2, "image/png", "x"), (3, None, "MIME=TEXT/")], "id int, mime string, note string")
    run = lambda *e: [r.id for r in catalog.filter_catalog(df, list(e)).orderBy("id").collect()]
    assert run("mime=text/.*") == [1, 3] and run("!mime=text/.*") == [2] and run("mime=", "!note=") == [1]


def test_update_and_merge(spark):
    schema = "path string, file string, bytes bigint, mtime string, sha256 string, est_lines bigint"
    known = spark.createDataFrame([("p", "same", 1, "t", "h", 9), ("p", "grown", 1, "t", "g", 9), ("p", "gone", 1, "t", "k", 9)], schema)
    scanned = spark.createDataFrame([("p", "same", 1, "t", None, None), ("p", "grown", 2, "t", None, None), ("p", "new", 1, "t", None, None)], schema)
    got = {r.file: (r.sha256, r.rescan) for r in catalog.merge_update(scanned, known).collect()}
    assert got == {"same": ("h", False), "grown": (None, True), "new": (None, True)}
    assert catalog.merge_catalogs(known, known, ["path", "file"]).count() == 3
    assert catalog.valid_column_names(["a_1", "B", "c d"]) == ["B", "c d"]


def test_exact_match_and_members(spark):
    df = spark.createDataFrame([("a", "z.zip"), ("a/z.zip", "m"), ("a", "z.zip")], "path string, file string")
    wanted = spark.createDataFrame([("a/z.zip",), ("none",)], "full_path string")
    assert {(r.full_path, r.found) for r in catalog.exact_match(df, wanted).collect()} == {("a/z.zip", 2), ("none", 0)}
    assert catalog.members_of(df, "a/z.zip").count() == 1


def test_split_and_join(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    parts = tables.split_tables(df, {"first": F.col("k") < 3, "second": F.col("v") == "b"}, {"first": {"v": "w"}})
    assert {n: p.count() for n, p in parts.items()} == {"first": 2, "second": 0, "unused_records": 1} and parts["first"].columns == ["k", "w"]
    other = spark.createDataFrame([(2, "x"), (4, "y")], "k int, z string")
    missing, whole = tables.join_by_key({"a": (df, "k"), "b": (other, "k")})
    assert missing.count() == 3 and [(r.a_key, r.b_records["z"]) for r in whole.collect()] == [(2, "x")]
    assert {tuple(r) for r in tables.value_stats(spark.createDataFrame([(["a", "b"], "c"), (["a"], None)], "x array<string>, y string"), ["x", "y"]).collect()} == {("x", "a", 2), ("x", "b", 1), ("y", "c", 1)}


def test_values(spark):
    lit = F.lit
    assert one(spark, values.email(lit("bart.simpson@provider.com"))["error"]) is None
    for bad in ("1234", "cat", "1234@domain.com@really"):
        assert one(spark, values.email(lit(bad))["error"])
    assert one(spark, values.phone_e164(lit("AU:0291234567"))["value"]) == "61291234567" and one(spark, values.phone_e164(lit("1234"))["error"])
    assert one(spark, values.phone_e164(lit("+61 2 9123 4567"))["value"]) == "61291234567"
    none = lit(None).cast("string")
    assert one(spark, values.person_name(lit("namey MCNAMA"), none, none)["value"]) == "Namey Mcnama"
    assert one(spark, values.person_name(lit("namey MCNAM"), lit("FACE    face"), none)["value"]) == "Namey Mcnam FACE FACE"
    assert one(spark, values.person_name(none, lit("FACE"), none)["value"]) == "FACE"
    assert one(spark, values.person_name(none, none, lit("BLAH mc blah BLAH"))["value"]) == "BLAH MC BLAH BLAH"
    assert one(spark, values.person_name(lit("a"), none, lit("b"))["error"]) and one(spark, values.person_name(none, none, none)["error"])
    assert one(spark, values.geoloc(lit("-33.9, 151.1"))["value"]["lon"]) == 151.1 and one(spark, values.geoloc(lit("91,0"))["error"]) and one(spark, values.geoloc(none)["error"]) is None
    assert one(spark, values.human_size(lit(1000))) == "1.0Kb" and one(spark, values.human_size(lit(300))) == "300.0b"
    assert one(spark, values.strip_quotes(lit("'a'"))) == "a" and one(spark, values.strip_quotes(lit("'"))) == "'" and one(spark, values.strip_quotes(lit("'a\""))) == "'a\""
    assert one(spark, values.blank_to_null(lit(" '\" "))) is None and one(spark, values.blank_to_null(lit(" a "))) == " a "
    assert one(spark, values.short_marking(lit(" owner "))["value"]) == "OWNER" and one(spark, values.short_marking(lit("x" * 32))["error"])
    assert abs(one(spark, values.distance_km(lit(0.0), lit(0.0), lit(0.0), lit(180.0))) - 20015.1) < 0.1


def test_document_id(spark):
    assert one(spark, ontology.document_id(F.lit(10), F.array(F.lit("10/test_data.csv:10")))) == "6daf5bc24d75fe36d25700633359fbe7c166d66ef19fc8eba236fa8670e7fa40"


def test_flight(spark):
    record = ("10/t.csv:1", "17/04/1979", "Some Name", "N123", "AU", "syd", "2016-01-01T10:00:00Z", "AKL", "2016-01-01T13:00:00Z")
    flights = spark.createDataFrame([record], "rec string, dob string, name string, passport_no string, passport_country string, departure_port string, departure_time string, arrival_port string, arrival_time string")
    ports = spark.createDataFrame([("SYD", "Sydney Intl", "Sydney", "AU", -33.946111, 151.177222), ("AKL", "Auckland Intl", "Auckland", "NZ", -37.008056, 174.791667)], "code string, name string, city string, country string, lat double, lon double")
    nodes, edges = ontology.flight_graphs(flights, ports, F.col("rec"))
    assert ontology.link_errors(nodes, edges).count() == 0 and ontology.attribute_errors(nodes).count() == 0 and ontology.acyclic(edges)
    doc = ontology.flatten(nodes, edges).first()
    assert doc.object_types == ["Airport", "Entity", "Event", "Flight", "IssuedDocument", "Location", "Passport", "Person", "Port"]
    assert doc.link_types == ["Arrived", "Departed", "Holds", "Travelled"]
    assert doc.fields["Person_ss"] == ["SOME NAME"] == doc.fields["Entity_ss"] and doc.fields["dob_dts"] == ["1979-04-17T00:00:00Z"]
    assert doc.fields["Airport_ss"] == ["Auckland Intl (AKL)", "Sydney Intl (SYD)"] == doc.fields["Port_ss"]
    assert doc.fields["geoloc"] == ["-33.946111,151.177222", "-37.008056,174.791667"] and doc.fields["Airport.country_ss"] == ["AU", "NZ"]
    unknown, links = ontology.flight_graphs(flights.withColumn("arrival_port", F.lit("XXX")), ports, F.col("rec"))
    assert unknown.count() == 4 and links.count() == 3
    circle = spark.createDataFrame([("d", 1, 2), ("d", 2, 1)], "doc_id string, src int, dst int")
    assert not ontology.acyclic(circle)


def test_registry():
    registry = ontology.REGISTRY
    assert registry.ancestors("Airport") == ["Airport", "Port", "Location"] and "dob" in registry.attributes("Person")
    legal = set(registry.legal())
    assert ("Person", "Holds", False, "Passport") in legal and ("Passport", "Holds", True, "Person") in legal and ("Passport", "Holds", False, "Person") not in legal
    assert ("Email", "AssociatedWith", False, "Person") in legal and ("Person", "AssociatedWith", False, "Email") in legal
    assert {"country", "type", "timestamp"} <= registry.shared_attributes() and "dob" not in registry.shared_attributes()
    assert "| Person | Entity |" in registry.markdown()


def test_fuzzy(spark):
    names = spark.createDataFrame([("Australia", "Australia"), ("Austria", "Austria"), ("Oz land", "Australia")], "name string, output string")
    queries = spark.createDataFrame([("Australian",), ("oz  land",), ("zzqq",), (None,)], "query string")
    assert {r.query: r.output for r in fuzzy.best_match(queries, names).collect()} == {"Australian": "Australia", "oz  land": "Australia"}
    known = spark.createDataFrame([("form", 5), ("from", 9), ("farm", 2)], "word string, n bigint")
    words = spark.createDataFrame([("form",), ("frm",), ("fromm",), ("xyz",), ("frmo",), (None,)], "word string")
    assert {r.word: r.correction for r in fuzzy.spelling(words, known).collect()} == {"form": None, "frm": "from", "fromm": "from", "xyz": None, "frmo": "from"}


def test_scan(spark, tmp_path):
    folder = tmp_path / "00000001"
    folder.mkdir()
    (folder / "a.csv").write_text("x\ny\nz")
    (folder / "empty.txt").write_text("")
    (folder / "g.txt.gz").write_bytes(gzip.compress("grün\n".encode()))
    inner = io.BytesIO()
    with tarfile.open(fileobj=inner, mode="w") as t:
        info = tarfile.TarInfo("in.txt")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
    with zipfile.ZipFile(folder / "z.zip", "w") as z:
        z.writestr("t.tar", inner.getvalue())
        z.writestr("nothing", "")
    (folder / "bad.zip").write_bytes(b"PK\x03\x04 broken")
    (folder / "b.7z").write_bytes(b"7z\xbc\xaf\x27\x1c...")
    rows = {(r.path, r.file): r for r in scan.scan(spark, str(tmp_path)).collect()}
    assert set(rows) == {
        ("00000001", "a.csv"), ("00000001", "g.txt.gz"), ("00000001/g.txt.gz", "g.txt"), ("00000001", "z.zip"), ("00000001/z.zip", "t.tar"),
        ("00000001/z.zip/t.tar", "in.txt"), ("00000001", "bad.zip"), ("00000001", "b.7z"), ("00000001", "empty.txt"),
    }
    assert rows[("00000001", "a.csv")].est_lines == 3 and rows[("00000001", "a.csv")].mime == "text/csv"
    assert scan.file_type(b"") == ("inode/x-empty", "binary")
    assert rows[("00000001/g.txt.gz", "g.txt")].enc == "utf-8" and [a.kind for a in rows[("00000001/z.zip/t.tar", "in.txt")].access_path] == ["file", "zip", "x-tar".removeprefix("x-")]
    assert rows[("00000001", "bad.zip")].error and rows[("00000001", "b.7z")].error
    out = str(tmp_path / "catalog")
    scan.write_catalog(scan.scan(spark, str(folder.parent)).drop("access_path"), out)
    assert spark.read.parquet(out).count() == 9


def test_json_lines_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    scan.write_json_lines(df, str(tmp_path / "j"))
    files = list((tmp_path / "j").glob("*.bz2"))
    assert files and sorted(line for f in files for line in bz2.open(f, "rt").read().splitlines()) == ['{"x":"a"}', '{"x":"b","y":"c"}']
    assert scan.read_json_lines(spark, [str(tmp_path / "j")]).count() == 2
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "out1.json").write_text(json.dumps(["h1", "h2"]))
    (tmp_path / "m" / "12.json").write_text(json.dumps([]))
    assert {tuple(r) for r in scan.read_manifest(spark, str(tmp_path / "m")).collect()} == {("out1", "h1"), ("out1", "h2")}
    (tmp_path / "k").mkdir()
    (tmp_path / "k" / "7.json").write_text(json.dumps({"owner": "X"}))
    assert [(r.cid, r.owner) for r in scan.read_markings(spark, str(tmp_path / "k" / "*.json")).collect()] == [(7, "X")]


def test_stream_loads_once(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()

    def run():
        load_stream(spark, str(source), "sha256 string, v int", str(target), str(tmp_path / "cp")).awaitTermination(120)
        return sorted((r.sha256 or "", r.v) for r in spark.read.parquet(*[str(p) for p in target.glob("batch=*")]).select("sha256", "v").collect())

    (source / "1.json").write_text('{"sha256":"a","v":1}\n{"sha256":"b","v":2}\n{"v":3}\n')
    assert run() == [("", 3), ("a", 1), ("b", 2)]
    (source / "2.json").write_text('{"sha256":"b","v":9}\n{"sha256":"c","v":4}\n')
    assert run() == [("", 3), ("a", 1), ("b", 2), ("c", 4)]


def test_spelling_two_edits(spark):
    def edits(word):
        splits = [(word[:i], word[i:]) for i in range(len(word) + 1)]
        return {a + b[1:] for a, b in splits if b} | {a + b[1] + b[0] + b[2:] for a, b in splits if len(b) > 1} | {a + c + b[k:] for a, b in splits for c in "abcd" for k in (0, 1) if b or not k}

    known = {"abcd": 3, "dcba": 2, "ab": 5, "bdacb": 2, "cccc": 1, "acbd": 1, "dabcab": 4}
    asked = ["bcda", "abdc", "badc", "ca", "dc", "bacdb", "ccdd", "dddd", "abcd", "cabd", "bdcab", "dbacba", "a", "ddabca", "cacbbd"]

    def correct(word):
        near = edits(word)
        for found in ({word} & set(known), near & set(known), {w for e in near for w in edits(e)} & set(known)):
            if found:
                best = min(found, key=lambda w: (-known[w], w))
                return None if best == word else best
        return None

    got = {r.word: r.correction for r in fuzzy.spelling(spark.createDataFrame([(w,) for w in asked], "word string"), spark.createDataFrame(list(known.items()), "word string, n long")).collect()}
    assert got == {w: correct(w) for w in asked}
