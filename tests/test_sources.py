import io
import random
import shutil
import subprocess
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import processors, scan


def lzw(data: bytes, most: int = 16) -> bytes:
    """As compress writes it: groups of eight codes, block mode, no clearing."""
    table, width, bits, size, taken = {bytes([i]): i for i in range(256)}, 9, 0, 0, 0
    count, entry = 257, b""

    def put(code):
        nonlocal bits, size, taken
        bits, size, taken = bits | code << size, size + width, taken + 1

    for i in range(len(data)):
        longer = entry + data[i : i + 1]
        if longer in table:
            entry = longer
            continue
        put(table[entry])
        if count < 1 << most:
            table[longer] = count
            count += 1
            if count > 1 << width and width < most:
                size += -taken % 8 * width
                width, taken = width + 1, 0
        entry = data[i : i + 1]
    if entry:
        put(table[entry])
    return b"\x1f\x9d" + bytes([128 | most]) + bits.to_bytes((size + 7) // 8, "little")


@pytest.mark.parametrize("text", [b"", b"a", b"aaaaaaaaaa" * 50, bytes(random.Random(1).choices(b"abcd \n", k=40_000)), bytes(random.Random(2).randbytes(9000))])
def test_lzw(text):
    packed = lzw(text)
    if shutil.which("gzip") and text:
        assert subprocess.run(["gzip", "-dc"], input=packed, capture_output=True, check=True).stdout == text
    assert scan.unlzw(packed) == text


def test_lzw_that_is_broken():
    for data in (b"", b"\x1f\x9d", b"\x1f\x9d\xff\x00", b"\x1f\x9d\x90\xff\xff\xff\xff"):
        with pytest.raises(ValueError):
            scan.unlzw(data)


def test_deep_archives_carry_an_error(spark, tmp_path):
    data, name = b"text", "in.txt"
    for n in range(scan.MAX_DEPTH + 2):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(name, data)
        data, name = out.getvalue(), f"z{n}.zip"
    (tmp_path / "deep.zip").write_bytes(data)
    (tmp_path / "a b.Z").write_bytes(lzw(b"one\ntwo\n"))
    rows = {r.file: r for r in scan.scan(spark, str(tmp_path)).collect()}
    assert [r.error for r in rows.values() if r.error] == [f"archives within archives beyond {scan.MAX_DEPTH}"] and "in.txt" not in rows
    assert rows["a b"].bytes == 8 and rows["a b"].access_path[-1].kind == "compress"


def test_a_container_of_ones_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan, "MAGIC", list(scan.MAGIC))
    monkeypatch.setattr(scan, "CONTAINERS", dict(scan.CONTAINERS))
    scan.register_container("application/x-own", b"OWN!", lambda content, name: iter([("part", content[4:], None)]))
    rows = list(scan.catalog_rows("p", "f.own", b"OWN!hello\n", None, []))
    assert [(r["file"], r["mime"]) for r in rows] == [("f.own", "application/x-own"), ("part", "text/plain")]


def test_csv_goes_on_after_long_cells_and_failed_records():
    text = 'A,B\n1,"' + "x" * 300_000 + '"\n2\n"3\nmore",4,5\n6,7\n'
    rows = list(processors.csv_rows(text))
    assert [bool(c) for c, _, _ in rows] == [True, False, False, True] and len(rows[0][0]["b"]) == 300_000
    assert rows[1][2] == "2" and rows[2][2] == '"3\nmore",4,5' and rows[3][0] == {"a": "6", "b": "7"}


def test_quoted_cells():
    cut = lambda line: processors.quoted_cells(line, ",", '"')
    assert cut('a,"b,c",d') == ["a", "b,c", "d"] and cut('"x ""y""",') == ['x "y"', ""] and cut('5" pipe,"open') == ['5" pipe', '"open'] and cut("") == [""] and cut('"a" b,c') == ['"a" b', "c"]
    rows = list(processors.generic_rows('A;B\r1;"2;3"\r', ";", '"', "\r"))
    assert rows == [({"a": "1", "b": "2;3"}, None, '1;"2;3"')]


def test_filters_catalogue_and_datasets(spark, tmp_path):
    for cid in ("00000001", "00000002"):
        (tmp_path / cid).mkdir()
        (tmp_path / cid / "a.csv").write_bytes("NAME,B\nké,1\n".encode("cp1252"))
    (tmp_path / "00000001" / "b.bin").write_bytes(b"\0\1\2,\n")
    folder = str(tmp_path)
    assert {r.src_file_rec for r in processors.load_files(spark, folder, "csv").collect()} == {"00000001/a.csv:0", "00000002/a.csv:0"}
    catalog = scan.scan(spark, folder)
    got = processors.load_files(spark, folder, "csv", catalog=catalog, cid=2).collect()
    assert [(r.src_file_rec, r.cells["name"]) for r in got] == [("00000002/a.csv:0", "ké")]
    none = catalog.withColumn("est_lines", F.lit(0).cast("bigint"))
    assert processors.load_files(spark, folder, "csv", catalog=none).count() == 0
    one = catalog.filter("file = 'a.csv'")
    with pytest.raises(ValueError, match="selected by a and b"):
        processors.no_overlap({"a": one, "b": one})
    processors.no_overlap({"a": one, "b": catalog.filter("file = 'b.bin'")})
    scan.write_selection(one, f"{folder}/out")
    assert spark.read.json(f"{folder}/out").count() == 2


def cpio_member(name, data, mode=0o100644):
    numbers = [1, mode, 0, 0, 1, 1_000_000_000, len(data), 0, 0, 0, 0, len(name) + 1, 0]
    head = b"070701" + b"".join(b"%08X" % n for n in numbers) + name.encode() + b"\0"
    fill = lambda b: b + b"\0" * (-len(b) % 4)
    return fill(head) + fill(data)


def test_more_containers():
    cpio = cpio_member("dir", b"", 0o040755) + cpio_member("a.txt", b"hello") + cpio_member("empty", b"") + cpio_member("TRAILER!!!", b"", 0)
    rows = list(scan.catalog_rows("p", "x.cpio", cpio, None, []))
    assert [(r["file"], r["bytes"]) for r in rows] == [("x.cpio", len(cpio)), ("a.txt", 5)]
    assert list(scan.catalog_rows("p", "x.cpio", cpio[:200], None, []))[0]["error"]
    member = lambda name, data: name.encode().ljust(16) + b"1000000000".ljust(12) + b"0     0     100644  " + str(len(data)).encode().ljust(10) + b"`\n" + data + b"\n" * (len(data) % 2)
    ar = b"!<arch>\n" + member("//", b"a_name_longer_than_sixteen.txt/\n") + member("/0", b"one") + member("b.txt/", b"four")
    assert [r["file"] for r in scan.catalog_rows("p", "x.a", ar, None, [])] == ["x.a", "a_name_longer_than_sixteen.txt", "b.txt"]
    import lzma

    assert [r["file"] for r in scan.catalog_rows("p", "x.txt.xz", lzma.compress(b"text"), None, [])] == ["x.txt.xz", "x.txt"]


def test_members_of_unchanged_archives_are_carried_over(spark, tmp_path):
    from millrace.operators.catalog import merge_update

    for name in ("same", "other"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("in.txt", name)
    known = spark.createDataFrame(scan.scan(spark, str(tmp_path)).collect(), scan.CATALOG)
    again = known.filter("size(access_path) = 0").withColumn("bytes", F.when(F.col("file") == "other.zip", F.col("bytes") + 1).otherwise(F.col("bytes")))
    got = {(r.path, r.file): r for r in merge_update(again, known).collect()}
    assert set(got) == {(".", "same.zip"), ("./same.zip", "in.txt"), (".", "other.zip")} or set(got) == {("", "same.zip"), ("/same.zip", "in.txt"), ("", "other.zip")}
    assert [r.rescan for r in got.values() if r.file == "other.zip"] == [True] and all(not r.rescan and r.sha256 for r in got.values() if r.file != "other.zip")


def test_airports_and_names(spark):
    from millrace.functions.values import person_attributes
    from millrace.operators.ontology import airports

    ports = spark.createDataFrame([("SYD", "Sydney Intl", "Sydney", "AU", -33.9, 151.2)], "code string, name string, city string, country string, lat double, lon double")
    rows = spark.createDataFrame([("syd",), ("XXX",), ("toolong",), (None,)], "p string")
    assert [(r.a_label, r.a_error) for r in airports(rows, ports, "p", "a").collect()] == [("Sydney Intl (SYD)", None), (None, "unknown airport"), (None, "not an airport code"), (None, None)]
    names = spark.createDataFrame([("Bart J", "Simp-son"), (" ", None)], "g string, f string")
    assert [r[0] for r in names.select(person_attributes(F.col("g"), F.col("f"))).collect()] == [{"givennames": ["bart j"], "surname": ["simp son"]}, {}]
