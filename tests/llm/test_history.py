import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.history import BYTES_NEAR, LINEAR, LOG_WIDTH, SHARE_NEAR, SIZE_WIDTH, History, chunks, name_core, name_keys, plain, prepared, repeated_records, text_chunks

SCHEMA = "meta_id bigint, batch int, sha256 string, bytes bigint, file string, head string, path string, class string"


def words(seed, n=40):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(3, 9))) for _ in range(n))


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300))
def test_chunks_make_up_the_text(text):
    assert "".join(chunks(text)) == text


def test_a_change_moves_few_chunks():
    a = plain(words(1, 200))
    b = a[:600] + "changed" + a[610:]
    assert len(set(text_chunks(a)) & set(text_chunks(b))) > 0.9 * len(text_chunks(a))


def test_names():
    for a, b in (("x_2020-05.csv", "Copy of x_2020-05.CSV"), ("n_000071.gz", "n 000071 (3).gz"), ("notes.txt", "fwd-notes.txt"), ("ćwierć_a_12.txt", "Ćwierć a 12_final.txt")):
        assert name_core(a) == name_core(b) and name_keys(name_core(a)) == name_keys(name_core(b)), (a, b)
    for a, b in (("x_2020-05.csv", "x_2020-06.csv"), ("register_000001.csv", "register_000002.csv"), ("notes.txt", "index.csv"), (None, "a"), ("", "")):
        assert not set(name_keys(name_core(a))) & set(name_keys(name_core(b))), (a, b)


def test_names_with_a_letter_wrong(spark):
    names = ["register_north_2020.bin", "registr_north_2020.bin", "register_south_2020.bin", "regisxer_north_2021.bin", None, ""]
    rows = [(i, 1, None, 5000, n, None, "p", "x") for i, n in enumerate(names)]
    assert {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()} == {(0, 1)}


def test_chunks_of_like_texts():
    a = words(2)
    shared = lambda x, y: len(set(text_chunks(x)) & set(text_chunks(y))) / max(1, len(text_chunks(x)))
    assert shared(a, a.upper().replace(" ", "  ")) == 1 and shared(a, a.replace(a.split()[3], "other")) > 0.8
    assert shared(a, words(3)) < 0.2 and shared("", "") == 0 and shared(None, a) == 0


def test_batches(spark):
    a, b, c = words(10), words(11), words(12)
    edited = " ".join(b.split()[:20] + ["new"] + b.split()[21:])
    header = "ROW URN NAME REGION TELEPHONE NUMBER"
    rows = [
        (1, 0, "s1", 1000, "a_000001.csv", a, "p", "x"), (2, 0, "s1", 1000, "a_000001.csv", a, "p", "x"), (3, 0, "s3", 2000, "b_000002.txt", b, "p", "x"), (4, 0, "e", 0, "empty", None, "p", "x"),
        (5, 1, "s1", 1000, "other.csv", a, "p", "x"), (6, 1, "s6", 2003, "c.txt", edited, "p", "x"), (7, 1, "e", 0, "empty", None, "p", "x"), (8, 1, "s8", 3000, "d_000009.bin", None, "p", "x"),
        (9, 1, None, 3000, "Copy of d_000009.bin", None, "p", "x"), (10, 1, None, 3000, "d_000010.bin", None, "p", "x"), (11, 1, "s11", 900_000, "c.txt", b, "p", "x"),
        (12, 2, "s12", 2001, "x.txt", edited.upper(), "p", "x"), (13, 2, None, 3000, "d_000009 (2).bin", None, "p", "x"), (14, 2, "s14", 5000, "y.csv", header + " " + c, "p", "x"),
        (15, 2, "s15", 5001, "z.csv", header + " " + words(13), "p", "x"), (16, None, "s1", 1000, "a", a, "p", "x"), (5, 1, "s1", 1000, "other.csv", a, "p", "x"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in repeated_records(df).collect()} == {(1, 5), (3, 6), (8, 9), (3, 12), (8, 13)}
    assert repeated_records(df.limit(0)).count() == 0
    assert repeated_records(df.filter("batch = 0")).count() == 0


def test_stock_openings_and_hot_copies(spark):
    header = words(99, 12)
    rows = [(i, 0 if i < 120 else 1, f"s{i}", 5000 + 40 * i, f"f{i}.csv", f"{header} {words(1000 + i, 25)}", "p", "x") for i in range(200)]
    rows += [(1000 + i, 1, None if i % 2 else "s7", 5000 + 40 * 7, "f7.csv", f"{header} {words(1007, 25)}", "p", "x") for i in range(150)]
    got = {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(7, 1000 + i) for i in range(150)}


def near_copies(n, changed, seed):
    """Texts of 42 words, each with words of its own in other places."""
    r, base = random.Random(seed), words(seed, 42).split()
    out = []
    for i in range(n):
        text = list(base)
        for place in r.sample(range(len(text)), changed):
            text[place] = f"own{seed}x{i}x{place}"
        out.append(" ".join(text))
    return out


def test_near_copies_at_any_count(spark):
    texts = near_copies(300, 4, 5)
    rows = [(i, 1, f"s{i}", 5000, f"f{i}.csv", t, "p", "x") for i, t in enumerate(texts[:200])]
    rows += [(i + 200, 2, f"t{i}", 5010, f"g{i}.csv", t, "p", "x") for i, t in enumerate(texts[200:])]
    got = {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()}
    # Texts of 42 words with 4 changed each have at least 34 in common, in order: all are one content.
    assert got == {(0, i) for i in range(1, 300)}


def test_contents_that_interleave_under_one_key(spark):
    names = ["alpha_000012.bin", "omega_000012.bin", "river_000012.bin"]
    rows = [(i, 1, f"s{i}", 2000, n, None, "p", "x") for i, n in enumerate(names)]
    rows += [(10 + i, 1, None, 2000, f"Copy of {n}", None, "p", "x") for i, n in enumerate(names)]
    rows += [(20 + i, 2, None, 2000, n.replace("_", " "), None, "p", "x") for i, n in enumerate(names)]
    got = {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(i, j + i) for i in range(3) for j in (10, 20)}


def test_every_name_of_a_checksum_is_kept(spark):
    rows = [(1, 0, "s1", 2000, "deliveries_000085.tif", None, "p", "x"), (2, 0, "s1", 2000, "manifest_733673.tif", None, "p", "x"), (3, 1, None, 2000, "Copy of manifest_733673.tif", None, "p", "x")]
    assert {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()} == {(1, 3)}


def test_unlike_contents_of_one_size_between_copies(spark):
    names = ["alpha_2020.csv", "beta_2020.csv", "gamma_2020.csv", "beta_2020 (2).csv"]
    rows = [(i, 1, None, 5000, n, None, "p", "x") for i, n in enumerate(names)]
    assert {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()} == {(1, 3)}


def test_a_history_is_kept_and_opened_again(spark, tmp_path):
    a, b = words(20), words(21)
    row = lambda i, s, text: (i, 1, s, 5000, f"f{i}.csv", text, "p", "x")
    first = History(spark, str(tmp_path))
    first.add(prepared(spark.createDataFrame([row(1, "s1", a), row(2, "s2", b)], SCHEMA)))
    first.close()
    size = spark.read.parquet(f"{tmp_path}/keys").count()
    again = History(spark, str(tmp_path))
    placed = again.add(prepared(spark.createDataFrame([row(3, "s3", a.replace(a.split()[5], "new")), row(4, "s4", words(22))], SCHEMA)))
    again.close()
    assert {(r.x, r.label) for r in spark.read.schema("x bigint, label bigint").parquet(placed).collect()} == {(1, 1), (3, 1)}
    # What is appended is what is new: the checksum, the name and the chunks around the word changed.
    grown = spark.read.parquet(f"{tmp_path}/keys").filter("kind = 1 and class = 1").count()
    assert spark.read.parquet(f"{tmp_path}/keys").count() > size and grown < 1.2 * len(text_chunks(a))


def test_names_with_both_ends_or_the_middle_wrong(spark):
    names = ["img_20200512.bin", "ipg_20200512.bin", "img_20200513.bin", "deliveries_of_the_northern_2020.bin", "eliveries_of_the_northerm_2020.bin", "zzliveries_of_the_northyyx_2020.bin"]
    rows = [(i, 1, None, 5000, n, None, "p", "x") for i, n in enumerate(names)]
    assert {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()} == {(0, 1), (3, 4)}


def test_a_content_is_met_at_the_size_of_any_of_its_forms(spark):
    a = words(30)
    rows = [(i, i, f"s{i}", 5100 + 150 * i, f"f{i}.csv", a.replace(a.split()[i], "new"), "p", "x") for i in range(5)]
    assert {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()} == {(0, i) for i in range(1, 5)}
    rows = [(i, 1, *r[2:]) for i, r in enumerate(rows)] + [(9, 2, "s9", 5850, "f9.csv", a.upper(), "p", "x")]
    assert {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()} == {(0, i) for i in (1, 2, 3, 4, 9)}


def size_class(size):
    return math.floor(min(size, LINEAR) / SIZE_WIDTH + math.log(max(size, LINEAR) / LINEAR) / LOG_WIDTH)


def away(size):
    return max(BYTES_NEAR, math.ceil(size * SHARE_NEAR))


def test_sizes_nearly_the_same_at_the_edge_of_a_class(spark):
    size = next(b for b in range(2_000_000, 3_000_000) if size_class(b + away(b)) < size_class(b + away(b) + 1) and away(b + away(b) + 1) > away(b))
    rows = [(1, 0, "s1", size + away(size) + 1, "a.csv", words(31), "p", "x"), (2, 1, "s2", size, "b.csv", words(31), "p", "x")]
    assert {tuple(r) for r in repeated_records(spark.createDataFrame(rows, SCHEMA)).collect()} == {(1, 2)}
