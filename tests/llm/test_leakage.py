import random

import numpy as np

from millrace.llm.leakage import K, WINDOW, Item, find_leaks, fingerprints, leaked_items, normalized_bytes
from millrace.llm.leakage import _seeds as seeds


def words(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 10))) for _ in range(n)]


def test_every_long_shared_span_shares_a_fingerprint():
    r = random.Random(1)
    for n in range(60):
        shared = "".join(words(n, 20)).replace(" ", "")[: WINDOW + K - 1]
        a, b = "".join(words(n + 1000, 8)) + shared + "".join(words(n + 2000, 8)), "".join(words(n + 3000, r.randint(1, 9))) + shared
        assert np.intersect1d(fingerprints(a), fingerprints(b)).size, n


def test_normalization():
    assert bytes(normalized_bytes("Ab-C “Ünder” 1,2\n·")) == "abcünder12".encode()
    assert fingerprints(None).size == 0 and fingerprints("short").size == 0


def leaked(passage, seed):
    return "\n".join([" ".join(words(seed, 60)), passage, " ".join(words(seed + 1, 60))])


def test_leaks(spark):
    items = [(i, " ".join(words(500 + i, 60)), "en") for i in range(5)] + [(9, None, "en"), (10, "tiny", "en")]
    item = items[0][1].split()
    noisy = list(item)
    for i in range(5, 60, 11):
        noisy[i] = "changed"
    typed = [w[:2] + "x" + w[3:] if n % 9 == 4 else w for n, w in enumerate(item)]
    docs = [
        (1, leaked(" ".join(item).upper(), 1)), (2, leaked(" ".join(noisy), 3)), (3, leaked(" ".join(typed), 5)), (4, leaked("-\n".join(item[:30]), 7)),
        (5, leaked(" ".join(item[:15]) + "\n" + " ".join(words(77, 120)) + "\n" + " ".join(item[40:55]), 9)), (6, leaked(" ".join(item[:18]), 11)), (7, leaked(" ".join(item[:8]), 13)),
        (8, " ".join(words(15, 200))), (9, None), (10, ""), (11, leaked(items[1][1] + " Page 3 of 9 " + items[2][1], 17)), (11, leaked(items[1][1], 17)), (12, "word " * 300_000 + items[3][1]),
    ]
    d = spark.createDataFrame([(*x, "x") for x in docs], "doc_id bigint, text string, item_id string")
    b = spark.createDataFrame(items, "item_id bigint, text string, doc_id string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, b).collect()} == {(1, 0), (2, 0), (3, 0), (4, 0), (5, 0), (11, 1), (11, 2), (12, 3)}
    assert find_leaks(d.limit(0), b).count() == 0 and find_leaks(d, b.limit(0)).count() == 0


def test_many_fingerprints_are_joined(spark, monkeypatch):
    import millrace.llm.leakage as leakage

    items = [(i, " ".join(words(900 + i, 40)), "en") for i in range(3)]
    docs = [(1, leaked(items[1][1], 21), "x"), (2, " ".join(words(23, 100)), "x")]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string, x string"), spark.createDataFrame(items, "item_id bigint, text string, lang string")
    monkeypatch.setattr(leakage, "MAX_FILTER", 5)
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, b).collect()} == {(1, 1)}


def test_short_stretches_of_short_words(spark):
    """Ten of 25 words of three or four letters share one fingerprint at least, and that is enough."""
    r = random.Random(4)
    short = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 4)))
    items = [(i, " ".join(short() for _ in range(25)), "en") for i in range(200)]
    docs = [(i, leaked(" ".join(text.split()[i % 15 : i % 15 + 10]), 3000 + 2 * i), "x") for i, text, _ in items]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string, x string"), spark.createDataFrame(items, "item_id bigint, text string, lang string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, b).collect()} == {(i, i) for i in range(200)}


def test_the_bound_refuses_nothing_that_aligns():
    r = random.Random(5)
    for n in range(150):
        item = words(7000 + n, 40)
        text = list(item[: r.randint(16, 40)])
        for place in r.sample(range(len(text)), r.randint(0, 4)):
            text[place] = r.choice(["x", text[place][:-1], "another", text[place] + "e"])
        passage = leaked(" ".join(text), 9000 + 2 * n)
        one = Item(" ".join(item))
        chars = "".join(c for c in passage.lower() if c.isalnum())
        if leaked_items(passage, [(1, one)]):
            assert one.may_be_in(*one.within(np.sort(seeds(chars)))), n


def test_more_items_than_are_aligned_at_once(spark):
    opening = " ".join(words(1, 15))
    items = [(i, f"{opening} {' '.join(words(4000 + i, 30))}", "en") for i in range(150)]
    docs = [(1, f"{opening} {' '.join(t for _, t, _ in items[:100])}", "x")]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string, x string"), spark.createDataFrame(items, "item_id bigint, text string, lang string")
    assert {r.item_id for r in find_leaks(d, b).collect()} >= set(range(100))
