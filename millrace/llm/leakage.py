"""Evaluation texts leaking into training text: winnowing, then extension of the hits.

Texts are reduced to their letters and digits in lower case; of every WINDOW consecutive k-grams the least hash is kept.
Two texts that share WINDOW + K - 1 such characters in a row thus share a fingerprint. Fingerprints of corpus and test
items are joined; every pair that shares one is then aligned, character by character, bridging small changes.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import cut_lineage

K, WINDOW = 16, 12
#: Items that are aligned with a document at once; a document that meets more takes more rows.
AT_ONCE = 64
#: Share of an item's words, in one or two stretches of at least MIN_WORDS words each, that makes a case.
MIN_SHARE, MIN_WORDS = 0.38, 10
#: Up to so many test fingerprints go to the tasks as a list to filter by; beyond it every fingerprint is joined.
MAX_FILTER = 1_000_000
#: Share of a stretch's characters that must agree: DENSE, or MIN_DENSITY if LONG_RUN of them do in a row. Set phrases
#: that items share agree in shorter runs with more between them.
MIN_DENSITY, DENSE, LONG_RUN = 0.8, 0.9, 40
SEED = 8  # characters that must agree in a row for the alignment to notice

_KEEP = np.zeros(256, dtype=bool)
_KEEP[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def normalized_bytes(text: str) -> np.ndarray:
    """The UTF-8 bytes of the text's letters and digits, in lower case; symbols and punctuation are gone."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    keep = _KEEP[raw]
    if raw.size and raw.max() >= 0xC2:
        for lead, length in ((0xC2, 2), (0xE2, 3)):  # Latin-1 signs; general punctuation, arrows, boxes and the like
            at = np.flatnonzero(raw == lead)
            for i in range(length):
                keep[at + i] = False
    return raw[keep]


def fingerprints(text: str | None, k: int = K, window: int = WINDOW) -> np.ndarray:
    """Distinct winnowed k-gram hashes; none for texts with fewer than k characters left."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    codes = normalized_bytes(text)
    if codes.size < k:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        grams, size, base = _CODES[codes], 1, np.uint64(0x9E3779B97F4A7C15)
        power = base
        while size < k:  # k is a power of two
            grams = grams[:-size] * power + grams[size:]
            power = power * power
            size *= 2
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
    least, span = grams, 1
    window = min(window, grams.size)
    while span < window:
        step = min(span, window - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return np.unique(least)


def fingerprint_column(only: np.ndarray | None = None, k: int = K, window: int = WINDOW):
    """Column function: a text's fingerprints as bigints, or only those of a sorted list."""

    @F.arrow_udf(returnType=T.ArrayType(T.LongType()))
    def column(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            found = fingerprints(text.as_py(), k, window)
            if only is not None and found.size:
                at = np.searchsorted(only, found)
                at[at == only.size] = 0
                found = found[only[at] == found] if only.size else found[:0]
            out.append(found.view(np.int64))
        return pa.array(out, type=pa.list_(pa.int64()))

    return column.asNondeterministic()  # so that a filter on it doesn't compute it twice


def _seeds(chars: str) -> np.ndarray:
    """A hash of every SEED characters in a row."""
    codes = np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if codes.size < SEED:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        hashes, size, power = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9), 1, np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
        while size < SEED:  # a power of two
            hashes = hashes[:-size] * power + hashes[size:]
            power = power * power
            size *= 2
    return hashes


def _marked(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of so many places lie within one of the stretches of that length."""
    change = np.zeros(size + 1, dtype=np.int64)
    change[starts] += 1
    change[starts + length] -= 1
    return np.cumsum(change[:-1]) > 0


class Item:
    """A test item ready for alignment: its letters and digits, their word numbers, and its seeds."""

    def __init__(self, text: str) -> None:
        pieces, self.word_of = [], []
        for n, word in enumerate(re.findall(r"[^\W_]+", text.lower())):
            pieces.append(word)
            self.word_of += [n] * len(word)
        self.chars = "".join(pieces)
        self.words = self.word_of[-1] + 1 if self.word_of else 0
        seeds = _seeds(self.chars)
        self.places = np.argsort(seeds, kind="stable")
        self.seeds = seeds[self.places]
        ends = np.cumsum([0, *map(len, pieces)])
        least = lambda n: int((ends[n:] - ends[:-n]).min()) if 0 < n <= self.words else sys.maxsize
        words = math.ceil(MIN_SHARE * self.words - 1e-9)
        self.window = max(SEED, least(MIN_WORDS) - 4)
        # Characters of the shortest stretch or two that make a case; at either end two may lack.
        self.least = min([least(max(MIN_WORDS, words)), *(least(n) + least(words - n) for n in range(MIN_WORDS, words - MIN_WORDS + 1))]) - 8

    def within(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From where to where each of the item's seeds stands among the sorted seeds of a text."""
        return np.searchsorted(seeds, self.seeds), np.searchsorted(seeds, self.seeds, "right")

    def may_be_in(self, first: np.ndarray, last: np.ndarray) -> bool:
        """Whether enough of the item lies in stretches most of whose characters stand, in any order, within a text. What
        this refuses the alignment would; it asks for less, as gaps may be spread unevenly."""
        size = len(self.chars)
        if size < self.window:
            return False
        there = _marked(self.places[last > first], SEED, size)
        met = np.concatenate([[0], np.cumsum(there)])
        dense = np.flatnonzero(met[self.window :] - met[: -self.window] >= 0.7 * self.window)
        return int(_marked(dense, self.window, size).sum()) >= 0.75 * self.least

    def segments(self, places: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple[int, int, int]]:
        """(place in the text, place in the item, characters) of every run of SEED and more that both have, given the
        places of the text's sorted seeds."""
        times = last - first
        item = np.repeat(self.places, times)
        text = places[np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())]
        by_diagonal = np.lexsort((text, text - item))
        text, item = text[by_diagonal], item[by_diagonal]
        start = np.flatnonzero((np.diff(text - item, prepend=-sys.maxsize) != 0) | (np.diff(text, prepend=-sys.maxsize) != 1))
        length = np.diff(start, append=text.size) + SEED - 1
        return list(zip(text[start].tolist(), item[start].tolist(), length.tolist()))

    def covered_words(self, start: int, end: int) -> int:
        """Whole words within a stretch; one that lacks a character or two at the edge still counts."""
        first, last = self.word_of[start], self.word_of[end - 1]
        return last - first + 1 - (bisect.bisect_left(self.word_of, first) + 2 < start) - (bisect.bisect_right(self.word_of, last) - 2 > end)


def _bridged(item_gap: int, doc_gap: int) -> bool:
    """A changed word lies between, or lines of a page header in the document alone. Set phrases that many items share
    stand further apart, with other names between them."""
    return -SEED < item_gap <= 16 and -SEED < doc_gap <= 26 or -SEED < item_gap <= 4 and 0 < doc_gap <= 220


def stretches(segments: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The best chain of (doc, item, length) segments that ends with each: item start, item end, characters that agree,
    most of them in a row."""
    segments = sorted(segments)
    best: list[tuple[int, int, int, int]] = []
    for n, (doc, item, length) in enumerate(segments):
        own = (item, item + length, length, length)
        m = n - 1
        while m >= 0 and segments[m][0] >= doc - 1000:
            d, i, size = segments[m]
            if i < item and d < doc and _bridged(item - i - size, doc - d - size):
                agree = best[m][2] + length - max(0, i + size - item)
                if agree > own[2]:
                    own = (best[m][0], item + length, agree, max(length, best[m][3]))
            m -= 1
        best.append(own)
    return best


def share_of_item(item: Item, chains: list[tuple[int, int, int, int]]) -> float:
    """Share of the item's words in its longest stretch and the longest other that doesn't overlap it."""
    if not item.words:
        return 0.0
    dense = {(a, b) for a, b, agree, run in chains if agree >= (MIN_DENSITY if run >= LONG_RUN else DENSE) * (b - a)}
    sized = sorted(((item.covered_words(a, b), a, b) for a, b in dense), reverse=True)
    sized = [s for s in sized if s[0] >= MIN_WORDS]
    if not sized:
        return 0.0
    total, a, b = sized[0]
    total += next((n for n, c, d in sized[1:] if c >= b - SEED or d <= a + SEED), 0)
    return min(1.0, total / item.words)


def leaked_items(text: str, candidates: list[tuple[int, Item]]) -> list[tuple[int, float]]:
    """Of the candidate items those that the text gives away, with the share of their words."""
    seeds = _seeds(re.sub(r"[\W_]+", "", text.lower()))
    places = np.argsort(seeds, kind="stable")
    seeds = seeds[places]
    out = []
    for item_id, item in candidates:
        first, last = item.within(seeds)
        if item.may_be_in(first, last):
            share = share_of_item(item, stretches(item.segments(places, first, last)))
            if share >= MIN_SHARE:
                out.append((item_id, share))
    return out


@functools.lru_cache(maxsize=4096)  # those met lately; others are made again
def _item(text: str) -> Item:
    return Item(text)


_FOUND = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("share", T.DoubleType())]))


@F.arrow_udf(returnType=_FOUND)
def _aligned(texts: pa.Array, items: pa.Array) -> pa.Array:
    out = []
    for text, group in zip(texts, items):
        ids, passages = group.values.field("item_id").to_pylist(), group.values.field("item_text").to_pylist()
        candidates = [(i, _item(t)) for i, t in zip(ids, passages)]
        out.append([{"item_id": i, "share": s} for i, s in leaked_items(text.as_py(), candidates)])
    return pa.array(out, type=pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())])))


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, share: every document with the test items it gives away and the share of the item's words.

    Null, empty and very short texts on either side are no case. Rows of one doc_id count as one document, a pair
    comes out once with its greatest share; equal items under several ids come out under each. No documents or no
    items give no rows. Other columns are ignored, whatever their names.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text is not null")
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("item_text")).filter("item_text is not null")
    item_prints = cut_lineage(items.select("item_id", F.explode(fingerprint_column()("item_text")).alias("print")).distinct())
    distinct = item_prints.select("print").distinct()
    known = distinct.limit(MAX_FILTER + 1).collect()
    only = np.unique(np.array([r[0] for r in known], dtype=np.int64).view(np.uint64)) if len(known) <= MAX_FILTER else None

    hits = docs.withColumn("prints", fingerprint_column(only)("text")).filter(F.size("prints") > 0)
    if only is not None:
        hits = cut_lineage(hits.withColumn("part", F.monotonically_increasing_id()))
    else:
        hits = hits.withColumn("part", F.xxhash64("doc_id", "text"))
    # Pairs are few bytes but much work, so their number of tasks isn't left to their size.
    session = documents.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), 2 * session.sparkContext.defaultParallelism)
    pairs = (
        hits.select("part", F.explode("prints").alias("print"))
        .join(item_prints, "print")
        .select("part", "item_id")
        .distinct()
        .repartition(tasks, "part")
        .withColumn("slice", F.pmod(F.xxhash64("item_id"), F.ceil(F.count("*").over(Window.partitionBy("part")) / AT_ONCE)))
        .join(items, "item_id")
        .groupBy("part", "slice")
        .agg(F.collect_list(F.struct("item_id", "item_text")).alias("items"))
    )
    found = pairs.join(hits.select("part", "doc_id", "text"), "part").select("doc_id", F.explode(_aligned("text", "items")).alias("hit"))
    return found.groupBy("doc_id", "hit.item_id").agg(F.max("hit.share").alias("share")).select("doc_id", "item_id", "share")
