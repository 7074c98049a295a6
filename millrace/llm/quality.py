"""Per-document statistics of text, and a probability that it is natural prose.

One pass over a text gives counts over its characters, lines and sentences. Boosted trees, fitted by quality_train on
weakly labelled prose and structural junk, turn the statistics into a probability; a logistic curve fitted on a
hand-checked holdout calibrates it.
"""

from __future__ import annotations

import functools
import json
import math
import pkgutil
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The list of common words is a parameter held by every task.
MAX_COMMON_WORDS = 100_000
#: A sentence that runs has this many words at least, and a share of common words between these.
RUNNING_WORDS, RUNNING_COMMON, RUNNING_MOST = 5, 0.1, 0.9

STATISTICS = [
    "n_words",
    "mean_word_length",
    "symbol_share",
    "punctuated_line_share",
    "common_word_share",
    "running_share",
    "distinct_line_share",
    "distinct_word_share",
    "digit_share",
    "upper_share",
    "words_per_line",
    "short_line_share",
    "table_line_share",
    "list_line_share",
    "words_per_sentence",
    "comma_share",
    "longest_word",
    "repeated_sentence_share",
]

_WORD = re.compile(r"[^\W_]+")
_TABLE = re.compile(r".*\S {3,}\S.*|.*\t.*|.*\|.*\|.*|.*\.{4,}.*|.*_{6,} +_{6,}.*")
_TABLE_SIGNS = ("   ", "\t", "|", "....", "______")
_LIST = re.compile(r"(?:[-*•–—·]|\(?\d{1,3}[.)]|\(?[a-z][.)]|\[\d{1,4}\])(?:\s+|$)")
_END = tuple(".!?…")
_CLOSING = "\"”’'»)]"
_SENTENCE = re.compile(r"""(?<=[.!?…])["”’'»)\]]*\s+""")

#: Class of each character up to U+2FFF: 0 other signs, 1 lower or caseless letter, 2 upper case, 3 digit, 4 space, 5 comma.
_CLASS = np.array([3 if c.isdigit() else 2 if c.isupper() else 1 if c.isalpha() else 4 if c.isspace() else 5 if c == "," else 0 for c in map(chr, range(0x3000))], dtype=np.uint8)


def _is_table(line: str) -> bool:
    return any(sign in line for sign in _TABLE_SIGNS) and _TABLE.match(line) is not None


def statistics(text: str | None, common: frozenset[str]) -> list[float] | None:
    """The values of STATISTICS; None for null and blank texts.

    Words in running sentences are those of sentences, over hard-wrapped lines too, that end as sentences do and hold
    common words; of a sentence that comes again only the first counts. Lines of tables are no sentences.
    """
    if text is None or not text.strip():
        return None
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    signs, lower, upper, digits, spaces, commas = np.bincount(_CLASS[np.minimum(codes, 0x2FFF)], minlength=6).tolist()
    lines = [x.strip() for x in text.lower().split("\n")]
    full = [x for x in lines if x]

    words: list[str] = []
    lengths: list[int] = []
    seen: set[str] = set()
    running = ended = tables = items = 0
    find, is_common = _WORD.findall, common.__contains__

    def sentences(block: str) -> None:
        nonlocal running, ended
        for sentence in _SENTENCE.split(block):
            its = find(sentence)
            if not its:
                continue
            words.extend(its)
            lengths.append(len(its))
            if len(its) < RUNNING_WORDS or not sentence.rstrip(_CLOSING).endswith(_END):
                continue
            ended += 1
            if sentence in seen:
                continue
            seen.add(sentence)
            if RUNNING_COMMON * len(its) <= sum(map(is_common, its)) <= RUNNING_MOST * len(its):
                running += len(its)

    current: list[str] = []
    for line in lines:
        table = bool(line) and _is_table(line)
        item = None if not line or table or line[0].isalpha() and line[1:2] not in (".", ")") else _LIST.match(line)
        if (not line or table or item) and current:
            sentences(" ".join(current))
            current = []
        if table:
            tables += 1
            words += find(line)
        elif item:
            items += 1
            words += find(item.group())
            current.append(line[item.end() :])
        elif line:
            current.append(line)
    if current:
        sentences(" ".join(current))

    n = len(words)
    total, letters = max(n, 1), lower + upper
    shown = max(letters + digits + signs + commas, 1)
    return [
        float(n),
        sum(map(len, words)) / total,
        (signs + commas) / shown,
        sum(1 for x in full if x[-1] in ".,;:!?…\"”’»)") / len(full),
        sum(map(is_common, words)) / total,
        running / total,
        len(set(full)) / len(full),
        len(set(words)) / math.sqrt(total),
        digits / shown,
        upper / max(letters, 1),
        n / len(full),
        sum(1 for x in full if len(x) < 40) / len(full),
        tables / len(full),
        items / len(full),
        sum(lengths) / max(len(lengths), 1),
        commas / total,
        float(max(map(len, words), default=0)),
        1 - len(seen) / max(ended, 1),
    ]


@functools.lru_cache(maxsize=4)
def load_model(path: str | None = None) -> dict:
    if path is None:
        return json.loads(pkgutil.get_data("millrace.llm", "quality_model.json"))
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _flat(tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A tree as arrays: statistic (-1 in a leaf), threshold, child at most, child above, value. A node is [statistic,
    threshold, at most, above], a leaf its value."""
    nodes: list[list[float]] = []

    def add(node) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, at, at, 0.0])
        if isinstance(node, list):
            nodes[at][:4] = [node[0], node[1], add(node[2]), add(node[3])]
        else:
            nodes[at][4] = node
        return at

    add(tree)
    columns = list(zip(*nodes))
    return tuple(np.array(c, dtype=d) for c, d in zip(columns, (np.intp, float, np.intp, np.intp, float)))


def raw_scores(values: np.ndarray, model: dict) -> np.ndarray:
    """The trees' sum for each row of statistics."""
    total = np.full(len(values), float(model["base"]))
    rows = np.arange(len(values))
    for tree in model["trees"]:
        statistic, threshold, least, above, value = _flat(tree)
        at = np.zeros(len(values), dtype=np.intp)
        while len(values) and (statistic[at] >= 0).any():
            at = np.where(values[rows, statistic[at]] <= threshold[at], least[at], above[at])
        total += value[at]
    return total


def probabilities(values: np.ndarray, model: dict) -> np.ndarray:
    """Calibrated probabilities that texts with these statistics are prose."""
    return 1 / (1 + np.exp(-np.clip(model["slope"] * raw_scores(values, model) + model["shift"], -50, 50)))


def probability(values: list[float], model: dict) -> float:
    return float(probabilities(np.array([values]), model)[0])


_RESULT = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS] + [T.StructField("p_prose", T.DoubleType())])
_ARROW = pa.struct([(s, pa.float64()) for s in STATISTICS] + [("p_prose", pa.float64())])


def common_word_set(common_words: DataFrame) -> frozenset[str]:
    rows = common_words.select(F.lower("word")).filter("word is not null").distinct().limit(MAX_COMMON_WORDS + 1).collect()
    if len(rows) > MAX_COMMON_WORDS:
        raise ValueError(f"more than {MAX_COMMON_WORDS} common words")
    return frozenset(r[0] for r in rows)


def quality_column(common: frozenset[str], model_path: str | None = None):
    @F.arrow_udf(returnType=_RESULT)
    def column(texts: pa.Array) -> pa.Array:
        model = load_model(model_path)
        found = [statistics(text.as_py(), common) for text in texts]
        rated = iter(probabilities(np.array([v for v in found if v is not None]).reshape(-1, len(STATISTICS)), model).tolist())
        return pa.array([None if v is None else dict(zip(STATISTICS, v), p_prose=next(rated)) for v in found], type=_ARROW)

    return column.asNondeterministic()  # so that several uses of its fields don't compute it again


def text_quality(documents: DataFrame, common_words: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, the statistics, p_prose and is_prose of every row of documents.

    Null and blank texts have null statistics and are no prose. Repeated rows come out as often as they came in; no
    rows give none. Without common words every share of them is 0. Other columns are ignored, whatever their names.
    """
    rated = documents.select("doc_id", quality_column(common_word_set(common_words), model_path)("text").alias("q"))
    return rated.select("doc_id", *[f"q.{s}" for s in STATISTICS], F.col("q.p_prose"), (F.coalesce("q.p_prose", F.lit(0.0)) >= 0.5).alias("is_prose"))
