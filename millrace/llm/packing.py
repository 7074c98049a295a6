"""Filling containers of fixed capacity with texts, sized in tokens of a public tokenizer.

Bounded-space online best-fit: at most OPEN_BINS containers are open; their free space is kept as a bitset, so the
tightest that still fits is one shift and one lowest-bit away; when a new one is needed and all are open, the fullest
closes. Texts are spread over shards that pack on their own; what stands in containers still open at the end of the
shards is packed once more, so that shards leave next to no space unused.
"""

from __future__ import annotations

import base64
import functools
import math

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's byte-level BPE cuts a text before merging (fixed value, public with the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OPEN_BINS = 256
ITEMS_PER_SHARD = 50_000
#: Budgets are a list of parameters, held by every task.
MAX_BUDGETS = 1000
#: Distinct pre-tokens whose token counts a worker remembers; more are counted anew, with the same result.
CACHED_WORDS = 1_000_000


@functools.lru_cache(maxsize=4)
def _counter(path: str):
    import regex
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = regex.compile(PATTERN)
    known: dict[str, int] = {}

    def count(text: str | None) -> int:
        if not text:
            return 0
        total = 0
        get = known.get
        for word in words.findall(text):
            n = get(word)
            if n is None:
                n = len(encoding.encode_ordinary(word))
                if len(known) < CACHED_WORDS and len(word) < 100:
                    known[word] = n
            total += n
        return total

    return count


def token_count(path: str = TOKENIZER):
    """Column function: tokens of a text; 0 for null and empty texts. Byte-level BPE never merges across pre-tokens,
    so counts of distinct pre-tokens add up to the count of the text."""

    @F.arrow_udf(returnType="bigint")
    def count(text: pa.Array) -> pa.Array:
        counter = _counter(path)
        return pa.array([counter(t.as_py()) for t in text], type=pa.int64())

    return count


class OpenBins:
    """Best fit over a bounded number of open containers."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit, self.open = capacity, limit, 0
        self.bits = 0  # bit f: some open container has f free
        self.by_free: dict[int, list[int]] = {}
        self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, size: int) -> int:
        """The container for an item of at most the capacity."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            number, free = self.made, self.capacity
            self.made += 1
        free -= size
        if free or not size:
            self.by_free.setdefault(free, []).append(number)
            self.bits |= 1 << free
            self.open += 1
        return number

    def still_open(self) -> set[int]:
        return {n for bins in self.by_free.values() for n in bins}


def _pack(sizes, capacity: int, limit: int):
    bins = OpenBins(capacity, limit)
    numbers = [bins.place(s) for s in sizes]
    return numbers, bins.still_open()


_ITEM = "budget_id int, capacity_tokens int, id bigint, copy int, piece bigint, first_token bigint, n_tokens bigint"


def pack_texts(
    texts: DataFrame,
    budgets: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    open_bins: int = OPEN_BINS,
    items_per_shard: int = ITEMS_PER_SHARD,
) -> DataFrame:
    """budget_id, capacity_tokens, container_id, <id_col>, copy, piece, first_token, n_tokens: where each text stands.

    A text longer than the capacity is cut into pieces of the capacity and a rest (piece from 0); no other is cut.
    Null and empty texts have 0 tokens and get a container too. Rows that share an id are packed each for itself and
    told apart by `copy` (from 0). Budgets that are null or below 1 are left out. No texts or no budgets: no rows.
    Equal sizes keep the order of their ids. Other columns are ignored, whatever their names.
    """
    budget_rows = budgets.select("budget_id", "capacity_tokens").filter("capacity_tokens >= 1").distinct().orderBy("budget_id").limit(MAX_BUDGETS + 1).collect()
    if len(budget_rows) > MAX_BUDGETS:
        raise ValueError(f"more than {MAX_BUDGETS} budgets")
    counted = texts.select(F.col(id_col).cast("bigint").alias("id"), token_count(tokenizer)(F.col(text_col)).alias("size"))
    # Only ids and sizes go on from here; cutting keeps the texts from being tokenized again below.
    copies = Window.partitionBy("id").orderBy("size")
    sized = cut_lineage(counted.withColumn("copy", F.row_number().over(copies) - 1))
    shards = max(1, math.ceil(sized.count() / items_per_shard))

    offered = F.array(*[F.struct(F.lit(b.budget_id).cast("int").alias("budget_id"), F.lit(b.capacity_tokens).cast("int").alias("capacity_tokens")) for b in budget_rows])
    if not budget_rows:
        offered = F.array().cast("array<struct<budget_id:int,capacity_tokens:int>>")
    per_budget = sized.withColumn("b", F.explode(offered)).select("b.*", "id", "copy", "size")
    capacity = F.col("capacity_tokens").cast("bigint")
    whole = F.floor(F.col("size") / capacity)
    # A piece as long as the capacity is a container of its own; only what is left of each text is packed.
    full = per_budget.filter(whole > 0).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), whole - 1)))
    full = full.select("budget_id", "capacity_tokens", "id", "copy", "piece", (F.col("piece") * capacity).alias("first_token"), capacity.alias("n_tokens"), (F.lit(2 << 60) + F.monotonically_increasing_id()).alias("container_id"))
    rest = F.col("size") - whole * capacity
    items = per_budget.filter((rest > 0) | (F.col("size") == 0)).select("budget_id", "capacity_tokens", "id", "copy", whole.alias("piece"), (whole * capacity).alias("first_token"), rest.alias("n_tokens"))

    def packer(level: int):
        def pack(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["id", "copy", "piece"], kind="stable")
            numbers, opened = _pack(group["n_tokens"].tolist(), int(group["capacity_tokens"].iloc[0]), open_bins)
            shard = int(group["shard"].iloc[0])
            return group.assign(container_id=[(level << 60) + (shard << 28) + n for n in numbers], open=[n in opened for n in numbers]).drop(columns="shard")

        return pack

    schema = f"{_ITEM}, container_id bigint, open boolean"
    result = ["budget_id", "capacity_tokens", "container_id", F.col("id").alias(id_col), "copy", "piece", "first_token", "n_tokens"]
    sharded = items.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("bigint"))
    first = sharded.groupBy("budget_id", "shard").applyInPandas(packer(0), schema)
    if shards == 1:
        return first.drop("open").unionByName(full).select(*result)
    # Items of containers still open: at most OPEN_BINS containers a shard, so a small share of all.
    first = cut_lineage(first)
    again = max(1, math.ceil(shards / 64))
    left = first.filter("open").withColumn("shard", F.pmod(F.shiftright("container_id", 28), F.lit(again)).cast("bigint")).drop("container_id", "open")
    second = left.groupBy("budget_id", "shard").applyInPandas(packer(1), schema)
    return first.filter("not open").unionByName(second).drop("open").unionByName(full).select(*result)


def packing_report(placed: DataFrame) -> DataFrame:
    """Per budget: containers, tokens and the share of space left over."""
    return placed.groupBy("budget_id", "capacity_tokens").agg(
        F.countDistinct("container_id").alias("containers"),
        F.sum("n_tokens").alias("tokens"),
        (1 - F.sum("n_tokens") / (F.countDistinct("container_id") * F.first("capacity_tokens"))).alias("unused_share"),
    )
