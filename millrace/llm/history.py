"""New batches against everything accepted before, without going over the history again.

Content-defined chunking: a rolling hash over the text's letters sets the chunk boundaries, so a change moves only the
chunks around it. A persistent table leads from chunk to the accepted contents that hold it; a batch looks its own
rarest chunks up in it, the bytes shared with each content are added up, and their share decides. Checksums and file
names go through the same table as chunks of their own. Only chunks that don't lead to a content yet are appended.
"""

from __future__ import annotations

import re
import unicodedata
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import connected
from millrace.session import cut_lineage, shared_path

#: A chunk ends where the rolling hash of the last ROLL characters is 0 modulo DIVISOR.
ROLL, DIVISOR, MIN_CHUNK = 3, 6, 4
#: What is looked up: checksums, texts and names.
CHECKSUM, TEXT, NAME = 0, 1, 2
#: A text is looked up by its rarest chunks, which make up so much of it: stock openings and phrases, which files have in
#: common whatever their content, don't count.
RARE = 0.7
#: Share of these that a content must cover. Texts that differ in a few words share half of them and more, texts that
#: merely begin alike or are of a series a fifth at most.
COVERED = 0.3
#: Shortest length of one opening in proportion to the other's.
LENGTHS = 0.6
#: Edits, by length, between two names that differ at most in small ways.
NAME_EDITS = 0.1
#: Sizes count as nearly the same up to this many bytes, or this share of the larger.
BYTES_NEAR, SHARE_NEAR = 160, 0.0005
#: Texts are told apart by classes of sizes, so wide up to LINEAR bytes and beyond in proportion to the size; sizes nearly
#: the same are in one class or in two next to each other.
SIZE_WIDTH, LINEAR, LOG_WIDTH = 1000.0, 320_000.0, 0.004
#: Files that the chunk table is divided into by chunk, so that a look-up never moves it.
BUCKETS = 8

_CODES = np.random.default_rng(7).integers(1, 1 << 62, 1 << 16, dtype=np.int64).view(np.uint64)
#: What people and programs put around the name of a file they copy (fixed values).
_DECORATION = re.compile(r"copy|of|final|resend|resent|fwd|fw|re|bak|backup|old|new|tmp|v\d{1,2}|rev|rev\d{1,2}")
_COUNTER = re.compile(r"\(\d{1,3}\)")


def plain(text: str | None) -> str:
    """Letters and digits in lower case, one space between words."""
    return " ".join(re.findall(r"[^\W_]+", (text or "").lower()))


def chunks(text: str) -> list[str]:
    """Content-defined chunks of a plain text; together they are the text."""
    if not text:
        return []
    codes = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), dtype=np.uint16)
    if codes.size != len(text):  # characters beyond the first plane: positions would differ
        codes = np.array([ord(c) & 0xFFFF for c in text], dtype=np.uint16)
    with np.errstate(over="ignore"):
        rolled = _CODES[codes]
        total = rolled.copy()
        for back in range(1, min(ROLL, len(text))):
            total[back:] += rolled[:-back] * np.uint64(2 * back + 1)
        total ^= total >> np.uint64(31)
        total *= np.uint64(0x9E3779B97F4A7C15)
        total >>= np.uint64(33)
    out, start = [], 0
    for end in np.flatnonzero(total % np.uint64(DIVISOR) == 0).tolist():
        if end + 1 - start >= MIN_CHUNK:
            out.append(text[start : end + 1])
            start = end + 1
    if start < len(text):
        out.append(text[start:])
    return out


def _numbered(parts: list[str]) -> list[str]:
    """The parts, told apart where one comes again, so that two lists have as many in common as their multisets."""
    seen: dict[str, int] = {}
    out = []
    for part in parts:
        seen[part] = n = seen.get(part, 0) + 1
        out.append(part if n == 1 else f"{part}\x00{n}")
    return out


def text_chunks(text: str | None) -> list[str]:
    return _numbered(chunks(plain(text)))


def name_core(name: str | None) -> list[str]:
    """The name's parts without extension and what a copy adds."""
    stem, dot, extension = (name or "").rpartition(".")
    stem = stem if dot and len(extension) <= 5 else name or ""
    parts = re.findall(r"[^\W_]+", unicodedata.normalize("NFC", _COUNTER.sub(" ", stem)).lower())
    core = [p for p in parts if not _DECORATION.fullmatch(p)]
    return core or parts


def name_keys(core: list[str]) -> list[str]:
    """The numbers of a name, with the whole name where it is too short to differ by an edit from any other."""
    numbers = "/".join(d.lstrip("0") for p in core for d in re.findall(r"\d+", p))
    whole = "".join(core)
    return [f"{numbers}^{whole if (len(whole) + 1) * NAME_EDITS < 1 else ''}"] if core else []


def _size_class(size: Column) -> Column:
    return F.floor(F.least(size, F.lit(LINEAR)) / SIZE_WIDTH + F.log(F.greatest(size, F.lit(LINEAR)) / LINEAR) / LOG_WIDTH)


@F.arrow_udf(returnType=T.ArrayType(T.StringType()))
def _text_chunks(texts: pa.Array) -> pa.Array:
    return pa.array([text_chunks(t) for t in texts.to_pylist()], type=pa.list_(pa.string()))


_NAMED = T.StructType([T.StructField("core", T.StringType()), T.StructField("keys", T.ArrayType(T.StringType()))])


@F.arrow_udf(returnType=_NAMED)
def _named(names: pa.Array) -> pa.Array:
    cores = [name_core(n) for n in names.to_pylist()]
    return pa.array([{"core": "".join(c), "keys": name_keys(c)} for c in cores], type=pa.struct([("core", pa.string()), ("keys", pa.list_(pa.string()))]))


def prepared(records: DataFrame) -> DataFrame:
    """Records with the keys they are found by: first (the record that stands for this one, where they are the same in
    checksum, size, name and opening), size class, bare (without checksum), core of the name, length of the opening's
    chunks, and keys, an array of base, weight, kind and probe (is looked up). batch is kept; any number of batches can
    be prepared at once. How rare a chunk is, is counted over all records given."""
    rows = records.select("batch", "meta_id", "sha256", "bytes", "file", "head").filter("bytes > 0 and meta_id is not null").dropDuplicates(["batch", "meta_id"])
    rows = rows.withColumn("form", F.xxhash64(*[x for c in ("sha256", "bytes", "file", "head") for x in (F.col(c).isNull(), F.col(c))]))
    firsts = rows.groupBy("batch", "form").agg(F.min("meta_id").alias("first"))
    rows = rows.join(firsts, ["batch", "form"]).drop("form")
    # Copies stand for themselves only until here: their texts are not cut again.
    chosen = F.col("first") == F.col("meta_id")
    rows = rows.withColumns({"name": F.when(chosen, _named("file")), "chunks": F.when(chosen, _text_chunks(F.when(chosen, F.col("head"))))})
    rows = cut_lineage(rows.drop("file", "head"), "chunks")
    pieces = rows.select("batch", "meta_id", F.explode("chunks").alias("chunk")).withColumn("base", F.xxhash64(F.lit("t"), "chunk"))
    pieces = pieces.withColumn("weight", F.octet_length(F.substring_index("chunk", "\x00", 1)))
    often = pieces.groupBy("base").agg(F.count("*").alias("n"))
    # The chunks of one text are few enough for one row.
    ranked = pieces.join(often, "base").groupBy("batch", "meta_id").agg(F.sum("weight").cast("int").alias("length"), F.array_sort(F.collect_list(F.struct("n", F.negate("weight").alias("light"), "base"))).alias("ranked"))
    so_far = lambda i: F.aggregate(F.slice("ranked", 1, i), F.lit(0), lambda acc, c: acc - c["light"])
    key = lambda base, weight, kind, probe: F.struct(base.alias("base"), weight.cast("int").alias("weight"), F.lit(kind).cast("int").alias("kind"), probe.alias("probe"))
    texts = F.transform("ranked", lambda c, i: key(c["base"], F.negate(c["light"]), TEXT, so_far(i) <= RARE * F.col("length")))
    sums = F.when(chosen & F.col("sha256").isNotNull(), F.array(key(F.xxhash64(F.lit("s"), "sha256"), F.lit(1), CHECKSUM, F.lit(True))))
    names = F.transform("name.keys", lambda c: key(F.xxhash64(F.lit("n"), "bytes", c), F.lit(1), NAME, F.lit(True)))
    empty = F.array().cast("array<struct<base:bigint,weight:int,kind:int,probe:boolean>>")
    keys = F.concat(*[F.coalesce(k, empty) for k in (sums, texts, names)])
    rows = rows.join(ranked, ["batch", "meta_id"], "left")
    return rows.select("batch", "meta_id", "first", "bytes", F.col("sha256").isNull().alias("bare"), F.col("name.core").alias("core"), "length", keys.alias("keys"))


def _at(size: Column) -> Column:
    """The key in the table of chunks: those of texts are told apart by the class of sizes too."""
    return F.when(F.col("kind") == TEXT, F.xxhash64("base", _size_class(size))).otherwise(F.col("base"))


def _away(size: str = "bytes") -> Column:
    return F.greatest(F.lit(BYTES_NEAR), F.ceil(F.col(size) * SHARE_NEAR))


def _keys(records: DataFrame, *more: str) -> DataFrame:
    """A row for each key of a record."""
    rows = records.select("meta_id", "bytes", "bare", "core", "length", *more, F.explode("keys").alias("k")).select("meta_id", "bytes", "bare", "core", "length", *more, "k.*")
    return rows.withColumns({"bare": F.col("bare") & (F.col("kind") == NAME), "core": F.when(F.col("kind") == NAME, F.col("core")), "length": F.when(F.col("kind") == TEXT, F.col("length"))})


def _asked(records: DataFrame) -> DataFrame:
    """The records' keys to look up, texts in all classes of sizes that are near enough."""
    # Up to the largest size that this one is near to by that size's own share.
    above = F.greatest(_away(), F.ceil((F.col("bytes") + 1) * SHARE_NEAR / (1 - SHARE_NEAR)) + 1)
    ends = [_at(F.col("bytes") - _away()), _at(F.col("bytes") + above)]
    return _keys(records, "own", "need").filter("probe").withColumn("key", F.explode(F.array_distinct(F.array(*ends))))


def _held(records: DataFrame, content: str) -> DataFrame:
    """The records' keys as rows of the table of chunks."""
    return _keys(records, content).select(_at(F.col("bytes")).alias("key"), F.col(content).alias("class"), "kind", "bytes", "length", "core", "bare")


#: What a key leads to, in sizes so near to each other that whatever is near to one of them is near to the least or the
#: largest, or between them.
PLACE = ["key", "class", "kind", "core", "bare", "cell"]


def _placed(keys: DataFrame) -> DataFrame:
    return keys.withColumn("cell", F.floor(F.col("bytes") / BYTES_NEAR))


def _forms(keys: DataFrame) -> DataFrame:
    """The least and the largest size that a content has each of its keys in."""
    form = F.struct("bytes", "length")
    ends = _placed(keys).groupBy(*PLACE).agg(F.min(form).alias("low"), F.max(form).alias("high"))
    return ends.withColumn("form", F.explode(F.array_distinct(F.array("low", "high")))).select("key", "class", "kind", "form.*", "core", "bare")


def _covered(asked: DataFrame, table: DataFrame) -> DataFrame:
    """meta_id, class: every content of the table that covers enough of a record asked about."""
    there = table.select("key", "class", F.col("bytes").alias("size"), F.col("length").alias("extent"), F.col("core").alias("like"), F.col("bare").alias("either"))
    met = asked.join(there, "key").filter("class <> own")
    near = (F.abs(F.col("bytes") - F.col("size")) <= F.greatest(_away("bytes"), _away("size"))) & (F.least("length", "extent") >= LENGTHS * F.greatest("length", "extent"))
    named = (F.col("bare") | F.col("either")) & (F.levenshtein("core", "like") <= F.floor(NAME_EDITS * F.greatest(F.length("core"), F.length("like"))))
    met = met.filter(F.when(F.col("kind") == TEXT, near).when(F.col("kind") == NAME, named).otherwise(True)).select("meta_id", "class", "kind", "base", "weight", "need")
    # A content may hold a chunk in two classes of sizes.
    once = met.repartition("meta_id").groupBy("meta_id", "class", "kind", "base").agg(F.min("weight").alias("weight"), F.min("need").alias("need"))
    sums = once.groupBy("meta_id", "class", "kind").agg(F.sum("weight").alias("shared"), F.min("need").alias("need"))
    return sums.filter((F.col("kind") != TEXT) | (F.col("shared") >= F.col("need"))).select("meta_id", "class").distinct()


class History:
    """What has been accepted so far: one table in a folder that leads from chunk (key) to content (class, the first
    record with it). It is bucketed by key, so looking a batch up in it moves the batch to the table and never the
    table; and as a near copy brings few new chunks, it grows with the contents, not with the records."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS) -> None:
        """path may hold the table of an earlier session, made with the same number of buckets."""
        self.spark, self.path, self.buckets = spark, path or shared_path(spark, "history"), buckets
        self.name = f"history_{uuid.uuid4().hex}"
        columns = "key bigint, class bigint, kind int, bytes bigint, length int, core string, bare boolean"
        spark.sql(f"create table {self.name} ({columns}) using parquet clustered by (key) into {buckets} buckets location '{self.path}/keys'")

    def close(self) -> None:
        """Forgets the table's name; its files stay."""
        self.spark.sql(f"drop table if exists {self.name}")

    def add(self, records: DataFrame) -> str:
        """Looks a batch of prepared records up, appends what is new in it, and gives the path of its classes: x and
        label for those that stand for others and aren't alone with their content."""
        work = shared_path(self.spark, "batch")

        def step(df: DataFrame, name: str) -> DataFrame:
            self.last = f"{work}/{name}"
            df.write.parquet(self.last)
            return self.spark.read.schema(df.schema).parquet(self.last)

        probes = F.aggregate(F.filter("keys", lambda k: k["probe"] & (k["kind"] == TEXT)), F.lit(0), lambda acc, k: acc + k["weight"])
        heads = records.filter("first = meta_id").withColumns({"own": F.col("meta_id"), "need": COVERED * probes})

        # Within the batch each record meets the first that holds one of its keys, which brings most copies together ...
        first = _held(heads, "own").groupBy("key", "kind", "bare").agg(F.min(F.struct("class", "bytes", "length", "core")).alias("f")).select("key", "f.*", "bare")
        near = _covered(_asked(heads), first).filter("class < meta_id").groupBy("meta_id").agg(F.min("class").alias("head"))
        seen = Observation()
        heads = heads.join(near, "meta_id", "left").withColumn("own", F.coalesce("head", "meta_id"))
        heads = step(heads.observe(seen, F.count_if(F.col("head").isNotNull()).alias("met"), F.count("*").alias("all")), "heads")
        if 8 * seen.get["met"] >= seen.get["all"]:
            # Many copies: what is left meets the largest content under each of its keys, in all its forms. This only spares
            # the next step work, which compares with every content.
            held = _held(heads, "own").groupBy("key", "class", "kind", "core", "bare").agg(F.count("*").alias("n"), F.min("bytes").alias("bytes"), F.min("length").alias("length"))
            largest = held.groupBy("key", "kind", "bare").agg(F.max_by(F.struct("class", "bytes", "length", "core"), F.struct("n", F.negate("class"))).alias("f")).select("key", "f.*", "bare")
            more = _covered(_asked(heads.filter("head is null")), largest).groupBy("meta_id").agg(F.min("class").alias("more"))
            heads = heads.join(more, "meta_id", "left").withColumns({"head": F.coalesce("head", "more"), "own": F.coalesce("more", "own")}).drop("more")
            heads = step(heads, "gathered")
        # ... and then, with those taken as one, every content of the batch and of the history that shares a probe.
        mine = _forms(_held(heads, "own"))
        met = _covered(_asked(heads), mine.unionByName(self.spark.table(self.name))).unionByName(heads.filter("head is not null").select("meta_id", F.col("head").alias("class")))
        ends = F.explode(F.array(F.struct(F.col("meta_id").alias("x"), F.col("class").alias("y")), F.struct(F.col("class").alias("x"), F.col("meta_id").alias("y"))))
        edges = step(met.select(ends.alias("e")).select("e.*").distinct(), "edges")
        classes = connected(edges, step)
        placed = self.last

        # Appended: only keys that don't lead to this content yet, at this size. The join is by key alone, as the table is bucketed.
        known = heads.join(classes.withColumnRenamed("x", "meta_id"), "meta_id", "left").withColumn("content", F.coalesce("label", "meta_id"))
        leading = _placed(_forms(_held(known, "content").repartition(self.buckets, "key")))
        said = _placed(self.spark.table(self.name)).groupBy(*PLACE).agg(F.min("bytes").alias("_low"), F.max("bytes").alias("_high"))
        said = said.select(F.col("key").alias("_key"), F.col("class").alias("_class"), F.col("cell").alias("_cell"), F.col("core").alias("_core"), F.col("bare").alias("_bare"), "_low", "_high")
        same = (F.col("key") == F.col("_key")) & (F.col("class") - F.col("_class") == 0) & (F.col("cell") - F.col("_cell") == 0) & F.concat_ws(",", F.lit("="), "core", "bare").eqNullSafe(F.concat_ws(",", F.lit("="), "_core", "_bare"))
        new = leading.join(said, same & F.col("bytes").between(F.col("_low"), F.col("_high")), "left_anti")
        new.select("key", "class", "kind", "bytes", "length", "core", "bare").write.insertInto(self.name)
        return placed


def repeated_records(meta: DataFrame, path: str | None = None) -> DataFrame:
    """meta_id_a, meta_id_b: for every record b of a batch from 1 on whose content was accepted before, in an earlier
    batch or earlier in its own, the first record a with that content.

    The content is the same if the checksums are; or, one being null, if sizes are equal and names alike; or if at
    nearly the same size and length the content's chunks, in whatever of its forms were accepted, cover enough of the
    rarest of the opening. Records of no or unknown size are no case, nor are rows whose batch or meta_id is null.
    A meta_id that comes twice in a batch counts once. Null heads and names match nothing by themselves. Batches are
    taken in order, each looked up in and then added to a history that is only ever appended to; meta_id ascends with
    the batch. Other columns are ignored.
    """
    spark = meta.sparkSession
    numbers = [r[0] for r in meta.select("batch").filter("batch is not null").distinct().orderBy("batch").collect()]
    at = shared_path(spark, "prepared")
    rows = prepared(meta.filter("batch is not null"))
    rows.write.partitionBy("batch").parquet(at)
    batch_schema = T.StructType([f for f in rows.schema if f.name != "batch"])
    history, placed = History(spark, path), []
    for number in numbers:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/batch={number}")
        if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            placed.append(history.add(spark.read.schema(batch_schema).parquet(f"{at}/batch={number}")))
    history.close()
    if not placed:
        return spark.createDataFrame([], "meta_id_a bigint, meta_id_b bigint")
    classes = spark.read.schema("x bigint, label bigint").parquet(*placed).groupBy("x").agg(F.min("label").alias("label"))
    later = spark.read.schema(rows.schema).parquet(at).filter("batch >= 1").select("meta_id", "first")
    found = later.join(classes, F.col("first") == F.col("x"), "left").select(F.coalesce("label", "first").alias("meta_id_a"), F.col("meta_id").alias("meta_id_b"))
    return found.filter("meta_id_a < meta_id_b")
