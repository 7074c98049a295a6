"""Scanning folders into a file catalogue, opening archives, and the readers and sinks around it."""

from __future__ import annotations

import bz2
import gzip
import hashlib
import io
import lzma
import os
import re
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that type, encoding and number of lines are told from.
SAMPLE = 4 << 20
#: An archive within an archive is opened to this depth.
MAX_DEPTH = 8
CATALOG = "path string, file string, bytes bigint, size string, ctime timestamp, mtime timestamp, mime string, enc string, sha256 string, est_lines bigint, access_path array<struct<kind:string,member:string>>, error string"
#: First bytes and the type that they tell.
MAGIC = [(b"070701", "application/x-cpio"), (b"070702", "application/x-cpio"), (b"!<arch>\n", "application/x-archive"), (b"\xfd7zXZ\0", "application/x-xz"), (b"PK\x03\x04", "application/zip"), (b"\x1f\x8b", "application/gzip"), (b"BZh", "application/x-bzip2"), (b"\x1f\x9d", "application/x-compress"), (b"7z\xbc\xaf\x27\x1c", "application/x-7z-compressed"), (b"Rar!", "application/x-rar"), (b"%PDF", "application/pdf"), (b"\x89PNG", "image/png"), (b"\xff\xd8\xff", "image/jpeg"), (b"II*\x00", "image/tiff"), (b"MM\x00*", "image/tiff"), (b"\xd0\xcf\x11\xe0", "application/vnd.ms-excel")]
UNSUPPORTED = {"application/x-7z-compressed", "application/x-rar"}
OFFICE = (".xlsx", ".docx", ".pptx", ".odt", ".ods", ".odp", ".xls", ".doc", ".ppt")


def file_type(head: bytes, name: str = "") -> tuple[str, str]:
    """(mime, encoding) told from the first bytes."""
    if not head:
        return "inode/x-empty", "binary"
    for magic, mime in MAGIC:
        if head.startswith(magic):
            return mime, "binary"
    if head[257:262] == b"ustar":
        return "application/x-tar", "binary"
    if b"\0" in head[:1024]:
        return "application/octet-stream", "binary"
    try:
        head.decode("ascii")
        encoding = "ascii"
    except UnicodeDecodeError:
        try:
            head.decode("utf-8")
            encoding = "utf-8"
        except UnicodeDecodeError as error:
            # A character cut at the sample's end is no fault.
            encoding = "utf-8" if error.start >= len(head) - 3 and len(head) >= SAMPLE else "windows-1252" if any(0x80 <= b < 0xA0 for b in head) else "iso-8859-1"
    start = head.lstrip()[:64].lower()
    if start.startswith((b"<!doctype html", b"<html")):
        return "text/html", encoding
    return ("text/csv" if name.lower().endswith(".csv") else "text/plain"), encoding


def line_estimate(head: bytes, size: int) -> int:
    """Lines of the sample carried on to the whole size; the sample is what was read, however short."""
    if not head:
        return 0
    lines = head.count(b"\n") + (not head.endswith(b"\n"))
    return max(1, lines * size // len(head))


def human_size(size: float) -> str:
    for n, unit in reversed(list(enumerate(["b", "Kb", "Mb", "Gb", "Tb"]))):
        if size / 1024**n > 0.5 or n == 0:
            return f"{size / 1024**n:.1f}{unit}"
    return ""


Member = tuple[str, bytes, object]


def unlzw(data: bytes) -> bytes:
    """What compress packed (.Z): codes of 9 bits and more, the least bit first, in groups of eight of one width."""
    if data[:2] != b"\x1f\x9d" or len(data) < 3:
        raise ValueError("not a compressed file")
    most, block = data[2] & 31, bool(data[2] & 128)
    if not 9 <= most <= 16:
        raise ValueError(f"codes of {most} bits")
    first = 257 if block else 256
    table = [bytes([i]) for i in range(256)] + [b""] * (first - 256)
    out, width, previous = bytearray(), 9, b""
    bit, end, taken = 24, 8 * len(data), 0
    while bit + width <= end:
        at = bit >> 3
        code = int.from_bytes(data[at : at + 4], "little") >> (bit & 7) & (1 << width) - 1
        bit, taken = bit + width, taken + 1
        if block and code == 256:
            bit += -taken % 8 * width  # the rest of the group is empty
            del table[first:]
            width, previous, taken = 9, b"", 0
            continue
        if code < len(table):
            entry = table[code]
        elif code == len(table) and previous:
            entry = previous + previous[:1]
        else:
            raise ValueError("a code that stands for nothing")
        out += entry
        if previous and len(table) < 1 << most:
            table.append(previous + entry[:1])
        previous = entry
        if len(table) == 1 << width and width < most:
            bit += -taken % 8 * width
            width, taken = width + 1, 0
    return bytes(out)


def _zip(content: bytes, name: str) -> Iterator[Member]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for info in z.infolist():
            if not info.is_dir() and info.file_size:
                yield info.filename, z.read(info), pd.Timestamp(*info.date_time)


def _tar(content: bytes, name: str) -> Iterator[Member]:
    with tarfile.open(fileobj=io.BytesIO(content)) as t:
        for info in t:
            if info.isfile() and info.size:
                yield info.name, t.extractfile(info).read(), pd.Timestamp(info.mtime, unit="s")


def _cpio(content: bytes, name: str) -> Iterator[Member]:
    """The portable ASCII format: a header of hexadecimal numbers, name and content, each filled up to four bytes."""
    at = 0
    while content[at : at + 6] in (b"070701", b"070702"):
        numbers = [int(content[at + 6 + 8 * i : at + 14 + 8 * i], 16) for i in range(13)]
        mode, mtime, size, length = numbers[1], numbers[5], numbers[6], numbers[11]
        member = content[at + 110 : at + 110 + length - 1].decode("utf-8", "replace")
        start = at + (110 + length + 3) // 4 * 4
        if member == "TRAILER!!!":
            return
        if start + size > len(content):
            raise ValueError("the archive is cut off")
        if mode & 0o170000 == 0o100000 and size:
            yield member, content[start : start + size], pd.Timestamp(mtime, unit="s")
        at = start + (size + 3) // 4 * 4
    raise ValueError("the archive has no end")


def _ar(content: bytes, name: str) -> Iterator[Member]:
    """Unix archives: headers of 60 characters; long names stand in a member of their own."""
    at, long_names = 8, b""
    while at + 60 <= len(content):
        header = content[at : at + 60]
        label, size = header[:16].decode("utf-8", "replace").rstrip(), int(header[48:58])
        data, at = content[at + 60 : at + 60 + size], at + 60 + size + size % 2
        if label == "//":
            long_names = data
        elif label not in ("/", "/SYM64/") and data:
            if label[:1] == "/" and label[1:].isdigit():
                label = long_names[int(label[1:]) :].split(b"\n")[0].decode("utf-8", "replace")
            when = header[16:28].strip()
            yield label.rstrip("/"), data, pd.Timestamp(int(when), unit="s") if when else None


def _single(unpack: Callable[[bytes], bytes]) -> Callable[[bytes, str], Iterator[Member]]:
    """Formats that hold one file, named like the container without its extension."""

    def read(content: bytes, name: str) -> Iterator[Member]:
        stem, extension = os.path.splitext(os.path.basename(name))
        data = unpack(content)
        if data:
            yield (stem if len(extension) <= 4 or extension == ".gzip" else "decompressed"), data, None

    return read


#: Containers by type: a function of content and name that gives (name, content, time) of every file of more than no
#: bytes. Others can be added.
CONTAINERS: dict[str, Callable[[bytes, str], Iterator[Member]]] = {
    "application/zip": _zip, "application/x-tar": _tar, "application/gzip": _single(gzip.decompress), "application/x-bzip2": _single(bz2.decompress), "application/x-compress": _single(unlzw),
    "application/x-cpio": _cpio, "application/x-archive": _ar, "application/x-xz": _single(lzma.decompress),
}


def register_container(mime: str, magic: bytes, read: Callable[[bytes, str], Iterator[Member]]) -> None:
    """A further format, told by a file's first bytes."""
    MAGIC.insert(0, (magic, mime))
    CONTAINERS[mime] = read


def catalog_rows(path: str, file: str, content: bytes, mtime, access: list[dict], depth: int = 0) -> Iterator[dict]:
    head = content[:SAMPLE]
    mime, encoding = file_type(head, file)
    row = {
        "path": path, "file": file, "bytes": len(content), "size": human_size(len(content)), "ctime": None, "mtime": mtime, "mime": mime, "enc": encoding,
        "sha256": hashlib.sha256(content).hexdigest(), "est_lines": line_estimate(head, len(content)) if encoding != "binary" else None, "access_path": access, "error": None,
    }
    container = mime in CONTAINERS and not file.lower().endswith(OFFICE)
    if container and depth >= MAX_DEPTH:
        row["error"] = f"archives within archives beyond {MAX_DEPTH}"
    if mime in UNSUPPORTED and not container:
        row["error"] = f"{mime} can't be opened here"
    inner: list[dict] = []
    if container and depth < MAX_DEPTH:
        try:
            base = access or [{"kind": "file", "member": f"{path}/{file}"}]
            for name, data, time in CONTAINERS[mime](content, file):
                kind = mime.rsplit("/", 1)[1].removeprefix("x-")
                inner += catalog_rows(f"{path}/{file}", name, data, time, [*base, {"kind": kind, "member": name}], depth + 1)
        except Exception as error:  # a broken archive is a fault of the file, not of the scan
            row["error"] = f"{type(error).__name__}: {error}"
    yield row
    yield from inner


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """A catalogue row for every file under a folder and every member of its archives that isn't empty; each file is read
    by one task. Archives within archives are opened MAX_DEPTH deep, those beyond carry an error."""
    root = folder.rstrip("/").removeprefix("file://")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [f.split()[0] for f in CATALOG.split(", ")]
        for batch in batches:
            for path, content, mtime in zip(batch["path"], batch["content"], batch["modificationTime"]):
                full = path.removeprefix("file:").replace("//", "/")
                where, file = os.path.split(os.path.relpath(full, root))
                yield pd.DataFrame(list(catalog_rows(where, file, bytes(content), mtime, [])), columns=columns)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    # Spark gives files of no bytes to no task; they are what its listing has besides.
    listed = spark.createDataFrame([(unquote(re.sub("^file:/+", "file:/", p)),) for p in files.inputFiles()], "path string")
    empty = listed.join(files.select("path"), "path", "left_anti").select("path", F.lit(b"").alias("content"), F.lit(None).cast("timestamp").alias("modificationTime"))
    return files.select("path", "content", "modificationTime").unionByName(empty).mapInPandas(rows, CATALOG)


def read_catalog(spark: SparkSession, pattern: str) -> DataFrame:
    """The union of catalogue files, each a JSON list of records."""
    return spark.read.schema(CATALOG).option("multiLine", True).json(pattern)


def write_catalog(catalog: DataFrame, folder: str) -> None:
    """One sorted part per dataset (the first eight digits of the path); other datasets' parts stay."""
    dataset = catalog.withColumn("cid", F.regexp_extract("path", r"^(\d{8})", 1))
    dataset.repartition("cid").sortWithinPartitions("path", "file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cid").parquet(folder)


def read_json_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row a line, as text: records of different fields stand side by side (bz2 files are split between tasks)."""
    return spark.read.text(paths).withColumnRenamed("value", "line")


def write_json_lines(records: DataFrame, folder: str, compression: str = "bzip2") -> None:
    """JSON lines without null fields, compressed."""
    records.write.mode("overwrite").option("compression", compression).option("ignoreNullFields", True).json(folder)


def read_manifest(spark: SparkSession, pattern: str) -> DataFrame:
    """filename, sha256 of manifest files <filename>.json, each a JSON list of checksums."""
    text = spark.read.option("wholetext", True).text(pattern).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json[^/]*$", 1).alias("filename"), "value")
    return text.select("filename", F.explode(F.from_json("value", "array<string>")).alias("sha256"))


def write_manifest(manifest: DataFrame, folder: str) -> None:
    """The checksums of each output as a JSON list, in one row a file name."""
    manifest.filter("sha256 is not null").groupBy("filename").agg(F.to_json(F.array_sort(F.collect_set("sha256"))).alias("value")).write.mode("overwrite").partitionBy("filename").text(folder)


def read_markings(spark: SparkSession, pattern: str) -> DataFrame:
    """cid and the fields of marking files <cid>.json, one JSON object each."""
    read = spark.read.option("multiLine", True).json(pattern)
    return read.withColumn("cid", F.regexp_extract(F.input_file_name(), r"(\d+)\.json[^/]*$", 1).cast("int"))


def record_ids(files: DataFrame, path: str = "path", row: str = "row") -> DataFrame:
    """src_file_rec of rows numbered from 1 in their file: <path>:<row from 0>."""
    return files.withColumn("src_file_rec", F.concat(F.col(path), F.lit(":"), (F.col(row) - 1).cast("string")))


def write_selection(catalog: DataFrame, folder: str) -> None:
    """The selected records as JSON lines, in order of their full path."""
    catalog.orderBy("path", "file").write.mode("overwrite").json(folder)
