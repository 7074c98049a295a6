"""Turning delimited files into records: separator and header detection, the two row rules, and a registry of processors."""

from __future__ import annotations

import csv
import functools
import io
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.scan import file_type, line_estimate

SAMPLE_LINES = 1000
SAMPLE_BYTES = 4 << 20
#: Signs that separate cells more often than others, the likelier first (fixed values).
COMMON_SEPARATORS = [",", "\t", ";", "|", "~", "||", ":"]
RECORD = "src_file_rec string, src_file_row bigint, cells map<string,string>, _load_error string, _line_b64encoded string"


def _constant_width(lines: list[str], separator: str) -> int | None:
    widths = {len(line.split(separator)) for line in lines}
    return widths.pop() if len(widths) == 1 and max(widths, default=0) != 1 else None


def detect_separator(lines: list[str], strategy: str = "signs") -> str | None:
    """The separator that cuts every sampled line into the same number of cells, more than one; None if there is none.

    "signs" tries the common separators first, then every other run of up to three signs by length, shortest first; if
    none fits all lines, that by which at least half are as wide as the first.
    "ngram" tries all runs of up to three characters, the longest first, then the most frequent; letters count too, so
    what all lines begin with may win.
    """
    lines = [x for x in lines[:SAMPLE_LINES] if x.strip()]
    if not lines:
        return None
    grams: Counter[str] = Counter()
    for line in lines:
        bare = line.strip()
        for n in (1, 2, 3):
            grams.update(bare[i : i + n] for i in range(len(bare) - n + 1))
    if strategy == "ngram":
        ranked = sorted(grams, key=lambda g: (-len(g), -grams[g]))  # of equals the first met
    elif strategy == "signs":
        other = sorted((g for g in grams if not re.search(r"[\w\s\"'.-]", g)), key=lambda g: (len(g), -grams[g], g))
        ranked = [*COMMON_SEPARATORS, *other]
        double = [g for g in ranked if len(g) == 2 and len(set(g)) == 1 and _constant_width(lines, g)]
        ranked = double + ranked  # || also cuts at |, into cells with empty ones between
    else:
        raise ValueError(f"no strategy {strategy}")
    found = next((g for g in ranked if _constant_width(lines, g)), None)
    if found is None and strategy == "signs":
        # Some lines don't fit: the sign by which most are as wide as the header.
        fitting = {g: sum(len(x.split(g)) == len(lines[0].split(g)) for x in lines) for g in COMMON_SEPARATORS if g in lines[0]}
        found = max(fitting, key=lambda g: fitting[g], default=None)
        found = found if found and 2 * fitting[found] >= len(lines) else None
    return found


def parse_header(line: str, separator: str) -> list[str]:
    """Column names in lower case; only letters, digits and underscores may be in them, and each only once."""
    names = [plain_cell(c).lower() for c in line.rstrip("\r\n").split(separator)]
    bad = [n for n in names if not re.fullmatch("[a-z0-9_]+", n)]
    if bad or len(set(names)) < len(names):
        raise ValueError(f"column names that can't be used: {bad or names}")
    return names


def plain_cell(cell: str) -> str:
    cell = cell.strip()
    return cell[1:-1] if len(cell) > 1 and cell[0] == cell[-1] and cell[0] in "\"'" else cell


def quoted_cells(line: str, separator: str, quote: str) -> list[str]:
    """The cells of a line; what stands in quotes may hold the separator, and a doubled quote stands for one. A quote
    that is not closed is plain text."""
    cells, at = [], 0
    while True:
        start = at + len(line[at:]) - len(line[at:].lstrip(" \t")) if not separator.isspace() else at
        end, cell = -1, None
        if line.startswith(quote, start):
            close = start + 1
            while (close := line.find(quote, close)) >= 0 and line.startswith(quote, close + 1):
                close += 2
            rest = line[close + 1 :].lstrip(" ") if close >= 0 else ""
            if close >= 0 and (not rest or rest.startswith(separator)):
                cell, end = line[start + 1 : close].replace(quote * 2, quote).strip(), len(line) - len(rest) if rest else -1
        if cell is None:
            end = line.find(separator, at)
            cell = line[at : end if end >= 0 else None].strip()
        cells.append(cell)
        if end < 0:
            return cells
        at = end + len(separator)


def generic_rows(text: str, separator: str | None = None, quote: str | None = None, lineend: str | None = None) -> Iterator[tuple[dict | None, str | None, str]]:
    """(cells, error, line) of each line after the header: short rows are filled up with nothing, long ones fail. With a
    quote cells may be quoted, else matching quotes around a cell are taken off; lines end as given, else as usual."""
    lines = text.splitlines() if lineend is None else text.removesuffix(lineend).split(lineend)
    if not lines:
        return
    separator = separator or detect_separator(lines)
    if separator is None:
        raise ValueError("no separator found")
    names = parse_header(lines[0], separator)
    for line in lines[1:]:
        if not line.strip():
            yield None, "Zero length line", line
            continue
        cells = quoted_cells(line.strip(), separator, quote) if quote else [plain_cell(c) for c in line.strip().split(separator)]
        if len(cells) > len(names):
            yield None, f"expecting {len(names)} cells but got {len(cells)}", line
        else:
            yield {n: c for n, c in zip(names, cells) if c}, None, line


def csv_rows(text: str, separator: str | None = None, quote: str | None = None, lineend: str | None = None) -> Iterator[tuple[dict | None, str | None, str]]:
    """(cells, error, line) of each record of a comma-separated text: blank lines are skipped, short rows fail too. The
    line of a failed record is what stands in the file; the records after it are read on."""
    csv.field_size_limit(sys.maxsize)
    taken: list[str] = []

    def lines() -> Iterator[str]:
        for line in io.StringIO(text, newline="") if lineend is None else (x + "\n" for x in text.removesuffix(lineend).split(lineend)):
            taken.append(line)
            yield line

    reader = csv.reader(lines(), delimiter=separator or ",", quotechar=quote or '"')
    names = None
    while True:
        taken.clear()
        try:
            cells = next(reader)
        except StopIteration:
            return
        except csv.Error as error:
            yield None, str(error), "".join(taken).rstrip("\r\n")
            continue
        if not cells:
            continue
        if names is None:
            names = [c.strip().lower() for c in cells]
            continue
        if len(cells) != len(names):
            yield None, f"expecting {len(names)} cells but got {len(cells)}", "".join(taken).rstrip("\r\n")
        else:
            yield {n: c for n, c in zip(names, cells) if c.strip(" \t\r\n'\"")}, None, ""


#: name: (rows of a text, filters that its catalogue records must satisfy)
PROCESSORS: dict[str, tuple[Callable, list[str]]] = {
    "generic": (generic_rows, ["mime=text/.*", "!est_lines=0$"]),
    "csv": (csv_rows, ["mime=text/.*", "!est_lines=0$"]),
}


def register(name: str, rows: Callable, filters: list[str]) -> None:
    PROCESSORS[name] = (rows, filters)


def _passes(filters: list[str], record: dict) -> bool:
    """Whether a catalogue record satisfies every filter, as operators.catalog.pair_filter has it."""
    pairs = [f"{k}={v}" for k, v in record.items() if v is not None]
    return all(any(re.search(f.lstrip("!"), p, re.IGNORECASE) for p in pairs) != f.startswith("!") for f in filters)


def no_overlap(selections: dict[str, DataFrame], key: str = "sha256") -> None:
    """An error if a file is selected for more than one processor."""
    every = functools.reduce(DataFrame.unionByName, [df.select(F.col(key).alias("file"), F.lit(name).alias("by")) for name, df in selections.items()])
    twice = every.filter("file is not null").groupBy("file").agg(F.array_sort(F.collect_set("by")).alias("by")).filter("size(by) > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0].file} is selected by {' and '.join(twice[0].by)}")


def dataset_filter(cid: int) -> str:
    """The filter of a dataset's own files: their paths begin with its number in eight digits."""
    return f"^path={cid:08d}.*"


def load_files(
    spark: SparkSession,
    folder: str,
    processor: str = "generic",
    separator: str | None = None,
    encoding: str | None = None,
    quote: str | None = None,
    lineend: str | None = None,
    catalog: DataFrame | None = None,
    cid: int | None = None,
) -> DataFrame:
    """Records of all files under a folder, each file by one task: src_file_rec is <path>:<row from 0>, rows count from 1
    over valid and failed ones. Files that the processor's filters refuse are left out, as are, given a cid, those of
    other datasets; a file's type and lines are as the catalogue has them, else told from its opening. Text is read as
    given, else as the catalogue says, else as UTF-8, what doesn't fit replaced. A file that can't be read as a whole
    gives one failed row."""
    rows_of, filters = PROCESSORS[processor]
    filters = [*filters, *([dataset_filter(cid)] if cid is not None else [])]
    root = folder.rstrip("/").removeprefix("file://")

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64

        names = [f.split()[0] for f in RECORD.split(", ")]
        for batch in batches:
            for path, content, mime, enc, est in zip(batch["path"], batch["content"], batch["mime"], batch["enc"], batch["est_lines"]):
                file = path.removeprefix("file:").replace("//", "/").removeprefix(root).lstrip("/")
                content, out = bytes(content), []
                head = content[:SAMPLE_BYTES]
                told = {"path": file, "mime": mime or file_type(head, file)[0], "enc": enc, "est_lines": line_estimate(head, len(content)) if pd.isna(est) else int(est)}
                if not _passes(filters, told):
                    continue
                known = encoding or enc or "utf-8"
                try:
                    options = {k: v for k, v in (("quote", quote), ("lineend", lineend)) if v is not None}
                    for n, (cells, error, line) in enumerate(rows_of(content.decode(known, "replace"), separator, **options)):
                        raw = base64.b64encode(line.encode(known, "replace")).decode() if error else None
                        out.append((f"{file}:{n}", n + 1, cells, error, raw))
                except (ValueError, LookupError) as failure:
                    out.append((f"{file}:{len(out)}", len(out) + 1, None, str(failure), None))
                for start in range(0, len(out), 10_000):
                    yield pd.DataFrame(out[start : start + 10_000], columns=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "content")
    if catalog is None:
        none = {c: F.lit(None).cast(k) for c, k in (("mime", "string"), ("enc", "string"), ("est_lines", "bigint"))}
        return files.withColumns(none).mapInPandas(load, RECORD)
    place = F.ltrim(F.replace(F.regexp_replace("path", "^file:/+", "/"), F.lit(root), F.lit("")), F.lit("/"))
    said = catalog.select(F.concat_ws("/", F.nullif("path", F.lit("")), "file").alias("place"), "mime", "enc", "est_lines").dropDuplicates(["place"])
    return files.withColumn("place", place).join(said, "place", "left").drop("place").mapInPandas(load, RECORD)


def to_columns(records: DataFrame, names: list[str]) -> DataFrame:
    """The records' cells as columns of that name, beside what failed rows hold."""
    return records.select("src_file_rec", *[F.col("cells")[n].alias(n) for n in names], "_load_error", "_line_b64encoded", F.when(F.col("_load_error").isNotNull(), F.col("src_file_row")).alias("row"))
