"""Recursive-descent grammar of delimited records.

    file    := record (LF record)*
    record  := cell (SEP cell)*
    cell    := quoted | plain
    quoted  := QUOTE (char | QUOTE QUOTE)* QUOTE      followed by SEP, LF or the end
    plain   := any characters up to SEP, LF or the end, not starting with QUOTE

A record that breaks a rule becomes a located error. Inside a file the parser then resumes at the
next validated record-start anchor: a line start from which a whole record parses and has the
layout's width and types.
"""

from __future__ import annotations

import datetime
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

_BIGINT = re.compile(r"[+-]?[0-9]+")
_DECIMAL = re.compile(r"[+-]?[0-9]+(?:\.[0-9]+)?")
_DATE = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")


def is_bigint(cell: str) -> bool:
    if not _BIGINT.fullmatch(cell):
        return False
    digits = cell.lstrip("+-").lstrip("0")
    return len(digits) < 20 and int(digits or "0") < (1 << 63) + cell.startswith("-")


def is_decimal(cell: str) -> bool:
    return bool(_DECIMAL.fullmatch(cell))


def is_date(cell: str) -> bool:
    if not _DATE.fullmatch(cell):
        return False
    try:
        datetime.date(int(cell[:4]), int(cell[5:7]), int(cell[8:]))
    except ValueError:
        return False
    return True


def is_boolean(cell: str) -> bool:
    return cell.lower() in ("true", "false")


CHECKS = {"bigint": is_bigint, "decimal": is_decimal, "date": is_date, "boolean": is_boolean}


@dataclass
class Record:
    """cells of a valid record, or the error and its position in the text."""

    start: int
    end: int
    cells: list[str] | None = None
    error: str | None = None
    at: int | None = None


class _Broken(Exception):
    def __init__(self, reason: str, at: int) -> None:
        self.reason, self.at = reason, at


@dataclass
class RecordGrammar:
    sep: str
    quote: str
    columns: list[tuple[str, str, bool]]
    _closing: tuple[str, int, int] = field(init=False, default=("", 0, -1))

    def __post_init__(self) -> None:
        if not self.sep:
            raise ValueError("a layout needs a separator")
        self._width = len(self.columns)
        self._typed = [(i, name, CHECKS[kind]) for i, (name, kind, _) in enumerate(self.columns) if kind in CHECKS]
        self._required = [(i, name) for i, (name, _, required) in enumerate(self.columns) if required]

    @staticmethod
    def from_spec(spec: str) -> RecordGrammar:
        sep, quote, columns = json.loads(spec)
        return RecordGrammar(sep, quote or "", [tuple(c) for c in columns])

    # The grammar's rules. Each takes the position it starts at and gives the position it ends at.

    def _cell(self, text: str, pos: int, end: int, cells: list[str], starts: list[int]) -> int:
        starts.append(pos)
        if self.quote and text.startswith(self.quote, pos, end):
            return self._quoted_cell(text, pos, end, cells)
        stop = text.find(self.sep, pos, end)
        stop = end if stop < 0 else stop
        cells.append(text[pos:stop])
        return stop

    def _close(self, text: str, pos: int, end: int) -> int:
        """Where the quoted cell whose content starts at pos is closed: at the first quote that isn't one of a pair. The end
        if it isn't."""
        q = self.quote
        while text.startswith(q + q, pos, end):
            pos += 2 * len(q)
        if text.startswith(q, pos, end):
            return pos
        # From here the next single quote is the same for all starts up to it; those of a file are looked for once.
        seen, start, close = self._closing
        if end == len(text) and seen is text and start <= pos <= close:
            return close
        at = text.find(q, pos, end)
        while at >= 0 and text.startswith(q, at + len(q), end):
            at = text.find(q, at + 2 * len(q), end)
        at = end if at < 0 else at
        if end == len(text):
            self._closing = (text, pos, at)
        return at

    def _quoted_cell(self, text: str, pos: int, end: int, cells: list[str]) -> int:
        q = self.quote
        close = self._close(text, pos + len(q), end)
        if not text.startswith(q, close, end):
            raise _Broken("quoted cell is not closed", pos)
        cells.append(text[pos + len(q) : close].replace(q + q, q))
        after = close + len(q)
        if after < end and not text.startswith(self.sep, after, end):
            raise _Broken("text after the closing quote", after)
        return after

    def _record(self, text: str, pos: int, end: int) -> tuple[list[str], list[int]]:
        cells: list[str] = []
        starts: list[int] = []
        pos = self._cell(text, pos, end, cells, starts)
        while pos < end:
            pos = self._cell(text, pos + len(self.sep), end, cells, starts)
        return cells, starts

    def _validate(self, cells: list[str], starts: list[int]) -> None:
        if len(cells) != self._width:
            raise _Broken(f"expecting {self._width} cells but got {len(cells)}", starts[min(len(cells), self._width) - 1])
        for i, name in self._required:
            if not cells[i].strip(" "):
                raise _Broken(f"required cell {name} is empty", starts[i])
        for i, name, check in self._typed:
            cell = cells[i].strip(" ")
            if cell and not check(cell):
                raise _Broken(f"cell {name} is not a {self.columns[i][1]}", starts[i])

    def line(self, text: str | None, start: int = 0, end: int | None = None) -> Record:
        """One record that takes up the whole of text[start:end]; a carriage return at the end isn't part of it."""
        text = text or ""
        end = stop = len(text) if end is None else end
        if text.endswith("\r", start, end):
            end -= 1
        if not text[start:end].strip():
            return Record(start, stop, error="Zero length line", at=start)
        try:
            cells, starts = self._record(text, start, end)
            self._validate(cells, starts)
        except _Broken as broken:
            return Record(start, stop, error=broken.reason, at=broken.at)
        return Record(start, stop, cells)

    def _record_end(self, text: str, pos: int) -> int | None:
        """Where the record that starts at pos ends: at a line feed outside quoted cells. None: its quoting is broken."""
        q, size = self.quote, len(text)
        while True:
            if q and text.startswith(q, pos):
                close = self._close(text, pos + len(q), size)
                pos = close + len(q)
                if not text.startswith(q, close) or not (pos >= size or text.startswith((self.sep, "\n", "\r\n"), pos)):
                    return None
            feed, sep = text.find("\n", pos), text.find(self.sep, pos)
            if feed < 0 and sep < 0:
                return size
            if sep < 0 or 0 <= feed < sep:
                return feed
            pos = sep + len(self.sep)

    def _anchor(self, text: str, pos: int) -> int | None:
        """The next line start after pos from which a valid record parses."""
        feed = text.find("\n", pos)
        while feed >= 0 and feed + 1 < len(text):
            end = self._record_end(text, feed + 1)
            if end is not None and self.line(text, feed + 1, end).error is None:
                return feed + 1
            feed = text.find("\n", feed + 1)
        return None

    def file(self, text: str) -> Iterator[Record]:
        """All records of a text, failed ones included; nothing of the text is left out."""
        pos = 0
        while pos < len(text):
            end = self._record_end(text, pos)
            if end is None:
                anchor = self._anchor(text, pos)
                stop = len(text) if anchor is None else anchor - 1
                record = self.line(text, pos, stop)
                if record.error is None:  # the broken cell is only closed beyond the anchor
                    record = Record(pos, stop, error="quoted cell is not closed", at=pos)
                yield record
                pos = stop + 1
            else:
                yield self.line(text, pos, end)
                pos = end + 1
