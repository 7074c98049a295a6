"""Text that was decoded with an encoding other than its own.

Characters are mapped back to the bytes that the wrong encoding read. Where these are UTF-8, a byte-structure automaton
finds the maximal well-formed multibyte spans and only those are decoded. Single-byte text read as another single-byte
encoding has no byte structure; there a word counts as garbled if its bytes, read otherwise, give a word that the whole
corpus has far more often. Replacement characters, control characters and scripts mixed within a word tell of text that
was garbled whether or not it can be restored.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import cut_lineage

#: Encodings that text was read with (fixed values: Python's codec names).
READ_AS = ["cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "koi8-r", "iso8859-5", "cp866", "cp437", "cp850", "cp852", "mac-roman", "cp1253", "iso8859-7", "cp1254", "iso8859-15", "mac-cyrillic", "cp737"]
#: Single-byte encodings that text was written in.
WRITTEN_IN = ["cp1252", "iso8859-15", "cp1250", "iso8859-2", "cp1251", "koi8-r", "iso8859-5", "cp866", "cp1253", "iso8859-7", "cp437", "cp850", "cp852", "mac-roman", "mac-cyrillic", "cp737"]
#: Multibyte encodings that text may have been read with; every character beyond ASCII is then two bytes.
READ_AS_WIDE = ["big5", "gb18030", "shift_jis", "euc-kr"]
#: A restored word must be this many times as frequent as the garbled one.
TIMES_MORE = 2.0

#: Shorter words turn into other words by chance; they count as garbled only by their bytes' structure.
MIN_LETTERS = 4

_TOKEN = re.compile(r"[A-Za-z\u0080-\U0010ffff]+")
#: What is left of UTF-8 read as Western text once it was put in lower case.
_LOWERED = re.compile("[\u00e2\u00e3](?=[\u0080-\u00bf])")
_FOREIGN = re.compile(r"[\u0080-\U0010ffff]")


@functools.lru_cache(maxsize=64)
def _to_byte(encoding: str) -> dict[str, int]:
    """Character to byte. Bytes the encoding leaves undefined were passed through as control characters."""
    table = {}
    for byte in range(128, 256):
        try:
            table[bytes([byte]).decode(encoding)] = byte
        except UnicodeDecodeError:
            table.setdefault(chr(byte), byte)
    return table


def _frequent(char: str) -> bool:
    """What a single well-formed sequence may well decode to: letters with marks, Greek, Cyrillic, common signs."""
    code = ord(char)
    return 0xA0 <= code < 0x180 or 0x218 <= code < 0x21C or 0x370 <= code < 0x460 or 0x490 <= code < 0x500 or 0x2010 <= code < 0x2030 or char in "‰‹›€№™�﻿" or 0x1E00 <= code < 0x2000


def _writing(char: str) -> str:
    """The script of a letter by the first word of its name; kana and Chinese characters go together."""
    name = unicodedata.name(char, "").split(" ")[0].split("-")[0]
    return "CJK" if name in ("HIRAGANA", "KATAKANA", "IDEOGRAPHIC", "FULLWIDTH") else name


def _credible(decoded: str) -> bool:
    """Whether a span's text was meant: of any one script, if more than a sequence or two says so by chance. Characters
    of the supplementary planes, emoji among them, take four bytes that chance doesn't give."""
    rest = [c for c in decoded if not _frequent(c) and c not in "\u200d\ufe0f"]
    if not rest:
        return True
    if any(unicodedata.category(c) in ("Cn", "Co", "Cs", "Cc") for c in rest):
        return False
    near = [c for c in rest if ord(c) < 0x10000]
    letters = {_writing(c) for c in near if unicodedata.category(c)[0] in "LM"}
    return len(letters) <= 1 and (not near or len(rest) >= 2)


def utf8_spans(data: list[int]) -> list[tuple[int, int]]:
    """The automaton: maximal runs of well-formed multibyte sequences in a list of bytes (-1: no byte)."""
    spans, i, size = [], 0, len(data)
    while i < size:
        start = i
        while i < size:
            lead = data[i]
            if 0xC2 <= lead <= 0xDF:
                need, low, high = 1, 0x80, 0xBF
            elif 0xE0 <= lead <= 0xEF:
                need, low, high = 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
            elif 0xF0 <= lead <= 0xF4:
                need, low, high = 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
            else:
                break
            tail = data[i + 1 : i + 1 + need]
            if len(tail) < need or not low <= tail[0] <= high or any(not 0x80 <= b <= 0xBF for b in tail[1:]):
                break
            i += need + 1
        if i > start:
            spans.append((start, i))
        else:
            i += 1
    return spans


def decode_spans(text: str, encoding: str) -> tuple[str, int, int]:
    """The text with its well-formed spans decoded, the number of characters they gave, and how many characters beyond
    ASCII stand outside them."""
    table = _to_byte(encoding)
    data = [table.get(c, -1) if ord(c) > 127 else ord(c) for c in text]
    out, last, given, foreign = [], 0, 0, sum(1 for c in text if ord(c) > 127)
    for start, end in utf8_spans(data):
        try:
            decoded = bytes(data[start:end]).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if not _credible(decoded):
            continue
        out += [text[last:start], decoded]
        last, given, foreign = end, given + len(decoded), foreign - (end - start)
    return "".join(out) + text[last:], given, foreign


def _script(char: str) -> str | None:
    if not char.isalpha():
        return None
    code = ord(char)
    if code < 0x250 and code not in (0xAA, 0xBA, 0xB5) or 0x1E00 <= code < 0x1F00:
        return "latin"
    if 0x370 <= code < 0x400 or 0x1F00 <= code < 0x2000:
        return "greek"
    return "cyrillic" if 0x400 <= code < 0x530 else None


def _odd_in_word(token: str) -> bool:
    """Signs between letters that no orthography puts there."""
    for n, c in enumerate(token):
        if 0x2500 <= ord(c) < 0x25A0 or 0x80 <= ord(c) < 0xA0:
            return True
        if 0 < n < len(token) - 1 and token[n - 1].isalpha() and token[n + 1].isalpha() and not c.isalpha() and (unicodedata.category(c) in ("So", "Sm", "Sc", "No", "Cc", "Sk") or c == "§"):
            return True
    return False


def certain_cause(token: str) -> str | None:
    """Why a word is garbled beyond doubt, if it is."""
    if "�" in token:
        return "replacement"
    scripts = {_script(c) for c in token} - {None}
    if len(scripts) > 1:
        return "mixed scripts"
    if any(0x80 <= ord(c) < 0xA0 for c in token):
        return "control character"
    if _odd_in_word(token):
        return "sign within a word"
    return None


def _plausible(word: str) -> bool:
    """A word of one script with capitals, if any, at its start or throughout."""
    letters = [c for c in word if c.isalpha()]
    if len(letters) < len(word) * 0.8 or len({_script(c) for c in letters}) != 1:
        return False
    return word.islower() or word.isupper() or (word[0].isupper() and word[1:].islower()) or not any(c.isupper() != c.islower() for c in word)


def restorations(token: str) -> list[tuple[str, str, bool]]:
    """(restored word, how, sure) for each way to read the word's bytes otherwise; a way is `read as>written in`.
    Sure are UTF-8 spans that cover a word's characters beyond ASCII and couldn't stand there by chance."""
    ways = _ways(token)
    raised = _LOWERED.sub(lambda m: m.group().upper(), token) if token.islower() else token
    return ways if raised == token or any(sure for _, _, sure in ways) else _ways(raised)


def _ways(token: str) -> list[tuple[str, str, bool]]:
    out: dict[str, tuple[str, bool]] = {}
    missed: dict[str, int] = {}
    for wrong in READ_AS:
        table = _to_byte(wrong)
        word, rounds, given, left = token, 0, 0, 1
        while rounds < 3:
            decoded, now, outside = decode_spans(word, wrong)
            if not now:
                break
            word, rounds, given, left = decoded, rounds + 1, given + now, outside
        if rounds:
            if len({_script(c) for c in word} - {None}) > 1:
                continue
            western = wrong in ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp437", "cp850", "cp852", "mac-roman", "cp1254", "iso8859-15")
            known = all(_frequent(c) for c in word if ord(c) > 127)
            sure = western or given >= (2 if known else 4) and not left
            missed[word] = left
            if sure or word not in out:
                out[word] = (f"{wrong}>utf-8" + f"x{rounds}" * (rounds > 1), sure) if not out.get(word, ("", False))[1] else out[word]
        if len(token) >= MIN_LETTERS and all(ord(c) < 128 or c in table for c in token):
            data = bytes(table[c] if ord(c) > 127 else ord(c) for c in token)
            for true in WRITTEN_IN:
                if true != wrong:
                    try:
                        word = data.decode(true)
                    except UnicodeDecodeError:
                        continue
                    if word.casefold() != token.casefold() and _plausible(word):
                        out.setdefault(word, (f"{wrong}>{true}", False))
    if len(token) >= MIN_LETTERS - 1 and any(ord(c) > 0x2E7F for c in token):
        for wrong in READ_AS_WIDE:
            try:
                data = token.encode(wrong)
            except UnicodeEncodeError:
                continue
            for true in ["utf-8", *WRITTEN_IN]:
                try:
                    word = data.decode(true)
                except UnicodeDecodeError:
                    continue
                if word != token and _plausible(word):
                    out.setdefault(word, (f"{wrong}>{true}", False))
    raised = _FOREIGN.sub(lambda m: m.group().upper(), token) if token.islower() else token
    if raised != token and len(raised) == len(token):  # garbled first, then put in lower case
        for word, how, _ in _ways(raised):
            if word.islower() and not how.endswith("utf-8"):
                out.setdefault(word, (how, False))
    # Of several encodings that it may have been read with, those stand that explain most of the word.
    fewest = min((missed[word] for word, (_, sure) in out.items() if sure), default=0)
    return [(word, how, sure and missed[word] == fewest) for word, (how, sure) in out.items()]


def foreign_words(text: str | None) -> list[str]:
    """The distinct words of a text that hold characters beyond ASCII."""
    return sorted({t for t in _TOKEN.findall(text or "") if _FOREIGN.search(t)})


_WORDS = T.ArrayType(T.StringType())
_CHOICES = T.StructType([T.StructField("cause", T.StringType()), T.StructField("ways", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("how", T.StringType()), T.StructField("sure", T.BooleanType())])))])


@F.arrow_udf(returnType=_WORDS)
def _words(texts: pa.Array, is_head: pa.Array) -> pa.Array:
    out = []
    for text, head in zip(texts.to_pylist(), is_head.to_pylist()):
        if head and text and text.endswith("�"):
            text = text[:-1]  # a character the sample was cut in
        out.append(foreign_words(text))
    return pa.array(out, type=pa.list_(pa.string()))


@F.arrow_udf(returnType=_CHOICES)
def _choices(words: pa.Array) -> pa.Array:
    out = []
    for word in words.to_pylist():
        ways = [{"word": w, "how": h, "sure": s} for w, h, s in restorations(word)]
        out.append({"cause": certain_cause(word), "ways": ways})
    return pa.array(out, type=pa.struct([("cause", pa.string()), ("ways", pa.list_(pa.struct([("word", pa.string()), ("how", pa.string()), ("sure", pa.bool_())])))]))


def _texts(meta: DataFrame) -> DataFrame:
    """meta_id, field, text, words (distinct, with characters beyond ASCII): head and file each for itself."""
    both = meta.select("meta_id", F.explode(F.array(F.struct(F.lit("head").alias("field"), F.col("head").alias("text")), F.struct(F.lit("file").alias("field"), F.col("file").alias("text")))).alias("t"))
    foreign = both.select("meta_id", "t.*").filter(F.col("text").rlike(r"[^\x00-\x7f]"))
    return foreign.withColumn("words", _words("text", F.col("field") == "head"))


def garbled_words(texts: DataFrame) -> DataFrame:
    """word, cause, how, restored: every distinct word of the corpus that is garbled. Words are counted by the distinct
    texts that hold them, so a file delivered many times counts once."""
    seen = texts.select(F.xxhash64("text").alias("text_id"), F.explode("words").alias("word"))
    counts = cut_lineage(seen.distinct().groupBy("word").agg(F.count("*").alias("n")), "words")
    judged = counts.withColumn("c", _choices("word")).select("word", "n", "c.cause", "c.ways")
    judged = cut_lineage(judged, "choices")
    ways = judged.select("word", "n", F.explode("ways").alias("w")).select("word", "n", F.col("w.word").alias("restored"), "w.how", "w.sure")
    known = counts.select(F.col("word").alias("restored"), F.col("n").alias("known"))
    # A whole word restored to ASCII, as a curly quote may be, has no count; it stands by its byte structure alone.
    scored = ways.join(known, "restored", "left").withColumn("known", F.coalesce("known", F.lit(0)))
    good = scored.filter(F.col("sure") | (F.col("known") >= F.greatest(TIMES_MORE * F.col("n"), F.col("n") + 1)))
    best = good.groupBy("word").agg(F.max_by(F.struct("restored", "how"), F.struct("known", F.col("sure"), F.negate(F.length("restored")), F.col("how"))).alias("b")).select("word", "b.restored", "b.how")
    certain = judged.filter("cause is not null").select("word", "cause")
    return certain.join(best, "word", "full").select("word", F.coalesce("cause", F.lit("other encoding")).alias("cause"), "how", "restored")


def find_garbled(meta: DataFrame) -> DataFrame:
    """meta_id, field, text, cause, how, restored_text: every head and file name that holds garbled text.

    restored_text is the text with the garbled words restored, those that can't be left as they are; null if none could.
    Null and empty texts and texts all in ASCII are no case, nor is a single U+FFFD at the very end of head. Repeated
    rows come out as often as they came in; no rows give none. Other columns are ignored, whatever their names.
    """
    texts = cut_lineage(_texts(meta).withColumn("row_id", F.monotonically_increasing_id()), "foreign")
    bad = garbled_words(texts)
    hits = texts.select("row_id", F.explode("words").alias("word")).join(bad, "word")
    per_text = hits.groupBy("row_id").agg(
        F.min("cause").alias("cause"), F.mode("how").alias("how"), F.collect_list(F.when(F.col("restored").isNotNull(), F.struct("word", "restored"))).alias("pairs")
    )
    out = texts.drop("words").join(per_text, "row_id")
    return out.select("meta_id", "field", "text", "cause", "how", _replaced("text", "pairs", "how").alias("restored_text"))


def restore(text: str, known: dict[str, str], how: str | None) -> str:
    """The text with its garbled words replaced; between the first and the last of them words that weren't known are
    read the way most others were."""
    places = [m for m in _TOKEN.finditer(text) if m.group() in known]
    if not places:
        return text
    start, end = places[0].start(), places[-1].end()
    wrong, _, true = (how or "").partition(">")

    def other(match: re.Match) -> str:
        word = match.group()
        if word in known:
            return known[word]
        if not start <= match.start() < end or not _FOREIGN.search(word) or not true or true.startswith("utf-8"):
            return word
        table = _to_byte(wrong) if wrong in READ_AS else {}
        if not all(ord(c) < 128 or c in table for c in word):
            return word
        read = bytes(table[c] if ord(c) > 127 else ord(c) for c in word).decode(true, "replace")
        return read if _plausible(read) else word

    return _TOKEN.sub(other, text)


@F.arrow_udf(returnType=T.StringType())
def _replaced(texts: pa.Array, pairs: pa.Array, hows: pa.Array) -> pa.Array:
    out = []
    for text, known, how in zip(texts.to_pylist(), pairs.to_pylist(), hows.to_pylist()):
        table = {p["word"]: p["restored"] for p in known}
        out.append(restore(text, table, how) if table else None)
    return pa.array(out, type=pa.string())
