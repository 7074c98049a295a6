"""Text analyzers as Columns: what a field's text is indexed and searched by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[\p{L}\p{N}_']+"
#: The usual English stop words.
ENGLISH_STOP = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()


def text_general(text: Column) -> Column:
    """Words in lower case, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def text_ws(text: Column) -> Column:
    """What stands between white space, as it is."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def keyword_lower(text: Column) -> Column:
    return F.lower(text)


def path_ancestors(path: Column, separator: str = "/") -> Column:
    """a/b/c as a, a/b, a/b/c: what a path is found under."""
    parts = F.split(path, separator)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator))


def char_ngrams(text: Column, low: int, high: int) -> Column:
    """Sliding character n-grams of each length from low to high, shorter first; null for null."""
    def of(n: int) -> Column:
        sliding = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))
        return F.when(F.length(text) >= n, sliding).otherwise(F.when(text.isNotNull(), F.array().cast("array<string>")))

    grams = [of(n) for n in range(low, high + 1)]
    return grams[0] if len(grams) == 1 else F.concat(*grams)


def text_language(text: Column, language: str, stop=None, protected=()) -> Column:
    """The words of a text as its language's analyzer gives them (functions/languages.py); English has stop words of its
    own, other languages those given."""
    from millrace.functions.languages import analyze

    return analyze(text, language, ENGLISH_STOP if stop is None and language == "en" else stop or (), protected)


def text_cjk(text: Column) -> Column:
    """Width-folded lower case, Han, kana and hangul in overlapping pairs, other words whole."""
    folded = F.lower(_nfkc(text))
    runs = F.regexp_extract_all(folded, F.lit(r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]+|[\p{L}\p{N}_']+)"), F.lit(1))
    wide = lambda r: r.rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]")
    pairs = lambda r: F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(2)))
    return F.flatten(F.transform(runs, lambda r: F.when(wide(r), pairs(r)).otherwise(F.array(r))))


def word_parts(text: Column) -> Column:
    """Words cut at case changes, digits and punctuation, and each word whole; lower case, each once."""
    words = F.split(F.trim(text), r"\s+")
    cut = lambda w: F.filter(F.split(F.regexp_replace(F.regexp_replace(w, r"(?<=\p{Ll})(?=\p{Lu})|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})", " "), r"[^\p{L}\p{N}]+", " "), " "), lambda p: p != "")
    whole = lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]+", "")
    return F.array_distinct(F.filter(F.transform(F.flatten(F.transform(words, lambda w: F.array_append(cut(w), whole(w)))), F.lower), lambda p: p != ""))


@F.arrow_udf(returnType=T.StringType())
def _nfkc(text):
    import unicodedata

    import pyarrow as pa

    return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in text.to_pylist()], type=pa.string())


@F.arrow_udf(returnType=T.ArrayType(T.StringType()))
def porter(words):
    """Porter's stemmer over arrays of words; each distinct word of a batch is stemmed once."""
    import pyarrow as pa

    from millrace.functions.stemming import stem

    return pa.array([None if w is None else [stem(x) for x in w] for w in words.to_pylist()], type=pa.list_(pa.string()))
