"""Porter's stemmer (Porter 1980, An algorithm for suffix stripping), rule by rule."""

from __future__ import annotations

import functools
import re

#: Fixed values of the published algorithm: suffix, replacement; in each step the longest suffix that fits counts.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _shape(word: str) -> str:
    """v for vowels, c for consonants; y is a vowel after a consonant."""
    out = ""
    for letter in word:
        out += "v" if letter in "aeiou" or letter == "y" and out.endswith("c") else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word).endswith("c")


def _short(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word: str, suffixes: list[str]) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


@functools.lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    if len(word) < 3:
        return word
    ending = _longest(word, ["sses", "ies", "ss", "s"])
    if ending in ("sses", "ies"):
        word = word[:-2]
    elif ending == "s":
        word = word[:-1]

    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) else word
    else:
        cut = _longest(word, ["ed", "ing"])
        if cut and "v" in _shape(word[: -len(cut)]):
            word = word[: -len(cut)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _double(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"

    for rules in (STEP2, STEP3):
        found = _longest(word, [s for s, _ in rules])
        if found and _measure(word[: -len(found)]):
            word = word[: -len(found)] + dict(rules)[found]
    found = _longest(word, STEP4)
    if found and _measure(word[: -len(found)]) > 1 and (found != "ion" or word[-4:-3] in ("s", "t")):
        word = word[: -len(found)]

    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or m == 1 and not _short(word[:-1]):
            word = word[:-1]
    if _measure(word) > 1 and _double(word) and word.endswith("l"):
        word = word[:-1]
    return word
