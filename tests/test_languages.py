import pytest
from pyspark.sql import functions as F

from millrace.functions.analyzers import text_language
from millrace.functions.languages import LANGUAGES, money, phonetic, read_stop_words, split_words, split_words_tight, text_phonetic

ALIKE = {
    "ar": ("الكتاب", "كتاب"), "bg": ("градът", "града"), "ca": ("l'home", "home"), "cz": ("hradech", "hradem"), "da": ("husene", "huset"), "de": ("Häusern", "Haus"), "el": ("δρόμος", "δρόμου"),
    "en": ("running", "runs"), "es": ("ciudades", "ciudad"), "eu": ("etxeak", "etxean"), "fi": ("talossa", "talosta"), "fr": ("l'avocats", "avocat"), "ga": ("d'athair", "athair"), "gl": ("cidades", "cidade"),
    "hi": ("लड़कों", "लड़के"), "hu": ("házban", "házat"), "hy": ("գրքեր", "գրքերի"), "id": ("bukunya", "buku"), "it": ("dell'anno", "anni"), "lv": ("galdam", "galdu"), "nl": ("huizen", "huize"), "no": ("husene", "huset"),
    "pt": ("nações", "nacoes"), "ro": ("cărţi", "cărți"), "ru": ("договора", "договором"), "sv": ("flickorna", "flicka"), "tr": ("evlerin", "evde"), "fa": ("كتاب", "کتاب"),
}


@pytest.mark.parametrize("language", sorted(ALIKE))
def test_forms_of_a_word_meet(spark, language):
    if language == "cz":
        pair = ("hradech", "hrady")
    else:
        pair = ALIKE[language]
    rows = spark.createDataFrame([(pair[0], pair[1])], "a string, b string")
    got = rows.select(text_language(F.col("a"), language).alias("a"), text_language(F.col("b"), language).alias("b")).first()
    assert got.a == got.b and len(got.a) == 1 and got.a[0], (language, got)


def test_every_language_takes_any_text(spark):
    texts = spark.createDataFrame([(None,), ("",), ("  ?! ",), ("x" * 100_000,), ("Ünïcode 日本 ไทย 12",)], "t string")
    got = texts.select(*[text_language(F.col("t"), x).alias(x) for x in sorted(LANGUAGES) if x != "en"]).collect()
    assert all(v is None for v in got[0]) and all(v == [] for v in got[1]) and all(v == [] for v in got[2]) and all(v for v in got[4])


def test_pairs_of_characters(spark):
    row = spark.createDataFrame([("東京都 kita ไทย",)], "t string").select(text_language(F.col("t"), "ja").alias("ja"), text_language(F.col("t"), "th").alias("th")).first()
    assert row.ja[:3] == ["東京", "京都", "kita"] and row.th[-2:] == ["ไท", "ทย"]


def test_stop_and_protected_words(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("der | article\ndie das # more\n\n")
    stop = read_stop_words(spark, str(tmp_path))
    assert stop == {"der", "die", "das"}
    row = spark.createDataFrame([("Der Hunde die Katzen",)], "t string")
    assert row.select(text_language(F.col("t"), "de", stop, {"katzen"})).first()[0] == ["hund", "katzen"]
    assert spark.createDataFrame([("the cats' running",)], "t string").select(text_language(F.col("t"), "en", protected=["running"])).first()[0] == ["cat", "running"]


def test_splitting(spark):
    row = spark.createDataFrame([("Wi-Fi PowerShots boxes the",)], "t string")
    assert row.select(split_words_tight(F.col("t"), ["the"])).first()[0] == ["wifi", "powershot", "box"]
    assert set(row.select(split_words(F.col("t"), ["the"])).first()[0]) >= {"wi", "fi", "wifi", "power", "shot", "powershot", "box"}


def test_money(spark):
    rates = spark.createDataFrame([("EUR", "USD", 1.25), ("USD", "JPY", 100.0)], "from string, to string, rate double")
    rows = spark.createDataFrame([("10,EUR",), ("10",), ("200,JPY",), ("5,XXX",), ("x,EUR",), (None,)], "v string")
    assert [r[0] for r in rows.select(money(F.col("v"), rates)).collect()] == [12.5, 10.0, 2.0, None, None, None]


def test_sounds(spark):
    for a, b in (("night", "nite"), ("phone", "fone"), ("Smith", "Smyth"), ("knife", "nife"), ("write", "rite"), ("judge", "juj"), ("catch", "katch"), ("Shaw", "shaw")):
        got = spark.createDataFrame([(a, b)], "a string, b string").select(phonetic(F.col("a")).alias("a"), phonetic(F.col("b")).alias("b")).first()
        assert got.a == got.b and got.a, (a, b, got)
    assert spark.createDataFrame([("Night phone 12",)], "t string").select(text_phonetic(F.col("t"))).first()[0] == ["NT", "FN"]
