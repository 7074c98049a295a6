import datetime

import pytest

from millrace.llm.mojibake import certain_cause, decode_spans, find_garbled, foreign_words, restorations, utf8_spans

WORDS = "größe straße können müssen gebühr küste behörde öffnung señal montaña teléfono información région forêt hôtel".split()
RUSSIAN = "причал корабль подъезд рынок письмо граница якорь".split()


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "cp437", "mac-roman", "cp850", "cp1250", "iso8859-2"])
def test_round_trip_of_utf8(wrong):
    for word in WORDS:
        raw = word.encode()
        garbled = "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in raw)
        assert word in [w for w, _, sure in restorations(garbled) if sure], (word, garbled)


@pytest.mark.parametrize("wrong", ["cp1251", "koi8-r", "cp866"])
def test_round_trip_of_cyrillic(wrong):
    for word in RUSSIAN:
        garbled = "".join(bytes([b]).decode(wrong, "ignore") or chr(b) for b in word.encode())
        assert word in [w for w, _, sure in restorations(garbled) if sure], (word, garbled)


def test_only_spans_are_decoded():
    assert decode_spans("für mÃ¼ssen", "cp1252") == ("für müssen", 1, 1)
    assert utf8_spans([0x61, 0xC3, 0xBC, 0xE2, 0x80, 0x99, 0xC3]) == [(1, 6)]
    assert utf8_spans([0xC0, 0x80, 0xED, 0xA0, 0x80, 0xF5]) == []


def test_sound_words_are_left():
    for word in WORDS + RUSSIAN + ["ŁÓDŹ", "ŻÓŁTY", "καὶ", "m³", "µm", "“quoted”"]:
        assert certain_cause(word) is None and not [w for w, _, sure in restorations(word) if sure], word


SCHEMA = "meta_id bigint, file string, head string, enc string, word string, scanned_at timestamp"


def test_find(spark):
    sound = " ".join(WORDS)
    now = datetime.datetime(2020, 1, 1)
    rows = [(i, f"f{i}.txt", f"{sound} {i}", "utf-8", None, now) for i in range(6)]
    rows += [
        (10, "a.txt", "señal " + "montaña información".encode().decode("cp1252"), "utf-8", "x", now),
        (11, "größe.txt".encode().decode("cp437"), None, None, None, now),
        (12, "b.txt", "stra�e", None, None, now),
        (13, "b.txt", "stra�", None, None, now),
        (14, None, "", None, None, None),
        (15, "c.txt", "montaña información teléfono".encode("cp1252").decode("cp1251"), "utf-8", None, now),
        (16, "d.txt", "größe".encode().decode("cp1252").encode().decode("cp1252"), "utf-8", None, now),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r.meta_id, r.field): r for r in find_garbled(df).collect()}
    assert set(found) == {(10, "head"), (11, "file"), (12, "head"), (15, "head"), (16, "head")}
    assert found[(10, "head")].restored_text == "señal montaña información" and found[(11, "file")].restored_text == "größe.txt"
    assert found[(12, "head")].restored_text is None and found[(15, "head")].restored_text == "montaña información teléfono" and found[(16, "head")].restored_text == "größe"
    assert find_garbled(df.limit(0)).count() == 0
    assert find_garbled(df.unionByName(df)).count() == 10


def test_long_text():
    assert foreign_words("ñandú " * 400_000) == ["ñandú"]


@pytest.mark.parametrize("text", ["こんにちは", "日本語", "שלום", "مرحبا", "😀", "สวัสดี", "안녕하세요", "Ωμέγα", "Привет", "naïveté"])
@pytest.mark.parametrize("wrong", ["latin-1", "cp1252"])
def test_any_script_is_restored(text, wrong):
    raw = text.encode()
    read = "".join(chr(b) if wrong == "latin-1" else (bytes([b]).decode(wrong, "ignore") or chr(b)) for b in raw)
    sure = {word for word, _, sure in restorations(read) if sure}
    assert sure == {text}, (read, restorations(read))


@pytest.mark.parametrize("word", ["café’…", "работа", "орган", "Ärger", "élève", "Øresund", "été", "łódź", "ñandú", "über", "你好", "שלום"])
def test_sound_words_have_no_sure_way(word):
    assert not any(sure for _, _, sure in restorations(word)), restorations(word)


def test_letters_lowered_afterwards():
    assert "é" in {w for w, _, _ in restorations("ã©")} and "été" in {w for w, _, _ in restorations("ã©tã©")}
