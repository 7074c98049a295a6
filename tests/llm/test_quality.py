import csv
import os

import pytest

from millrace.llm import quality
from millrace.llm.quality import STATISTICS, load_model, probability, statistics, text_quality

COMMON = frozenset("the of and to in that it is was for on as with he be by at not this had are but from or have an they which you".split())
PROSE = "The tribunal was entitled to prefer the account of the clerk to that of the buyer.\n\nNo reason was given for the delay, and none was\nsuggested in argument. It follows that the claim on the lease fails."


def value(text, name):
    return statistics(text, COMMON)[STATISTICS.index(name)]


def test_statistics():
    text = "Ab cd.\n\nthe, 12"
    assert value(text, "n_words") == 4 and value(text, "mean_word_length") == 2.25 and value(text, "common_word_share") == 0.25
    assert value(text, "symbol_share") == 2 / 11 and value(text, "punctuated_line_share") == 0.5 and value(text, "digit_share") == 2 / 11
    assert value(PROSE, "running_share") == 1.0
    assert value("\n".join([PROSE.split("\n")[0]] * 10), "running_share") == pytest.approx(0.1)
    assert statistics(None, COMMON) is None and statistics(" \n ", COMMON) is None
    assert statistics("😀 ok", COMMON) is not None and statistics("...", COMMON)[0] == 0


def test_kinds():
    model = load_model()
    judge = lambda text: probability(statistics(text, COMMON), model) >= 0.5
    assert judge(PROSE) and judge(PROSE.upper()) and judge("IN THE COURT\n\n[2015] VCA 12\n\n" + PROSE + "\nPage 2 of 5\n" + PROSE.replace("clerk", "seller").replace("lease", "deed"))
    assert not judge("\n".join(f"{n} | Tanwick | deed | 5,{n}.93 | 01/02" for n in range(30)))
    assert not judge("see next sheet\n" * 40) and not judge((PROSE.split("\n")[0] + "\n") * 20)
    assert not judge(" ".join(["the of and to in that"] * 30)) and not judge("Home | Print | Log in | Terms | Cookies\n" * 3)


def test_table(spark):
    rows = [(1, PROSE, "a"), (1, PROSE, "a"), (2, None, "a"), (3, "", "a"), (4, "see next sheet\n" * 50, "a"), (5, "The lease was of the buyer. " * 100_000, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string")
    common = spark.createDataFrame([(w.upper(),) for w in COMMON] + [(None,)], "word string")
    out = text_quality(docs, common)
    assert [(r.doc_id, r.is_prose) for r in out.orderBy("doc_id").collect()] == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, False)]
    assert text_quality(docs.limit(0), common).count() == 0 and text_quality(docs, common.limit(0)).filter("common_word_share > 0").count() == 0


def test_held_out_accuracy(spark):
    """Hand-checked documents that the trees were not fitted on."""
    from millrace.session import table

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    with open(os.path.join(os.path.dirname(quality.__file__), "quality_holdout.csv")) as file:
        checked = {int(r["doc_id"]): r["prose"] == "1" for r in csv.DictReader(file)}
    rated = text_quality(table(spark, folder, "documents"), table(spark, folder, "common_words"))
    got = {r.doc_id: r.is_prose for r in rated.select("doc_id", "is_prose").collect()}
    assert sum(got[d] == y for d, y in checked.items()) >= 0.98 * len(checked)
