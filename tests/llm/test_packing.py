import base64
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.packing import PATTERN, TOKENIZER, OpenBins, _counter, pack_texts, packing_report


def brute(sizes, capacity, limit):
    """The same rule over a plain list of open bins."""
    bins, out, made = {}, [], 0
    for size in sizes:
        fitting = [(free, n) for n, free in bins.items() if free >= size]
        if fitting:
            best = min(free for free, _ in fitting)
            out.append(best - size)
            n = next(n for free, n in fitting if free == best)
            bins[n] = best - size
        else:
            if len(bins) >= limit:
                fullest = min(bins.values())
                del bins[next(n for n, f in bins.items() if f == fullest)]
            n, made = made, made + 1
            bins[n] = capacity - size
            out.append(capacity - size)
        if bins[n] == 0 and size:
            del bins[n]
    return out, made


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=60), st.integers(1, 5))
def test_best_fit_agrees_with_brute_force(sizes, limit):
    bins, free, out = OpenBins(20, limit), {}, []
    for size in sizes:
        n = bins.place(size)
        free[n] = free.get(n, 20) - size
        out.append(free[n])
    assert (out, bins.made) == brute(sizes, 20, limit)


def test_counts_are_the_tokenizers():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(TOKENIZER, "rb"))}
    whole = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ["", "It's a test.  Two  spaces\n\nand lines\t\r\n", "naïve Größe 12345 <|endoftext|> ..... 東京", "x" * 5000, " " * 3000]:
        assert _counter(TOKENIZER)(text) == len(whole.encode_ordinary(text))
    assert _counter(TOKENIZER)(None) == 0


def test_packing(spark):
    r = random.Random(5)
    rows = [(i, "word " * r.choice([0, 3, 40, 90, 260]), "x") for i in range(300)] + [(300, None, "x"), (7, "again and again", "x"), (7, "again and again", "x")]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string, size string")
    budgets = spark.createDataFrame([(1, 64), (2, 100), (3, None), (4, 0)], "budget_id int, capacity_tokens int")
    for per_shard in (1000, 40):
        out = pack_texts(texts, budgets, open_bins=8, items_per_shard=per_shard).collect()
        assert {o.budget_id for o in out} == {1, 2}
        for budget, capacity in ((1, 64), (2, 100)):
            mine = [o for o in out if o.budget_id == budget]
            filled, per_text = {}, {}
            for o in mine:
                filled[o.container_id] = filled.get(o.container_id, 0) + o.n_tokens
                per_text.setdefault((o.doc_id, o.copy), []).append(o)
            assert max(filled.values()) <= capacity and len(per_text) == 303
            count = _counter(TOKENIZER)
            for (doc, _), pieces in per_text.items():
                pieces.sort(key=lambda o: o.piece)
                total = sum(p.n_tokens for p in pieces)
                assert [p.piece for p in pieces] == list(range(len(pieces))) and [p.first_token for p in pieces] == [i * capacity for i in range(len(pieces))]
                assert len(pieces) == 1 if total <= capacity else all(p.n_tokens == capacity for p in pieces[:-1])
                if doc < 300 and doc != 7:
                    assert total == count(rows[doc][1])
            unused = 1 - sum(filled.values()) / (capacity * len(filled))
            assert unused < 0.15
    assert pack_texts(texts.limit(0), budgets).count() == 0 and pack_texts(texts, budgets.limit(0)).count() == 0
    assert packing_report(pack_texts(texts, budgets)).count() == 2
