import math
import zlib
from collections import Counter

import numpy as np
import pytest

from groundline.llm.common import id_remainder
from groundline.llm import lm
from groundline.llm.lm import CONCENTRATION, DISCOUNT, score
from tests.llm.data import frame, odd_texts, syllables


def by_hand(rows, trains, order=2):
    tokens = [(text or "").encode().lower().split() + [None] for _, text in rows]
    grams, contexts = Counter(), Counter()

    def all_grams(t):
        """(context, word) of every length for each word; the begin of the text is a word too."""
        for i in range(len(t)):
            before = ("start", *t[:i])[-(order - 1) :] if order > 1 else ()
            yield [(before[len(before) - m :], t[i]) for m in range(len(before) + 1)]

    for t, own in zip(tokens, trains):
        if own:
            for found in all_grams(t):
                grams.update(found)
                contexts.update(h for h, _ in found)
    words = Counter({w: c for (h, w), c in grams.items() if not h})
    n, v = sum(words.values()), len(words)
    out = []
    for (i, _), t, own in zip(rows, tokens, trains):
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        total = 0.0
        for found in all_grams(t):
            w = found[0][1]
            p = (words[w] - DISCOUNT) / n if words[w] else (DISCOUNT * v / n if n else 1.0)
            for h, _ in found[1:]:
                p = (grams[h, w] + CONCENTRATION * p) / (contexts[h] + CONCENTRATION)
            total += math.log10(p)
        out.append((-9 if i is None else i, not own, len(t), sum(words[w] > 0 for w in t), n, round(base, 6), round(total, 6)))
    return sorted(out)


def check(spark, texts, **options):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    trains = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i, _ in rows]
    got = score(frame(spark, texts), id_remainder("doc_id", 5) == 1, **options).collect()
    got = sorted((-9 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert got == by_hand(rows, trains, options.get("order", 2))


@pytest.mark.parametrize("texts", [odd_texts(), syllables(2, 120)])
@pytest.mark.parametrize("part_bytes", [1 << 23, 500])
def test_against_counting_by_hand(spark, texts, part_bytes):
    check(spark, texts, part_bytes=part_bytes)


@pytest.mark.parametrize("texts", [odd_texts(), syllables(2, 120), ["a b a b c", "a b c a", None, "b", "", "a b a b c a a a"]])
@pytest.mark.parametrize("order", [1, 3, 4])
def test_other_orders_against_counting_by_hand(spark, texts, order):
    check(spark, texts, order=order)


@pytest.mark.parametrize("tokens", [1, 2, 7])
@pytest.mark.parametrize("order", [2, 3, 4])
def test_the_state_is_carried_from_slice_to_slice(monkeypatch, tokens, order):
    texts = ["a b c a b d", "a b c a b c a b c x a b", "", "b c", "x y z a b c"]
    trains = [True, True, True, False, False]
    words, counts = lm.hashes([t.encode() for t in texts])
    learned = lm._trains([not t for t in trains], counts)
    keys, seen = [], []
    for hashed, valid in lm.grams(words, counts, order):
        _, places, own = lm._own_counts(hashed[valid], learned[valid])
        everywhere = np.zeros(len(words), dtype=np.int64)
        everywhere[valid] = own[places]
        keys.append(hashed), seen.append(everywhere)
    n, v = int(learned.sum()), len(set(words[learned].tolist()))
    monkeypatch.setattr(lm, "SLICE", tokens)
    sums = lm.run_texts(keys, seen, counts, n, 3)
    unknown = np.add.reduceat((seen[0] == 0).astype(int), np.cumsum(counts) - counts)
    expected = [row[-1] for row in by_hand(list(enumerate(texts)), trains, order)]
    assert np.round(sums + unknown * math.log10(DISCOUNT * v / n), 6).tolist() == pytest.approx(expected)


def test_probabilities_sum_to_one():
    words, pairs, states = Counter("aabc"), Counter({("a", "b"): 2, ("a", "a"): 1}), 3
    n, v = 4, 3
    root = {w: (c - DISCOUNT) / n for w, c in words.items()} | {"unknown": DISCOUNT * v / n}
    assert sum(root.values()) == pytest.approx(1)
    assert sum((pairs["a", w] + CONCENTRATION * p) / (states + CONCENTRATION) for w, p in root.items()) == pytest.approx(1)


def test_held_out_texts_are_likelier_than_by_the_base(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    row = score(docs, id_remainder("doc_id", 5) == 1).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]


def test_no_rows_and_nothing_to_learn(spark):
    from pyspark.sql import functions as F

    docs = frame(spark, [(1, "a b"), (2, None)])
    assert score(docs.filter("doc_id > 5")).collect() == []
    assert {(r.base_score, r.score, r.n_known) for r in score(docs, F.lit(True)).collect()} == {(0.0, 0.0, 0)}
