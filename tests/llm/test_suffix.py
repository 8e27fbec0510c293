import hashlib
import random

import pytest
import xxhash

from groundline.llm import suffix
from groundline.llm.common import stored
from tests.llm.data import frame, odd_texts, syllables


def by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, xxhash.xxh32_intdigest((r[1] or "").encode())))
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        lost = [False] * len(data)
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                lost[p : p + 100] = [True] * 100
            seen.add(window)
        spans = sum(x and not before for x, before in zip(lost, [False, *lost]))
        kept = bytes(b for b, x in zip(data, lost) if not x)
        out.append((i, len(data), sum(lost), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def hostile(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choices("abcdefghij klmnop é", k=n))
    passages = [noise(rng.randint(80, 400)) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [
            rng.choice([noise(rng.randint(0, 120)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 40) :], "x" * rng.randint(0, 250), "the " * rng.randint(0, 60)])
            for _ in range(rng.randint(0, 7))
        ]
        rows.append((i, "".join(parts)))
    for i in range(120, 160):
        text = list(rng.choice(rows)[1])
        for _ in range(rng.randint(0, 3)):
            if text:
                text[rng.randrange(len(text))] = "Q"
        rows.append((i, "".join(text)))
    rows += [(None, rows[3][1]), (None, None), (500, ""), (7, rows[8][1]), (7, rows[7][1]), (7, rows[7][1]), (-5, rows[20][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "texts, part, block, piece",
    [
        (hostile(3), 8 << 20, 8 << 20, 1 << 22),
        (hostile(4), 5000, 6000, 1 << 22),
        (hostile(5), 5000, 3000, 300),  # long texts in several pieces
        (odd_texts(), 1000, 3000, 1 << 22),
        ([(1, "s" * 150 + "t" * 90)] * 5, 50, 100, 1 << 22),  # equal rows, each a block of its own
        (syllables(4, 150), 4000, 9000, 1 << 22),
    ],
)
@pytest.mark.parametrize("gathered", [1000, 3, 0])
def test_against_all_windows(spark, monkeypatch, texts, part, block, piece, gathered):
    monkeypatch.setattr(suffix, "GATHERED", gathered)
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix, "AT_ONCE", 20 * block)
    monkeypatch.setattr(suffix, "PIECE", piece)
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    docs = stored(frame(spark, rows, 5), "test")
    got = sorted((tuple(r) for r in suffix.remove_repeats(docs, part_bytes=part).collect()), key=repr)
    assert got == by_hand(rows)


def test_no_rows(spark):
    assert suffix.remove_repeats(frame(spark, [(1, "a")]).filter("doc_id > 1")).collect() == []
