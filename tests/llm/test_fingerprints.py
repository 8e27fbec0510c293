import hashlib
import random

import numpy as np
import pytest

from groundline.llm import fingerprints as P
from tests.llm.data import frame, odd_texts, syllables


def test_multiset_hash():
    pieces = [f"Sentence {i}. " for i in range(40)]
    shuffled = random.Random(1).sample(pieces, 40)
    whole = P.fingerprint("".join(pieces))
    assert np.array_equal(whole, P.fingerprint("".join(shuffled)))  # order does not matter
    assert not np.array_equal(whole, P.fingerprint("".join(pieces + pieces[:1])))  # repeats do
    assert np.array_equal(P.delete(P.insert(whole, ["new"]), pieces[:2]), P.total(pieces[2:] + ["new"]))
    one = P.total(["a"])
    assert np.array_equal(P.total(["a"] * 70_000), one * np.uint32(70_000)) and not (one * np.uint32(1 << 31) * np.uint32(2)).any()  # modulo 2 ** 32


def test_very_many_equal_paragraphs():
    many, half = P.fingerprint("line\n" * 40_000), P.fingerprint("line\n" * 20_000)
    assert P.likeness(many, half) == pytest.approx(0.8)
    log = P.fingerprint("line\n" * 65_536)
    assert log.any() and P.likeness(log, P.fingerprint("")) == 0


def test_likeness():
    pieces = [f"{i}\n" for i in range(400)]
    like = P.likeness(P.total(pieces), P.total(pieces[100:] + [f"other {i}\n" for i in range(100)]))
    assert like == pytest.approx(0.75, abs=0.15)
    assert P.likeness(P.total(pieces[:50]), P.total(pieces[50:100])) < 0.3
    assert P.likeness(P.total([]), P.total([])) == 1 and P.likeness(P.total([]), P.total(["a"])) == 0


@pytest.mark.parametrize("text", ["", "a", "One. Two? Three!\nFour. ", "a\0b. c", "\n\n. . ", "e.g. 1.5\r\nx"])
def test_paragraphs_make_up_the_text(text):
    assert "".join(P.paragraphs(text)) == text


@pytest.mark.parametrize("seed", range(30))
def test_edits_update_the_fingerprint(seed):
    rng = random.Random(seed)
    text, following = ("".join(rng.choices("ab. \n!\0", k=rng.randint(0, 60))) for _ in range(2))
    pieces = P.paragraphs(text)
    edited, print_ = P.edit(text, pieces, P.total(pieces), following)
    third = len(text) // 3
    assert edited == text[: len(text) - third] + following[:third]
    assert np.array_equal(print_, P.fingerprint(edited))


@pytest.mark.parametrize("texts, rows_per_run", [(odd_texts(), 3), (odd_texts(), 2000), (syllables(8, 130), 7), ([(1, "alone. Here")], 5)])
def test_with_edits(spark, texts, rows_per_run):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).digest()))
    expected = []
    for n, (i, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, changed = P.fingerprint(text), P.fingerprint(edited)
        expected.append(
            (str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), P.hexadecimal(own), P.hexadecimal(changed),
             P.likeness(own, changed), P.likeness(own, P.fingerprint(following)))
        )
    got = P.with_edits(frame(spark, texts), rows_per_run=rows_per_run).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(expected)


def test_no_rows(spark):
    assert P.with_edits(frame(spark, [(1, "a")]).filter("doc_id > 1")).collect() == []
