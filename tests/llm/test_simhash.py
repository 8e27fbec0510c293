import random

import pytest
import xxhash

from groundline.llm.components import components
from groundline.llm.simhash import classes, fingerprint, links, one_per_class
from tests.llm.data import frame, odd_texts, syllables


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def by_hand(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprint_and_native_hash(spark):
    for text in [t for _, t in odd_texts()] + syllables(3, 30) + ["A b", "Ä B c d"]:
        assert fingerprint(text) % (1 << 64) == by_hand(text)
    assert spark.sql("SELECT xxhash64('ab c d')").first()[0] % (1 << 64) == by_hand("AB c d")


def crowds(seed):
    """Fingerprints around some, many of which share all but a few bits, or one half and nothing else."""
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    prints = set(base)
    for p in base:
        for _ in range(40):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    half = rng.getrandbits(32)
    prints |= {half | rng.getrandbits(32) << 32 for _ in range(60)}  # one value of a segment, far apart
    prints |= {half ^ 1 | p & ~0xFFFFFFFF for p in list(prints)[:30]}
    return [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]


@pytest.mark.parametrize("distance, segments, crowd", [(2, 2, 64), (2, 2, 3), (2, 2, 0), (2, 3, 5), (2, 1, 4), (4, 4, 7), (4, 2, 30), (0, 2, 2)])
def test_links_connect_all_within_the_distance(spark, distance, segments, crowd):
    signed = crowds(distance + segments)
    frame_ = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    edges = [(r.a, r.b) for r in links(frame_, distance, segments, crowd).collect()]
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance]
    assert {(min(e), max(e)) for e in edges if e[0] != e[1]} <= set(near)
    assert roots(signed, edges) == roots(signed, near)
    if crowd == 64 and segments == 2:
        assert {(min(e), max(e)) for e in edges} == set(near)  # tables alone give every link
    with pytest.raises(ValueError, match="even"):
        links(frame_, 3)


def test_a_crowd_does_not_give_its_pairs(spark):
    """Thousands that share a half: entries grow with their number, not with its square."""
    rng = random.Random(1)
    prints = spark.createDataFrame([(0x1234 | rng.getrandbits(31) << 32,) for _ in range(3000)], "fingerprint long").distinct()
    assert links(prints).count() < 3000


@pytest.mark.parametrize("n, m", [(60, 0), (60, 40), (300, 280), (50, 400)])
def test_components(spark, n, m):
    rng = random.Random(n + m)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1040)]
    found = {r["node"]: r["class"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {k: v for k, v in roots(nodes, [e for e in edges if e[0] != e[1]]).items()}


@pytest.mark.parametrize("texts", [odd_texts(), syllables(5, 90)])
def test_classes(spark, texts):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    prints = [by_hand(t) for _, t in rows]
    of = roots(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for n, root in of.items():
        if rows[n][0] is not None:
            least[root] = min(least.get(root, rows[n][0]), rows[n][0])
    expected = sorted((str(i), p, str(least.get(of[n]))) for n, ((i, _), p) in enumerate(zip(rows, prints)))
    got = classes(frame(spark, texts)).collect()
    assert sorted((str(r.doc_id), r.fingerprint % (1 << 64), str(r.component_id)) for r in got) == expected
    kept = one_per_class(frame(spark, texts))
    assert kept.columns == frame(spark, texts).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(least.get(root)) for root in set(of.values()))


def test_no_rows(spark):
    assert classes(frame(spark, [(1, "a")]).filter("doc_id > 1")).collect() == []
