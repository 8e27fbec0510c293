import itertools
import random
import zlib

import pytest

from groundline.llm.sharding import difference, shard_by_bytes
from tests.llm.data import frame, odd_texts, syllables


def spread(sizes, placed, shards):
    sums = [0] * shards
    for size, shard in zip(sizes, placed):
        sums[shard] += size
    return max(sums) - min(sums)


def test_two_way_differencing_by_hand():
    # 8 7 6 5 4 -> (8-7) 6 5 4 -> .. the known result of Karmarkar-Karp is a difference of 2
    assert spread([8, 7, 6, 5, 4], difference([8, 7, 6, 5, 4], 2), 2) == 2


@pytest.mark.parametrize("shards", [2, 3, 5])
def test_differencing_is_near_the_best(shards):
    rng = random.Random(shards)
    sizes = [rng.randint(1, 60) for _ in range(8)]
    best = min(spread(sizes, p, shards) for p in itertools.product(range(shards), repeat=8)) if shards < 5 else 0
    assert spread(sizes, difference(sizes, shards), shards) <= best + max(sizes)
    many = [rng.randint(1, 10_000) for _ in range(2000)]
    assert spread(many, difference(many, shards), shards) <= 20


@pytest.mark.parametrize("texts", [odd_texts(), syllables(1, 400)])
def test_shards(spark, texts):
    rows = shard_by_bytes(frame(spark, texts), shards=5, rows_per_run=20).collect()
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    assert sorted((r.doc_id or -9, r.size, r.text_crc32) for r in rows) == sorted(
        (i or -9, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs
    )
    of = {}
    for r in rows:
        of.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(s) == 1 for s in of.values())  # equal texts stay together
    for shard in range(5):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    groups = {}
    for r in rows:
        groups[r.text_crc32, r.size] = groups.get((r.text_crc32, r.size), 0) + r.size
    sums = [sum(r.size for r in rows if r.shard == s) for s in range(5)]
    assert max(sums) <= max(max(groups.values()), sum(sums) / 5 * 1.02)


def test_whole_table(spark, sf_dir):
    rows = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    sums = [sum(r.size for r in rows if r.shard == s) for s in range(40)]
    largest = max(r.size for r in rows)
    assert max(sums) - min(sums) <= largest


def test_no_rows(spark):
    assert shard_by_bytes(frame(spark, [(1, "a")]).filter("doc_id > 1")).collect() == []
