import heapq
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from groundline.llm.common import GAP_CHARACTERS, word_count
from groundline.llm.mixing import apportion, cut_runs, mix, plan_sources, shard_words, targets
from tests.llm.data import frame, odd_texts, syllables


def one_by_one(wanted, limits, n):
    got = [0] * len(wanted)
    heap = [(-w, i) for i, w in enumerate(wanted) if limits[i]]
    heapq.heapify(heap)
    for _ in range(n):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < limits[i]:
            heapq.heappush(heap, (-wanted[i] / (2 * got[i] + 1), i))
    return got


@pytest.mark.parametrize("seed", range(20))
def test_apportion(seed):
    rng = random.Random(seed)
    wanted = [rng.choice([0, 5, 5, rng.randint(1, 1000)]) for _ in range(rng.randint(1, 9))]
    limits = [rng.randint(0, 300) for _ in wanted]
    for n in (0, 1, 7, 150, 5000):
        assert list(apportion(np.array(wanted, float), np.array(limits), n)) == one_by_one(wanted, limits, n)


def test_targets_reshare_what_is_above():
    sizes, weights = np.array([10, 100, 1000.0]), np.array([5, 2, 1.0])
    found = targets(sizes, weights)
    assert found.sum() == pytest.approx(1.5 * 1110) and (found <= 2 * sizes + 1e-9).all()
    assert list(found[:2]) == [20, 200]


@pytest.mark.parametrize("texts", [odd_texts(), syllables(6, 200)])
def test_mix(spark, texts):
    docs = frame(spark, texts).select("doc_id", "source", word_count("text").alias("size"), "text")
    mixed = mix(docs, rows_per_run=20, block=8).withColumn("parts", cut_runs(F.col("others.text"), F.col("runs")))
    rows = mixed.collect()
    assert len(rows) == len(texts)
    by_source = {}
    for r in rows:
        words = (r.others.text or "").translate({ord(c): " " for c in GAP_CHARACTERS}).split(" ")
        words = [w for w in words if w]
        assert r.size == len(words) and 0 <= r.taken <= 2 * r.size
        assert r.taken == r.passes * r.size + sum(x["to"] - x["from"] for x in r.runs)
        for run, part in zip(r.runs, r.parts):
            part = [w for w in part.translate({ord(c): " " for c in GAP_CHARACTERS}).split(" ") if w]
            assert part == words[run["from"] : run["to"]]
        by_source.setdefault((r.source, r.source_size, r.target), []).append(r)
    assert sum(target for _, _, target in by_source) == pytest.approx(1.5 * sum(r.size for r in rows))
    for (_, size, target), own in by_source.items():
        assert size == sum(r.size for r in own)
        assert abs(sum(r.taken for r in own) - target) <= 3 * 8
    again = mix(docs.repartition(5), rows_per_run=7, block=8).collect()
    assert sorted((str(r.doc_id), r.size, r.taken) for r in again) == sorted((str(r.doc_id), r.size, r.taken) for r in rows)


def test_shard_quotas_add_up(spark):
    totals = spark.createDataFrame([("b", 5000), ("a", 90), (None, 700)], "source string, source_size long")
    rows = plan_sources(totals, shards=4).collect()
    assert [r.source for r in rows] == ["a", "b", None]
    assert all(sum(r.shard_quotas) == r.quota for r in rows)
    per_shard = [sum(r.shard_quotas[j] for r in rows) for j in range(4)]
    assert max(per_shard) - min(per_shard) <= 1


@pytest.mark.parametrize("block,shards", [(8, 4), (1, 3), (64, 8)])
def test_shards_hold_their_quotas(spark, block, shards):
    rng = random.Random(block)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 0, 1, 7, 40, 300])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    mixed = mix(docs, rows_per_run=20, block=block, shards=shards, dealt=True)
    found = mixed.withColumn("by_shard", shard_words(F.col("pieces"), shards)).collect()
    totals = docs.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    plan = {r.source: r for r in plan_sources(totals, block=block, shards=shards).collect()}
    words = {}
    for r in found:
        covered = [p for p in r.pieces if p["pass"] < r.passes]
        assert sorted(p["from"] for p in covered) == sorted(p["from"] for p in covered if p["to"] > p["from"])
        assert sum(p["to"] - p["from"] for p in covered) == r.passes * r.size
        assert [(p["from"], p["to"]) for p in r.pieces if p["pass"] == r.passes] == [(x["from"], x["to"]) for x in r.runs]
        assert sum(r.by_shard) == r.taken
        for shard, n in enumerate(r.by_shard):
            words[r.source, shard] = words.get((r.source, shard), 0) + n
    for source, p in plan.items():
        for shard, quota in enumerate(p.shard_quotas):  # its blocks, each of `width` words or one more
            assert quota * p.width <= words.get((source, shard), 0) <= quota * (p.width + (p.wider > 0))


@pytest.mark.parametrize("words", [[10, 4000], [31, 9000, 96], [1, 2, 50_000], [63, 64, 65, 700, 3000]])
def test_small_sources_come_near_their_targets(spark, words):
    rows = [(i, f"s{i:02d}", n) for i, n in enumerate(words)]
    found = mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    for r in found:
        assert abs(r.taken - r.target) <= max(1, r.source_size / 64, 64), (r.source, r.taken, r.target)
        assert r.taken <= 2 * r.size


def test_no_rows(spark):
    docs = frame(spark, [(1, "a")]).filter("doc_id > 1").select("doc_id", "source", F.lit(1).alias("size"))
    assert mix(docs).collect() == []
