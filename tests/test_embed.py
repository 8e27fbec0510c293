import hashlib
import re

import pytest

from pyspark.sql import functions as F

from groundline.functions.tokens import bucket, tokens
from groundline.plans import queries, tables

TEXTS = ["", "...", "Ab ab-c9 ÄÖ ß", "\n 12 x_y\tz", "東京タワー 東京", "\U0001d54f\U0001d54f .a", "tail ", None]


@pytest.mark.parametrize("query", [queries.embed_terms, queries.embed_model])
def test_a_few_splits_more_than_cores_are_dealt_out(spark, monkeypatch, query):
    cores = spark.sparkContext.defaultParallelism
    rows = [(i, f"title {i}\nred words {i}") for i in range(40)]
    few, many = (spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(n) for n in (cores + 1, 3 * cores + 1))
    monkeypatch.setattr(tables, "table", lambda *_: few)
    dealt = query(spark, "")
    assert dealt.rdd.getNumPartitions() == 2 * cores
    found = sorted(map(tuple, dealt.collect()))
    monkeypatch.setattr(tables, "table", lambda *_: many)
    left = query(spark, "")
    assert left.rdd.getNumPartitions() == 3 * cores + 1
    assert found and found == sorted(map(tuple, left.collect()))


def test_tokens_are_runs_of_letters_and_digits(spark):
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(TEXTS)], "i INT, text STRING")
    found = {r.i: r.found for r in rows.select("i", tokens(F.col("text")).alias("found")).collect()}
    by_hand = [None if t is None else [w for w in re.split(r"[\W_]+", t.lower()) if w] for t in TEXTS]
    assert [found[i] for i in range(len(TEXTS))] == by_hand


@pytest.mark.parametrize("n", [1, 2, 8, 10, 16, 31, 1000, 1 << 12, 1 << 13, 1 << 20, (1 << 20) + 1])
def test_a_bucket_is_the_head_of_the_md5(spark, n):
    words = [f"word{i}" for i in range(50)]
    rows = spark.createDataFrame([(w,) for w in words], "w STRING")
    found = {r.w: r.b for r in rows.select("w", (bucket(F.col("w"), n)).alias("b")).collect()}
    assert found == {w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % n for w in words}
