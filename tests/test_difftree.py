import random
import re

import pytest

from pyspark.sql import functions as F

from groundline.operators import difftree
from groundline.operators.difftree import index_diff_tree, unequal_branches, within
from groundline.operators.index import index_diff
from groundline.session import shared_dir
from tests.test_plans import plan

SCHEMA = "id BIGINT, content STRING"


def rows_of(df):
    return sorted((r.id, r.op) for r in df.collect())


def snapshots(seed: int, ids: list[int], share: float):
    rng = random.Random(seed)
    old = {i: rng.choice(["a", "b", None, f"text {i}"]) for i in ids}
    new = {}
    for i, text in old.items():
        change = rng.random()
        if change > share:
            new[i] = text
        elif change > share / 2:
            new[i] = "changed" if text is not None else None
    new |= {max(ids, default=0) + j: "more" for j in range(1, 4)} if share else {}
    return list(new.items()), list(old.items())


IDS = {
    "dense": list(range(3000)),
    "chunks": [doc * 1_000_000 + chunk for doc in range(300) for chunk in range(doc % 9)],
    "crowded": [*range(1500), *(random.Random(1).getrandbits(63) - (1 << 62) for _ in range(500)), -(1 << 63), (1 << 63) - 9],
    "one": [7],
    "none": [],
}


@pytest.mark.parametrize("ids", IDS)
@pytest.mark.parametrize("share", [0.0, 0.01, 1.0])
def test_equals_the_join(spark, ids, share, monkeypatch):
    monkeypatch.setattr(difftree, "MAX_RANGES", 5)
    new, old = (spark.createDataFrame(rows, SCHEMA).withColumn("content_md5", F.md5("content")) for rows in snapshots(3, IDS[ids], share))
    expected = rows_of(index_diff(new, old))
    assert rows_of(index_diff_tree(new, old)) == expected
    assert rows_of(index_diff_tree(new.drop("content_md5"), old, leaf_rows=1)) == expected
    monkeypatch.setattr(difftree, "MAX_BRANCHES", 2)
    assert rows_of(index_diff_tree(new, old)) == expected


def test_few_changes_move_few_ids(spark):
    """One changed row in a thousand, anywhere: under 2 % of the ids reach the join, and the levels move fewer sums than that."""
    n = 200_000
    old = spark.range(n).select("id", F.md5(F.col("id").cast("string")).alias("content_md5"))
    changed = F.pmod(F.xxhash64("id"), F.lit(1000)) == 0
    new = old.withColumn("content_md5", F.when(changed, "x").otherwise(F.col("content_md5")))
    branches, shift = unequal_branches(new, old)
    kept = within(old, branches, shift).count()
    assert old.filter(changed).count() <= kept < 0.02 * n
    assert rows_of(index_diff_tree(new, old)) == [(r.id, "update") for r in old.filter(changed).orderBy("id").collect()]


def test_changes_in_one_place_are_a_filter_for_the_reader(spark):
    path = shared_dir(spark, "test-old")
    old = spark.range(100_000).select("id", F.md5(F.col("id").cast("string")).alias("content_md5"))
    old.repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(path)
    old = spark.read.parquet(path)
    new = old.withColumn("content_md5", F.when(F.col("id").between(70_000, 70_050), "x").otherwise(F.col("content_md5")))
    text = plan(index_diff_tree(new, old))
    assert len(re.findall(r"PushedFilters: \[.*(?:GreaterThanOrEqual\(id,|LessThanOrEqual\(id,)", text)) == 2
    assert index_diff_tree(new, old).count() == 51


def test_ranges():
    assert difftree._ranges([5, 3, 4, 9, -1, -2], 2) == [(-8, -1), (12, 23), (36, 39)]
