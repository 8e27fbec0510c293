import glob
import os

import pytest

from pyspark.sql import functions as F

from groundline.operators.embed import Embedder, hashing_embedder
from groundline.operators.index import (
    apply_changes, build_index, clean_index, compact_index, index_diff, index_exists, latest_version, open_index, sync_index,
)
from groundline.session import shared_dir

EMBEDDER = hashing_embedder()
OLD = [(i * 1_000_000, f"text {i}") for i in range(20)]
NEW = [(i * 1_000_000, f"text {i}" if i % 3 else f"changed {i}") for i in range(5, 25)]
CHANGE = "seq BIGINT, op STRING, id BIGINT, content STRING"


def chunks(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, content STRING")


def content(index):
    return sorted(((r.id, r.content, r.content_md5, r.vec) for r in index.rows().collect()), key=repr)


@pytest.fixture
def root(spark):
    return shared_dir(spark, "test-index")


def test_diff(spark, root):
    index = build_index(chunks(spark, OLD), root, EMBEDDER)
    ops = {r.id // 1_000_000: r.op for r in index_diff(chunks(spark, NEW), index.rows()).collect()}
    expected = {i: "delete" for i in range(5)} | {i: "insert" for i in range(20, 25)}
    assert ops == expected | {i: "update" for i in range(5, 20) if i % 3 == 0}


def test_sync_equals_rebuild(spark, root):
    assert not index_exists(spark, root)
    sync_index(chunks(spark, OLD), root, EMBEDDER)
    assert index_exists(spark, root)
    synced = sync_index(chunks(spark, NEW), root, EMBEDDER)
    rebuilt = build_index(chunks(spark, NEW), shared_dir(spark, "rebuilt"), EMBEDDER)
    assert content(synced) == content(rebuilt)
    assert synced.rows().columns == rebuilt.rows().columns


def test_missing_texts_are_values(spark, root):
    with_null = [(1, None), (2, "b")]
    index = sync_index(chunks(spark, [(1, "a"), (2, "b")]), root, EMBEDDER)
    for _ in range(2):
        sync_index(chunks(spark, with_null), root, EMBEDDER)
        assert content(index) == content(build_index(chunks(spark, with_null), shared_dir(spark, "rebuilt"), EMBEDDER))
    assert spark.read.parquet(f"{root}/versions").count() == 2


def test_rebuild_retires_what_was_there(spark, root):
    build_index(chunks(spark, OLD), root, EMBEDDER)
    sync_index(chunks(spark, NEW), root, EMBEDDER)
    rebuilt = build_index(chunks(spark, OLD[:3]), root, EMBEDDER)
    assert [r[:2] for r in content(rebuilt)] == sorted(OLD[:3], key=repr)


def test_a_small_change_writes_little(spark, root):
    rows = [(i, f"text {i} " + "word " * 50) for i in range(2000)]
    build_index(chunks(spark, rows), root, EMBEDDER)
    rows[3:23] = [(i, "other " * 50) for i in range(3, 23)]
    sync_index(chunks(spark, rows), root, EMBEDDER)
    sizes = [sum(map(os.path.getsize, glob.glob(f"{root}/data/v={v}/*.parquet"))) for v in (1, 2)]
    assert spark.read.parquet(f"{root}/data/v=2").count() == 20 and sizes[1] < 0.2 * sizes[0]
    sync_index(chunks(spark, rows), root, EMBEDDER)
    assert spark.read.parquet(f"{root}/versions").count() == 2


def test_delete_everything_then_add(spark, root):
    build_index(chunks(spark, OLD), root, EMBEDDER)
    emptied = sync_index(chunks(spark, []), root, EMBEDDER)
    assert content(emptied) == []
    assert content(sync_index(chunks(spark, OLD), root, EMBEDDER)) == content(
        build_index(chunks(spark, OLD), shared_dir(spark, "rebuilt"), EMBEDDER)
    )


def test_changes_newest_wins_and_replay_is_ignored(spark, root):
    first = [(1, "insert", 1, "a"), (3, "update", 1, "c"), (2, "update", 1, "b"), (4, "insert", 2, "x"), (5, "delete", 2, None)]
    index = apply_changes(spark.createDataFrame(first, CHANGE), root, EMBEDDER, batch_id=0)
    assert [(r.id, r.content) for r in index.rows().collect()] == [(1, "c")]
    other = spark.createDataFrame([(9, "update", 1, "not applied")], CHANGE)
    assert content(apply_changes(other, root, EMBEDDER, batch_id=0)) == content(index)
    assert [r.content for r in apply_changes(other, root, EMBEDDER, batch_id=1).rows().collect()] == ["not applied"]


def test_late_changes_lose_across_batches(spark, root):
    apply = lambda rows, n: apply_changes(spark.createDataFrame(rows, CHANGE), root, EMBEDDER, batch_id=n)
    apply([(3, "update", 1, "newest"), (5, "delete", 2, None)], 0)
    index = apply([(2, "update", 1, "older"), (4, "insert", 2, "back from the dead")], 1)
    assert [(r.id, r.content) for r in index.rows().collect()] == [(1, "newest")]
    compact_index(index)
    index = apply([(4, "insert", 2, "still dead"), (3, "update", 1, "equal seq, later batch")], 2)
    assert [(r.id, r.content) for r in index.rows().collect()] == [(1, "equal seq, later batch")]


def test_compaction_and_clean_up(spark, root):
    index = build_index(chunks(spark, OLD), root, EMBEDDER)
    for n in (4, 9, 14):
        sync_index(chunks(spark, OLD[:n] + NEW[n:]), root, EMBEDDER)
    before = content(index)
    compact_index(index)
    assert content(index) == before
    assert clean_index(index) == [1, 2, 3, 4] and content(index) == before
    assert not os.path.exists(f"{root}/data/v=2")
    assert content(sync_index(chunks(spark, NEW), root, EMBEDDER)) == content(
        build_index(chunks(spark, NEW), shared_dir(spark, "rebuilt"), EMBEDDER)
    )


def test_failed_write_is_not_visible(spark, root):
    index = build_index(chunks(spark, OLD), root, EMBEDDER)
    before = content(index)
    # a version that was written but never logged
    chunks(spark, [(1, "x")]).write.parquet(f"{root}/data/v=2")
    assert content(open_index(spark, root, EMBEDDER)) == before
    assert len(content(sync_index(chunks(spark, NEW), root, EMBEDDER))) == len(NEW)


def test_latest_version(spark):
    rows = [("a", "9"), ("a", "10"), ("b", "0")]
    got = latest_version(spark.createDataFrame(rows, "name STRING, version STRING")).collect()
    assert {r.name: r.latest_version for r in got} == {"a": 10, "b": 1}


def test_rows_are_embedded_where_they_are_written(spark, root):
    """Vectors are neither shuffled nor sorted: a row's vector is made by the task that writes its file."""
    by_task = Embedder("task", 1, lambda text: F.array(F.spark_partition_id()))
    index = build_index(chunks(spark, OLD).repartition(8), root, by_task)
    apply_changes(spark.createDataFrame([(1, "update", i, t) for i, t in NEW], CHANGE).repartition(8), root, by_task)
    for version in (1, 2):
        rows = spark.read.parquet(f"{root}/data/v={version}").select(F.input_file_name().alias("file"), F.col("vec")[0].alias("task")).distinct()
        assert rows.count() == rows.select("file").distinct().count()
    assert {"content_md5", "vec"} < set(index.rows().columns)
