import math
from collections import Counter

import pytest

from groundline.functions.tokens import N_BUCKETS
from groundline.operators.embed import embed_queries, hashing_embedder
from groundline.operators.index import apply_changes, build_index, clean_index, compact_index, sync_index
from groundline.operators.postings import build_postings
from groundline.operators.termstats import ALL, _kept_versions, search_text_weighted, term_frequencies, weighted
from groundline.session import shared_dir
from groundline.streaming.sync import CHANGE_SCHEMA

EMBEDDER = hashing_embedder()
OLD = [(1, "red apples"), (2, "blue sky the the"), (3, "the red sky"), (4, None), (5, "")]
NEW = [(1, "green apples the"), (3, "the red sky"), (4, "sky at last"), (6, "the end")]


@pytest.fixture
def root(spark):
    return shared_dir(spark, "test-index")


def chunks(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, content STRING")


def frequencies(index):
    return {r.bucket: r.df for r in term_frequencies(index).collect()}


def by_hand(spark, rows):
    vectors = embed_queries(chunks(spark, rows).selectExpr("id AS qid", "content AS query"), EMBEDDER).collect()
    full = [r.vec.buckets for r in vectors if r.vec is not None and r.vec.buckets]
    return dict(Counter(b for buckets in full for b in buckets)) | ({ALL: len(full)} if full else {})


def test_after_syncs_as_after_a_rebuild(spark, root):
    index = build_index(chunks(spark, OLD), root, EMBEDDER)
    assert frequencies(index) == by_hand(spark, OLD)
    sync_index(chunks(spark, NEW), root, EMBEDDER)
    sync_index(chunks(spark, NEW + [(7, "red red")]), root, EMBEDDER)  # two versions without counts
    assert frequencies(index) == by_hand(spark, NEW + [(7, "red red")])
    assert _kept_versions(index) == {1, 2, 3}
    changes = [(9, "delete", 3, None), (9, "update", 6, "the sky"), (9, "insert", 8, "blue"), (9, "delete", 99, None)]
    apply_changes(spark.createDataFrame(changes, CHANGE_SCHEMA), root, EMBEDDER)
    now = [(1, "green apples the"), (4, "sky at last"), (6, "the sky"), (7, "red red"), (8, "blue")]
    assert frequencies(index) == by_hand(spark, now)
    compact_index(index)
    assert frequencies(index) == by_hand(spark, now)
    clean_index(index)
    build_index(chunks(spark, OLD), root, EMBEDDER)
    assert frequencies(index) == by_hand(spark, OLD)


def test_an_index_without_terms(spark, root):
    index = build_index(chunks(spark, [(1, None), (2, "...")]), root, EMBEDDER)
    assert frequencies(index) == {}
    assert search_text_weighted(spark.createDataFrame([(1, "red")], "qid INT, query STRING"), index).collect() == []


def test_weights_and_limit(spark, root):
    index = build_index(chunks(spark, NEW), root, EMBEDDER)
    asked = spark.createDataFrame([("a", "the sky sky unknown"), ("b", "the"), ("c", None), ("d", "")], "qid STRING, query STRING")
    rows = {r.qid: r.vec for r in weighted(embed_queries(asked, EMBEDDER), term_frequencies(index), 0.5).collect()}
    assert set(rows) == {"a"}  # `the` stands in three of four rows
    assert rows["a"].weights == [2 * math.floor(1000 * math.log(10 / 5))]
    every = {r.qid: r.vec for r in weighted(embed_queries(asked, EMBEDDER), term_frequencies(index), 1.0).collect()}
    assert set(every) == {"a", "b"} and every["a"].buckets == sorted(every["a"].buckets) and max(every["a"].buckets) < N_BUCKETS


def test_rare_words_count_more(spark, root):
    rows = [(i, "common words here") for i in range(8)] + [(100, "rare"), (101, "common rare thing here"), (102, "common words words words")]
    index = build_index(chunks(spark, rows), root, EMBEDDER)
    asked = spark.createDataFrame([(1, "common words rare"), (1, "zzz")], "qid INT, query STRING")
    found = search_text_weighted(asked, index, max_share=1.0)
    assert found.columns == ["qid", "rank", "id", "content", "score"]
    assert [r.id for r in found.orderBy("rank").collect()][0] == 100
    listed = search_text_weighted(asked, index, max_share=1.0, postings=build_postings(index.rows(), shared_dir(spark, "test-postings")))
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, found.collect()))
