import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from groundline.functions.tokens import squared_norm, term_vector, vec_head
from groundline.operators import nearest as near
from groundline.operators.cells import build_cells, open_cells, probe_cells
from groundline.operators.embed import embed, from_vectors, hashing_embedder, model_embedder, term_rows
from groundline.operators.index import build_index, open_index
from groundline.operators.search import retrieve, search_approx, search_text, search_vector
from groundline.plans.tables import table
from groundline.session import shared_dir
from tests.test_plans import plan

VECTORS = "id BIGINT, vec ARRAY<DOUBLE>"
QUERIES = "qid BIGINT, vec ARRAY<DOUBLE>"


def brute(queries, rows, k):
    hits = []
    for qid, q in queries:
        scored = []
        for i, v in rows:
            n = math.sqrt(np.dot(q, q) * np.dot(v, v))
            scored.append((-round(float(np.dot(q, v)) / n, 6) if n else 0.0, i))
        hits += [(qid, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(hits)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    # few distinct small vectors, so that equal scores are common and order by id matters
    rows = [(int(i), [float(x) for x in rng.integers(-1, 2, 4)]) for i in rng.permutation(400)]
    queries = [(int(q), [float(x) for x in rng.integers(-1, 2, 4)]) for q in range(30)]
    return queries, rows


def collected(df):
    return sorted((r.qid, r["rank"], r.id, r.score + 0.0) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"max_matrix_values": 8, "block_rows": 50}, {"max_matrix_values": 8}])
def test_nearest_equals_brute_force(spark, vectors, options):
    queries, rows = vectors
    hits = near.nearest(
        spark.createDataFrame(queries, QUERIES), spark.createDataFrame(rows, VECTORS).repartition(5), 4, 4, **options
    )
    assert (hits.n_queries is None) == bool(options)
    assert collected(hits.rows) == brute(queries, rows, 4)


def test_small_batches_and_query_slices(spark, vectors, monkeypatch):
    queries, rows = vectors
    monkeypatch.setattr(near, "QUERY_SLICE", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        hits = near.nearest(spark.createDataFrame(queries, QUERIES), spark.createDataFrame(rows, VECTORS), 4, 4)
        assert collected(hits.rows) == brute(queries, rows, 4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_fewer_rows_than_k_and_no_rows(spark):
    queries = spark.createDataFrame([(1, [1.0, 0.0])], QUERIES)
    rows = spark.createDataFrame([(5, [1.0, 0.0]), (6, None)], VECTORS)
    assert collected(near.nearest(queries, rows, 4, 2).rows) == [(1, 1, 5, 1.0)]
    assert collected(near.nearest(queries, rows.limit(0), 4, 2).rows) == []
    assert collected(near.nearest(queries.limit(0), rows, 4, 2).rows) == []


@pytest.mark.parametrize("options", [{}, {"max_matrix_values": 8, "block_rows": 50}])
def test_all_cells_probed_is_exact(spark, vectors, options):
    queries, rows = vectors
    path = shared_dir(spark, "test-cells")
    build_cells(spark.createDataFrame(rows, VECTORS), 5, path)
    cells = open_cells(spark, path)
    probed = probe_cells(spark.createDataFrame(queries, QUERIES), cells.centres, 5)
    assert collected(near.nearest(probed, cells.rows, 4, 4, **options).rows) == brute(queries, rows, 4)


def test_given_centres(spark):
    """Rows go to the centre of highest cosine, the first of equals; a zero vector has a cell, a missing one is left out."""
    rows = [(1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [-1.0, 0.1])]
    centres = np.array([[1.0, 0.0], [0.0, 5.0]])
    cells = build_cells(spark.createDataFrame(rows, VECTORS), 2, shared_dir(spark, "test-given"), centres=centres)
    assert {r["id"]: r["cell"] for r in cells.rows.collect()} == {1: 0, 2: 1, 3: 0, 4: 0, 6: 1}
    assert np.array_equal(cells.centres, centres)


def test_recall_of_cells(spark, sf_dir):
    """Every vector as a query, 4 of 16 cells: recall@4 against the exact search."""
    rows = from_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    queries = rows.withColumnRenamed("id", "qid")
    exact = search_vector(queries, rows, 64).select("qid", "id")
    cells = build_cells(rows, 16, shared_dir(spark, "test-cells"))
    approx = search_approx(queries, cells, 4).select("qid", "id")
    recall = exact.join(approx, ["qid", "id"]).count() / exact.count()
    assert recall > 0.6


def test_self_is_nearest(spark, sf_dir):
    rows = from_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    best = search_vector(rows.withColumnRenamed("id", "qid"), rows, 64).filter("rank = 1")
    assert best.filter("score >= 0.999999 AND id <= qid").count() == rows.count()


def python_terms(text):
    tokens = [t for t in re.split(r"[^\w]+|_", text.lower()) if t]
    return Counter(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % (1 << 20) for t in tokens)


@pytest.mark.parametrize("text", ["English embedding test.", "한국어 임베딩 테스트 입니다.", "Spark와 SQL, a a A b", "", "!?"])
def test_term_vector(spark, text):
    row = spark.createDataFrame([(text,)], "t STRING").select(term_vector(F.col("t")).alias("v")).first().v
    assert dict(zip(row.buckets, row.weights)) == python_terms(text)
    assert list(row.buckets) == sorted(row.buckets)


def test_term_rows_and_norm(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, None)], "id BIGINT, content STRING")
    embedded = embed(df, "content", hashing_embedder())
    assert sorted(r.weight for r in term_rows(embedded, "id").collect()) == [1, 2]
    assert [r[0] for r in embedded.orderBy("id").select(squared_norm(F.col("vec"))).collect()] == [5, None]
    assert spark.sql("SELECT array(1, 2, 3, 4, 5, 6) v").select(vec_head(F.col("v"))).first()[0] == [1, 2, 3, 4, 5]


CHUNKS = [(1, "red apples and pears"), (2, "blue sky"), (3, "red wine"), (4, "apples"), (5, "red apples and pears"), (6, "!")]


def make_index(spark, embedder):
    chunks = spark.createDataFrame(CHUNKS, "id BIGINT, content STRING")
    return build_index(chunks, shared_dir(spark, "test-index"), embedder)


def test_search_text_and_retrieve(spark):
    index = make_index(spark, hashing_embedder())
    questions = spark.createDataFrame([(10, "red apples and pears"), (11, "zebra")], "qid BIGINT, query STRING")
    rows = search_text(questions, index).orderBy("qid", "rank").collect()
    assert [(r.qid, r["rank"], r.id) for r in rows] == [(10, 1, 1), (10, 2, 5), (10, 3, 4), (10, 4, 3)]
    assert rows[0].score == 1.0 and rows[0].content == CHUNKS[0][1]
    got = {r.qid: r.contents for r in retrieve(questions, index).collect()}
    assert len(got[10]) == 4 and got[11] == []


def test_model_embedder_plugs_in(spark):
    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    index = make_index(spark, model_embedder("length", 2, load))
    questions = spark.createDataFrame([(10, "12345678")], "qid BIGINT, query STRING")
    assert search_text(questions, index, k=1).first().id == 2


def test_index_remembers_its_embedder(spark):
    index = make_index(spark, hashing_embedder())
    with pytest.raises(ValueError, match="embedded by"):
        open_index(spark, index.root, hashing_embedder(128))
    with pytest.raises(ValueError, match="no index"):
        open_index(spark, shared_dir(spark, "none"), hashing_embedder())


def test_a_repeated_question_is_ranked_once(spark):
    index = make_index(spark, hashing_embedder())
    twice = spark.createDataFrame([(1, CHUNKS[0][1]), (1, CHUNKS[0][1]), (2, CHUNKS[1][1])], "qid BIGINT, query STRING")
    rows = retrieve(twice, index).collect()
    assert sorted(r.qid for r in rows) == [1, 2]
    once = {r.qid: r.contents for r in retrieve(twice.distinct(), index).collect()}
    assert {r.qid: r.contents for r in rows} == once and all(len(c) <= 4 for c in once.values())


def test_hits_share_a_token_with_the_question(spark, sf_dir):
    from groundline.functions.tokens import tokens
    from groundline.operators.search import search_text
    from groundline.plans import tables

    asked = tables.questions(spark, sf_dir)
    hits = search_text(asked, tables.chunk_index(spark, sf_dir, tables.document_chunks)).join(asked, "qid")
    assert hits.count() > 0
    assert hits.filter(~F.arrays_overlap(tokens(F.col("query")), tokens(F.col("content")))).count() == 0


@pytest.mark.parametrize("scale", [1, 5000])
def test_products_by_matrix_and_entry_by_entry(monkeypatch, scale):
    """Common buckets go through matrices, others are joined; memory is bounded by tiles, and products are exact at any size."""
    rng = np.random.default_rng(scale)

    def some(n):
        wide = rng.integers(1, 9, (n, 400)) * (rng.random((n, 400)) < 1 / np.arange(1, 401)) * scale
        row, bucket = np.nonzero(wide)
        return wide, near.Sparse(n, row, bucket * 7, wide[row, bucket].astype(float))

    rows, queries = some(300), some(70)
    expected = rows[0] @ queries[0].T
    for columns, products in ((2048, 1 << 20), (0, 100), (3, 1)):
        monkeypatch.setattr(near, "DENSE_COLUMNS", columns)
        monkeypatch.setattr(near, "PRODUCTS", products)
        ready = near.Shared(rows[1], queries[1])
        assert ready.matrix.shape[1] <= columns and ready.kind is (np.float32 if scale == 1 else np.float64)
        for part in (slice(0, 70), slice(9, 31), np.array([3, 50, 4])):
            assert (ready.dots(queries[1][part]) == expected[:, part]).all()


def term_table(spark, rng, n, key):
    """Term vectors of words with falling frequencies; every tenth is missing, every eleventh empty."""
    rows = []
    for i in rng.permutation(n):
        bucket = np.flatnonzero(rng.random(60) < 4 / np.arange(1, 61))
        vec = ([int(b) for b in bucket], [int(w) for w in rng.integers(1, 4, len(bucket))])
        rows.append((int(i), None if i % 10 == 9 else ([], []) if i % 11 == 7 else vec))
    return rows, spark.createDataFrame(rows, f"{key} BIGINT, vec STRUCT<buckets: ARRAY<INT>, weights: ARRAY<INT>>")


@pytest.mark.parametrize("options", [{}, {"block_rows": 7}, {"block_values": 150}])
def test_many_blocks_of_term_vectors(spark, monkeypatch, options):
    """However queries are cut into blocks and rows into packs, hits are those of the plan without blocks."""
    rng = np.random.default_rng(8)
    queries, asked = term_table(spark, rng, 90, "qid")
    _, rows = term_table(spark, rng, 300, "id")
    # ids of queries may be structs and repeat
    asked = asked.union(asked.filter("qid < 3")).select(F.struct("qid").alias("qid"), "vec").repartition(6)

    def hits(**how):
        found = near.nearest(asked, rows.repartition(5), 4, 60, positive_only=True, **how).rows
        return sorted((r.qid.qid, r["rank"], r.id, r.score) for r in found.collect())

    expected = hits()
    assert {q for q, *_ in expected} == {q for q, vec in queries if vec and vec[0]}
    monkeypatch.setattr(near, "ROW_SLICE", 17)
    assert hits(max_matrix_values=8, **options) == expected


def test_blocks_copy_neither_side(spark):
    """More queries than a task takes at once: the index is not shuffled for them and queries are shuffled once, without copies."""
    rng = np.random.default_rng(9)
    _, asked = term_table(spark, rng, 60, "qid")
    path = shared_dir(spark, "test-copies")
    term_table(spark, rng, 200, "id")[1].write.parquet(path)
    rows = spark.read.parquet(path)
    text = plan(near.nearest(asked, rows, 4, 60, positive_only=True, max_matrix_values=8, block_rows=10).rows)
    assert "RoundRobinPartitioning(6)" in text
    assert len(re.findall(r"\) Exchange\n", text)) == 2  # the queries and, for their ranks, the hits
    assert "Generate" not in text and "Group" not in text.replace("WindowGroupLimit", "")
    # tasks stream the left side, the index, and hold a partition of the right one, a block of queries
    assert re.search(r"CartesianProduct[^E]*Coalesce[^E]*Exchange", text.split("\n\n")[0])
