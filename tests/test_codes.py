import re
import time

import numpy as np
import pytest

from groundline.operators import codes as C
from groundline.operators.cells import build_cells
from groundline.operators.codes import build_codes, encode, open_codes, search_codes
from groundline.operators.nearest import nearest
from groundline.operators.search import search_vector
from groundline.session import shared_dir
from tests.test_plans import plan

DIM = 64


@pytest.fixture(scope="module")
def vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS vec").cache()


@pytest.fixture(scope="module")
def coded(spark, vectors):
    path = shared_dir(spark, "test-code-cells")
    return build_codes(build_cells(vectors, 8, path), shared_dir(spark, "test-codes")), path


def test_codes_are_the_nearest_words():
    rng = np.random.default_rng(1)
    units, books = rng.normal(size=(50, 12)), rng.normal(size=(3, 7, 4))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    for row, code in zip(units, encode(units, books)):
        for p in range(3):
            distances = ((books[p] - row[4 * p : 4 * p + 4]) ** 2).sum(axis=1)
            assert distances[code[p]] == pytest.approx(distances.min())


def test_rounds_bring_words_nearer(spark, vectors):
    sample = vectors.select("id", "vec")
    units = C._units(vectors.toArrow()["vec"].combine_chunks(), DIM)

    def error(books):
        found = encode(units, books)
        return ((units.reshape(-1, 16, 4) - books[np.arange(16), found]) ** 2).sum()

    errors = [error(C.fit_books(sample, DIM, words=16, iterations=i)) for i in (0, 1, 4)]
    assert errors[0] > errors[1] > errors[2]


def test_recall_with_every_cell_probed(spark, vectors, coded):
    """Every vector as a question, codes of 16 bytes instead of 256, a short list of 64."""
    asked = vectors.withColumnRenamed("id", "qid")
    exact = {(r.qid, r.id) for r in nearest(asked, vectors, 4, DIM).rows.collect()}
    found = {(r.qid, r.id): r.score for r in search_codes(asked, coded[0], 8).collect()}
    assert len(found) == len(exact)
    assert len(exact & set(found)) >= 0.9 * len(exact)
    scores = {(r.qid, r.id): r.score for r in nearest(asked, vectors, 4, DIM).rows.collect()}
    assert all(found[key] == pytest.approx(scores[key], abs=2e-6) for key in exact & set(found))


def test_a_long_short_list_is_exact(spark, vectors, coded):
    asked = vectors.filter("id % 50 = 0").withColumnRenamed("id", "qid")
    exact = sorted((r.qid, r["rank"], r.id) for r in nearest(asked, vectors, 4, DIM).rows.collect())
    for questions in (3, 1000):  # in blocks, or all at once
        found = search_codes(asked, coded[0], 8, shortlist=10_000, questions=questions)
        assert sorted((r.qid, r["rank"], r.id) for r in found.collect()) == exact


def test_only_probed_cells_and_codes_are_read(spark, vectors, coded):
    text = plan(search_codes(vectors.filter("id = 0").withColumnRenamed("id", "qid"), coded[0], 1))
    scans = re.findall(r"PartitionFilters: (\[.*?\])\n.*?ReadSchema: (.*?)\n", text, re.S)
    assert len(scans) == 2 and all("cell" in filters for filters, _ in scans)
    assert sorted("code" in schema for _, schema in scans) == [False, True]
    assert "Exchange" not in text.split("MapInArrow")[0] or "WindowGroupLimit" in text


def test_open_again_and_columns(spark, vectors, coded):
    index, path = coded
    again = open_codes(spark, path, re.sub("/codes/.*", "", index.codes.inputFiles()[0]))
    assert np.array_equal(again.books, index.books)
    asked = vectors.filter("id < 5").withColumnRenamed("id", "qid")
    assert sorted(search_codes(asked, again, 2).collect()) == sorted(search_codes(asked, index, 2).collect())


def test_missing_zero_and_no_vectors(spark):
    rows = [(i, [float(i % 3), 1.0, 0.0, float(i)]) for i in range(20)] + [(20, [0.0] * 4), (21, None)]
    rows = spark.createDataFrame(rows, "id BIGINT, vec ARRAY<FLOAT>")
    built = build_codes(build_cells(rows, 2, shared_dir(spark, "test-code-cells")), shared_dir(spark, "test-codes"), parts=2, words=4)
    assert built.codes.count() == 21
    asked = spark.createDataFrame([("a", None), ("b", [1.0, 1.0, 0.0, 4.0]), ("c", [0.0] * 4)], "qid STRING, vec ARRAY<FLOAT>")
    found = search_codes(asked, built, 2, k=3).collect()
    assert {r.qid for r in found} == {"b", "c"} and len(found) == 6
    assert search_codes(asked.filter("qid = 'z'"), built, 2).collect() == []


def test_faster_than_the_scan_on_twenty_copies(spark, vectors, coded):
    """Seconds of both searches are in the README; here both must end and agree on what they find first."""
    many = vectors.crossJoin(spark.range(20).withColumnRenamed("id", "copy")).selectExpr("id + copy * 1000000 AS id", "vec")
    path = shared_dir(spark, "test-many")
    built = build_codes(build_cells(many, 8, path, max_iter=2), shared_dir(spark, "test-many-codes"), sample_rows=2000)
    asked = vectors.filter("id % 100 = 0").withColumnRenamed("id", "qid")
    start = time.time()
    near = search_codes(asked, built, 8).collect()
    middle = time.time()
    exact = search_vector(asked, built.cells.rows, DIM).collect()
    print(f"codes {middle - start:.2f} s, scan {time.time() - middle:.2f} s")
    assert {(r.qid, r["rank"], r.id) for r in near} == {(r.qid, r["rank"], r.id) for r in exact}
