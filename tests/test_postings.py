import random
import re

import pyarrow as pa
import pytest

from groundline.operators import postings
from groundline.operators.embed import embed, embed_queries, hashing_embedder
from groundline.operators.index import build_index
from groundline.operators.nearest import nearest
from groundline.operators.postings import _segment_blocks, build_postings, live_segments, nearest_by_terms, open_postings, search_text_postings
from groundline.operators.search import search_text
from groundline.session import shared_dir
from tests.test_plans import plan

EMBEDDER = hashing_embedder()
WORDS = [f"w{i}" for i in range(60)]


def texts(seed: int, n: int) -> list:
    """Short texts over a few words with very unequal frequencies; copies, empty and missing ones."""
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    out = [" ".join(["the", *rng.choices(WORDS, weights, k=rng.randint(0, 12))]) for _ in range(n)]
    return [*out, *out[:7], "", None, "...", "the " * 50]


def frames(spark, rows, asked):
    rows = spark.createDataFrame(list(enumerate(rows, 5)), "id BIGINT, content STRING")
    questions = spark.createDataFrame(list(enumerate(asked)), "qid BIGINT, query STRING")
    return embed(rows, "content", EMBEDDER), embed_queries(questions, EMBEDDER)


def hits(df):
    return sorted((str(r.qid), r["rank"], r.id, r.score) for r in df.collect())


@pytest.mark.parametrize("k, parts, segment_rows, group_terms", [(1, 4, 10, 1 << 20), (4, 64, 37, 50), (4, 1, 1 << 16, 1 << 20), (9, 7, 100, 1)])
def test_equals_the_scan(spark, k, parts, segment_rows, group_terms):
    rows, questions = frames(spark, texts(k, 300), [*texts(k + 50, 40), "unknown words only", "w3 w3 w59", "the"])
    built = build_postings(rows, shared_dir(spark, "test-postings"), parts, segment_rows)
    expected = nearest(questions, rows, k, EMBEDDER.dim, positive_only=True).rows
    assert hits(nearest_by_terms(questions, open_postings(spark, built.path), k, group_terms)) == hits(expected)


def test_segments_below_the_floor_are_not_read(spark):
    """Rows that only share the word of every row cannot reach those that share the rare ones."""
    rows, questions = frames(spark, ["the common text of row " + " ".join(WORDS[i % 50 : i % 50 + 5]) for i in range(1000)] + ["needle in a haystack"] * 4, ["the needle haystack"])
    built = build_postings(rows, shared_dir(spark, "test-postings"), 16, 20)
    live = live_segments(questions, built, 4)
    segments = built.blocks().select("segment").distinct().count()
    assert live.count() <= 4 < segments
    assert hits(nearest_by_terms(questions, built, 4)) == hits(nearest(questions, rows, 4, EMBEDDER.dim, positive_only=True).rows)


def test_other_folders_and_lists_are_not_read(spark):
    rows, questions = frames(spark, texts(3, 200), ["w1 w2"])
    built = build_postings(rows, shared_dir(spark, "test-postings"), 32, 50)
    wanted = {r.b % 32 for r in questions.selectExpr("explode(vec.buckets) AS b").collect()}
    bounds = plan(live_segments(questions, built, 4))
    assert "ids" not in "".join(re.findall(r"ReadSchema: .*", bounds))
    for text in (bounds, plan(nearest_by_terms(questions, built, 4))):
        filters = re.findall(r"PartitionFilters: \[.*?(?:part#\d+ IN \(([^)]*)\)|\(part#\d+ = (\d+)\))", text)
        assert filters and all({int(x) for x in re.findall(r"\d+", a or b)} <= wanted for a, b in filters)
    assert "CoGroup" not in bounds and "EvalPython" not in bounds


def test_a_frequent_bucket_is_many_blocks(spark):
    rows, _ = frames(spark, ["the same"] * 500, [])
    built = build_postings(rows, shared_dir(spark, "test-postings"), 4, 25)
    sizes = [r.n for r in built.blocks().selectExpr("size(ids) AS n").collect()]
    assert len(sizes) > 20 and max(sizes) < 80 and sum(sizes) == 1000


def test_search_by_text(spark):
    chunks = spark.createDataFrame([(1, "red apples"), (2, "blue sky"), (3, "red sky at night"), (4, None)], "id BIGINT, content STRING")
    index = build_index(chunks, shared_dir(spark, "test-index"), EMBEDDER)
    built = build_postings(index.rows(), shared_dir(spark, "test-postings"))
    asked = spark.createDataFrame([((1, 2), "red sky"), ((1, 2), "zzz"), ((3, 4), None), ((5, 6), "")], "qid STRUCT<a: INT, b: INT>, query STRING")
    found = search_text_postings(asked, index, built)
    assert found.columns == ["qid", "rank", "id", "content", "score"] and found.count() == 3
    assert hits(found) == hits(search_text(asked, index))
    assert hits(search_text_postings(asked.filter("qid.a > 9"), index, built)) == []


def test_nothing_to_search(spark):
    rows, questions = frames(spark, ["", None], ["the"])
    built = build_postings(rows, shared_dir(spark, "test-postings"))
    assert nearest_by_terms(questions, built, 4).collect() == []


def test_blocks_do_not_depend_on_how_many_entries_are_sorted_at_once(spark, monkeypatch):
    """A segment is turned into its blocks in one task, in pieces of a bounded number of entries."""
    rows = embed(spark.createDataFrame(list(enumerate(texts(8, 90))), "id BIGINT, content STRING"), "content", EMBEDDER)
    table = rows.filter("vec IS NOT NULL").select("id", "vec").toArrow()
    key = (pa.scalar(3, pa.int32()),)

    def blocks():
        return sorted(_segment_blocks(4)(key, table).to_pylist(), key=lambda b: b["bucket"])

    whole = blocks()
    monkeypatch.setattr(postings, "BUILD_ENTRIES", 50)
    assert blocks() == whole
    held = {r.id: dict(zip(r.vec.buckets, r.vec.weights)) for r in rows.collect() if r.vec is not None}
    for block in whole:
        ids = sorted(i for i, vec in held.items() if block["bucket"] in vec)
        squares = [sum(w * w for w in held[i].values()) for i in ids]
        weights = [held[i][block["bucket"]] for i in ids]
        best = max((w / s**0.5, -i) for w, s, i in zip(weights, squares, ids))
        assert (block["ids"], block["weights"], block["squares"]) == (ids, weights, squares)
        assert (block["max_impact"], -block["top_id"], block["part"], block["segment"]) == (*best, block["bucket"] % 4, 3)
    assert len(whole) == len({b for vec in held.values() for b in vec})
