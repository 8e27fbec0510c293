import math
import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from groundline.llm import ranking
from groundline.llm.ranking import search
from tests.llm.data import frame, odd_texts, syllables
from tools.check import connect


def terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def by_hand(docs, items, k=20):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, length = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, counts, n in held:
            score = 0
            for t in terms(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * n * n_docs) // length
                    score += w * ((1000000000 * counts[t]) // (1000 * counts[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=lambda r: (r[0] or 0, r[1]))


def rows_of(found):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect()), key=lambda r: (r[0] or 0, r[1]))


@pytest.fixture
def short_reads(monkeypatch):
    """Many rounds and shards on few rows; functions travel with the module's values as they are at their call."""
    monkeypatch.setattr(ranking, "FIRST_READ", 2)


@pytest.mark.parametrize("k, postings", [(1, 1 << 21), (3, 40), (20, 300)])
def test_against_all_scores(spark, short_reads, k, postings):
    rng = random.Random(k)
    texts = syllables(11, 150, 30) + ["tie tie the"] * 30 + ["The, the! THE?"] * 5
    docs = [(i, t) for i, t in enumerate(texts)] + [(i, t) for i, t in odd_texts()] + [(700 + i, "x " * rng.randint(1, 50)) for i in range(20)]
    items = [(i, " ".join(rng.choices(" ".join(syllables(11, 150, 30)).split(), k=rng.randint(1, 25)))) for i in range(25)]
    items += [(50, "tie"), (51, "the THE x"), (52, "word"), (53, "nowhere"), (54, ""), (55, None), (56, "...")]
    found = search(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), k, shard_postings=postings)
    assert rows_of(found) == by_hand(docs, items, k)


def test_items_in_blocks(spark):
    texts = syllables(12, 60, 20)
    items = [(i, t) for i, t in enumerate(syllables(13, 12, 10))]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(search(frame(spark, texts), asked, 5, block_terms=15)) == by_hand(list(enumerate(texts)), items, 5)


def test_reading_stops_early():
    """A document that holds every rare term settles the first place before the common list is at its end."""
    import numpy as np
    import pyarrow as pa

    n = 5000
    owner = np.concatenate([np.arange(n), np.arange(3)])
    held = np.concatenate([np.zeros(n, int), np.ones(3, int)])
    times = np.ones(n + 3, dtype=np.int64)
    shard = ranking.Shard(pa.array(range(n)), np.full(n, 10), owner, held, times, n, 10 * n)
    lists = shard.lists(Counter([0, 1]), np.array([1, 9000]))
    reads = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                reads.append(key.stop - key.start)
            return np.ndarray.__getitem__(self, key)

    shard.docs = shard.docs.view(Watched)
    at, scores = shard.best(lists, 3, 0)
    assert sorted(at.tolist()) == [0, 1, 2] and len(set(scores.tolist())) == 1
    assert sum(reads) < n


def test_long_texts_in_pieces(spark, monkeypatch):
    text = "Alpha beta, " * 30
    monkeypatch.setattr(ranking, "PIECE", 50)
    assert [t for some in ranking.terms(text) for t in some] == [t.encode() for t in terms(text)]
    docs = [(1, "word " * 50_000 + "needle"), (2, "needle")]
    items = [(1, "needle " * 3000)]
    assert rows_of(search(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))) == by_hand(docs, items)


def test_clashing_names_and_nothing_to_do(spark):
    docs = frame(spark, [(1, "one two"), (2, "two")]).withColumn("terms", F.lit("x")).withColumn("rank", F.lit(0)).withColumn("item", F.lit(0))
    items = spark.createDataFrame([("q", "two two", 3)], "item_id string, text string, score int")
    found = search(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and [r.doc_id for r in found.collect()] == [2, 1]
    assert search(docs.filter("doc_id > 5"), items).collect() == []
    assert search(docs, items.filter("item_id = 'x'")).collect() == []


def test_query_equals_its_sql(spark, sf_dir):
    import __spark_entry__ as contract

    columns = ["item_id", "rank", "doc_id", "score"]
    expected = connect(sf_dir).sql(contract.oracle_sql()["op13_ranked_search"]).df()[columns].sort_values(columns)
    found = contract.queries()["op13_ranked_search"](spark, sf_dir).toPandas()[columns].sort_values(columns)
    assert found.values.tolist() == expected.values.tolist()
