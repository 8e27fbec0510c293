"""Ranked lexical search: impact-sorted lists read from the top, with an interval for each document's score (NRA)."""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundline.llm.common import stored, text_slices

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what lies between these is a term, A-Z in lower case
BLOCK_TERMS = 1 << 20  # terms of items that are asked at once
SHARD_POSTINGS = 1 << 20  # entries whose lists a task sorts by impact at once
FIRST_READ = 128  # entries of a list that are read at first; each round reads as many as all before
PIECE = 1 << 20  # bytes of a text that are split at once
UNIT = 1_000_000_000

LETTERS = (*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100))
PLAIN = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in LETTERS else 0x20 for b in range(256))
GAP = re.compile(rb" ")


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, list by list; none for a missing one."""
    data = (text or "").encode("utf-8", "replace").translate(PLAIN)
    start = 0
    while len(data) - start > PIECE:
        cut = GAP.search(data, start + PIECE)
        if cut is None:
            break
        yield data[start : cut.start()].split()
        start = cut.start()
    yield data[start:].split()


@dataclass
class Items:
    """A block of items: for each its id and how often it holds each term (by the term's number)."""

    ids: list
    counts: list[Counter]
    numbers: dict[bytes, int]


def blocks(items: DataFrame, id_column: str, text_column: str, size: int = BLOCK_TERMS) -> Iterator[Items]:
    """The items in blocks of about `size` terms; the driver holds one block, one partition of items at a time."""
    block = Items([], [], {})
    held = 0
    for row in items.select(id_column, text_column).toLocalIterator():
        found = Counter()
        for some in terms(row[1]):
            found.update(block.numbers.setdefault(t, len(block.numbers)) for t in some)
        block.ids.append(row[0])
        block.counts.append(found)
        held += len(found) + 1
        if held >= size:
            yield block
            block, held = Items([], [], {}), 0
    if block.ids:
        yield block


def with_counts(docs: DataFrame, numbers: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """`(doc_id, n, terms, tfs)`: a document's number of terms, and the given terms it holds by number with their occurrences. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 1):
            sizes, held, times, ends = [], [], [], [0]
            for text in part.column(1).to_pylist():
                found, n = Counter(), 0
                for some in terms(text):
                    found.update(some)
                    n += len(some)
                known = [(numbers[t], tf) for t, tf in found.items() if t in numbers]
                held += [t for t, _ in known]
                times += [tf for _, tf in known]
                ends.append(len(held))
                sizes.append(n)
            offsets = pa.array(ends, pa.int32())
            columns = [
                part.column(0),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(held, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def weights(counted: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and each term's weight, from one aggregation by Spark; the driver gets a row per term of the block."""
    n, length = counted.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    found = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    df = np.zeros(n_terms, dtype=np.int64)
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    logs = [math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()]
    return n, length or 0, np.array(logs, dtype=np.int64)


class Shard:
    """Impact-sorted lists of some documents: for each term, its documents by falling impact."""

    def __init__(self, doc_ids: pa.Array, sizes: np.ndarray, owner: np.ndarray, held: np.ndarray, times: np.ndarray, n: int, length: int):
        self.doc_ids, self.n_docs = doc_ids, len(sizes)
        m = 75 + (25 * sizes * n) // max(length, 1)
        impact = (UNIT * times) // (1000 * times + 12 * m[owner])  # below 2^20 = 1,048,576, as 1000 * tf divides out
        order = np.argsort(held.astype(np.int64) << 20 | (1 << 20) - 1 - impact, kind="stable")
        self.docs, self.impacts = owner[order], impact[order]
        self.terms, self.starts = np.unique(held[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))

    def lists(self, counts: Counter, weight: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, factor) of the lists of an item's terms that can add to a score; a term's factor is its weight for each occurrence."""
        wanted = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
        at = np.searchsorted(self.terms, wanted)
        out = []
        for i, term in zip(at.tolist(), wanted.tolist()):
            if i < len(self.terms) and self.terms[i] == term and weight[term] > 0:
                out.append((int(self.starts[i]), int(self.ends[i]), int(weight[term]) * counts[term]))
        return out

    def best(self, lists: list[tuple[int, int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the `k` best of all that score `floor` or more, and their exact scores.

        Each round reads every list as deep as all rounds before. A document's lower bound is what was read of it; its
        upper bound adds, for each list that it was not met in, the impact that comes next there. A document stays while
        its upper bound reaches the k-th lower bound and `floor`, ties included; reading ends when no interval is open.
        """
        lower = np.zeros(self.n_docs, dtype=np.int64)
        seen = np.zeros((len(lists), self.n_docs), dtype=bool)
        live = np.ones(self.n_docs, dtype=bool)  # an interval that reaches the bound
        depth, stop = 0, FIRST_READ
        while True:
            following = np.zeros(len(lists), dtype=np.int64)
            for t, (start, end, factor) in enumerate(lists):
                to = min(start + stop, end)
                docs = self.docs[start + depth : to]
                if len(docs):
                    open_ = live[docs]
                    docs = docs[open_]
                    lower[docs] += factor * self.impacts[start + depth : to][open_]
                    seen[t, docs] = True
                if to < end:
                    following[t] = factor * self.impacts[to]
            at = np.flatnonzero(live)
            known = lower[at]
            kth = int(np.partition(known, len(known) - k)[len(known) - k]) if len(known) >= k else 0
            bound = max(kth, floor, 1)
            at = at[known + following.sum() >= bound]  # what no list could lift needs no closer look
            missing = following @ ~seen[:, at] if following.any() else np.zeros(len(at), dtype=np.int64)
            reach = lower[at] + missing >= bound
            at, missing = at[reach], missing[reach]
            if not missing.any():
                return at, lower[at]
            live[:] = False
            live[at] = True
            depth, stop = stop, 2 * stop


class Best:
    """The `k` best (score, id) of an item so far: high scores first, then small ids, missing ids before all."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def floor(self) -> int:
        return self.rows[-1][0] if len(self.rows) >= self.k else 0

    def add(self, scores: list[int], ids: list) -> None:
        self.rows += zip(scores, ids)
        self.rows.sort(key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
        del self.rows[self.k :]


def top_of_block(counted: DataFrame, block: Items, k: int, shard_postings: int) -> DataFrame:
    """`(item, doc_id, score)`: of each task the `k` best documents of each item of the block, the item by its place there."""
    n, length, weight = weights(counted, len(block.numbers))
    counts = block.counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in counts]

        def read(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held)
            lists, tfs = (table[c].combine_chunks() for c in ("terms", "tfs"))
            owner = pc.list_parent_indices(lists).to_numpy()
            sizes = table["n"].to_numpy()
            ids = table["doc_id"].combine_chunks()
            shard = Shard(ids, sizes, owner, pc.list_flatten(lists).to_numpy(), pc.list_flatten(tfs).to_numpy().astype(np.int64), n, length)
            for item, own in enumerate(counts):
                if lists := shard.lists(own, weight):
                    at, scores = shard.best(lists, k, best[item].floor)
                    if len(at):
                        first = top(at, scores, shard.doc_ids)
                        best[item].add(scores[first].tolist(), shard.doc_ids.take(pa.array(at[first])).to_pylist())

        def top(at: np.ndarray, scores: np.ndarray, ids: pa.Array) -> np.ndarray:
            """Places of the k best, so that a crowd of equal texts is not carried on."""
            found = pa.table({"score": scores, "id": ids.take(pa.array(at))})
            order = pc.sort_indices(found, sort_keys=[("score", "descending"), ("id", "ascending")], null_placement="at_start")
            return order.to_numpy()[:k]

        held, postings = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                held.append(part)
                postings += len(pc.list_flatten(part.column("terms")))
                if postings >= shard_postings:
                    read(held)
                    held, postings = [], 0
        if held:
            read(held)
        rows = [(item, i, score) for item, b in enumerate(best) for score, i in b.rows]
        items, ids, scores = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"]
        )

    return counted.mapInArrow(run, "item long, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """`(item_id, rank, doc_id, score)`: for each item its `k` best documents with a score above 0, equal scores by ascending id.

    Documents are counted once for a block of items: only the items' terms are kept, and N, L and the document
    frequencies come from all documents. Each task then sorts the lists of a shard of its documents by impact and reads
    them from the top (`Shard.best`); what it has found bounds its next shards. Spark ranks the k rows per item and task.
    Ids are whole numbers; a missing id stands before all others among equal scores, repeated rows and ids are documents
    of their own. Missing and empty texts have no terms and score nothing, and an item without terms has no rows; of
    rows that repeat an item's id each is ranked alone. Other columns are left out. No rows on either side give no rows.
    """
    of_block = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    kind = items.schema[item_column].dataType
    out = None
    for block in blocks(items, item_column, item_text, block_terms):
        counted = stored(with_counts(docs, block.numbers, id_column, text_column), "search-counts")
        found = top_of_block(counted, block, k, shard_postings).withColumn("rank", F.row_number().over(of_block)).filter(F.col("rank") <= k)
        spark = docs.sparkSession
        names = spark.createDataFrame(list(enumerate(block.ids)), schema="item long, item_id " + kind.simpleString())
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return out


#: `op13_ranked_search` over `documents` and `benchmark`.
SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), docs AS (
  SELECT doc_id, terms, len(terms)::BIGINT AS n FROM split WHERE len(terms) > 0
), total AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS length FROM docs
), sized AS (
  SELECT doc_id, terms, 75 + (25 * n * n_docs) // length AS m FROM docs, total
), held AS (
  SELECT doc_id, m, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, m, unnest(terms) AS term FROM sized) GROUP BY ALL
), weighed AS (
  SELECT term, floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, total GROUP BY term
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
