"""k nearest rows for every query, without forming query-row pairs in Spark.

Two exact plans share one scoring step:

* Up to a checked number of queries, their vectors go to every task. A task multiplies its Arrow
  batches with them and keeps k rows per query, so the index is read once, is not shuffled, and only
  `k * queries` rows leave a task.
* Beyond that, queries are cut into blocks of bounded size. A task holds one block and reads a part of
  the index from where it is stored, so neither side is copied for the other, and again only k rows
  per query leave a task.

Rows and queries may carry cells (see `cells.py`); a query then meets only the rows of its cells.
Scores are cosines rounded to 6 places; equal scores are ordered by id.
"""

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from groundline.session import shared_dir

MAX_MATRIX_VALUES = 2_000_000  # query values sent to every task: 16 MB as doubles
MAX_QUERIES = 10_000  # and no more queries than this, which bounds the hits too
BLOCK_ROWS = 10_000  # queries in one block of the blocked plan
BLOCK_VALUES = 2_000_000  # and about so many values in their vectors
PARTS = 16  # of the index, each against every block of queries
WAVES = 4  # of tasks at least, which may take more parts
QUERY_SLICE = 256  # queries scored at a time, which bounds the score matrix of a batch
ROW_SLICE = 10_000  # rows that meet a block of queries as one pack
TILE_ROWS = 4096  # rows among them whose products are held at once
DENSE = 1e-3  # share of pairs that have a bucket in common, above which it is a column of matrices
DENSE_COLUMNS = 2048  # and no more columns than this
PRODUCTS = 1 << 20  # products of single entries held at once
SLACK = 2e-6  # covers the rounding of scores to 6 places


class Hits(NamedTuple):
    rows: DataFrame  # (qid, id, score, rank)
    n_queries: int | None  # None if beyond the checked bound


def topk(scored: DataFrame, k: int, by: str = "score") -> DataFrame:
    """Rank 1..k per query, highest `by` first, ties by id.

    Spark limits each group to k rows before the shuffle, so a query with very many rows is no skew.
    """
    order = Window.partitionBy("qid").orderBy(F.col(by).desc(), F.col("id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class Dense:
    """Vectors of equal length as a matrix."""

    def __init__(self, values: np.ndarray):
        self.values = values

    @classmethod
    def of(cls, vec: pa.Array, dim: int):
        values = pc.list_flatten(vec).to_numpy(zero_copy_only=False)
        return cls(values.astype(np.float64).reshape(len(vec), dim))

    def __len__(self) -> int:
        return len(self.values)

    def __getitem__(self, at):
        return Dense(self.values[at])

    def norms(self) -> np.ndarray:
        return np.einsum("ij,ij->i", self.values, self.values)

    def dots(self, queries) -> np.ndarray:
        return self.values @ queries.values.T


class Sparse:
    """Term vectors as flat entries in row order: only what a row and a query have in common is ever multiplied, whatever the dimension."""

    def __init__(self, n: int, row: np.ndarray, bucket: np.ndarray, weight: np.ndarray):
        self.n, self.row, self.bucket, self.weight = n, row, bucket, weight
        self._columns = None

    @classmethod
    def of(cls, vec: pa.Array, _dim: int):
        buckets, weights = vec.flatten()
        row = np.repeat(np.arange(len(vec)), pc.list_value_length(buckets).to_numpy(zero_copy_only=False))
        bucket = pc.list_flatten(buckets).to_numpy(zero_copy_only=False)
        return cls(len(vec), row, bucket, pc.list_flatten(weights).to_numpy(zero_copy_only=False).astype(np.float64))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, at):
        chosen = np.arange(self.n)[at]
        if not len(chosen) or (np.diff(chosen) == 1).all():
            start = int(chosen[0]) if len(chosen) else 0  # neighbours: a stretch of the entries
            kept = slice(*np.searchsorted(self.row, [start, start + len(chosen)]))
            row = self.row[kept] - start
        else:
            place = np.full(self.n, -1)
            place[chosen] = np.arange(len(chosen))
            kept = np.flatnonzero(place[self.row] >= 0)
            kept = kept[np.argsort(place[self.row[kept]], kind="stable")]
            row = place[self.row[kept]]
        part = Sparse(len(chosen), row, self.bucket[kept], self.weight[kept])
        if self._columns is not None:
            part._columns = self._columns[0], self._columns[1][kept]
        return part

    def norms(self) -> np.ndarray:
        return np.bincount(self.row, weights=self.weight**2, minlength=self.n)

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        """The buckets that occur and, of every entry, its bucket's place among them; slices keep them."""
        if self._columns is None:
            self._columns = np.unique(self.bucket, return_inverse=True)
        return self._columns

    def dots(self, queries) -> np.ndarray:
        return Shared(self, queries).dots(queries)


class Shared:
    """Rows made ready for products with slices of `queries`, by the buckets that both have.

    A bucket that many rows and many queries have is a column of two dense matrices and their product costs next to nothing
    a pair; any other is joined entry by entry. `DENSE` is where the two cost the same, so neither the number of buckets
    nor the words that all texts have decide the time.
    """

    def __init__(self, rows: Sparse, queries: Sparse):
        self.n = len(rows)
        vocabulary, asked = queries.columns()
        column = np.searchsorted(vocabulary, rows.bucket)
        known = np.flatnonzero(column < len(vocabulary))
        known = known[vocabulary[column[known]] == rows.bucket[known]]
        row, column, weight = rows.row[known], column[known], rows.weight[known]
        held = np.bincount(column, minlength=len(vocabulary))
        pairs = held * np.bincount(asked, minlength=len(vocabulary)).astype(np.float64)
        dense = np.flatnonzero(pairs > DENSE * self.n * len(queries))
        dense = dense[np.argsort(-pairs[dense], kind="stable")][:DENSE_COLUMNS]
        self.place = np.full(len(vocabulary), -1)
        self.place[dense] = np.arange(len(dense))
        # sums of whole numbers below 2^24 are exact in single precision, and by Cauchy-Schwarz no sum is above this
        largest = np.sqrt(rows.norms().max(initial=0.0) * queries.norms().max(initial=0.0))
        whole = (rows.weight == np.rint(rows.weight)).all() and (queries.weight == np.rint(queries.weight)).all()
        self.kind = np.float32 if whole and largest < 2**24 else np.float64
        thick = self.place[column] >= 0
        self.matrix = np.zeros((self.n, len(dense)), dtype=self.kind)
        np.add.at(self.matrix, (row[thick], self.place[column[thick]]), weight[thick].astype(self.kind))
        order = np.argsort(column[~thick], kind="stable")
        self.row, self.weight = row[~thick][order], weight[~thick][order]
        self.count = np.where(self.place < 0, held, 0)
        self.start = np.cumsum(self.count) - self.count

    def dots(self, queries: Sparse) -> np.ndarray:
        """Products of all rows with some of the queries."""
        column = queries.columns()[1]
        at = self.place[column]
        thick = at >= 0
        asked = np.zeros((self.matrix.shape[1], len(queries)), dtype=self.kind)
        np.add.at(asked, (at[thick], queries.row[thick]), queries.weight[thick].astype(self.kind))
        dots = self.matrix @ asked
        flat = dots.reshape(-1)
        thin = np.flatnonzero(self.count[column])
        first, n, query, weight = self.start[column[thin]], self.count[column[thin]], queries.row[thin], queries.weight[thin]
        ends = np.cumsum(n)
        done = 0
        while done < len(n):  # entry by entry, so many products at a time
            upto = max(done + 1, int(np.searchsorted(ends, ends[done] - n[done] + PRODUCTS, side="right")))
            times = n[done:upto]
            entry = np.repeat(first[done:upto] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            cell = self.row[entry] * len(queries) + np.repeat(query[done:upto], times)
            np.add.at(flat, cell, (self.weight[entry] * np.repeat(weight[done:upto], times)).astype(self.kind))
            done = upto
        return dots


def _vectors(vec: pa.Array, dim: int) -> Dense | Sparse:
    return (Sparse if pa.types.is_struct(vec.type) else Dense).of(vec, dim)


def _empty():
    return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)


def _rounded(scores: np.ndarray) -> np.ndarray:
    """To 6 places, halves away from zero as SQL rounds them."""
    return np.copysign(np.floor(np.abs(scores) * 1e6 + 0.5) / 1e6, scores)


def _worst(best, n_queries, k):
    """Score and id of each query's k-th hit so far; below everything while it has fewer."""
    query, ids, score = best
    counts = np.bincount(query, minlength=n_queries)
    at = np.cumsum(counts) - 1
    floor_score, floor_id = np.full(n_queries, -np.inf), np.full(n_queries, np.iinfo(np.int64).max)
    full = counts == k
    floor_score[full], floor_id[full] = score[at[full]], ids[at[full]]
    return floor_score, floor_id


def _score(ids, rows, queries, wanted, best, k, positive_only):
    """Rows that may enter the hits of the `wanted` queries: arrays (query position, id, score).

    One product and one comparison run over all pairs; scores are worked out for the few pairs that
    pass. The comparison is looser than the rounding of scores, so no hit is lost to it.
    """
    floor_score, floor_id = _worst(best, len(queries), k)
    row_norms = rows.norms()
    inverse = np.divide(1.0, np.sqrt(row_norms), out=np.zeros(len(rows)), where=row_norms > 0)[:, None]
    ready = Shared(rows, queries) if isinstance(rows, Sparse) else rows
    parts = [_empty()]
    for start in range(0, len(wanted), QUERY_SLICE):
        part = wanted[start : start + QUERY_SLICE]
        asked = queries[part]
        norms = asked.norms()
        dots = ready.dots(asked)
        inverse = inverse.astype(dots.dtype, copy=False)
        scaled = dots * inverse  # score times length of the query
        fresh = floor_score[part] == -np.inf
        bound = np.where(fresh, 0, floor_score[part]) * np.sqrt(norms)
        if fresh.any():
            bound[fresh] = -np.inf
            if len(rows) > k:
                bound[fresh] = np.partition(scaled[:, fresh], len(rows) - k, axis=0)[len(rows) - k]
        passes = scaled >= (bound - SLACK * np.sqrt(norms)).astype(dots.dtype, copy=False)
        if positive_only:
            passes &= dots > 0
        at_row, at_query = np.nonzero(passes)
        lengths = np.sqrt(row_norms[at_row] * norms[at_query])
        scores = np.divide(dots[at_row, at_query].astype(np.float64), lengths, out=np.zeros(len(lengths)), where=lengths > 0)
        query, row_ids, scores = part[at_query], ids[at_row], _rounded(scores)
        enters = (scores > floor_score[query]) | ((scores == floor_score[query]) & (row_ids < floor_id[query]))
        parts.append((query[enters], row_ids[enters], scores[enters]))
    return tuple(np.concatenate(column) for column in zip(*parts))


def _merge(best, new, k):
    """The k best per query of two candidate sets."""
    query, ids, score = (np.concatenate(pair) for pair in zip(best, new))
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], ids[keep], score[keep]


def _scored(ids, rows, queries, wanted, best, k, positive_only):
    """The hits so far and those of some more rows, which are scored a tile at a time."""
    for start in range(0, len(rows), TILE_ROWS):
        tile = slice(start, start + TILE_ROWS)
        best = _merge(best, _score(ids[tile], rows[tile], queries, wanted, best, k, positive_only), k)
    return best


def _scan(qids, queries, probes, dim, k, positive_only):
    """Task function of the first plan: one pass over the batches, k rows per query at the end."""

    def run(batches):
        best = _empty()
        every = np.arange(len(queries))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column("id").to_numpy()
            rows = _vectors(batch.column("vec"), dim)
            if probes is None:
                groups = [(slice(None), every)] if len(every) else []
            else:
                cells = batch.column("cell").to_numpy()
                groups = [(cells == c, probes[c]) for c in np.unique(cells) if c in probes]
            for at, wanted in groups:
                best = _scored(ids[at], rows[at], queries, wanted, best, k, positive_only)
        query, ids, score = best
        yield pa.RecordBatch.from_arrays([qids.take(pa.array(query)), pa.array(ids), pa.array(score)], ["qid", "id", "score"])

    return run


def _bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _read(packed) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all().combine_chunks()


def _packed(table: pa.Table, names: list[str]):
    """A row per cell of `table`, which holds the cell's own rows as bytes."""
    cells = table["cell"].unique()
    for cell in cells:
        own = table if len(cells) == 1 else table.filter(pc.equal(table["cell"], cell))
        columns = [pa.array([cell.as_py()], cell.type), pa.array([_bytes(own.drop_columns("cell"))], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names)


def _pack_rows(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, ROW_SLICE):
            yield from _packed(pa.Table.from_batches([batch.slice(start, ROW_SLICE)]), ["cell", "rows"])


def _pack_queries(batches):
    """The queries of a task as one block, since all of them are scored in one pass over the rows."""
    batches = [batch for batch in batches if batch.num_rows]
    if batches:
        block = TaskContext.get().partitionId()
        for pack in _packed(pa.Table.from_batches(batches).combine_chunks(), ["cell", "asked"]):
            yield pack.append_column("block", pa.array([block], pa.int32()))


def _score_packs(dim, k, positive_only):
    """Task function of the second plan: the packs of rows of the task against a block of queries, k rows per query at the end."""

    def run(batches):
        held = {}  # of a block and cell: query ids, vectors and hits so far
        for batch in batches:
            keys = zip(batch.column("block").to_pylist(), batch.column("cell").to_pylist())
            for key, asked, packed in zip(keys, batch.column("asked"), batch.column("rows")):
                if key not in held:
                    block = _read(asked.as_py())  # a copy, so that the batch can go
                    held[key] = block["qid"].combine_chunks(), _vectors(block["vec"].combine_chunks(), dim), _empty()
                qids, queries, best = held[key]
                rows = _read(packed.as_buffer())
                ids, vectors = rows["id"].to_numpy(), _vectors(rows["vec"].combine_chunks(), dim)
                held[key] = qids, queries, _scored(ids, vectors, queries, np.arange(len(queries)), best, k, positive_only)
        for qids, _, (query, ids, score) in held.values():
            yield pa.RecordBatch.from_arrays([qids.take(pa.array(query)), pa.array(ids), pa.array(score)], ["qid", "id", "score"])

    return run


def _in_blocks(queries, index, dim, k, positive_only, schema, block_rows, block_values) -> DataFrame:
    """Every block of queries against every pack of rows of its cell.

    A task takes one block, which is all it holds, and reads a part of the index from where it is stored: queries are computed,
    written and shuffled once and rows not at all, however many blocks there are. A task leaves k rows per query, and the more
    blocks there are, the fewer parts of the index keep all cores busy, so what goes to disk grows with the queries alone.
    """
    spark = queries.sparkSession
    path = shared_dir(spark, "asked")
    queries.write.parquet(path)
    queries = spark.read.schema(queries.schema).parquet(path)
    sparse = queries.schema["vec"].dataType.typeName() == "struct"
    n_rows, n_values = queries.agg(F.count("*"), F.sum(F.size("vec.buckets") if sparse else F.lit(dim))).first()
    blocks = max(1, math.ceil(n_rows / block_rows), math.ceil((n_values or 0) / block_values))
    cell = queries.schema["cell"].dataType.simpleString()
    asked = queries.repartition(blocks).mapInArrow(_pack_queries, f"cell {cell}, asked binary, block int")
    cell = index.schema["cell"].dataType.simpleString()
    parts = max(PARTS, math.ceil(WAVES * spark.sparkContext.defaultParallelism / blocks))
    packs = index.coalesce(parts).mapInArrow(_pack_rows, f"cell {cell}, rows binary")
    # of this join a task holds a partition of the right side, a block; the left side streams
    pairs = packs.hint("shuffle_replicate_nl").join(asked, "cell")
    return pairs.mapInArrow(_score_packs(dim, k, positive_only), schema)


def nearest(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    dim: int,
    positive_only: bool = False,
    max_matrix_values: int = MAX_MATRIX_VALUES,
    block_rows: int = BLOCK_ROWS,
    block_values: int = BLOCK_VALUES,
) -> Hits:
    """The k rows of `index(id, vec[, cell])` nearest to each of `queries(qid, vec[, cells])`.

    `vec` is an array of `dim` numbers or a term vector struct. `positive_only` leaves out rows
    without any similarity, so a query may then have fewer than k hits.
    """
    with_cells = "cells" in queries.columns
    queries = queries.filter("vec IS NOT NULL")
    index = index.filter("vec IS NOT NULL").select("id", "vec", *(["cell"] if with_cells else []))
    schema = f"qid {queries.schema['qid'].dataType.simpleString()}, id bigint, score double"

    sparse = queries.schema["vec"].dataType.typeName() == "struct"
    max_queries = MAX_QUERIES if sparse else min(MAX_QUERIES, max(1, max_matrix_values // dim))
    max_queries = min(max_queries, max_matrix_values)
    local = queries.limit(max_queries + 1).toArrow().combine_chunks()
    if local.num_rows > max_queries:
        if with_cells:
            queries = queries.withColumn("cell", F.explode("cells")).drop("cells")
        else:
            queries, index = queries.withColumn("cell", F.lit(0)), index.withColumn("cell", F.lit(0))
        scored = _in_blocks(queries, index, dim, k, positive_only, schema, block_rows, block_values)
        return Hits(topk(scored, k), None)

    qids = local.column("qid").combine_chunks()
    matrix = _vectors(local.column("vec").combine_chunks(), dim) if local.num_rows else Dense(np.zeros((0, dim)))
    probes = None
    if with_cells:
        cells = local.column("cells").combine_chunks()
        owner = np.repeat(np.arange(len(cells)), pc.list_value_length(cells).to_numpy(zero_copy_only=False))
        flat = pc.list_flatten(cells).to_numpy()
        probes = {int(c): owner[flat == c] for c in np.unique(flat)}
        # lets a table that is partitioned by cell skip the cells nobody asks for
        index = index.filter(F.col("cell").isin(list(probes)))
    scored = index.mapInArrow(_scan(qids, matrix, probes, dim, k, positive_only), schema)
    return Hits(topk(scored, k), local.num_rows)
