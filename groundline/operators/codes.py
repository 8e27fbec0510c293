"""Approximate search by short codes: product quantisation inside cells, then exact scores for a short list.

A unit vector is cut into `parts` pieces, and each piece is replaced by the number of its nearest codeword, so a vector of
64 floats is 16 bytes. A task adds up, for each question, the products of the question's pieces with the codewords that a
code names; the best `shortlist` rows of each question are scored again from their full vectors.
"""

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundline.operators.cells import CellIndex, open_cells, probe_cells
from groundline.operators.nearest import _rounded, topk

PARTS, WORDS = 16, 256  # a code is one byte a part
SAMPLE_ROWS = 1 << 16  # rows that codewords are fitted on; all rows get codes
SHORTLIST = 64
QUESTIONS = 1024  # questions of one scan: their tables of products are 32 MB
BATCH_CODES = 8192  # codes that are scored at once


@dataclass(frozen=True)
class CodeIndex:
    cells: CellIndex
    codes: DataFrame  # (id, code, cell), a table partitioned by cell
    books: np.ndarray  # (part, word, piece of a vector)


def _units(vec: pa.Array, dim: int) -> np.ndarray:
    values = pc.list_flatten(vec).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vec), dim)
    return values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-300)


def encode(units: np.ndarray, books: np.ndarray) -> np.ndarray:
    """The nearest codeword of each piece, the first of equals: (row, part) as bytes."""
    parts, _, width = books.shape
    pieces = units.reshape(len(units), parts, width)
    half = (books**2).sum(axis=2) / 2
    return np.stack([np.argmax(pieces[:, p] @ books[p].T - half[p], axis=1) for p in range(parts)], axis=1).astype(np.uint8)


def fit_books(sample: DataFrame, dim: int, parts: int = PARTS, words: int = WORDS, iterations: int = 8) -> np.ndarray:
    """Codewords of all parts by Lloyd's rounds over `sample(id, vec)`: tasks add up their rows by codeword, Spark adds up the tasks.

    A round brings `parts * words` sums to the driver. The first words are the rows that come first by a hash of the id.
    """
    width = dim // parts
    first = sample.orderBy(F.xxhash64("id"), "id").limit(words).select("vec").toArrow()["vec"].combine_chunks()
    pieces = _units(first, dim).reshape(-1, parts, width)
    books = pieces[np.arange(words) % len(pieces)].transpose(1, 0, 2).copy()

    def sums(books: np.ndarray):
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                units = _units(batch.column(0), dim)
                codes, pieces = encode(units, books), units.reshape(-1, parts, width)
                place = codes.astype(np.int64) + np.arange(parts) * words
                total = np.zeros((parts * words, width))
                np.add.at(total, place.ravel(), pieces.reshape(-1, width))
                n = np.bincount(place.ravel(), minlength=parts * words)
                used = np.flatnonzero(n)
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(total[used].ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[used], pa.int64()), values], ["word", "n", "total"])

        return run

    for _ in range(iterations):
        found = sample.select("vec").mapInArrow(sums(books), "word int, n long, total array<double>")
        added = found.groupBy("word").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")).toArrow()
        at, n = added["word"].to_numpy(), added["n"].to_numpy()
        means = pc.list_flatten(added["total"].combine_chunks()).to_numpy().reshape(-1, width) / n[:, None]
        books.reshape(parts * words, width)[at] = means  # a word without rows stays where it is
    return books


def build_codes(
    cells: CellIndex, path: str, parts: int = PARTS, words: int = WORDS, sample_rows: int = SAMPLE_ROWS, iterations: int = 8, books: np.ndarray | None = None
) -> CodeIndex:
    """Codes of all rows of a cell index, written by cell. Codewords are fitted on about `sample_rows` rows, by a hash of the id, or given.

    The vectors' length is a multiple of `parts`; there are at most 256 words. A zero vector gets the code of any other.
    """
    spark, dim = cells.rows.sparkSession, cells.centres.shape[1]
    if books is None:
        n = cells.rows.count()
        share = int(min(1.0, sample_rows / max(n, 1)) * (1 << 30))
        cells.rows.select("id", "vec").filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) < share).write.mode("overwrite").parquet(f"{path}/sample")
        books = fit_books(spark.read.parquet(f"{path}/sample"), dim, parts, words, iterations)

    @F.arrow_udf("binary")
    def code(vectors: pa.Array) -> pa.Array:
        return pa.array([row.tobytes() for row in encode(_units(vectors, dim), books)], pa.binary())

    coded = cells.rows.select("id", code("vec").alias("code"), "cell")
    coded.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/codes")
    flat = [(p, w, [float(x) for x in books[p, w]]) for p in range(books.shape[0]) for w in range(books.shape[1])]
    spark.createDataFrame(flat, "part INT, word INT, piece ARRAY<DOUBLE>").coalesce(1).write.mode("overwrite").parquet(f"{path}/books")
    return CodeIndex(cells, spark.read.parquet(f"{path}/codes"), books)


def open_codes(spark: SparkSession, cells_path: str, path: str) -> CodeIndex:
    words = spark.read.parquet(f"{path}/books").orderBy("part", "word").collect()  # a row per codeword
    pieces = np.array([w.piece for w in words])
    parts = words[-1].part + 1
    return CodeIndex(open_cells(spark, cells_path), spark.read.parquet(f"{path}/codes"), pieces.reshape(parts, -1, pieces.shape[1]))


def _scan(qids: pa.Array, units: np.ndarray, probes: dict[int, np.ndarray], books: np.ndarray, shortlist: int):
    """Task function: the `shortlist` best codes of each question, one pass over the task's codes."""
    parts, words, width = books.shape
    products = np.einsum("qpw,pcw->qpc", units.reshape(len(units), parts, width), books).reshape(len(units), parts * words)
    shift = np.arange(parts) * words

    def run(batches):
        held_ids = [np.empty(0, dtype=np.int64)] * len(units)
        held_scores, held_cells = [np.empty(0)] * len(units), [np.empty(0, dtype=np.int32)] * len(units)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_CODES):
                part = batch.slice(start, BATCH_CODES)
                ids, cell = part.column("id").to_numpy(), part.column("cell").to_numpy()
                codes = np.frombuffer(b"".join(part.column("code").to_pylist()), dtype=np.uint8).reshape(-1, parts) + shift
                for c in np.unique(cell):
                    rows = np.flatnonzero(cell == c)
                    for q in probes.get(int(c), ()):
                        score = _rounded(products[q][codes[rows]].sum(axis=1))
                        if len(held_scores[q]) == shortlist:  # ties are decided by id
                            near = score >= held_scores[q][-1]
                            at, score = rows[near], score[near]
                        else:
                            at = rows
                        all_ids, all_scores = np.concatenate([held_ids[q], ids[at]]), np.concatenate([held_scores[q], score])
                        all_cells = np.concatenate([held_cells[q], np.full(len(at), c, dtype=np.int32)])
                        best = np.lexsort((all_ids, -all_scores))[:shortlist]
                        held_ids[q], held_scores[q], held_cells[q] = all_ids[best], all_scores[best], all_cells[best]
        owner = np.repeat(np.arange(len(units)), [len(h) for h in held_ids])
        columns = [qids.take(pa.array(owner)), *(pa.array(np.concatenate(x)) if x else pa.array([], t) for x, t in ((held_ids, pa.int64()), (held_cells, pa.int32()), (held_scores, pa.float64())))]
        yield pa.RecordBatch.from_arrays(columns, ["qid", "id", "cell", "score"])

    return run


def search_codes(queries: DataFrame, index: CodeIndex, n_probe: int, columns=(), k: int = 4, shortlist: int = SHORTLIST, questions: int = QUESTIONS) -> DataFrame:
    """`(qid, rank, id, <columns>, score)`: the k rows of highest cosine among the `shortlist` best codes of the probed cells.

    Questions `(qid, vec)` are taken in blocks of `questions`, one scan of the codes each, with the same plan for any number;
    the driver holds one block. A scan reads ids and codes in the folders of the probed cells. Full vectors are read from
    these cells too, for the short lists alone. Missing vectors get no hits; scores are rounded to 6 places, ties by id.
    """
    dim, kind = index.cells.centres.shape[1], queries.schema["qid"].dataType.simpleString()
    probed = probe_cells(queries, index.cells.centres, n_probe).select("qid", "vec", "cells")
    asked = probed.toLocalIterator()
    out = None
    while block := list(islice(asked, questions)):
        local = queries.sparkSession.createDataFrame(block, probed.schema).toArrow()
        units = _units(local["vec"].combine_chunks(), dim)
        cells = local["cells"].combine_chunks()
        owner = np.repeat(np.arange(len(cells)), pc.list_value_length(cells).to_numpy(zero_copy_only=False))
        flat = pc.list_flatten(cells).to_numpy()
        probes = {int(c): owner[flat == c] for c in np.unique(flat)}
        scan = _scan(local["qid"].combine_chunks(), units, probes, index.books, shortlist)
        found = index.codes.filter(F.col("cell").isin(list(probes))).mapInArrow(scan, f"qid {kind}, id long, cell int, score double")
        short = topk(found, shortlist).select("qid", "id", "cell")
        # at most `questions * shortlist` rows: a bound by count, whatever the index holds
        full = index.cells.rows.filter(F.col("cell").isin(list(probes))).select("id", "cell", "vec", *columns)
        asked_vectors = queries.sparkSession.createDataFrame(block, probed.schema).select("qid", F.col("vec").alias("asked"))
        near = full.join(F.broadcast(short), ["id", "cell"]).join(F.broadcast(asked_vectors), "qid")
        ranked = topk(near.select("qid", "id", *columns, _cosine(F.col("asked"), F.col("vec")).alias("score")), k)
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        empty = index.cells.rows.limit(0).select(F.lit(None).cast(kind).alias("qid"), "id", *columns, F.lit(0.0).alias("score"))
        out = topk(empty, k)
    return out.select("qid", "rank", "id", *columns, "score")


def _cosine(a, b):
    """Cosine of two arrays, to 6 places; 0 for a zero vector."""

    def dot(x, y):
        products = F.zip_with(x, y, lambda i, j: i.cast("double") * j.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)

    norms = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norms > 0, F.round(dot(a, b) / norms, 6)).otherwise(F.lit(0.0))
