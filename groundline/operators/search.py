"""Similarity search by text or vector, and retrieval of chunk texts for many questions at once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundline.operators.cells import CellIndex, probe_cells
from groundline.operators.embed import embed_queries
from groundline.operators.index import VectorIndex
from groundline.operators.nearest import Hits, nearest

RESULTS = 4


def distinct_questions(questions: DataFrame) -> DataFrame:
    """`(qid, query)` with every qid once; of different questions under one qid the first in text order counts."""
    return questions.groupBy("qid").agg(F.min("query").alias("query"))


def attach(hits: Hits, rows: DataFrame, columns) -> DataFrame:
    """Fetch `columns` of the hit rows: `(qid, rank, id, <columns>, score)`.

    Scoring reads ids and vectors only; the wide columns are read here, for hits alone. Hits are
    broadcast when the number of queries, and so their number, was checked to be small.
    """
    found = hits.rows if hits.n_queries is None else F.broadcast(hits.rows)
    return rows.select("id", *columns).join(found, "id").select("qid", "rank", "id", *columns, "score")


def search_vector(queries: DataFrame, rows: DataFrame, dim: int, columns=(), k: int = RESULTS) -> DataFrame:
    """Exact search by vector: `queries(qid, vec)` against `rows(id, vec, <columns>)`."""
    hits = nearest(queries, rows, k, dim)
    if not columns:
        return hits.rows.select("qid", "rank", "id", "score")
    return attach(hits, rows, columns)


def search_text(queries: DataFrame, index: VectorIndex, columns=("content",), k: int = RESULTS) -> DataFrame:
    """Search by question text: `queries(qid, query)` are embedded by the index's own embedder."""
    rows = index.rows()
    hits = nearest(embed_queries(distinct_questions(queries), index.embedder), rows, k, index.embedder.dim, positive_only=True)
    return attach(hits, rows, columns)


def search_approx(
    queries: DataFrame, cells: CellIndex, n_probe: int, columns=(), k: int = RESULTS
) -> DataFrame:
    """Search by vector in the `n_probe` nearest cells of each query; exact when all are probed."""
    probed = probe_cells(queries, cells.centres, n_probe)
    hits = nearest(probed, cells.rows, k, cells.centres.shape[1])
    if not columns:
        return hits.rows.select("qid", "rank", "id", "score")
    return attach(hits, cells.rows, columns)


def retrieve(questions: DataFrame, index: VectorIndex, k: int = RESULTS) -> DataFrame:
    """`(qid, query, contents)`: the texts of the k nearest chunks in rank order, maybe none. A repeated qid gives one row."""
    questions = distinct_questions(questions)
    found = (
        search_text(questions, index, ("content",), k)
        .groupBy("qid")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "content"))).alias("hits"))  # at most k per group
        .select("qid", F.col("hits.content").alias("contents"))
    )
    contents = F.coalesce("contents", F.array().cast("array<string>")).alias("contents")
    return questions.join(found, "qid", "left").select("qid", "query", contents)
