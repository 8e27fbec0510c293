"""Embedding a text column. The built-in embedder is a set of column expressions; models plug in."""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundline.functions.tokens import N_BUCKETS, term_vector


@dataclass(frozen=True)
class Embedder:
    """How to turn a text column into a vector column; `embedder_id` is stored with an index."""

    embedder_id: str
    dim: int
    vector: Callable[[Column], Column]


def hashing_embedder(n_buckets: int = N_BUCKETS) -> Embedder:
    """Feature hashing of tokens into integer term counts, in the JVM."""
    return Embedder(f"hash-md5-{n_buckets}", n_buckets, lambda text: term_vector(text, n_buckets))


def model_embedder(embedder_id: str, dim: int, load: Callable[[], Callable[[list], list]]) -> Embedder:
    """Wrap a model: `load()` runs once per task and returns a function from texts to vectors. Missing texts have none."""

    def vector(text: Column) -> Column:
        @F.arrow_udf("array<float>")
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                texts = [text for text in batch.to_pylist() if text is not None]
                vectors = iter(model(texts) if texts else [])
                known = [list(next(vectors)) if there else None for there in batch.is_valid().to_pylist()]
                yield pa.array(known, pa.list_(pa.float32()))

        return score(text)

    return Embedder(embedder_id, dim, vector)


def embed(df: DataFrame, col: str, embedder: Embedder, out_col: str = "vec") -> DataFrame:
    return df.withColumn(out_col, embedder.vector(F.col(col)))


def embed_queries(queries: DataFrame, embedder: Embedder) -> DataFrame:
    """Questions `(qid, query)` as `(qid, vec)`, by the same embedder as the index."""
    return embed(queries, "query", embedder).select("qid", "vec")


def from_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Vectors that exist already, as the `(id, vec)` that search takes."""
    return df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))


def term_rows(embedded: DataFrame, id_col: str) -> DataFrame:
    """Long form of term vectors: `(id, bucket, weight)`."""
    terms = F.arrays_zip("vec.buckets", "vec.weights")
    return embedded.select(id_col, F.explode(terms).alias("term")).select(
        id_col, F.col("term.buckets").alias("bucket"), F.col("term.weights").cast("long").alias("weight")
    )
