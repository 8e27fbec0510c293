"""Cells for approximate search: each vector belongs to its nearest centre, a query probes a few."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CellIndex:
    rows: DataFrame  # (id, vec, .., cell), a table partitioned by cell
    centres: np.ndarray


def open_cells(spark: SparkSession, path: str) -> CellIndex:
    centres = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()  # one row per cell
    return CellIndex(spark.read.parquet(f"{path}/rows"), np.array([r.centre for r in centres]))


def build_cells(
    rows: DataFrame,
    n_cells: int,
    path: str,
    seed: int = 7,
    max_iter: int = 10,
    train_fraction: float = 1.0,
    centres: np.ndarray | None = None,
) -> CellIndex:
    """Assign `rows(id, vec, ..)` to cells by k-means under cosine distance and write them by cell.

    `train_fraction` lets the centres be fitted on a part of the vectors; all rows are assigned. With given
    `centres` nothing is fitted: a row goes to the centre of highest cosine, the first of equals.
    """
    if centres is not None:
        placed = probe_cells(rows, centres, 1).withColumn("cell", F.col("cells")[0]).drop("cells")
        return _write_cells(placed, centres, path)
    values = F.col("vec").cast("array<double>")
    # cosine distance has no answer for a zero vector: any cell will do
    first_axis = F.transform(values, lambda _, i: F.when(i == 0, 1.0).otherwise(0.0))
    usable = F.when(F.exists(values, lambda v: v != 0), values).otherwise(first_axis)
    featured = rows.filter("vec IS NOT NULL").withColumn("_features", array_to_vector(usable))
    training = featured.select("_features")
    if train_fraction < 1:
        training = training.sample(train_fraction, seed)
    means = KMeans(
        k=n_cells, seed=seed, maxIter=max_iter, distanceMeasure="cosine", featuresCol="_features", predictionCol="cell"
    )
    model = means.fit(training)
    return _write_cells(model.transform(featured).drop("_features"), np.array(model.clusterCenters()), path)


def _write_cells(placed: DataFrame, centres: np.ndarray, path: str) -> CellIndex:
    placed.hint("rebalance", F.col("cell")).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    spark = placed.sparkSession
    numbered = [(i, [float(v) for v in centre]) for i, centre in enumerate(centres)]
    spark.createDataFrame(numbered, "cell INT, centre ARRAY<DOUBLE>").write.mode("overwrite").parquet(f"{path}/centres")
    return open_cells(spark, path)


def probe_cells(queries: DataFrame, centres: np.ndarray, n_probe: int) -> DataFrame:
    """Add `cells`: the `n_probe` cells whose centres are nearest to the query vector."""
    unit = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)

    @F.arrow_udf("array<int>")
    def probe(vectors: pa.Array) -> pa.Array:
        values = pc.list_flatten(vectors).to_numpy(zero_copy_only=False)
        scores = values.reshape(len(vectors), unit.shape[1]) @ unit.T
        nearest = np.argsort(-scores, axis=1, kind="stable")[:, :n_probe]
        return pa.array(nearest.astype(np.int32).tolist(), pa.list_(pa.int32()))

    return queries.filter("vec IS NOT NULL").withColumn("cells", probe("vec"))
