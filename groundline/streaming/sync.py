"""Triggered index sync: take the change files that are new, apply them, stop."""

from pyspark.sql import SparkSession

from groundline.operators.embed import Embedder
from groundline.operators.index import VectorIndex, apply_changes

CHANGE_SCHEMA = "seq BIGINT, op STRING, id BIGINT, content STRING"


def sync_stream(
    spark: SparkSession, changes_dir: str, root: str, embedder: Embedder, checkpoint: str, files_per_batch: int = 1000
) -> VectorIndex:
    """One triggered run over parquet change files. A batch that is replayed changes nothing."""

    def upsert(batch, batch_id):
        apply_changes(batch, root, embedder, batch_id)

    changes = spark.readStream.schema(CHANGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(changes_dir)
    query = (
        changes.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return VectorIndex(spark, root, embedder)
