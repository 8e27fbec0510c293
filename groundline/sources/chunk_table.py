"""The chunk table: one batch write, ids computed in parallel."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNKS_PER_DOCUMENT = 1_000_000
MAX_DOCUMENT = (1 << 63) // CHUNKS_PER_DOCUMENT - 1


def chunk_id(doc_id: Column, chunk_no: Column) -> Column:
    """`doc_id * 1000000 + chunk_no`: unique, in insertion order, and needs no coordination.

    Where that does not fit (a document id that is negative or above 9.2e12, such as a hash, or more than a million
    chunks) the id is a negative 63-bit hash of both. Those never meet the others; `write_chunks` counts whether they
    meet each other.
    """
    doc = doc_id.cast("long")
    fits = doc.between(0, MAX_DOCUMENT) & (chunk_no < CHUNKS_PER_DOCUMENT)
    plain = F.when(fits, doc).otherwise(F.lit(0)) * F.lit(CHUNKS_PER_DOCUMENT).cast("long") + F.when(fits, chunk_no).otherwise(F.lit(0))
    hashed = F.xxhash64(doc, chunk_no.cast("long")).bitwiseOR(F.lit(-(1 << 63)))
    return F.when(fits, plain).otherwise(hashed)


def with_chunk_id(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        chunk_id(F.col("doc_id"), F.col("chunk_no")).alias("id"),
        *chunks.columns,
        F.md5("content").alias("content_md5"),
    )


def write_chunks(
    chunks: DataFrame, table: str, now: datetime | None = None, path: str | None = None, zone: str = "UTC+9"
) -> None:
    """Create or replace the chunk table from `(doc_id, chunk_no, content, headers)`.

    `created_at` is the wall time in `zone` of the instant `now` (naive values are UTC); give `now`
    to make a run repeatable. Raises if two hashed ids are equal.
    """
    instant = F.current_timestamp() if now is None else F.lit(now.isoformat(" ")).cast("timestamp")
    writer = (
        with_chunk_id(chunks)
        .withColumn("created_at", F.from_utc_timestamp(instant, zone))
        .write.mode("overwrite")
        .format("parquet")
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    hashed = chunks.sparkSession.table(table).filter("id < 0")
    n, distinct = hashed.agg(F.count("id"), F.count_distinct("id")).first()
    if n != distinct:
        raise ValueError(f"{n - distinct} hashed chunk ids of {table} are not unique")


def read_chunks(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).orderBy("id")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)
