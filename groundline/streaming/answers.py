"""Requests in, answers out: the endpoint's work as a triggered stream."""

from collections.abc import Iterator

import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from groundline.operators.answer import answer_extractive
from groundline.operators.index import VectorIndex
from groundline.operators.search import RESULTS, retrieve
from groundline.sources.payload import payload_values

REQUEST_SCHEMA = "request_id BIGINT, payload STRING"


NO_QUESTION = "no question in the payload"


def answer_requests(requests: DataFrame, index: VectorIndex, k: int = RESULTS, respond=answer_extractive) -> DataFrame:
    """`(request_id, pos, query, answer, error)` for the questions in `(request_id, payload)` rows.

    A request that holds no question keeps one row, without an answer and with an error; so does a question that is
    missing. A request that is delivered again is answered once; of different payloads under one id the first in text
    order counts.
    """
    once = requests.groupBy("request_id").agg(F.min("payload").alias("payload"))
    asked = once.select("request_id", F.posexplode_outer(payload_values(F.col("payload"))).alias("pos", "query"))
    asked = asked.withColumn("qid", F.struct("request_id", "pos"))
    answers = respond(retrieve(asked.filter("query IS NOT NULL").select("qid", "query"), index, k))
    error = F.when(F.col("query").isNull(), F.lit(NO_QUESTION))
    return asked.join(answers, "qid", "left").select("request_id", "pos", "query", "answer", error.alias("error"))


def first_requests(requests: DataFrame) -> DataFrame:
    """The requests of a stream that have not come before, by keyed state; of different payloads in one batch the first in text order.

    State is an id per request, kept in the checkpoint as long as the stream: a timeout would keep a triggered run from
    ending. A missing id is one id.
    """

    def first(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        payloads = [payload for part in parts for payload in part["payload"] if payload is not None]
        if state.exists:
            return
        state.update((True,))
        yield pd.DataFrame({"request_id": pd.array([key[0]], dtype="Int64"), "payload": [min(payloads, default=None)]})

    keyed = requests.groupBy("request_id")
    return keyed.applyInPandasWithState(first, REQUEST_SCHEMA, "seen BOOLEAN", "append", GroupStateTimeout.NoTimeout)


def answer_stream(
    spark: SparkSession,
    requests_dir: str,
    index: VectorIndex,
    out_dir: str,
    checkpoint: str,
    k: int = RESULTS,
    respond=answer_extractive,
    files_per_batch: int = 1000,
) -> DataFrame:
    """One triggered run over JSON-lines request files; the answers so far are returned.

    Each batch takes up to `files_per_batch` files, writes a folder of its own and overwrites it if it is replayed. A
    request is answered once, in whatever batches and runs it comes (`first_requests`): the model does not see it again.
    """

    def write(batch, batch_id):
        batch.persist()  # the plan reads it twice; the stream's state is taken once
        try:
            answers = answer_requests(batch, index, k, respond)
            answers.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")
        finally:
            batch.unpersist()

    requests = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(requests_dir)
    query = (
        first_requests(requests)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(out_dir).drop("batch")
