from groundline.operators.answer import answer_extractive, model_responder
from groundline.operators.embed import hashing_embedder
from groundline.operators.index import apply_changes, build_index
from groundline.session import shared_dir
from groundline.sources.payload import encode_inputs, encode_split
from groundline.streaming.answers import REQUEST_SCHEMA, answer_requests, answer_stream
from groundline.streaming.sync import CHANGE_SCHEMA, sync_stream

from pyspark.sql import functions as F

EMBEDDER = hashing_embedder()


def rows_of(index):
    return sorted((r.id, r.content) for r in index.rows().collect())


def test_triggered_runs_take_new_files_only(spark):
    feed, root, checkpoint = (shared_dir(spark, f"test-{n}") for n in ("feed", "root", "checkpoint"))
    first = spark.createDataFrame([(1, "insert", i, f"t{i}") for i in range(50)], CHANGE_SCHEMA)
    second = spark.createDataFrame(
        [(2, "delete", 1, None), (2, "update", 2, "new"), (2, "insert", 99, "more")], CHANGE_SCHEMA
    )
    first.write.mode("append").parquet(feed)
    assert len(rows_of(sync_stream(spark, feed, root, EMBEDDER, checkpoint))) == 50
    log = spark.read.parquet(f"{root}/versions")
    versions = log.select("version").distinct().count()
    sync_stream(spark, feed, root, EMBEDDER, checkpoint)
    assert spark.read.parquet(f"{root}/versions").select("version").distinct().count() == versions
    second.write.mode("append").parquet(feed)
    streamed = sync_stream(spark, feed, root, EMBEDDER, checkpoint)
    batch = apply_changes(first.union(second), shared_dir(spark, "test-batch"), EMBEDDER)
    assert rows_of(streamed) == rows_of(batch)


def test_answers(spark):
    chunks = spark.createDataFrame([(1, "red apples. they are sweet"), (2, "blue sky")], "id BIGINT, content STRING")
    index = build_index(chunks, shared_dir(spark, "test-index"), EMBEDDER)
    asked = spark.createDataFrame([(7, "are apples red"), (8, "what sky")], "request_id BIGINT, query STRING")
    requests = asked.select("request_id", encode_split(F.col("query")).alias("payload")).union(
        asked.select(F.col("request_id") + 10, encode_inputs(F.col("query")))
    )
    empty = spark.createDataFrame([(9, "not json"), (10, None)], "request_id BIGINT, payload STRING")
    requests = requests.union(requests).union(empty)
    folder, out, checkpoint = (shared_dir(spark, f"test-{n}") for n in ("in", "out", "checkpoint"))
    requests.write.json(folder)
    streamed = answer_stream(spark, folder, index, out, checkpoint)
    expected = {7: "red apples.", 8: "blue sky", 17: "red apples.", 18: "blue sky", 9: None, 10: None}
    assert {r.request_id: r.answer for r in streamed.collect()} == expected
    assert {r.request_id: r.answer for r in answer_requests(requests, index).collect()} == expected
    assert {r.request_id for r in streamed.filter("error IS NOT NULL").collect()} == {9, 10}
    requests.write.mode("append").json(folder)  # all of them once more
    assert answer_stream(spark, folder, index, out, checkpoint, files_per_batch=2).count() == 6


def test_a_request_reaches_the_model_once(spark):
    chunks = spark.createDataFrame([(1, "red apples"), (2, "blue sky")], "id BIGINT, content STRING")
    index = build_index(chunks, shared_dir(spark, "test-index"), EMBEDDER)
    folder, out, checkpoint = (shared_dir(spark, f"test-{n}") for n in ("in", "out", "checkpoint"))
    seen = []

    def respond(retrieved):
        seen.extend(r.query for r in retrieved.collect())
        return answer_extractive(retrieved)

    def deliver(*rows):
        spark.createDataFrame(rows, REQUEST_SCHEMA).coalesce(1).write.mode("append").json(folder)
        return {(r.request_id, r.query, r.answer) for r in answer_stream(spark, folder, index, out, checkpoint, respond=respond, files_per_batch=1).collect()}

    def asks(text):
        return '{"inputs": {"query": ["' + text + '"]}}'

    first = deliver((1, asks("apples")), (2, asks("sky")), (1, asks("apples")), (3, "broken"))
    assert sorted(seen) == ["apples", "sky"] and len(first) == 3
    assert deliver((1, asks("apples")), (2, asks("other words")), (3, "broken")) == first  # in a batch and run of its own
    again = deliver((4, asks("sky")), (1, asks("apples")), (4, asks("blue")))
    assert again - first == {(4, "blue", "blue sky")} and first < again
    assert sorted(seen) == ["apples", "blue", "sky"]
    assert deliver((None, asks("red")), (None, asks("red"))) - again == {(None, "red", "red apples")}


def test_model_in_the_stream(spark):
    chunks = spark.createDataFrame([(1, "red apples"), (2, None)], "id BIGINT, content STRING")
    index = build_index(chunks, shared_dir(spark, "test-index"), EMBEDDER)
    respond = model_responder(lambda params: lambda texts: [t.upper() for t in texts], template="{context}|{question}")
    requests = spark.createDataFrame([(1, '{"inputs": {"query": ["apples"]}}')], "request_id BIGINT, payload STRING")
    assert answer_requests(requests, index, respond=respond).first().answer == "RED APPLES|APPLES"
