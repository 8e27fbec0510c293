"""Text search over inverted lists: a question reads the lists of its own buckets, and of those only blocks that can matter.

Layout: `part=<bucket mod parts>/` holds a row per bucket and segment of rows (a hash of the id): the list of ids with their
weights and squared lengths, the largest impact in it (weight over length) and the id that has it. Segments are bounded, so a
bucket that every row has is many blocks, and all blocks of a row lie in one segment.

Search is exact and follows MaxScore. What a question can gain from a list is bounded by its weight there times the largest
impact. From the bounds alone, without any list:

* the ids that hold the largest impacts have at least the sum of those, so the k-th of these sums is a floor for the k-th hit;
* a segment whose bounds sum up to less than the floor holds no hit, and none of its blocks is read.

Inside a segment lists are taken by falling bound. Once the bounds of those that are left sum up to less than the floor, they
bring no new candidates and are looked up for the candidates alone, of which each leaves when it cannot reach the floor.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundline.functions.tokens import squared_norm
from groundline.operators.embed import embed_queries
from groundline.operators.index import VectorIndex
from groundline.operators.nearest import SLACK, _rounded, topk

BLOCKS = (
    "bucket INT, segment INT, max_impact DOUBLE, top_id BIGINT, ids ARRAY<BIGINT>, weights ARRAY<INT>, squares ARRAY<BIGINT>, part INT"
)
PARTS = 64
SEGMENT_ROWS = 1 << 14
GROUP_TERMS = 1 << 20  # terms of questions that meet a segment at once
BUILD_ENTRIES = 1 << 21  # entries of a segment that are sorted at once
_LISTS = {"ids": pa.int64(), "weights": pa.int32(), "squares": pa.int64()}
BLOCK_SCHEMA = pa.schema(
    [("part", pa.int32()), ("bucket", pa.int32()), ("segment", pa.int32()), ("max_impact", pa.float64()), ("top_id", pa.int64())]
    + [(name, pa.list_(kind)) for name, kind in _LISTS.items()]
)


@dataclass(frozen=True)
class Postings:
    spark: SparkSession
    path: str
    parts: int

    def blocks(self) -> DataFrame:
        """`(bucket, segment, max_impact, top_id, ids, weights, squares, part)`"""
        return self.spark.read.schema(BLOCKS).parquet(f"{self.path}/blocks")


def open_postings(spark: SparkSession, path: str) -> Postings:
    return Postings(spark, path, spark.read.parquet(f"{path}/layout").first().parts)


def _lists(ids: np.ndarray, bucket: np.ndarray, weight: np.ndarray, square: np.ndarray) -> dict:
    """The lists of some buckets from their entries, each list in id order."""
    order = np.lexsort((square, weight, ids, bucket))
    bucket, ids, weight, square = bucket[order], ids[order], weight[order], square[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1))
    sizes = np.diff(starts, append=len(bucket))
    impact = weight / np.sqrt(square)
    largest = np.maximum.reduceat(impact, starts)
    holds = impact == np.repeat(largest, sizes)
    ends = pa.array(np.append(starts, len(bucket)), pa.int32())
    values = {"ids": ids, "weights": weight, "squares": square}
    return {
        "bucket": bucket[starts],
        "max_impact": largest,
        "top_id": np.minimum.reduceat(np.where(holds, ids, np.iinfo(np.int64).max), starts),
        **{name: pa.ListArray.from_arrays(ends, pa.array(column)) for name, column in values.items()},
    }


def _segment_blocks(parts: int):
    """Group function: the blocks of a segment from its `(segment, id, vec)`, by so many entries at a time."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        buckets, weights = rows["vec"].combine_chunks().flatten()
        sizes = pc.list_value_length(buckets).to_numpy(zero_copy_only=False)
        bucket = pc.list_flatten(buckets).to_numpy(zero_copy_only=False).astype(np.int32)
        weight = pc.list_flatten(weights).to_numpy(zero_copy_only=False).astype(np.int32)
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        square = np.bincount(row, weights=weight.astype(np.float64) ** 2, minlength=len(sizes)).astype(np.int64)
        ids = rows["id"].to_numpy()
        pieces = math.ceil(len(bucket) / BUILD_ENTRIES)
        tables = [pa.table([pa.array([], field.type) for field in BLOCK_SCHEMA], schema=BLOCK_SCHEMA)]
        for piece in range(pieces):
            at = np.flatnonzero(bucket % pieces == piece)
            if len(at):
                made = _lists(ids[row[at]], bucket[at], weight[at], square[row[at]])
                n = len(made["bucket"])
                made |= {"part": made["bucket"] % parts, "segment": np.full(n, key[0].as_py())}
                tables.append(pa.table({f.name: pa.array(made[f.name]).cast(f.type) for f in BLOCK_SCHEMA}, schema=BLOCK_SCHEMA))
        return pa.concat_tables(tables)

    return run


def build_postings(rows: DataFrame, path: str, parts: int = PARTS, segment_rows: int = SEGMENT_ROWS) -> Postings:
    """Write the lists of `rows(id, vec)`, term vectors of unique ids. Rows without a vector or without terms are in none.

    Rows are shuffled whole, by segment, and a task turns the rows of one segment at a time into its blocks: entries are
    neither shuffled nor aggregated one by one, and a bucket of very many rows is no skew.
    """
    spark = rows.sparkSession
    rows = rows.filter("vec IS NOT NULL").select("id", "vec")
    segments = max(1, math.ceil(rows.count() / segment_rows))
    segment = F.pmod(F.xxhash64("id"), F.lit(segments)).cast("int").alias("segment")
    schema = "part INT, bucket INT, segment INT, max_impact DOUBLE, top_id BIGINT, ids ARRAY<BIGINT>, weights ARRAY<INT>, squares ARRAY<BIGINT>"
    blocks = rows.select(segment, "id", "vec").groupBy("segment").applyInArrow(_segment_blocks(parts), schema)
    blocks = blocks.hint("rebalance", "part").sortWithinPartitions("part", "bucket", "segment")
    blocks.write.mode("overwrite").partitionBy("part").parquet(f"{path}/blocks")
    spark.createDataFrame([(parts, segments)], "parts INT, segments INT").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    return Postings(spark, path, parts)


def _score_segment(k: int, schema: pa.Schema):
    """Group function: the questions that may have hits in a segment against the segment's blocks."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        asked, found, scores = [], [], []
        if left.num_rows and right.num_rows:
            ids, weights, squares = (pc.list_flatten(right[c].combine_chunks()).to_numpy() for c in ("ids", "weights", "squares"))
            sizes = pc.list_value_length(right["ids"].combine_chunks()).to_numpy()
            ends = np.cumsum(sizes)
            docs, place = np.unique(ids, return_inverse=True)
            square = np.zeros(len(docs), dtype=np.int64)
            square[place] = squares
            length = np.sqrt(square)
            maxima = right["max_impact"].to_numpy()
            block_of = {b: i for i, b in enumerate(right["bucket"].to_pylist())}
            questions = zip(*(left[c].to_pylist() for c in ("buckets", "weights", "square", "floor")))
            for number, (buckets, own, q_square, floor) in enumerate(questions):
                lists = [(maxima[block_of[b]] * w, block_of[b], w) for b, w in zip(buckets, own) if b in block_of]
                lists.sort(reverse=True)
                rest = np.cumsum([bound for bound, _, _ in reversed(lists)])[::-1]  # of this list and all after it
                dots = np.zeros(len(docs), dtype=np.int64)
                chosen = None  # candidates, once no others can come
                for (_, block, w), left_over in zip(lists, rest):
                    at = place[ends[block] - sizes[block] : ends[block]]
                    gain = weights[ends[block] - sizes[block] : ends[block]].astype(np.int64) * w
                    if left_over < floor:
                        held = np.flatnonzero(dots) if chosen is None else np.flatnonzero(chosen)
                        held = held[dots[held] / length[held] + left_over >= floor]
                        chosen = np.zeros(len(docs), dtype=bool)
                        chosen[held] = True
                        if not len(held):
                            break
                        kept = chosen[at]
                        at, gain = at[kept], gain[kept]
                    dots[at] += gain  # an id is once in a block
                at = np.flatnonzero(dots if chosen is None else chosen)
                score = _rounded(dots[at] / np.sqrt(float(q_square) * square[at]))
                best = np.lexsort((docs[at], -score))[:k]
                asked.append(np.full(len(best), number))
                found.append(docs[at][best])
                scores.append(score[best])
        number = np.concatenate(asked) if asked else np.empty(0, dtype=np.int64)
        qids = left["qid"].combine_chunks().take(pa.array(number)).cast(schema.field("qid").type) if left.num_rows else pa.array([], schema.field("qid").type)
        values = [qids, pa.array(np.concatenate(found) if found else [], pa.int64()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
        return pa.Table.from_arrays(values, schema=schema)

    return run


def _asked(questions: DataFrame, postings: Postings) -> tuple[int, list[int]]:
    """How many terms the questions have, and the folders of their buckets: as many numbers as there are parts at most."""
    buckets = questions.filter("vec IS NOT NULL").select(F.explode("vec.buckets").alias("bucket"))
    part = F.pmod("bucket", F.lit(postings.parts))
    return tuple(buckets.agg(F.count("*"), F.collect_set(part)).first())


def live_segments(questions: DataFrame, postings: Postings, k: int, parts: list[int] | None = None) -> DataFrame:
    """`(qid, buckets, weights, square, floor, segment)`: the segments that each of `questions(qid, vec)` has to look into.

    Only the headers of blocks are read, in the folders of the questions' own buckets.
    """
    asked = questions.filter("vec IS NOT NULL").select(
        "qid", F.col("vec.buckets").alias("buckets"), F.col("vec.weights").alias("weights"), squared_norm(F.col("vec")).alias("square")
    )
    terms = asked.select("qid", "square", F.explode(F.arrays_zip("buckets", "weights")).alias("term")).select(
        "qid", "square", F.col("term.buckets").alias("bucket"), F.col("term.weights").alias("weight")
    )
    parts = _asked(questions, postings)[1] if parts is None else parts
    headers = postings.blocks().filter(F.col("part").isin(parts)).select("bucket", "segment", "max_impact", "top_id")
    bounds = terms.join(headers, "bucket").select("qid", "square", "segment", "top_id", (F.col("weight") * F.col("max_impact")).alias("bound"))
    least = topk(bounds.groupBy("qid", F.col("top_id").alias("id")).agg(F.sum("bound").alias("score")), k).filter(F.col("rank") == k)
    # a little lower: sums of doubles are not exact and scores are compared after rounding
    least = least.select("qid", (F.col("score") * (1 - 1e-9)).alias("least"))
    reach = bounds.groupBy("qid", "segment").agg(F.sum("bound").alias("reach"))
    floor = F.coalesce("least", F.lit(0.0)) - SLACK * F.sqrt("square")
    return (
        asked.join(reach, "qid")
        .join(least, "qid", "left")
        .withColumn("floor", floor)
        .filter("reach >= floor")
        .select("qid", "buckets", "weights", "square", "floor", "segment")
    )


def nearest_by_terms(questions: DataFrame, postings: Postings, k: int, group_terms: int = GROUP_TERMS) -> DataFrame:
    """`(qid, id, score, rank)`: the k rows of highest cosine for each of `questions(qid, vec)`, ties by id, similar ones only.

    Equal to `nearest` over the same rows. Blocks of live segments are read once for a group of questions and shuffled
    by segment; neither questions nor lists pass through the driver.
    """
    n_terms, parts = _asked(questions, postings)
    live = live_segments(questions, postings, k, parts)
    keys = live.select("segment", F.explode("buckets").alias("bucket")).distinct()
    blocks = postings.blocks().filter(F.col("part").isin(parts)).select("bucket", "segment", "max_impact", "ids", "weights", "squares")
    blocks = blocks.join(keys, ["segment", "bucket"], "left_semi")
    groups = max(1, math.ceil(n_terms / group_terms))
    live = live.withColumn("part_of", F.pmod(F.xxhash64("qid"), F.lit(groups)).cast("int"))
    blocks = blocks.withColumn("part_of", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))) if groups > 1 else F.lit(0))
    kind = questions.schema["qid"].dataType
    result = f"qid {kind.simpleString()}, id bigint, score double"
    schema = pa.schema([("qid", _arrow_type(questions)), ("id", pa.int64()), ("score", pa.float64())])
    keyed = "segment", "part_of"
    scored = live.groupBy(*keyed).cogroup(blocks.groupBy(*keyed)).applyInArrow(_score_segment(k, schema), result)
    return topk(scored, k)


def _arrow_type(questions: DataFrame) -> pa.DataType:
    return questions.select("qid").limit(0).toArrow().schema.field("qid").type


def search_text_postings(queries: DataFrame, index: VectorIndex, postings: Postings, columns=("content",), k: int = 4) -> DataFrame:
    """`search_text` by inverted lists: `queries(qid, query)` against the postings of `index`; `(qid, rank, id, <columns>, score)`."""
    questions = queries.groupBy("qid").agg(F.min("query").alias("query"))
    hits = nearest_by_terms(embed_queries(questions, index.embedder), postings, k)
    if not columns:
        return hits.select("qid", "rank", "id", "score")
    return index.rows().select("id", *columns).join(hits, "id").select("qid", "rank", "id", *columns, "score")
