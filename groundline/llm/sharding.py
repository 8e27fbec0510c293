"""Shards of near equal bytes from groups that must stay whole, by Karmarkar-Karp differencing."""

import heapq

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundline.llm.common import stored, whole

ROW_BYTES = 16  # counted for a row besides its text


def difference(sizes, shards: int) -> np.ndarray:
    """The shard of each piece: Karmarkar-Karp for `shards` subsets.

    Every piece starts as a partial partition of its own. The two partial partitions of largest spread
    are combined again and again, the largest subsets of one with the smallest of the other. A node keeps
    its subsets in descending order, so that combining is one addition of a reversed row.
    """
    sizes = np.asarray(sizes, dtype=np.float64)
    n = len(sizes)
    sums = {}
    heap = []
    for i, size in enumerate(sizes):
        row = np.zeros(shards)
        row[0] = size
        sums[i] = row
        heap.append((-size, i))
    heapq.heapify(heap)
    joined = {}  # node -> (left, right, order of the combined subsets)
    node = n
    while len(heap) > 1:
        (_, left), (_, right) = heapq.heappop(heap), heapq.heappop(heap)
        row = sums.pop(left) + sums.pop(right)[::-1]
        order = np.argsort(-row, kind="stable")
        row = row[order] - row[order[-1]]  # only differences count from here on
        joined[node], sums[node] = (left, right, order), row
        heapq.heappush(heap, (-row[0], node))
        node += 1
    placed = np.zeros(n, dtype=np.int64)
    labels = {node - 1: np.arange(shards)} if n else {}
    for parent in range(node - 1, n - 1, -1):
        left, right, order = joined[parent]
        own = labels.pop(parent)
        labels[left], labels[right] = np.empty_like(own), np.empty_like(own)
        labels[left][order] = own
        labels[right][shards - 1 - order] = own
    for leaf, own in labels.items():
        placed[leaf] = own[0]
    return placed


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    bundles_per_shard: int = 200,
    rows_per_run: int = 10_000,
) -> DataFrame:
    """`(doc_id, size, text_crc32, shard, slot)`: equal texts share a shard, shard sizes are as near as that allows.

    Groups are summed before anything is decided. A group above the total divided by `shards * bundles_per_shard`
    is a piece of its own; there are fewer such groups than that divisor, whatever the input. The small groups are
    dealt by hash into that many bundles, each a piece. So at most twice that many pieces (16,000 by default) are
    differenced, in one task, at any input size. Slots come from counts per (shard, run of rows) and a row number
    inside the run, so no task holds a shard.

    A missing text counts as an empty one; repeated rows are rows of their own with neighbouring slots; a missing
    id is ordered first. No rows give no rows.
    """
    text = F.col(text_column)
    rows = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(whole(text)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(whole(text).cast("binary")).alias("text_crc32"),
            F.md5(whole(text).cast("binary")).alias("key"),
        ),
        "shard-rows",
    )
    n_bundles = shards * bundles_per_shard
    totals = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    limit = (totals["bytes"] or 0) / n_bundles
    n_runs = max(1, -(-totals["rows"] // rows_per_run))
    bundle = F.pmod(F.xxhash64("key"), F.lit(n_bundles)).cast("string")
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    pieces = (
        groups.withColumn("piece", F.when(F.col("bytes") > limit, F.col("key")).otherwise(bundle))
        .groupBy("piece")
        .agg(F.sum("bytes").alias("bytes"))
    )

    def place(pieces: pd.DataFrame) -> pd.DataFrame:
        ordered = pieces.sort_values(["bytes", "piece"], ascending=[False, True])
        return pd.DataFrame({"piece": ordered["piece"], "shard": difference(ordered["bytes"], shards)})

    placed = stored(pieces.groupBy().applyInPandas(place, "piece string, shard int"), "shard-pieces")
    large = placed.filter(F.length("piece") == 32)
    small = placed.filter(F.length("piece") < 32)
    dealt = (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(large.select(F.col("piece").alias("key"), F.col("shard").alias("own"))), "key", "left")
        .join(F.broadcast(small.select(F.col("piece").alias("bundle"), "shard")), "bundle", "left")
        .withColumn("shard", F.coalesce("own", "shard"))
        .withColumn("run", F.pmod(F.xxhash64("doc_id", "key"), F.lit(n_runs)))
        .select("doc_id", "size", "text_crc32", "key", "shard", "run")
    )
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "run")
        .count()
        .select("shard", "run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "run").orderBy("doc_id", "key")
    numbered = dealt.withColumn("n", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "run"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("n") + F.col("offset")).cast("long").alias("slot")
    )
