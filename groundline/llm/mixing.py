"""A mix of sources to target weights: Sainte-Laguë quotas of equal blocks of words, then seeded blocks."""

import hashlib
import math

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundline.llm.common import WORD, let, stored, whole

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
TIMES = 2  # at most so often a source's words
BLOCK = 64  # words
FEWEST = 64  # blocks of a small source at least, or as many as it has words
SHARDS = 8
SEED = "mix-1"
STRIDE = 1 << 20  # largest step between chosen blocks: products stay within 63 bits up to 8e12 blocks a source

PLAN = (
    "source string, source_size long, target double, blocks long, quota long, shard_quotas array<long>, shard_ends array<long>, "
    "passes long, rest long, step long, offset long, width long, wider long"
)


def targets(sizes: np.ndarray, weights: np.ndarray, share: float = SHARE, times: float = TIMES) -> np.ndarray:
    """Words for each source by weight; what lies above `times` a source's size is reshared among the others."""
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), share * sizes.sum()
    while free.any():
        out[free] = left * weights[free] / weights[free].sum()
        above = free & (out > times * sizes)
        if not above.any():
            break
        out[above] = times * sizes[above]
        left -= out[above].sum()
        free &= ~above
    return out


def apportion(wanted: np.ndarray, limits: np.ndarray, n: int) -> np.ndarray:
    """Sainte-Laguë: `n` blocks one by one to the highest quotient `wanted / (2 * got + 1)`, never above a limit.

    The quotient that the last block reaches is bracketed first, so that the cost does not grow with `n`.
    Equal quotients go to the earlier source.
    """

    def quotas(quotient):
        return np.minimum(limits, np.floor(wanted / (2 * quotient) + 0.5)).astype(np.int64)

    got = np.zeros(len(wanted), dtype=np.int64)
    n = min(n, int(limits.sum()))
    if n <= 0:
        return got
    low, high = 1e-9, 2 * wanted.max() + 1  # too many blocks below, none above
    for _ in range(200):
        middle = math.sqrt(low * high)
        low, high = (middle, high) if quotas(middle).sum() > n else (low, middle)
    got = quotas(high)
    while got.sum() < n:
        quotient = np.where(got < limits, wanted / (2 * got + 1), -1)
        got[int(np.argmax(quotient))] += 1
    return got


def step_and_offset(source, blocks: int, seed: str) -> tuple[int, int]:
    """Block k stands at place (step * k + offset) mod blocks; a step that shares no factor with `blocks` makes that a permutation."""
    digest = hashlib.md5(f"{seed}:{'' if source is None else source}".encode()).hexdigest()
    step = 1 + int(digest[:8], 16) % min(blocks, STRIDE)
    while math.gcd(step, blocks) != 1:
        step += 1
    return step, int(digest[8:16], 16) % blocks


def plan_sources(
    totals: DataFrame, shards: int = SHARDS, block: int = BLOCK, share: float = SHARE, times: int = TIMES, seed: str = SEED
) -> DataFrame:
    """`totals(source, source_size)` with targets, quotas (whole and per shard) and the seeded choice of blocks.

    One row per source is decided in one task; nothing else passes through it.
    """

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        names = [None if pd.isna(name) else name for name in rows["source"]]
        order = sorted(range(len(names)), key=lambda i: (names[i] is None, names[i] or ""))
        names, sizes = [names[i] for i in order], rows["source_size"].to_numpy()[order]
        weights = np.resize(np.array(WEIGHTS, dtype=np.float64), len(names))
        wanted = targets(sizes, weights, share, times)
        blocks = np.maximum(np.round(sizes / block), np.minimum(sizes, FEWEST)).astype(np.int64)
        wide = sizes / np.maximum(blocks, 1)  # a source's own blocks: a small one has narrow ones, so that its quota meets its target
        wanted_blocks = np.where(blocks > 0, wanted / np.maximum(wide, 1e-9), 0)
        n = round(wanted_blocks.sum())
        upto = [apportion(wanted_blocks, times * blocks, n * (j + 1) // shards) for j in range(shards)]
        parts = np.diff(np.array([np.zeros_like(upto[0]), *upto]), axis=0)
        quota = upto[-1]
        some = np.maximum(blocks, 1)
        chosen = [step_and_offset(name, int(m), seed) for name, m in zip(names, some)]
        return pd.DataFrame(
            {
                "source": names,
                "source_size": sizes,
                "target": wanted,
                "blocks": blocks,
                "quota": quota,
                "shard_quotas": [list(map(int, parts[:, i])) for i in range(len(names))],
                "shard_ends": [[int(u[i]) for u in upto] for i in range(len(names))],  # blocks of a shard and those before it
                "passes": quota // some,
                "rest": quota % some,
                "step": [c[0] for c in chosen],
                "offset": [c[1] for c in chosen],
                "width": sizes // some,  # words of a block; the first `wider` ones have one more
                "wider": sizes % some,
            }
        )

    return totals.groupBy().applyInPandas(plan, PLAN)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, F.greatest(b, F.lit(1)))


def mix(
    docs: DataFrame, rows_per_run: int = 5000, block: int = BLOCK, seed: str = SEED, dealt: bool = False, **options
) -> DataFrame:
    """Rows of `docs(doc_id, source, size, ..)` with `source_size, target, quota, passes, taken, runs`.

    The words of a source are laid out document after document in the order of a seeded hash and cut into equal
    blocks of about `block` words, narrower ones where the source is small. A source whose quota is more than all its blocks is taken whole `passes` times; the rest of the
    quota are blocks chosen by a seeded permutation. `runs` are the word ranges (from, to) of a document inside chosen
    blocks, `taken` counts the words of passes and runs together. `docs` is read three times: store it if it is dear.

    `dealt` adds `pieces`: the word ranges (from, to) of all blocks taken, those of passes too, each with its pass and shard.
    A source's blocks go to the shards in the order of pass and permutation, to each as many as its quota there, so that
    every shard holds the sources by the same weights.

    Positions are sums per (source, run of the hash) and sums inside a run, so no task holds a source. Missing sources
    are one source, last; missing sizes count 0; repeated rows are rows of their own, next to each other in the order.
    """
    extra = [c for c in docs.columns if c not in ("doc_id", "source", "size")]
    rows = docs.select(
        "doc_id",
        "source",
        F.coalesce("size", F.lit(0)).cast("long").alias("size"),
        F.struct(*extra).alias("others") if extra else F.lit(None).cast("struct<none:int>").alias("others"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("turn"),
    )
    totals = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-totals")
    n_rows = totals.agg(F.sum("n")).first()[0] or 0
    digits = max(1, math.ceil(math.log(max(1, n_rows / rows_per_run), 16)))
    plan = stored(plan_sources(totals.select("source", "source_size"), block=block, seed=seed, **options), "mix-plan")

    rows = rows.withColumn("run", F.substring("turn", 1, digits))
    earlier = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("source", "run")
        .agg(F.sum("size").alias("words"))
        .select("source", "run", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("source", "run").orderBy("turn", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("r")
    offsets = offsets.alias("o")
    same = F.col("r.source").eqNullSafe(F.col("o.source")) & (F.col("r.run") == F.col("o.run"))
    placed = placed.join(offsets, same).select("r.*", (F.col("inside") + F.col("before")).alias("start")).alias("r")
    plan = plan.withColumnRenamed("offset", "shift").alias("p")
    joined = placed.join(plan, F.col("r.source").eqNullSafe(F.col("p.source")))

    width, wider = F.col("width"), F.col("wider")

    def block_of(word: Column) -> Column:
        edge = wider * (width + 1)
        return F.when(word < edge, _div(word, width + 1)).otherwise(wider + _div(word - edge, width))

    def begin(k: Column) -> Column:
        return k * width + F.least(k, wider)

    first, last = block_of(F.col("start")), block_of(F.col("start") + F.col("size") - 1)
    chosen = F.filter(
        F.when(F.col("size") > 0, F.sequence(first, last)),
        lambda k: F.pmod(k * F.col("step") + F.col("shift"), F.col("p.blocks")) < F.col("rest"),
    )
    runs = F.transform(
        chosen,
        lambda k: F.struct(
            F.greatest(begin(k) - F.col("start"), F.lit(0)).alias("from"),
            F.least(begin(k + 1) - F.col("start"), F.col("size")).alias("to"),
        ),
    )
    zero = F.lit(0).cast("long")
    taken = F.col("passes") * F.col("size") + F.aggregate("runs", zero, lambda sum_, r: sum_ + r["to"] - r["from"])
    empty = F.array().cast("array<struct<from:bigint,to:bigint>>")

    def pieces_of(k: Column) -> Column:
        def turn(pass_: Column) -> Column:
            return pass_ * F.col("p.blocks") + F.pmod(k * F.col("step") + F.col("shift"), F.col("p.blocks"))

        passes = F.filter(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda pass_: turn(pass_) < F.col("quota"))
        return F.transform(
            passes,
            lambda pass_: F.struct(
                F.greatest(begin(k) - F.col("start"), F.lit(0)).alias("from"),
                F.least(begin(k + 1) - F.col("start"), F.col("size")).alias("to"),
                pass_.alias("pass"),
                F.size(F.filter("shard_ends", lambda end: end <= turn(pass_))).alias("shard"),
            ),
        )

    none = F.array().cast("array<struct<from:bigint,to:bigint,pass:bigint,shard:int>>")
    pieces = F.flatten(F.transform(F.when(F.col("size") > 0, F.sequence(first, last)), pieces_of))
    return (
        joined.select(
            "doc_id", "r.source", "size", "others", "source_size", "target", "quota", "passes",
            F.coalesce(runs, empty).alias("runs"), *([F.coalesce(pieces, none).alias("pieces")] if dealt else []),
        )
        .withColumn("taken", taken)
    )


def shard_words(pieces: Column, shards: int = SHARDS) -> Column:
    """Words that each shard takes of a document."""

    def words(shard: Column) -> Column:
        own = F.filter(pieces, lambda p: p["shard"] == shard)
        return F.aggregate(own, F.lit(0).cast("long"), lambda sum_, p: sum_ + p["to"] - p["from"])

    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), words)


def cut_runs(text: Column, runs: Column) -> Column:
    """The parts of a text that hold the words of each run, from the first word's start to the last word's end."""
    words_, gaps = F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0)), F.split(whole(text), WORD, -1)

    def part(pieces: Column, run: Column) -> Column:
        return F.array_join(F.slice(pieces, 2 * run["from"] + 1, 2 * (run["to"] - run["from"]) - 1), "")

    # gap after word i is gaps[i + 1]: words and gaps by turns
    woven = F.flatten(F.zip_with(words_, F.slice(gaps, 2, F.size(gaps)), lambda w, g: F.array(w, F.coalesce(g, F.lit("")))))
    return let(woven, lambda pieces: F.transform(runs, lambda run: part(pieces, run)))
