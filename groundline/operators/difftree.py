"""Difference of two snapshots by a hash tree over id prefixes: only branches whose sums differ are looked into.

A branch holds the ids that share all but their lowest bits, so it is a range of ids, and readers skip what lies outside. Its
sum adds the hashes of its rows, those of the new snapshot counted up and those of the old one down: equal branches sum up to
zero, whatever the order and the files of their rows. Tasks add up what they read, so a level shuffles a row per branch and
task instead of the ids; the ids of unequal branches alone are joined in the end.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundline.operators.index import _hashed, index_diff

FIRST_ROWS = 4096  # rows of a branch at the first level
FANOUT_BITS = 4
LEAF_ROWS = 16  # branches are not divided further below this mean
MAX_BRANCHES = 200_000  # unequal branches that the driver holds and tasks look up
MAX_RANGES = 64  # ranges of ids that are given to the readers one by one


def _ranges(branches: list[int], shift: int) -> list[tuple[int, int]]:
    """Neighbouring branches put together: ranges of ids (first, last)."""
    out: list[list[int]] = []
    for b in sorted(branches):
        if out and out[-1][1] == b - 1:
            out[-1][1] = b
        else:
            out.append([b, b])
    return [(a << shift, ((b + 1) << shift) - 1) for a, b in out]


def within(rows: DataFrame, branches: list[int], shift: int) -> DataFrame:
    """The rows of `rows(id, ..)` in some branches. The ranges are a filter that readers of tables in id order prune by."""
    ranges = _ranges(branches, shift)
    if len(ranges) <= MAX_RANGES:
        some: Column | None = None
        for first, last in ranges:
            here = F.col("id").between(first, last)
            some = here if some is None else some | here
        return rows.filter(some)
    wanted = rows.sparkSession.createDataFrame([(b,) for b in branches], "branch BIGINT")
    rows = rows.filter(F.col("id").between(ranges[0][0], ranges[-1][1]))
    return rows.join(F.broadcast(wanted), F.shiftright("id", shift) == F.col("branch"), "left_semi")


def unequal_branches(new: DataFrame, old: DataFrame, leaf_rows: int = LEAF_ROWS, first_rows: int = FIRST_ROWS) -> tuple[list[int], int] | None:
    """The branches in which `new(id, content_md5)` and `old(id, content_md5)` differ, and how many low bits they leave out.

    None if they differ in so many branches that looking into them saves nothing. Levels are divided while the unequal
    branches hold more than `leaf_rows` rows each, so ids that crowd somewhere are divided deeper.
    """
    digest = F.xxhash64("id", F.coalesce("content_md5", F.lit("")))
    low = digest.bitwiseAND(F.lit((1 << 32) - 1))  # halves, so that sums do not overflow

    def counted(rows: DataFrame, sign: int) -> DataFrame:
        high = F.shiftright(digest, 32)
        return rows.select("id", F.lit(sign).cast("long").alias("sign"), (high * sign).alias("high"), (low * sign).alias("low"))

    both = counted(new, 1).unionByName(counted(old, -1))
    first, last, n = both.agg(F.min("id"), F.max("id"), F.count("*")).first()
    if not n:
        return [], 0
    shift = max(0, (last - first).bit_length() - max(0, math.ceil(math.log2(max(1, n / first_rows)))))
    shift = min(shift, 63)
    found: tuple[list[int], int] | None = None
    while True:
        rows = both if found is None else within(both, *found)
        sums = rows.groupBy(F.shiftright("id", shift).alias("branch")).agg(
            F.count("*").alias("n"), F.sum("sign").alias("more"), F.sum("high").alias("high"), F.sum("low").alias("low")
        )
        unequal = sums.filter("more <> 0 OR high <> 0 OR low <> 0").select("branch", "n").limit(MAX_BRANCHES + 1).collect()
        if len(unequal) > MAX_BRANCHES:
            return found
        found = [r.branch for r in unequal], shift
        if shift == 0 or sum(r.n for r in unequal) <= 2 * leaf_rows * len(unequal):  # rows of both sides
            return found
        shift = max(0, shift - FANOUT_BITS)


def index_diff_tree(chunks: DataFrame, indexed: DataFrame, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """`index_diff` by a hash tree: `(id, op)` for rows to insert, update or delete; made for snapshots that differ in little.

    Ids are unique on both sides and never missing; a missing text is a value like any other. Sums are of 64-bit hashes, so a difference
    stays hidden with a chance of about 2^-64 a branch. Snapshots that differ almost everywhere are joined as a whole.
    """
    new = _hashed(chunks).select("id", "content_md5")
    old = indexed.select("id", "content_md5")
    found = unequal_branches(new, old, leaf_rows)
    if found is None:
        return index_diff(new, old)
    if not found[0]:
        return index_diff(new.limit(0), old.limit(0))
    return index_diff(within(new, *found), within(old, *found))
