"""Tokens and hashed term vectors as built-in expressions (no Python worker, no shuffle)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundline.functions.text import let

N_BUCKETS = 1 << 20


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in text order."""
    # `split` compiles its pattern anew for every text
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]++"), F.lit(0))


def bucket(token: Column, n_buckets: int = N_BUCKETS) -> Column:
    """Feature hash of a token (Weinberger et al., ICML 2009, unsigned)."""
    digits = 8
    if n_buckets & (n_buckets - 1) == 0:  # of a power of two, only the last hex digits count
        digits = min(8, max(1, (n_buckets.bit_length() + 2) // 4))
    head = F.conv(F.substring(F.md5(token), 9 - digits, digits), 16, 10).cast("long")
    return (head % n_buckets).cast("int")


def term_vector(text: Column, n_buckets: int = N_BUCKETS) -> Column:
    """Sparse vector `struct<buckets array<int>, weights array<int>>`, weight = term count.

    The bucket numbers of a text are sorted and run-length counted inside the row, so the cost is
    one sort of the tokens and nothing is shuffled. Empty text gives empty arrays, NULL gives NULL.
    """

    def count_runs(ordered: Column) -> Column:
        starts = F.array_compact(
            F.transform(ordered, lambda value, i: F.when((i == 0) | (value != F.get(ordered, i - 1)), i))
        )
        return let(
            starts,
            lambda s: F.struct(
                F.transform(s, lambda i: F.get(ordered, i)).alias("buckets"),
                F.transform(s, lambda i, j: F.coalesce(F.get(s, j + 1), F.size(ordered)) - i).alias("weights"),
            ),
        )

    hashed = F.transform(tokens(text), lambda token: bucket(token, n_buckets))
    return F.when(text.isNotNull(), let(F.sort_array(hashed), count_runs))


def squared_norm(vec: Column) -> Column:
    """Squared length of a term vector."""
    return F.aggregate(vec["weights"], F.lit(0).cast("long"), lambda acc, w: acc + w.cast("long") * w)


def vec_head(vec: Column, n: int = 5) -> Column:
    """First `n` components, for a look at a vector."""
    return F.slice(vec, 1, n)
