"""Connected components of a graph given as edges, in rounds that each end in a stored table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundline.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest node around it (itself included)."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the smallest of them. Edges lead from larger to smaller nodes."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`(node, class)` for each node of `edges(a, b)`, the class being its smallest node.

    Large-star and small-star rounds by turns (Kiveris et al., SoCC 2014) until neither changes the edges; the number
    of rounds grows with the logarithm of the graph. No neighbourhood is gathered: minima are aggregated before the
    shuffle and joined back.
    """
    kinds = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = stored(kinds, "edges")
    seen = state(current)
    while seen[0]:
        current = stored(_small_star(_large_star(current)), "edges")
        now = state(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("class")).union(
        current.select("b", "b").distinct().toDF("node", "class")
    )
