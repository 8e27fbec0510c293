"""Document frequencies of an index, kept per version, and search whose questions are weighted by them.

`terms/v=<version>/` holds, for each bucket, how many rows more have it than before that version: of a full version all its
rows, of a delta its new rows less those they replace. A version's counts are worked out once, when statistics are first
asked for after it, from its own rows and the older rows of the same ids; the frequencies of now are the sums over the
live versions.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundline.operators.embed import embed_queries
from groundline.operators.index import VectorIndex
from groundline.operators.nearest import nearest
from groundline.operators.postings import Postings, nearest_by_terms

COUNTS = "bucket INT, df BIGINT, v INT"
ALL = -1  # stands for all rows that have a term
MAX_SHARE = 0.5


def _counts(rows: DataFrame) -> DataFrame:
    """`(bucket, df)` of `rows(vec)`, and under `ALL` their number."""
    full = rows.filter("size(vec.buckets) > 0")
    buckets = F.concat(F.array(F.lit(ALL)), F.col("vec.buckets"))
    return full.select(F.explode(buckets).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("df"))


def _kept_versions(index: VectorIndex) -> set[int]:
    try:
        return {r.v for r in index.spark.read.schema(COUNTS).parquet(f"{index.root}/terms").select("v").distinct().collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def term_frequencies(index: VectorIndex) -> DataFrame:
    """`(bucket, df)`: in how many rows of the index each bucket occurs, and under `ALL` how many rows have a term.

    Versions without counts get them first, in order; each reads its own rows and, by their ids, what they replace.
    """
    log = index._checked_log()
    known = _kept_versions(index)
    for i, entry in enumerate(log):
        if entry.version in known:
            continue
        if entry.is_full or not entry.n_rows:
            now = index._read([entry]).filter("NOT deleted")
            counts = _counts(now)
        else:
            here = index._read([entry])
            before = index._current(log[:i], here.select("id")).filter("NOT deleted") if i else here.limit(0)
            gone = _counts(before).withColumn("df", -F.col("df"))
            counts = _counts(here.filter("NOT deleted")).unionByName(gone).groupBy("bucket").agg(F.sum("df").alias("df"))
        empty = index.spark.createDataFrame([(ALL, 0)], "bucket INT, df BIGINT")  # so that a version without terms is there too
        counts.unionByName(empty).coalesce(8).write.mode("overwrite").parquet(f"{index.root}/terms/v={entry.version}")
    live = [entry.version for entry in log]
    kept = index.spark.read.schema(COUNTS).parquet(f"{index.root}/terms").filter(F.col("v").isin(live))
    return kept.groupBy("bucket").agg(F.sum("df").alias("df")).filter("df > 0")


def weighted(questions: DataFrame, frequencies: DataFrame, max_share: float = MAX_SHARE) -> DataFrame:
    """`(qid, vec)`: the terms of `questions(qid, vec)` times `floor(1000 * ln((2 n + 2) / (2 df + 1)))`.

    Terms of no row, and of more than `max_share` of the n rows, are left out: a word of nearly every row tells nothing and
    its list is the longest. A question that is left without a term has no row.
    """
    n = frequencies.filter(F.col("bucket") == ALL).select("df").scalar()  # one number
    terms = questions.filter("vec IS NOT NULL").select("qid", F.explode(F.arrays_zip("vec.buckets", "vec.weights")).alias("term"))
    rarity = F.floor(1000 * F.log((2 * F.col("n") + 2) / (2 * F.col("df") + 1)))
    entry = F.struct("bucket", (F.col("term.weights") * rarity).cast("int").alias("weight"))
    return (
        terms.withColumn("bucket", F.col("term.buckets"))
        .join(frequencies.filter(F.col("bucket") != ALL), "bucket")
        .withColumn("n", n)
        .filter((F.col("df") <= max_share * F.col("n")) & (rarity > 0))
        .groupBy("qid")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))  # the terms of one question
        .select("qid", F.struct(F.col("entries.bucket").alias("buckets"), F.col("entries.weight").alias("weights")).alias("vec"))
    )


def search_text_weighted(
    queries: DataFrame, index: VectorIndex, columns=("content",), k: int = 4, max_share: float = MAX_SHARE, postings: Postings | None = None
) -> DataFrame:
    """`(qid, rank, id, <columns>, score)`: rows of highest cosine with the weighted questions `(qid, query)`; by `postings` of the index if given."""
    questions = embed_queries(queries.groupBy("qid").agg(F.min("query").alias("query")), index.embedder)
    asked = weighted(questions, term_frequencies(index), max_share)
    rows = index.rows()
    if postings is None:
        hits = nearest(asked, rows, k, index.embedder.dim, positive_only=True).rows
    else:
        hits = nearest_by_terms(asked, postings, k)
    if not columns:
        return hits.select("qid", "rank", "id", "score")
    return rows.select("id", *columns).join(hits, "id").select("qid", "rank", "id", *columns, "score")
