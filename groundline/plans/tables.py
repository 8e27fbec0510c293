"""Inputs of the registered queries, derived from the given tables."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundline.functions.cleaning import clean
from groundline.operators.chunk import chunk_by_heading
from groundline.operators.embed import hashing_embedder
from groundline.operators.index import VectorIndex, build_index
from groundline.operators.postings import Postings, build_postings
from groundline.operators.prompt import with_history
from groundline.session import shared_dir
from groundline.sources.chunk_table import chunk_id, with_chunk_id
from groundline.sources.documents import marked
from groundline.sources.pages import html_to_markdown, read_pages

EMBEDDER = hashing_embedder()
EXTRA = "Answer briefly"
SITEMAP_URLS = 1000

_built: dict[tuple, VectorIndex] = {}
_listed: dict[str, Postings] = {}  # by the index's folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, waves: int = 1) -> DataFrame:
    """Deal the rows of a small scan out over all cores before row-local work on texts.

    A file of one row group is read by one task whatever the split size. Scans with more splits than
    `waves` times the cores, so everything of cluster size, are left as they are. With one wave, a few splits more
    than there are cores leave most cores idle in a second wave; more waves cost a shuffle of such scans.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(2 * cores) if scan.rdd.getNumPartitions() <= waves * cores else scan


def marked_documents(spark: SparkSession, sf_dir: str, waves: int = 1) -> DataFrame:
    return marked(spread(table(spark, sf_dir, "documents").select("doc_id", "text"), waves))


def document_chunks(spark: SparkSession, sf_dir: str, waves: int = 1) -> DataFrame:
    """Documents, marked, cleaned and cut at headings."""
    return marked_documents(spark, sf_dir, waves).transform(clean, "md").transform(chunk_by_heading, "md")


def page_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_pages(spark, f"{sf_dir}/pages.parquet"))


def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages: article, Markdown, cleaned and cut at headings."""
    markdown = html_to_markdown(page_source(spark, sf_dir))
    return (
        markdown.select(F.col("page_id").alias("doc_id"), "md")
        .transform(clean, "md")
        .transform(chunk_by_heading, "md")
    )


def index_rows(chunks: DataFrame) -> DataFrame:
    """Chunks as the index takes them."""
    return with_chunk_id(chunks).select("id", "content")


def chunk_index(spark: SparkSession, sf_dir: str, chunks) -> VectorIndex:
    """The index over `chunks(spark, sf_dir)`, built on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, chunks.__name__)
    if key not in _built:
        root = shared_dir(spark, f"index-{chunks.__name__}")
        _built[key] = build_index(index_rows(chunks(spark, sf_dir)), root, EMBEDDER)
    return _built[key]


def chunk_postings(index: VectorIndex) -> Postings:
    """The inverted lists of an index, built on first use in a session."""
    if index.root not in _listed:
        _listed[index.root] = build_postings(index.rows(), shared_dir(index.spark, "postings"))
    return _listed[index.root]


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))


def chat_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn with its history, as a question whose id is its conversation and turn."""
    turns = with_history(table(spark, sf_dir, "conversations"), EXTRA)
    return turns.select(F.struct("conv_id", "turn").alias("qid"), "query")


def sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap files `(sitemap_id, xml)` of up to 1000 page URLs each."""
    escaped = F.col("url")
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(character), F.lit(entity))
    entry = F.concat(F.lit("<url><loc>"), escaped, F.lit("</loc></url>"))
    head = F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">')
    return (
        table(spark, sf_dir, "pages")
        .groupBy(F.floor(F.col("page_id") / SITEMAP_URLS).alias("sitemap_id"))
        .agg(F.sort_array(F.collect_list(F.struct("page_id", entry.alias("entry")))).alias("entries"))
        .select(
            "sitemap_id",
            F.concat(head, F.array_join("entries.entry", ""), F.lit("</urlset>")).alias("xml"),
        )
    )


def old_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's rows: the documents that have a label."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).join(labelled, "doc_id", "left_semi")
    return documents.select(chunk_id(F.col("doc_id"), F.lit(0)).alias("id"), F.col("text").alias("content"))


def new_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's rows: all documents but the toxic ones; those of good quality got a revision mark."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).join(labels, "doc_id", "left")
    kept = documents.filter(F.coalesce("toxic", F.lit(0)) == 0)
    content = F.when(F.col("quality") == 1, F.concat("text", F.lit(" (revised)"))).otherwise(F.col("text"))
    return kept.select(chunk_id(F.col("doc_id"), F.lit(0)).alias("id"), content.alias("content"))


def label_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    means = table(spark, sf_dir, "embeddings").groupBy("label").agg(Summarizer.mean(vector).alias("mean"))
    return means.select(F.col("label").cast("long").alias("qid"), vector_to_array("mean").alias("vec"))
