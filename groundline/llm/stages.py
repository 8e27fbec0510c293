"""Stages of the corpus pipeline: each takes `(spark, docs, sf_dir)` and applies one operator to all of `docs`.

`docs` has the columns of `documents` (doc_id, text, lang, source, n_chars) and may have others, which every stage but the
last passes on. Where a stage changes a text it sets `n_chars` anew.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundline.llm import bpe, mixing, pii, quality, simhash
from groundline.llm.common import word_count

BPE_FILE = "word_bpe_49k.json"
NEW_TEXT = "__new_text"


def _with_text(rows: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """`columns` of `rows` with another text and its length."""
    return rows.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from `labels`. Map-only after the learning."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality.learn_from(quality.statistics(docs), labels)
    row = F.struct(*[F.col(c) for c in docs.columns])
    judged = quality.with_verdict(quality.statistics(docs.select(row.alias("row"), "text"), id_column="row"), rules)
    return judged.filter("kept").select("doc_id.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose fingerprints of three-word shingles are linked within two bits."""
    return simhash.one_per_class(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data generalised to its kind and disclosing terms removed."""
    row = F.struct(*[F.col(c) for c in docs.columns])
    found = pii.find(docs.select("doc_id", "text", row.alias("row")))
    spans = F.concat("base", "extra")
    clean = F.when(F.size(spans) > 0, pii.sanitised(F.col("row.text"), spans)).otherwise(F.col("row.text"))
    return _with_text(found.select("row.*", clean.alias(NEW_TEXT)), docs.columns, F.col(NEW_TEXT))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document as often as whole passes take it, then each of its runs of words in chosen blocks as a document.

    A run is the part of the text from its first to its last word. Documents of which the mix takes nothing go.
    """
    row = F.struct(*[F.col(c) for c in docs.columns])
    rows = docs.select("doc_id", "source", word_count("text").alias("size"), row.alias("row"))
    mixed = mixing.mix(rows).filter("taken > 0")
    text = F.col("others.row.text")
    full = F.array_repeat(text, F.col("passes").cast("int"))
    pieces = F.explode(F.concat(full, mixing.cut_runs(text, F.col("runs")))).alias(NEW_TEXT)
    return _with_text(mixed.select("others.row.*", pieces), docs.columns, F.col(NEW_TEXT))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`(doc_id, n_tokens, ids, decoded)` of every document that the mix holds."""
    import public_tokenizers

    path = public_tokenizers.path(BPE_FILE)
    ids = bpe.encode(docs.select("doc_id", "text"), path)
    counted = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("ids").alias("again"))
    return bpe.decode(counted, path, "again", "decoded")
