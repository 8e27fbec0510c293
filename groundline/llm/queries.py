"""Registered queries of this package: each applies one operator to the whole documents table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundline.llm import alignment, bpe, fingerprints, langid, lm, mixing, pii, quality, ranking, sharding, simhash, suffix, token_counts
from groundline.llm.common import id_remainder, stored, whole, word_count

BPE_FILE = "word_bpe_49k.json"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
TOKEN_LIMIT = 2048


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_by_bytes(documents(spark, sf_dir))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir), held_out=id_remainder("doc_id", 5) == 1)


def op3_disclosing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.col("base")
    return found.select(
        "doc_id",
        *[pii.n_of(kind, base).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listing(base), 256).alias("base_sha256"),
        pii.listing(F.concat("base", "extra")).alias("spans"),
    )


def op4_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(documents(spark, sf_dir))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = stored(quality.statistics(documents(spark, sf_dir)), "quality-statistics")
    return quality.with_verdict(stats, quality.learn_from(stats, labels)).drop("n_distinct")


def op7_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_print(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = documents(spark, sf_dir).select("doc_id", "source", word_count("text").alias("size"))
    mixed = mixing.mix(stored(sizes, "mix-sizes"), dealt=True)
    by_shard = mixing.shard_words(F.col("pieces")).alias("shard_words")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", by_shard)


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only this query needs the files

    path = public_tokenizers.path(BPE_FILE)
    ids = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), path)
    digests = ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        "ids",
    )
    return bpe.decode(digests, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.train(docs.filter(id_remainder("doc_id", 3) != 1))
    found = langid.predict(docs, model)
    return found.withColumn("held_out", id_remainder("doc_id", 3) == 1)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = documents(spark, sf_dir).select("doc_id", F.octet_length(whole("text")).cast("long").alias("n_bytes"), "text")
    counted = token_counts.with_token_count(rows, public_tokenizers.path(BPE_FILE))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = documents(spark, sf_dir).select("doc_id", "text")
    paths = public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE)
    found = alignment.align(rows, *paths, outputs=("n_a", "n_b", "groups", "pairs"))
    groups = F.col("groups")
    found = found.select(
        F.monotonically_increasing_id().alias(alignment.ROW),
        "doc_id",
        "n_a",
        "n_b",
        F.regexp_count(groups, F.lit("[|]")).cast("long").alias("n_groups"),
        F.size("pairs").cast("long").alias("n_links"),
        F.when(groups == "", "").otherwise(F.sha2(groups, 256)).alias("groups_sha256"),
        "pairs",
    )
    found = stored(found, "alignment-links", "zstd")
    counts = stored(alignment.pair_counts(found), "alignment-pairs")
    sums = alignment.link_sums(found, counts)
    return found.drop("pairs").join(sums, alignment.ROW).drop(alignment.ROW)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_shard_by_bytes,
        op2_backoff_lm,
        op3_disclosing_terms,
        op4_multiset_fingerprints,
        op5_repeated_passages,
        op6_quality_rules,
        op7_simhash_classes,
        op8_mix_sources,
        op9_bpe_round_trip,
        op10_language_id,
        op11_token_counts,
        op12_token_alignment,
        op13_ranked_search,
    )
}

ORACLES = {"op13_ranked_search": ranking.SQL}
