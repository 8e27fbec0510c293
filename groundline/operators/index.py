"""The vector index: a table derived from the chunk table, kept in step by appended changes.

Layout under a root folder: `data/v=<version>/` holds the rows of a version and `versions/` an append-only log with one
row per version. A version is either full, which retires every earlier one, or a delta: upserted rows and tombstones of
deleted ids. Of an id, the row of the newest version counts. A version is written in full before its log row is appended,
so readers never see half of it, and a failed attempt is overwritten by the next one. One writer at a time.

Every row carries `seq`, the number of the change that made it, deleted ones too. A change feed is held against these
numbers, so a late change never replaces a newer one, in whatever batch it comes; of equal numbers the later batch wins.
Builds and syncs number their rows like the newest change before them.
"""

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundline.operators.embed import Embedder, embed
from groundline.session import remove_folder

LOG_SCHEMA = (
    "version INT, is_full BOOLEAN, n_rows BIGINT, max_seq BIGINT, embedder_id STRING, row_schema STRING, batch_id BIGINT"
)
UPKEEP = ("seq", "deleted")  # columns of the store that readers do not see


def _log(spark: SparkSession, root: str) -> list:
    """Log rows of the live versions, oldest first: the last full one and what came after it; empty without an index."""
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    full = log.filter("is_full").agg(F.max("version")).first()[0] or 0
    return sorted(log.filter(F.col("version") >= full).collect(), key=lambda r: r.version)


def index_exists(spark: SparkSession, root: str) -> bool:
    return bool(_log(spark, root))


def _last_version(log) -> int:
    return log[-1].version if log else 0


def _max_seq(log) -> int:
    return max((r.max_seq for r in log), default=0)


@dataclass(frozen=True)
class VectorIndex:
    spark: SparkSession
    root: str
    embedder: Embedder

    def rows(self) -> DataFrame:
        """The rows of the current version: `(id, content, content_md5, .., vec)`."""
        return self._current(self._checked_log()).filter("NOT deleted").drop(*UPKEEP)

    def _checked_log(self) -> list:
        log = _log(self.spark, self.root)
        if not log:
            raise ValueError(f"no index at {self.root}")
        stored = {r.embedder_id for r in log}
        if stored != {self.embedder.embedder_id}:
            raise ValueError(f"index at {self.root} was embedded by {stored}, not {self.embedder.embedder_id}")
        return log

    def _read(self, log) -> DataFrame:
        """All rows of some versions, with their version `v`."""
        schema = T.StructType.fromJson(json.loads(log[-1].row_schema))
        paths = [f"{self.root}/data/v={r.version}" for r in log if r.n_rows]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("v", F.lit(0))
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)

    def _current(self, log, among: DataFrame | None = None) -> DataFrame:
        """The newest row of every id, deleted ones as tombstones; with `among(id)`, of those ids alone.

        Only ids of deltas are aggregated; the rows of the full version lose those ids, and a single version is read as it is.
        Versions are held against `among` as they are read: few ids go to the tasks, and nothing else of the index is shuffled.
        """

        def read(versions) -> DataFrame:
            rows = self._read(versions)
            return rows if among is None else rows.join(among, "id", "left_semi")

        base, deltas = [r for r in log if r.is_full], [r for r in log if not r.is_full]
        if not any(r.n_rows for r in deltas):
            return read(log).drop("v")
        changed = read([r for r in deltas if r.n_rows] + log[-1:] * (not deltas[-1].n_rows))
        newest = changed.groupBy("id").agg(F.max("v").alias("v"))
        fresh = changed.join(newest, ["id", "v"], "left_semi").drop("v")
        if not base:
            return fresh
        schema_of = base + log[-1:]  # rows of the full version, read with the newest columns
        kept = read(schema_of).filter(F.col("v") == base[0].version).drop("v")
        return kept.join(newest.select("id"), "id", "left_anti").unionByName(fresh)


def open_index(spark: SparkSession, root: str, embedder: Embedder) -> VectorIndex:
    """An existing index; raises if it was embedded by another embedder."""
    index = VectorIndex(spark, root, embedder)
    index._checked_log()
    return index


def _commit(rows: DataFrame, index: VectorIndex, log, is_full: bool, batch_id: int | None = None) -> None:
    """Append `rows(id, content, .., seq, deleted)` as the next version; those that have no `vec` yet are embedded here.

    They are dealt out by a hash of the id, which needs no sort beforehand, and embedded after it, so vectors are written but
    neither shuffled nor sorted.
    """
    version, folder = _last_version(log) + 1, f"{index.root}/data/v={_last_version(log) + 1}"
    # even files, ids in order inside each, so that reads by id skip row groups
    rows = rows.hint("rebalance", "id").sortWithinPartitions("id")
    if "vec" not in rows.columns:
        rows = _embedded(rows, index.embedder)
        rows = rows.select(*[c for c in rows.columns if c not in UPKEEP], *UPKEEP)
    rows.write.mode("overwrite").parquet(folder)
    written = index.spark.read.schema("id BIGINT, seq BIGINT").parquet(folder)
    n, top = written.agg(F.count("*"), F.max("seq")).first()
    entry = (version, is_full, n, max(_max_seq(log), top or 0), index.embedder.embedder_id, rows.schema.json(), batch_id)
    index.spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{index.root}/versions")


def _hashed(chunks: DataFrame) -> DataFrame:
    """With `content_md5`, taken from the chunk table where it has it."""
    return chunks if "content_md5" in chunks.columns else chunks.withColumn("content_md5", F.md5("content"))


def _embedded(chunks: DataFrame, embedder: Embedder) -> DataFrame:
    return embed(_hashed(chunks), "content", embedder)


def _numbered(rows: DataFrame, seq, deleted: bool) -> DataFrame:
    return rows.withColumns({"seq": seq, "deleted": F.lit(deleted)})


def build_index(chunks: DataFrame, root: str, embedder: Embedder) -> VectorIndex:
    """Embed `content` of all `chunks(id, content, ..)` and write it as a full version."""
    index = VectorIndex(chunks.sparkSession, root, embedder)
    log = _log(index.spark, root)
    seq = F.lit(_max_seq(log)).cast("long")
    _commit(_numbered(chunks, seq, False), index, log, is_full=True)
    return index


def index_diff(chunks: DataFrame, indexed: DataFrame) -> DataFrame:
    """`(id, op)` for rows to insert, update or delete since the index was built.

    Ids are unique on both sides; only ids and hashes are shuffled. A missing text is a value like any other.
    """
    new = _hashed(chunks).select("id", F.col("content_md5").alias("new_md5"), F.lit(True).alias("in_new"))
    old = indexed.select("id", F.col("content_md5").alias("old_md5"), F.lit(True).alias("in_old"))
    op = (
        F.when(F.col("in_old").isNull(), "insert")
        .when(F.col("in_new").isNull(), "delete")
        .when(~F.col("new_md5").eqNullSafe(F.col("old_md5")), "update")
    )
    return new.join(old, "id", "full_outer").select("id", op.alias("op")).filter("op IS NOT NULL")


def _append(index: VectorIndex, log, changes: DataFrame, upserts, batch_id: int | None = None) -> None:
    """A delta from `changes(id, op, seq, ..)`, which are computed once and written; `upserts(changes)` gives the chunks."""
    path = f"{index.root}/changes/v={_last_version(log) + 1}"
    changes.write.mode("overwrite").parquet(path)
    changes = index.spark.read.schema(changes.schema).parquet(path)
    if changes.isEmpty():
        return
    added = upserts(changes.filter("op <> 'delete'")).withColumn("deleted", F.lit(False))
    gone = changes.filter("op = 'delete'").select("id", "seq", F.lit(True).alias("deleted"))
    _commit(added.unionByName(gone, allowMissingColumns=True), index, log, not log, batch_id)


def sync_index(chunks: DataFrame, root: str, embedder: Embedder) -> VectorIndex:
    """Bring the index in step with the chunk table; only changed chunks are embedded and written."""
    index = VectorIndex(chunks.sparkSession, root, embedder)
    if not index_exists(index.spark, root):
        return build_index(chunks, root, embedder)
    log = index._checked_log()
    changes = index_diff(chunks, index.rows()).withColumn("seq", F.lit(_max_seq(log)).cast("long"))
    _append(index, log, changes, lambda changed: chunks.join(changed.select("id", "seq"), "id"))
    return index


def apply_changes(changes: DataFrame, root: str, embedder: Embedder, batch_id: int | None = None) -> VectorIndex:
    """Apply a change feed `(seq, op, id, content)`; the newest change of an id wins, in whatever batch it comes.

    Creates the index if it is missing. Of equal `seq` in one batch a deletion wins, else the larger text. Batches are
    numbered upwards; a `batch_id` that is not above those in the log was applied before and is left out.
    """
    index = VectorIndex(changes.sparkSession, root, embedder)
    log = index._checked_log() if index_exists(index.spark, root) else []
    applied = max((r.batch_id for r in log if r.batch_id is not None), default=-1)
    if batch_id is not None and batch_id <= applied:
        return index
    # partial aggregation keeps one row per id and task before the shuffle, also for a hot id
    order = F.struct(F.col("seq"), (F.col("op") == "delete").alias("gone"), F.col("content"))
    newest = changes.groupBy("id").agg(F.max(F.struct(order.alias("by"), F.col("op"))).alias("at"))
    newest = newest.select("id", "at.op", "at.by.seq", "at.by.content")
    if log:
        known = index._current(log, newest.select("id")).select("id", F.col("seq").alias("known_seq"))
        newest = newest.join(known, "id", "left").filter("known_seq IS NULL OR seq >= known_seq").drop("known_seq")
    _append(index, log, newest, lambda changed: changed.select("id", "content", "seq"), batch_id)
    return index


def compact_index(index: VectorIndex) -> VectorIndex:
    """Write the current rows and tombstones as one full version, so that readers have no deltas to merge."""
    log = index._checked_log()
    if len(log) > 1:
        _commit(index._current(log), index, log, True, max((r.batch_id for r in log if r.batch_id is not None), default=None))
    return index


def clean_index(index: VectorIndex) -> list[int]:
    """Delete the files of versions before the last full one, and all kept changes; the deleted versions' numbers.

    For times when no reader still holds an older version.
    """
    log = index._checked_log()
    retired = list(range(1, log[0].version))
    for version in retired:
        remove_folder(index.spark, f"{index.root}/data/v={version}")
    remove_folder(index.spark, f"{index.root}/changes")
    return retired


def latest_version(versions: DataFrame) -> DataFrame:
    """`(name, latest_version)`: versions compare as integers and start at 1."""
    number = F.greatest(F.lit(1), F.max(F.col("version").cast("int")))
    return versions.groupBy("name").agg(number.alias("latest_version"))
