"""What the operators of this package share: words, stored tables, memory of a worker."""

import ctypes
import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundline.session import shared_dir

WORD = r"[^ \t-\r]+"  # space and the characters 9 to 13 part words
GAP = r"[ \t-\r]+"
GAP_CHARACTERS = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """`df` written once to the shared folder and read back: later jobs start from the files, whatever executors are lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_memory() -> dict:
    """What a Python worker keeps from task to task. Functions travel by value, so their modules' globals are new in each task."""
    return vars(sys.modules.setdefault("groundline_worker_memory", types.ModuleType("groundline_worker_memory")))


def give_back() -> None:
    """Hands memory that this worker has freed back to the system, since idle workers live on beside the busy ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def text_slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in slices of about `size` bytes of text, one text at least; batches are counted in rows, texts vary."""
    for batch in batches:
        texts = batch.column(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            reached = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, reached + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most `rows` rows for the jobs inside, where a row is long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def whole(text) -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.lit("abcdefghijklmnopqrstuvwxyz"))


def words(text) -> Column:
    """The words of a text in order; none for an empty or missing one."""
    core = F.btrim(whole(text), F.lit(GAP_CHARACTERS))
    return F.filter(F.split(core, GAP, -1), lambda word: word != "")


def word_count(text) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def id_remainder(id_column, divisor: int) -> Column:
    """crc32 of the id as decimal text, modulo `divisor`; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % divisor


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row for a body that uses it several times."""
    return F.transform(F.array(value), body)[0]
