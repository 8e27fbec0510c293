import random
import re

import pytest

from pyspark.sql import functions as F

from groundline.operators.chunk import chunk_by_heading
from groundline.operators.segments import chunk_segments, to_segments
from tests.test_plans import plan

LINES = ["# A", "# B", "## b", "## ", "### c", "###", "#", "#### not", "#x", "text", " more ", "", "  ", "# T ", "x # y"]


def chunks(df):
    return sorted((str(r.doc_id), r.chunk_no, r.content, sorted(r.headers.items())) for r in df.collect())


def documents(spark, seed, n=60):
    rng = random.Random(seed)
    texts = ["\n".join(rng.choices(LINES, k=rng.randint(0, 40))) for _ in range(n)]
    return spark.createDataFrame([*enumerate(texts), (None, "# of no id\ntext\ntext")], "doc_id BIGINT, text STRING")


def lines_of(docs):
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
@pytest.mark.parametrize("keep", [True, False])
def test_equals_chunks_of_whole_texts(spark, size, keep):
    docs = documents(spark, size)
    found = chunk_segments(to_segments(lines_of(docs), size), keep_heading_only=keep)
    assert chunks(found) == chunks(chunk_by_heading(docs, keep_heading_only=keep))


def test_other_headers(spark):
    docs = documents(spark, 9)
    headers = (("##", "outer"), ("#", "inner"))
    assert chunks(chunk_segments(to_segments(lines_of(docs), 3), headers)) == chunks(chunk_by_heading(docs, headers=headers))


def test_missing_and_blank_segments(spark):
    rows = [(1, 0, None), (1, 1, "# A"), (1, 2, "\n \n"), (1, 5, "one"), (1, 9, None), (1, 10, "two\n## B"), (2, 0, None)]
    found = chunk_segments(spark.createDataFrame(rows, "doc_id INT, segment_no INT, text STRING"))
    assert chunks(found) == [("1", 0, "one\ntwo", [("Header 1", "A")]), ("1", 1, "B", [("Header 1", "A"), ("Header 2", "B")])]
    assert chunk_segments(spark.createDataFrame(rows[:0], "doc_id INT, segment_no INT, text STRING")).collect() == []


def test_scans_see_no_texts(spark):
    """What is ordered by document holds numbers and titles; the column of texts is in no window."""
    text = plan(chunk_segments(to_segments(lines_of(documents(spark, 1)), 5)))
    windows = [part for part in text.split("\n\n") if ") Window" in part]
    assert windows and all("text#" not in w and "content#" not in w and "body#" not in w and "sections#" not in w for w in windows)


def test_a_document_of_very_many_lines(spark):
    """400,000 lines of one document, which as one row would be one value of one task."""
    n = 400_000
    line = F.when(F.col("id") % 1000 == 0, F.concat(F.lit("# part "), F.col("id"))).when(F.col("id") % 100 == 0, F.lit("## section"))
    lines = spark.range(n).select(F.lit(1).alias("doc_id"), F.col("id").alias("line_no"), F.coalesce(line, F.lit("some words of a line")).alias("line"))
    found = chunk_segments(to_segments(lines, 777))
    sizes = found.agg(F.count("*"), F.max("chunk_no"), F.sum(F.size(F.split("content", "\n"))), F.max(F.length("content"))).first()
    assert tuple(sizes)[:3] == (n // 100, n // 100 - 1, n // 100 * 99) and sizes[3] == 99 * 21 - 1


def test_segments_are_made_once(spark, tmp_path):
    """Lines are cut, shuffled and joined to segments once, for the titles and for the texts alike."""
    documents(spark, 2).write.parquet(f"{tmp_path}/docs")
    found = chunk_segments(to_segments(lines_of(spark.read.parquet(f"{tmp_path}/docs")), 3))
    found.collect()
    text = plan(found).split("Initial Plan")[0]
    assert len(set(re.findall(r"Scan parquet .*?\((\d+)\)", text))) == 1
