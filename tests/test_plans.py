"""What the plans must look like, whatever the results."""

import pytest

from groundline.functions.cleaning import clean
from groundline.operators.chunk import chunk_by_heading
from groundline.plans.queries import QUERIES
from groundline.plans import tables as t
from groundline.sources.documents import marked


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("clean_t")])
def test_no_pairwise_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_cleaning_chunking_and_embedding_do_not_shuffle(spark, sf_dir):
    chunks = marked(t.table(spark, sf_dir, "documents")).transform(clean, "md").transform(chunk_by_heading, "md")
    text = plan(t.index_rows(chunks).withColumn("vec", t.EMBEDDER.vector(chunks.content)))
    assert "Exchange" not in text and "Python" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_scoring_reads_vectors_only(spark, sf_dir):
    text = plan(QUERIES["search_text"](spark, sf_dir))
    assert "ReadSchema: struct<id:bigint,vec:struct<buckets:array<int>,weights:array<int>>,deleted:boolean>" in text
    assert "ReadSchema: struct<id:bigint,content:string,deleted:boolean>" in text
    assert "WindowGroupLimit" in text


def test_article_is_extracted_once_and_html_filter_is_pushed(spark, sf_dir):
    text = plan(QUERIES["html_markdown"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(html)]" in text
    assert "RegExpExtract" not in text.split("Filter")[0] and "Generate" in text
