from datetime import datetime

import pytest

from pyspark.sql import functions as F

from groundline.functions.html import flat_element, nested_element, to_markdown
from groundline.operators.chunk import chunk_by_heading
from groundline.sources import chunk_table, documents, pages, payload
from groundline.session import shared_dir


def test_sitemap_rows(spark):
    xml = '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>{}</loc></url><url><loc>{}</loc></url></urlset>'
    df = spark.createDataFrame([(2, xml.format("u3", "u4")), (1, xml.format("u1", "a&amp;b"))], "sitemap_id INT, xml STRING")
    assert sorted(r.url for r in pages.sitemap_urls(df).collect()) == ["a&b", "u1", "u3", "u4"]
    assert sorted(r.url for r in pages.sitemap_urls(df, max_documents=3).collect()) == ["a&b", "u1", "u3"]
    assert pages.sitemap_urls(df).select(F.spark_partition_id().alias("p")).count() == 4


def test_sitemap_file(spark, tmp_path):
    entries = "".join(f"<url><loc> http://x/{i} </loc><lastmod>2024</lastmod></url>" for i in range(20))
    (tmp_path / "map.xml").write_text(f'<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">{entries}</urlset>')
    got = {r.url for r in pages.read_sitemap(spark, str(tmp_path)).collect()}
    assert got == {f"http://x/{i}" for i in range(20)}


def test_pages_with_status(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = [(1, "u", "<b>", 200), (2, "v", "<b>", 404), (3, "w", None, None)]
    spark.createDataFrame(rows, "page_id INT, url STRING, html STRING, status INT").write.parquet(path)
    assert {r.page_id: r.html for r in pages.read_pages(spark, path).collect()} == {1: "<b>", 2: None, 3: None}


NESTED = [
    ('<div>x</div><div itemprop="articleBody" class=a> <div>in</div> t </div><div>y</div>', '<div itemprop="articleBody" class=a> <div>in</div> t </div>'),
    ("a\n<DIV\n itemprop='articleBody'>\n1</DIV >z", "<DIV\n itemprop='articleBody'>\n1</DIV >"),
    ('<script>"<div itemprop=articleBody>"</script><p>none</p>', None),
    ('<div itemprop="articleBody">open', '<div itemprop="articleBody">open'),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("html, expected", NESTED)
def test_nested_article(spark, html, expected):
    df = spark.createDataFrame([(1, "u", html)], "page_id INT, url STRING, html STRING")
    assert pages.extract_article(df).first().text == expected


def test_nested_element_by_tag_only(spark):
    df = spark.createDataFrame([("<ul><li>a<ul><li>b</ul></ul><ul>c</ul>",)], "h STRING")
    assert df.select(nested_element(F.col("h"), "ul")).first()[0] == "<ul><li>a<ul><li>b</ul></ul>"


def test_articles_must_exist(spark):
    df = spark.createDataFrame([("u", None), ("v", "t")], "url STRING, text STRING")
    assert [tuple(r) for r in pages.nonnull_articles(df).collect()] == [("v", "t")]
    with pytest.raises(ValueError, match="no article"):
        pages.nonnull_articles(df.filter("text IS NULL"))


def test_markdown(spark):
    html = (
        "<article><h1>T &amp;amp; <i>x</i></h1><p class='a'>one<br>two <b>bold</b></p><!-- c --><ul><li>a</li><li>b</li></ul>"
        "<table><tr><th>h</th><th>i</th></tr><tr><td>1</td><td>2</td></tr></table><script>x<y</script><pre>p</pre></article>"
    )
    got = spark.createDataFrame([(html,)], "h STRING").select(to_markdown(F.col("h"))).first()[0]
    assert got == "# T &amp; *x*\n\none\ntwo **bold**\n\n- a\n- b\n\n| h | i |\n| 1 | 2 |\n\np"


def test_page_range(spark):
    df = spark.createDataFrame([(1, "-----".join("abcd"))], "doc_id INT, text STRING")
    assert [tuple(r) for r in documents.page_range(df, 1, 2).collect()] == [(1, 1, "b"), (1, 2, "c")]


def test_chunk_table(spark):
    assert not chunk_table.table_exists(spark, "test_chunks")
    df = spark.createDataFrame([(2, "# b\nx"), (1, "# a\ny\n# c\nz")], "doc_id BIGINT, text STRING")
    now = datetime(2024, 1, 1, 20, 0)
    for _ in range(2):
        chunk_table.write_chunks(df.transform(chunk_by_heading), "test_chunks", now, shared_dir(spark, "test_chunks"))
    rows = chunk_table.read_chunks(spark, "test_chunks").collect()
    assert chunk_table.table_exists(spark, "test_chunks")
    assert [(r.id, r.content, r.headers) for r in rows] == [
        (1_000_000, "y", {"Header 1": "a"}),
        (1_000_001, "z", {"Header 1": "c"}),
        (2_000_000, "x", {"Header 1": "b"}),
    ]
    assert rows[0].created_at == datetime(2024, 1, 2, 5, 0)
    spark.sql("DROP TABLE test_chunks")


PAYLOADS = [
    ('{"dataframe_split": {"columns": ["a", "query"], "data": [["1", "q1"], ["2", "q2"]]}}', ["q1", "q2"]),
    ('{"dataframe_split": {"columns": ["a"], "data": [["1"]]}}', []),
    ('{"inputs": {"query": ["q1", "q\\n2"]}}', ["q1", "q\n2"]),
    ('{"inputs": {"query": "q1"}}', ["q1"]),
    ('{"inputs": [{"query": "q1"}, {"query": "q2"}, {"x": "y"}]}', ["q1", "q2"]),
    ('{"other": 1}', []),
    ("not json", []),
]


@pytest.mark.parametrize("text, expected", PAYLOADS)
def test_payload(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "request_id BIGINT, payload STRING")
    assert [r.query for r in payload.decode_payload(df).orderBy("pos").collect()] == expected


def test_payload_round_trip(spark):
    df = spark.createDataFrame([('say "x"\n가',)], "query STRING")
    for encode in (payload.encode_split, payload.encode_inputs):
        assert payload.decode_payload(df.select(encode(F.col("query")).alias("payload"))).first().query == 'say "x"\n가'


def test_responses(spark):
    rows = [(1, '{"result": {"data_array": [["a", "b"], ["c", "d"]]}}'), (2, "{}")]
    got = payload.data_array(spark.createDataFrame(rows, "qid INT, response STRING")).collect()
    assert [(r.qid, r.hit) for r in got] == [(1, ["a", "b"]), (1, ["c", "d"]), (2, None)]
    df = spark.createDataFrame([('{"predictions": ["x", "y"]}',), ('{"predictions": []}',), ("{}",)], "r STRING")
    assert [r[0] for r in df.select(payload.first_prediction(F.col("r"))).collect()] == ["x", None, None]


def test_markdown_takes_linear_time(spark):
    import time

    units = ["<!--", "<script>", "<style ", "<p ", "<h1", "</article", "<", "<article>", "&#", "&#1;", "-->", "<br"]
    bare = spark.createDataFrame([(unit * 60_000,) for unit in units], "html STRING")
    inside = spark.createDataFrame([(f"<article>{unit * 60_000}</article>",) for unit in units], "html STRING")
    start = time.time()
    bare.select(to_markdown(F.col("html"))).collect()
    assert inside.filter(flat_element(F.col("html"), "article").isNotNull()).count() == len(units)
    assert time.time() - start < 60


def test_character_references(spark):
    html = "a&#8217;b &#x1F600;&#X2014; &mdash; &hellip; &amp;#39; &#0; &#xD800; &#9999999; &#39;&nbsp;."
    got = spark.createDataFrame([(html,)], "h STRING").select(to_markdown(F.col("h"))).first()[0]
    assert got == "a\u2019b \U0001f600\u2014 \u2014 \u2026 &#39; &#0; &#xD800; &#9999999; ' ."


def test_markdown_of_an_element_chosen_by_attribute(spark):
    html = '<div>x</div><div itemprop="articleBody"><h2>T</h2><div>in</div></div>'
    df = spark.createDataFrame([(1, "u", html)], "page_id INT, url STRING, html STRING")
    assert pages.html_to_markdown(df, "div", "itemprop", "articleBody").first().md == "## T\n\nin"
