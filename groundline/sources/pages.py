"""Web pages: sitemap expansion, crawl output, article extraction."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundline.functions import html as H
from groundline.functions.markdown import nested_markdown
from groundline.functions.text import present

PAGE_COLUMNS = ("page_id", "url", "html")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Crawl output `(page_id, url, html)`. With a `status` column, html is NULL unless it is 200."""
    pages = spark.read.parquet(path)
    if "status" in pages.columns:
        pages = pages.withColumn("html", F.when(F.col("status") == 200, F.col("html")))
    return pages.select(*PAGE_COLUMNS)


def sitemap_urls(sitemaps: DataFrame, max_documents: int | None = None, n_partitions: int = 10) -> DataFrame:
    """Every `loc` text of the sitemap rows `(sitemap_id, xml)`, spread over partitions for fetching.

    `max_documents` keeps the first that many in sitemap order.
    """
    urls = sitemaps.select("sitemap_id", F.posexplode(F.expr("xpath(xml, '//loc/text()')")).alias("pos", "url"))
    if max_documents:
        urls = urls.orderBy("sitemap_id", "pos").limit(max_documents)
    return urls.select("url").repartition(n_partitions)


def read_sitemap(spark: SparkSession, path: str, n_partitions: int = 10) -> DataFrame:
    """URLs of sitemap files of any size: the XML source splits a file at its `<url>` rows."""
    schema = T.StructType([T.StructField("loc", T.StringType())])
    entries = spark.read.format("xml").schema(schema).option("rowTag", "url").load(path)
    return entries.select(F.trim("loc").alias("url")).filter("url IS NOT NULL").repartition(n_partitions)


def extract_article(
    pages: DataFrame,
    tag: str = "div",
    attr: str | None = "itemprop",
    value: str | None = "articleBody",
    nested: bool = True,
) -> DataFrame:
    """Add `text`: the first matching element with its markup, NULL if absent or html is empty.

    `nested=False` is for tags that never contain themselves (such as `article`); it stays in the
    JVM and takes no attribute test.
    """
    if nested:
        return pages.withColumn("text", H.nested_element(F.col("html"), tag, attr, value))
    if attr is not None:
        raise ValueError("the flat form selects by tag only; pass attr=None")
    return pages.withColumn("text", H.flat_element(F.col("html"), tag))


def nonnull_articles(articles: DataFrame) -> DataFrame:
    """Keep `(url, text)` rows that have a text; raise if there is none.

    The check stops at the first row found. Nothing is cached: persist the result if it is reused.
    """
    kept = articles.select("url", present(F.col("text")).alias("text"))
    if kept.isEmpty():
        raise ValueError("no article text found; check the sitemap and the crawl")
    return kept


def html_to_markdown(
    pages: DataFrame, tag: str | None = "article", attr: str | None = None, value: str | None = None, nested: bool = False
) -> DataFrame:
    """`(page_id, md)`: the page's article as Markdown. Pages without one are left out.

    With `attr` and `value` the element is chosen by attribute and may nest in its own tag; `tag=None` takes whole pages.
    `nested` keeps the structure of lists, tables, quotes, code and links (see `functions/markdown.py`).
    """
    html = F.col("html")
    write = nested_markdown if nested else H.to_markdown
    if tag is None:
        return pages.filter("html <> ''").select("page_id", write(html).alias("md"))
    article = H.flat_element(html, tag) if attr is None else H.nested_element(html, tag, attr, value)
    return (
        pages.filter(F.col("html").isNotNull())
        .select("page_id", present(article).alias("article"))
        .select("page_id", write(F.col("article")).alias("md"))
    )
