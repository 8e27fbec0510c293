"""Nested elements against the standard library's parser, and pages made to be slow."""

import random
import time
from html.parser import HTMLParser

import pytest

from pyspark.sql import functions as F

from groundline.functions.html import VOID_ELEMENTS, nested_element
from groundline.plans.queries import QUERIES
from tests.test_plans import plan


class First(HTMLParser):
    """Where the first element with a tag and attribute lies, as the standard library reads the page."""

    def __init__(self, page, tag, attr, value):
        super().__init__()
        self.page, self.wanted, self.depth, self.first, self.last = page, (tag, attr, value), 0, None, None
        self.lines = [0]
        for line in page.split("\n"):
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.feed(page)
        self.close()

    def at(self):
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        wanted, attr, value = self.wanted
        if tag != wanted or self.last is not None:
            return
        if self.depth:
            self.depth += 1
        elif attr is None or dict(attrs).get(attr) == value:
            self.first, self.depth = self.at(), 1
            if tag in VOID_ELEMENTS:
                self.depth, self.last = 0, self.first + len(self.get_starttag_text())

    def handle_startendtag(self, tag, attrs):
        if not self.depth:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == self.wanted[0] and self.depth and self.last is None:
            self.depth -= 1
            if not self.depth:
                self.last = self.page.find(">", self.at()) + 1

    def text(self):
        return None if self.first is None else self.page[self.first : self.last].strip()


def extract(spark, pages, *asked):
    rows = spark.createDataFrame(list(enumerate(pages)), "i INT, html STRING")
    return [r[1] for r in sorted(rows.select("i", nested_element(F.col("html"), *asked)).collect())]


def random_page(rng: random.Random) -> str:
    parts = [
        "<div>", "</div>", "<DIV class='ad'>", '<div id=x class="ad" >', "<div class=ad>", "<div class = 'ad'\n>", '<div class="ad wide">',
        "<div data-class='ad'>", "<div title='a>b' class='ad'>", '<div title="<div>" id=\'q\'>', "<div/>", "<div class=ad id=y>", "<divx class=ad>",
        "<!-- <div class='ad'> -->", "<script>'<div class=\"ad\">' </div></script>", "<style>a > b { }</style>", "<!DOCTYPE html>",
        "<p>text</p>", "a < b", "x > y", "é \U0001f600", "\n", "  ", "<br>", "<br/>", "</p >", "</div >", "it's \"quoted\"", "<ul><li>",
    ]
    return "".join(rng.choices(parts, k=rng.randint(0, 25)))


@pytest.mark.parametrize("asked", [("div", "class", "ad"), ("div", None, None), ("br", None, None), ("p", None, None)])
def test_random_pages(spark, asked):
    rng = random.Random(str(asked))
    pages = [random_page(rng) for _ in range(800)]
    for page, found in zip(pages, extract(spark, pages, *asked)):
        assert found == First(page, *asked).text(), page


CASES = [
    ("<!--> <div class=ad>a</div>", "<div class=ad>a</div>"),  # an empty comment
    ("<!-- never closed <div class=ad>a</div>", None),
    ("<script> never closed <div class=ad>a</div>", None),
    ("<SCRIPT src='a'>x</script ><div class=ad>a</div>", "<div class=ad>a</div>"),
    ("<div class=ad", None),
    ("<div class='ad><div class=ad>a</div>", None),  # the value reaches to the end
    ("<div class=\"ad\"id=1>a</div>", '<div class="ad"id=1>a</div>'),
    ("<div id='1'class=ad>a</div>", "<div id='1'class=ad>a</div>"),
    ("<div class=ads>a</div><div xclass=ad>b</div><div class='ad '>c</div>", None),
    ("<div class=ad>a<div><div></div>", "<div class=ad>a<div><div></div>"),
    ("<div class=ad>" + "<div>" * 500 + "x" + "</div>" * 501 + "y", "<div class=ad>" + "<div>" * 500 + "x" + "</div>" * 501),
    ("\U0001f600<div class=ad>\U0001f600</div>\U0001f600", "<div class=ad>\U0001f600</div>"),
    ("", None),
    (None, None),
]


def test_cases(spark):
    for (page, expected), found in zip(CASES, extract(spark, [p for p, _ in CASES], "div", "class", "ad")):
        assert found == expected, page


def test_values_are_plain_text(spark):
    page = "<div class='a.b'>1</div><div class='a+b'>2</div><div class=a+b>3</div>"
    assert extract(spark, [page], "div", "class", "a+b") == ["<div class='a+b'>2</div>"]
    assert extract(spark, ["<div class='axb'></div>"], "div", "class", "a.b") == [None]
    with pytest.raises(ValueError, match="quote"):
        nested_element(F.col("html"), "div", "class", 'a"b')


OPENERS = ["<!--", "<div ", "<div class='ad'>", "<![CDATA[", "<script>", '<div a="', "<a b='", "<", '="', "</div", "</", ">", "-->", "<!", "'", "<div class=ad ", "=  ", "<div>", "a"]


@pytest.mark.parametrize("opener", OPENERS)
def test_pages_made_to_be_slow(spark, opener):
    """One megabyte of what is opened and never closed."""
    rows = spark.createDataFrame([(opener * (1_000_000 // len(opener)),)], "html STRING")
    start = time.time()
    rows.select(nested_element(F.col("html"), "div", "class", "ad")).collect()
    assert time.time() - start < 10


def test_no_python(spark, sf_dir):
    text = plan(QUERIES["article_nested"](spark, sf_dir))
    assert "Python" not in text.replace("PythonRDD", "") and "Arrow" not in text
