import random
import time

import duckdb
import pandas as pd
import pytest

from pyspark.sql import functions as F

from groundline.functions import cleaning as c
from groundline.plans.oracle import _clean_ctes


def run(spark, fn, text):
    return spark.createDataFrame([(text,)], "x STRING").select(fn(F.col("x"))).first()[0]


def pages_steps(col):
    return c.join_pages(c.remove_references(c.remove_footnotes(c.split_pages(col))))


GOLDEN = [
    (c.drop_syntax_error_lines, "a\nMuPDF syntax error: x\nb", "a\nb"),
    (c.drop_syntax_error_lines, "a\r syntax error\nb", "b"),
    (c.drop_syntax_error_lines, "a\nx syntax error", "a\n"),
    (c.drop_syntax_error_lines, "Syntax Error stays", "Syntax Error stays"),
    (pages_steps, "p1 [1)] x\n1) note\nmore\n-----\n p2 ", "p1  x\n\n-----\np2"),
    (pages_steps, "a (123) b) c", "a (123) b) c".split("123")[0].strip()),
    (c.control_to_space, "a\x01b", "a b"),
    (c.fold_deep_heading, "#### a ##### b", "# a ## b"),
    (c.fold_deep_heading, "#########", "###"),
    (c.numbered_lines_to_headings, "1. a\nx 2. b\n12. c", "## 1. a\nx 2. b\n## 12. c"),
    (c.numbered_lines_to_headings, "x\r3. y", "x\r3. y"),
    (c.boxed_lines_to_headings, "□ a\nb □", "###  a\nb □"),
    (c.rewrite_symbols, "ㅇa→b ’24 ☞c", "- a 에서 b 2024 - c"),
    (c.rewrite_symbols, "don’t", "don20t"),
    (c.delete_characters, "**a** [b] ▲「c」", "a b c"),
    (c.drop_comma_parentheses, "x (A, 2020) y (SW) z (a (b, c))", "x  y (SW) z (a )"),
    (c.drop_page_breaks, "a------b", "a-b"),
    (c.drop_blank_line_pairs, "# T\n\nBody\n\n\nb", "# TBody\nb"),
    (c.fold_double_spaces, "a    b", "a  b"),
    (c.break_before_headings, "a## b", "a\n\n## b"),
    (c.repair_c_sharp, "C\n\n# and ABC\n# T", "C# and ABC# T"),
    (c.repair_c_sharp, "C \x1c# x", "C# x"),
    (c.break_before_list_items, " x - a-  b ", "x \n\n- a-  b"),
    (c.break_before_list_items, "\x1c　a - ", "a -"),
    (c.break_before_list_items, "- - x", "\n\n- \n\n- x"),
    (c.break_before_table_labels, "a 표 1 b", "a \n\n표 1 b"),
    (c.break_after_table_labels, "표 1 t |a|b|", "표 1 t \n\n|a|b|"),
    (c.break_after_table_labels, "표 1 t\n|a|", "표 1 t\n|a|"),
    (c.drop_side_notes, "a※n\nm­ b ※ open", "a\n b ※ open"),
    (c.drop_side_notes, "no note", "no note"),
    (c.drop_side_notes, "a­※b­※", "a­\n※"),
]


@pytest.mark.parametrize("step, text, expected", GOLDEN, ids=lambda v: getattr(v, "__name__", None))
def test_golden(spark, step, text, expected):
    assert run(spark, step, text) == expected


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "x STRING")
    assert df.select(c.clean_text(F.col("x"))).first()[0] is None


def test_footnotes_anchored(spark):
    text = "see item 3) here\n3) note\nrest"
    cut = lambda anchored: lambda x: c.join_pages(c.remove_footnotes(c.split_pages(x), anchored))
    assert run(spark, cut(False), text) == "see item"
    assert run(spark, cut(True), text) == "see item 3) here"


def test_step_count_and_chain(spark):
    assert len(c.STEPS) == 21
    df = spark.createDataFrame([("1. a\n□ b",)], "text STRING").transform(c.clean)
    assert df.first().text == "## 1. a\n\n\n### b"


LONG = 60_000
HOSTILE = {
    "digits": "7" * LONG,
    "open parenthesis and commas": "(" + "a," * LONG,
    "spaces": "x" + " " * LONG + "x",
    "side notes never closed": "※a" * LONG,
    "long line": "word " * LONG,
    "many lines": "3) line\n" * LONG,
    "hashes": "#" * LONG,
    "table labels": "표 1 " * LONG,
    "table labels and bars": "표 1 |" * LONG,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_long_runs_take_linear_time(spark, name):
    start = time.time()
    run(spark, c.clean_text, HOSTILE[name])
    assert time.time() - start < 10


PIECES = [
    "#", "##", "####", "-", "- ", "-----", "\n", "\n\n", "\r", " ", "  ", "\t", "\x01", "\x1c", "\x85", "\u3000", "\u00ad",
    "1. ", "12) ", "٣) ", "[3)]", "[", "]", "*", "(", ")", ",", "C", "C #", "표 1", "표 ٢", "|", "※", "□", "ㅇ", "→", "’", "☞",
    "▲", "「", "」", "syntax error", "word", "가나", "é", "7",
]


def test_random_texts_equal_sql(spark):
    """Every step, and the chain, on random mixtures of what the steps look for."""
    rng = random.Random(11)
    rows = [(i, "".join(rng.choices(PIECES, k=rng.randint(1, 40)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id INT, md STRING").cache()
    connection = duckdb.connect()
    connection.register("random_texts", pd.DataFrame(rows, columns=["doc_id", "md"]))
    for last in (1, 5, 8, 12, 16, 17, 18, 20, len(c.STEPS)):
        got = {r[0]: r[1] for r in df.select("doc_id", c.clean_through(F.col("md"), last)).collect()}
        ctes = ", ".join(_clean_ctes("random_texts", last))
        expected = dict(connection.execute(f"WITH {ctes} SELECT doc_id, x FROM cleaned").fetchall())
        wrong = [(dict(rows)[i], got[i], expected[i]) for i in got if got[i] != expected[i]]
        assert not wrong, wrong[:3]
