import re
from collections import Counter

import pytest

from pyspark.sql import functions as F

from groundline.llm.quality import Condition, learn, learn_from, statistics, verdict, with_verdict
from tests.llm.data import frame, odd_texts, syllables


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed, len(set(words)),
    )


@pytest.mark.parametrize(
    "texts", [odd_texts(), syllables(9, 60), ["a b c a b c", "a b a b a b a", "x\ny\nx\n\n\nx y", "# $ | < a\x0bb", " lead\n trail \n lead"]]
)
def test_statistics(spark, texts):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    got = statistics(frame(spark, texts)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_distinct"
    )
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted((str(i), *by_hand(t)) for i, t in rows)


def labelled(spark, good, n=900):
    rows = [(i, 60 + i % 200, 5 * (60 + i % 200), i % 7, 0, 0, 40 + i % 100) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_distinct long")
    return df.withColumn("good", F.expr(good))


def test_learns_a_planted_conjunction(spark):
    rows = labelled(spark, "NOT (n_words < 120 AND 1000 * n_symbols DIV n_words >= 40)")
    rules = learn(rows)
    assert rules and rows.filter(verdict(rules) != F.col("good")).count() <= 0.03 * 900
    assert rows.filter(F.col("good") & ~verdict(rules)).count() <= 0.01 * 900


def test_nothing_to_learn(spark):
    assert learn(labelled(spark, "true")) == [] and learn(labelled(spark, "CAST(NULL AS boolean)")) == []
    assert learn(labelled(spark, "pmod(hash(doc_id), 2) = 0")) == []  # labels that follow nothing
    assert verdict([])._jc.toString() == "true"


def test_ordered_expression(spark):
    rules = [(Condition("n_words", False, 5),), (Condition("n_words", True, 9), Condition("symbol_rate", True, 100))]
    df = statistics(frame(spark, ["a b", "a b c d e f g h i #", "a b c d e f"])).orderBy("doc_id")
    assert [r[0] for r in df.select(verdict(rules)).collect()] == [False, False, True]


def test_table(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    stats = statistics(docs)
    judged = with_verdict(stats, learn_from(stats, labels))
    rows = judged.join(labels, "doc_id").collect()
    assert judged.count() == docs.count()
    assert all(r.kept or r.base_failed for r in rows if r.quality == 1)  # clean documents stay
    assert judged.filter("kept AND base_failed").count() == 0


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = with_verdict(statistics(frame(spark, ["a"])), [(Condition("n_words", True, 3),)])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_rows(spark):
    docs = frame(spark, [(1, "a")]).filter("doc_id > 1")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert with_verdict(statistics(docs), learn_from(statistics(docs), labels)).collect() == []
