import math
import random
import re
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from groundline.llm import pii
from tests.llm.data import frame, odd_texts

# The base patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        worth = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(worth) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def spans(text):
    return [(k, m.start(), m.end(), m.group()) for k in BASE for m in re.finditer(BASE[k], text or "") if valid(k, m.group())]


def random_texts(n):
    rng = random.Random(5)
    pieces = ["a", "b.c", "@", "@x.y", ".", "1.2.3.4", "256", "4111 1111 1111 1111", "+1 (2) 3456789", "-", " ", "_", "\U0001f600", "é", "5", "12", "+", "%", "a@b.c_d@e.f"]
    return ["".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(n)]


def test_base_spans(spark):
    texts = random_texts(3000) + [t for _, t in odd_texts()] + [
        "x@y", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "0001.2.3.255", "1.2.3.99999999999", "4111-1111-1111-1111", "4111  1111", "+49 (0) 30 123456 -",
    ]
    rows = frame(spark, texts).select("doc_id", "text", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect()
    for r in rows:
        assert [tuple(s) for s in r.s] == spans(r.text), repr(r.text)


@pytest.mark.parametrize("unit", ["a", "a.", "1", "1.", "1 ", "+1", "a@", "a@b.", "+1(", "1-", "@", "%+"])
def test_hostile_texts_take_linear_time(spark, unit):
    import time

    start = time.time()
    frame(spark, [unit * 60_000]).select(F.size(pii.base_spans(F.col("text")))).collect()
    assert time.time() - start < 20


def tokens(text):
    return [t for t in re.split(r"[^\w]+|_+", text.lower()) if len(t) >= pii.MIN_TERM]


def by_hand(texts):
    """Disclosing terms, counted in plain loops."""
    f_term, f_entity, f_both = defaultdict(int), defaultdict(set), defaultdict(set)
    for n, text in enumerate(texts):
        for t in set(tokens(text)):
            f_term[t] += 1
        for kind, a, b, value in spans(text):
            f_entity[kind, value].add(n)
            low = max(0, a - pii.CONTEXT - 1)
            left, right = text[low:a], text[b : b + pii.CONTEXT + 1]
            left = re.sub(r"^[^\W_]+", "", left) if low else left
            right = re.sub(r"[^\W_]+$", "", right) if len(right) > pii.CONTEXT else right
            for t in set(tokens(left + " " + right)):
                f_both[kind, value, t].add(n)
    out = set()
    for (kind, value, t), docs in f_both.items():
        f_e = len(f_entity[kind, value])
        information = math.log(len(texts) / f_e)
        if len(docs) >= pii.SUPPORT and information > 0:
            if math.log(len(texts) * len(docs) / (f_term[t] * f_e)) >= pii.THRESHOLD * information:
                out.add(t)
    return out


def corpus():
    rng = random.Random(8)
    common = "this that with from have will your about there which".split()
    texts = [" ".join(rng.choices(common, k=30)) for _ in range(120)]
    for i in (3, 40, 77):
        texts[i] += " Zebulon wrote from zed@example.org about it"
    for i in (5, 6):
        texts[i] += " +1 (555) 123-4567 Quillfeather this"
    texts[90] += " Zebulon alone"
    texts[91] += " single@example.org Hapaxword"
    return texts


def test_disclosing_terms(spark):
    texts = corpus()
    rows = pii.find(frame(spark, texts)).collect()
    listed = by_hand(texts)
    assert "zebulon" in listed and "quillfeather" in listed and not listed & set("this that with".split())
    for r in rows:
        inside = lambda m: any(s < m.end() and m.start() < e for _, s, e, _ in spans(r.text))
        expected = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", r.text) if m.group().lower() in listed and not inside(m)]
        assert [(s.start, s.end) for s in r.extra] == expected and [tuple(s) for s in r.base] == spans(r.text)
    assert {r.doc_id for r in rows if r.extra} == {3, 40, 77, 5, 6, 90}


def test_many_terms_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 0)
    assert {r.doc_id for r in pii.find(frame(spark, corpus())).collect() if r.extra} == {3, 40, 77, 5, 6, 90}


def test_sanitised(spark):
    text = "Mail a@b.cc or +1 (555) 123-4567, Zed \U0001f600 1.2.3.4"
    rows = frame(spark, [text]).withColumn("s", pii.base_spans(F.col("text")))
    assert rows.select(pii.sanitised(F.col("text"), F.col("s"))).first()[0] == "Mail <EMAIL> or <PHONE>, Zed \U0001f600 <IP>"


def test_odd_rows(spark):
    docs = frame(spark, odd_texts() + [(20, "a@b.cc near"), (20, "a@b.cc near"), (None, "a@b.cc near")])
    rows = pii.find(docs).collect()
    assert len(rows) == 17 and sum(len(r.base) for r in rows) == 3
    assert pii.find(docs.filter("doc_id > 100")).collect() == []


def test_no_python(spark):
    plan = pii.find(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
