"""Terms that disclose an entity from anywhere in its documents, against counting in plain loops."""

import math
import random
import re
from collections import defaultdict

from groundline.llm import pii
from tests.llm.data import frame
from tests.llm.test_pii import spans


def corpus():
    """A name in a header, an account name in a signature, short names in other scripts: all far from the entity."""
    rng = random.Random(9)
    common = "this that with from have will your about there which".split()
    prose = lambda: " ".join(rng.choices(common, k=60))
    texts = [prose() for _ in range(120)]
    for i in (3, 40, 77):
        texts[i] = f"Zebulon {prose()} zed@example.org {prose()} acct9917"
    for i in (5, 6):
        texts[i] = f"김 {prose()} +1 (555) 123-4567 {prose()} 王伟"
    texts[90] += " Zebulon alone 王伟"
    texts[91] += " single@example.org Hapaxword"
    texts[92] += " ab@cd.ef x@y.z"
    return texts


def tokens(text):
    return {t for t in re.split(r"[\W_]+", text.lower()) if len(t) >= 3 or re.search("[^\x00-ɏ]", t)}


def by_hand(texts):
    f_term, f_entity, f_both = defaultdict(int), defaultdict(int), defaultdict(int)
    for text in texts:
        rest = text
        for _, a, b, _ in sorted(spans(text), key=lambda s: -s[1]):
            rest = rest[:a] + " " + rest[b:]
        for t in tokens(text):
            f_term[t] += 1
        for entity in {(kind, value) for kind, _, _, value in spans(text)}:
            f_entity[entity] += 1
            for t in tokens(rest):
                f_both[entity, t] += 1
    n = len(texts)
    return {
        t for (e, t), f in f_both.items()
        if f >= 2 and f_entity[e] < n and math.log(n * f / (f_term[t] * f_entity[e])) >= 0.9 * math.log(n / f_entity[e])
    }


def listed(spark, texts):
    rows = pii.find(frame(spark, texts)).collect()
    return {r.text[s.start : s.end].lower() for r in rows for s in r.extra}, {r.doc_id for r in rows if r.extra}


def test_terms_far_from_an_entity_and_short_names(spark, monkeypatch):
    texts = corpus()
    expected = by_hand(texts)
    assert {"zebulon", "acct9917", "김", "王伟"} <= expected and "hapaxword" not in expected and "this" not in expected
    assert listed(spark, texts) == (expected, {3, 40, 77, 5, 6, 90})
    for limit in ("BROADCAST_TERMS", "BROADCAST_ROWS"):
        monkeypatch.setattr(pii, limit, 0)
    assert listed(spark, texts) == (expected, {3, 40, 77, 5, 6, 90})
