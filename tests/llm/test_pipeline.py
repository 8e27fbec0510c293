import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from groundline.llm.common import stored
from groundline.llm.simhash import fingerprint
from tests.llm.data import frame, odd_texts
from tests.llm.test_pii import spans
from tests.llm.test_simhash import roots

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    """The documents and what each stage makes of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir), "test-stage"))
    return out


def test_order_and_columns(results):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "personal data", "mix", "tokens"]
    assert all(df.columns == results[0].columns for df in results[:-1])


def test_quality_rules_keep_rows_as_they_are(results):
    before, after = (Counter(map(tuple, df.collect())) for df in results[:2])
    assert 0 < after.total() < before.total() and after <= before
    for _, text, *_ in after:
        assert len(re.findall(WORD, text)) >= 50


def test_one_document_of_each_class(results):
    rows = results[1].collect()
    prints = [fingerprint(r.text) for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if ((prints[i] ^ prints[j]) & ((1 << 64) - 1)).bit_count() <= 2]
    of = roots(range(len(rows)), near)
    least = {}
    for n, root in of.items():
        least[root] = min(least.get(root, rows[n].doc_id), rows[n].doc_id)
    assert sorted(r.doc_id for r in results[2].collect()) == sorted(least.values())


def test_personal_data_is_gone_and_the_rest_stays(results):
    before = {r.doc_id: r.text for r in results[2].collect()}
    after = {r.doc_id: r for r in results[3].collect()}
    assert before.keys() == after.keys()
    touched = 0
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        if spans(before[i]):
            touched += 1
            assert not {v for *_, v in spans(before[i])} & {v for *_, v in spans(r.text)} and re.search("<(EMAIL|IP|CARD|PHONE)>", r.text)
        elif "<REMOVED>" not in r.text:
            assert r.text == before[i]
    assert touched


def test_mix(results):
    before = {r.doc_id: r for r in results[3].collect()}
    size = lambda text: len(re.findall(WORD, text))
    taken = Counter()
    for r in results[4].collect():
        assert r.text in before[r.doc_id].text and r.n_chars == len(r.text) and r.source == before[r.doc_id].source
        taken[r.doc_id] += size(r.text)
    assert all(n <= 2 * size(before[i].text) for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(size(r.text) for r in before.values()), rel=0.01)


def test_tokens(results):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in results[4].collect())
    rows = results[5].collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == expected
    assert all(r.n_tokens == len(r.ids) and r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in rows)


def test_run_is_the_stages(spark, sf_dir, results):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.decoded) for r in rows) == Counter((r.doc_id, r.decoded) for r in results[5].collect())


def test_stages_over_odd_rows_with_more_columns_and_over_none(spark, sf_dir):
    docs = frame(spark, odd_texts())
    for rows in (docs, docs.filter("doc_id > 100")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, sf_dir)
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= 2 * rows.count() + 40
