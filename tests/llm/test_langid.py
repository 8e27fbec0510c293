import numpy as np
import pytest

from groundline.llm.common import id_remainder
from groundline.llm.langid import ORDER, SPACE, keys, normal, predict, train
from tests.llm.data import frame, odd_texts


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def model(table):
    return train(table.filter(id_remainder("doc_id", 3) != 1))


def test_probabilities_sum_to_one(model):
    """Over the alphabet and one unknown character, after known and unknown contexts."""
    letters = [int(k) for k in range(256) if model.grams[0].find(keys([np.array([k], dtype=np.uint64)]))[1][0]]
    assert len(letters) > 20
    others = len(model.grams[0].keys) - len(letters)
    for context in ("the", "qqq", " a "):
        rows = [np.array([*map(ord, context), c], dtype=np.uint64) for c in letters]
        p = np.exp(np.concatenate([model.log_probabilities(r) for r in rows])).sum(axis=0)
        assert ((p > 0.9) & (p < 1.001)).all() or others


def test_normal():
    assert "".join(map(chr, normal("  Äb--3 C\n"))) == " " * (ORDER - 1) + "äb c " + " "
    assert set(normal(None)) == {SPACE} and len(normal("")) == ORDER


def test_held_out_accuracy(spark, table, model):
    held = table.filter(id_remainder("doc_id", 3) == 1)
    rows = predict(held, model).join(held.select("doc_id", "lang", "text"), "doc_id").collect()
    right = [r.lang_pred == r.lang for r in rows if len(r.text) > 60]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts(spark, model):
    docs = frame(spark, odd_texts())
    rows = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in predict(docs, model).collect() if r.doc_id in (1, 2, 3, 7)}
    assert rows == {(1, True, True), (2, True, True), (3, True, True), (7, False, False)}
    strange = predict(frame(spark, ["добрый день " * 20]), model).first()
    assert strange.rejected and strange.lang_pred in model.languages


def test_texts_are_scored_alike_alone_and_together(model):
    texts = ["the and of", None, "de la que el", "x" * 50, ""]
    together, _ = model.cross_entropies(texts)
    for i, text in enumerate(texts):
        assert np.allclose(model.cross_entropies([text])[0][0], together[i])


def test_long_texts_in_steps(model, monkeypatch):
    from groundline.llm import langid

    text = "the and of that with " * 50
    once = model.cross_entropies([text])[0]
    monkeypatch.setattr(langid, "STEP", 64)
    assert np.allclose(model.cross_entropies([text])[0], once, atol=1e-5)


def test_no_rows_and_no_labels(spark):
    docs = frame(spark, [(1, "abc")])
    empty = train(docs.filter("doc_id > 1"))
    assert empty.languages == [] and predict(docs, empty).first().lang_pred == "und"
    assert predict(docs.filter("doc_id > 1"), empty).collect() == []


@pytest.mark.parametrize("only", range(100, 109))  # whatever its hash says
def test_a_language_of_one_document_is_learned(spark, only):
    rows = [(i, "the cat sat on the mat and looked " * 3, "en") for i in range(3)] + [(only, "das ist ein kurzer Satz über Bäume", "de")]
    assert train(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == ["de", "en"]
