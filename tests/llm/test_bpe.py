import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from groundline.llm.bpe import Bpe, Tokens, decode, encode
from tests.llm.data import frame, odd_texts, syllables

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENS = Tokens(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return Bpe(PATH)


def same(bpe, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    found = bpe.encode(text)
    assert list(found) == ids, repr(text)
    assert TOKENS.decode(found) == library.decode(ids, skip_special_tokens=False)


def test_random_texts(bpe, library):
    rng = random.Random(1)
    pieces = list("abcxyzAB12'sd <>|/.,!?-\t\n\x00\x1c\x85") + [
        "Σ", "σς", "İ", "ß", "é", "ñ", "٣", " ", "​", "日本", "한국", "\U0001f44d\U0001f3fd", "­",
        "Ａ", "<|startoftext|>", "<|endoftext|>", "</w>", "'re", "ing", "tion", "a" * 50, "ab" * 40,
    ]
    for _ in range(4000):
        same(bpe, library, "".join(rng.choices(pieces, k=rng.randint(0, 30))))


def test_long_words(bpe, library):
    for text in ("abcdefgh" * 3000, "a" * 30_001, "the" * 20_000, "!" * 5000):
        same(bpe, library, text)


def test_cuts_are_where_no_token_reaches(bpe):
    word = "xqzjvkthe\xe9\x00\x01"
    pieces = bpe.cut(word)
    assert "".join(pieces) == word and len(pieces) > 1
    assert not any(a[-1] + b[0] in bpe.inner for a, b in zip(pieces, pieces[1:]))


def test_documents(spark, library, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.union(frame(spark, odd_texts() + syllables(7, 20)).select("doc_id", "text"))
    ids = encode(docs.withColumn("copy", F.col("text")), PATH)
    for r in decode(ids.withColumn("again", F.col("ids")), PATH, "again", "decoded").collect():
        expected = library.encode(r.copy or "", add_special_tokens=False).ids
        assert r.ids == expected and r.decoded == library.decode(expected, skip_special_tokens=False)


def test_no_rows_and_missing_ids(spark):
    assert encode(frame(spark, [(1, "a")]).filter("doc_id > 1"), PATH).collect() == []
    rows = spark.createDataFrame([(1, None), (2, [320])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in decode(rows, PATH).collect()} == {1: "", 2: "a</w>"}
