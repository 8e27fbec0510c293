import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from groundline.llm import token_counts
from groundline.llm.bpe import Bpe
from groundline.llm.token_counts import Counter, pieces, with_token_count
from tests.llm.data import frame, odd_texts, syllables

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(PATH)


def n_of(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def one_by_one(counter, word):
    """Merges without heap or list: the lowest rank, leftmost of equals, searched anew each time."""
    data = word.encode()
    symbols = [int(counter.inside[b]) for b in data[:-1]] + [int(counter.at_end[data[-1]])]
    while True:
        ranked = [(found[0], i, found[1]) for i in range(len(symbols) - 1) if (found := counter.merges.get(symbols[i] << 32 | symbols[i + 1]))]
        if not ranked:
            return len(symbols)
        _, i, new = min(ranked)
        symbols[i : i + 2] = [new]


def test_heap_merges_as_a_plain_loop(counter):
    rng = random.Random(4)
    for _ in range(1500):
        word = "".join(rng.choices("aeinrstlo'éß日", k=rng.randint(1, 40)))
        assert counter.merged(word) == one_by_one(counter, word)


def test_random_texts(counter, library):
    rng = random.Random(2)
    parts = list("abcxyzAB12'sd <>|/.,!?-\t\n\x00\x1c\x85_") + [
        "Σ", "σς", "İ", "ß", "é", "é", "ñ", "٣", " ", "​", "日本", "한국", "\U0001f44d\U0001f3fd", "­", "՘",
        "Ａ", "Ᲊ", "<|startoftext|>", "<|endoftext|>", "</w>", "'re", "ing", "a" * 50, "ab" * 40,
    ]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        assert counter.count(text) == n_of(library, text), repr(text)


def test_every_code_point(counter, library):
    """Counts, and the ids of the encoder that shares the words."""
    codes = [*range(0xD800), *range(0xE000, 0x32400), *range(0xE0000, 0xE0200), 0xF0000, 0x10FFFD]
    texts = [f"x{chr(c)}Y {chr(c)}{chr(c)}1" for c in codes]
    bpe = Bpe(PATH)
    for start in range(0, len(texts), 10_000):
        some = texts[start : start + 10_000]
        for text, found in zip(some, library.encode_batch_fast(some, add_special_tokens=False)):
            assert counter.count(text) == len(found.ids), repr(text)
            assert bpe.encode(text).tolist() == found.ids, repr(text)


def test_long_words_and_texts(counter, library, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE", 100)
    for text in ("abcdefgh" * 3000, "a" * 30_001, "!" * 5000, "Ärger über die Bäume\n" * 500, " " * 999 + "x"):
        assert "".join(pieces(text)) == text
        assert counter.count(text) == n_of(library, text)


def test_remembered_words_stay_bounded(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN_WORDS", 10)
    before = counter.count(" ".join(f"w{i}ord" for i in range(100)))
    assert len(counter.known) <= 10
    assert counter.count(" ".join(f"w{i}ord" for i in range(100))) == before


def test_documents(spark, library, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.union(frame(spark, odd_texts() + syllables(7, 20)).select("doc_id", "text"))
    for r in with_token_count(docs.withColumn("copy", F.col("text")), PATH).collect():
        assert r.n_tokens == n_of(library, r.copy)


def test_clashing_names_and_no_rows(spark):
    rows = frame(spark, [(1, "one two"), (1, "one two"), (2, None)]).withColumn("n_tokens", F.lit("x")).withColumn("batch", F.lit(1))
    found = with_token_count(rows, PATH)
    assert found.columns == [c for c in rows.columns if c not in ("text", "n_tokens")] + ["n_tokens"]
    assert sorted(r.n_tokens for r in found.collect()) == [0, 2, 2]
    assert with_token_count(rows.filter("doc_id > 5"), PATH).collect() == []
