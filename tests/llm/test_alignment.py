import random
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from groundline.llm import alignment
from groundline.llm.alignment import ROW, Tokenizers, align, aligned, link_sums, pair_counts
from groundline.llm.pretokens import byte_characters
from tests.llm.data import frame, odd_texts, syllables

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    " leading", "trailing ", "two  spaces", "tab\t x", "\n\n", " ", "a b", "x y z", "w ́x", "a ​ b", "▁ mark", "a ▁b",
    "<|endoftext|> and <s> </s> <0x0A>", "日本 語 한국", "don't 's 12 345 !! ?", "é ﬁ Ａ", "\x00 \x85 x", "a" * 3000, "ab " * 2000, "\U0001f44d \U0001f3fd",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def by_hand(libraries, text):
    """Ids, groups and links of one text, token by token."""
    a, b = libraries
    byte = {c: i for i, c in enumerate(byte_characters())}
    if not text:
        return [], [], "", []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(byte[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if any(b"".join(x) != (" " + text).encode() for x in (a_bytes, b_bytes)):
        return [], [], "", []
    groups, links, run, i, j, at_a, at_b = [], [], ([], []), 0, 0, 0, 0
    while i < len(a_ids):
        links.append((a_ids[i], b_ids[j]))
        end_a, end_b = at_a + len(a_bytes[i]), at_b + len(b_bytes[j])
        if end_a <= end_b:
            run[0].append(str(a_ids[i]))
            i, at_a = i + 1, end_a
        if end_b <= end_a:
            run[1].append(str(b_ids[j]))
            j, at_b = j + 1, end_b
        if end_a == end_b:
            groups.append(",".join(run[0]) + "|" + ",".join(run[1]))
            run = ([], [])
    return a_ids, b_ids, ";".join(groups), links


def check(libraries, texts, found):
    for i, text in enumerate(texts):
        a_ids, b_ids, groups, links = by_hand(libraries, text)
        assert found["a_ids"][i].as_py() == a_ids and found["b_ids"][i].as_py() == b_ids, repr(text)
        assert found["groups"][i].as_py() == groups, repr(text)
        assert found["pairs"][i].as_py() == [a << 32 | b for a, b in links], repr(text)
        assert (found["n_a"][i].as_py(), found["n_b"][i].as_py()) == (len(a_ids), len(b_ids))


def test_against_the_libraries(libraries):
    rng = random.Random(3)
    parts = list("abcAB12'sd <>|/.,!?-\t\n\x00\x85_   ") + ["é", "é", "ß", "日本", " ", " ", "▁", "the", " the", " and ", "ing ", "\U0001f44d"]
    texts = [None, "", *ODD, *syllables(2, 40), *("".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(1500))]
    both = Tokenizers(A_PATH, B_PATH)
    assert both.cuts
    check(libraries, texts, aligned(both, pa.array(texts, pa.string())))
    check(libraries, texts[:300], aligned(both, pa.array(texts[:300], pa.string())))  # from memory
    both.cuts = False  # whole texts, as for a vocabulary whose pieces reach over spaces
    both.forget()
    check(libraries, texts[:400], aligned(both, pa.array(texts[:400], pa.string())))
    check(libraries, [None, ""], aligned(both, pa.array([None, ""], pa.string())))


def test_memory_starts_anew(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_CHUNKS", 50)
    both, texts = Tokenizers(A_PATH, B_PATH), syllables(5, 30)
    for text in texts:
        check(libraries, [text], aligned(both, pa.array([text])))


@pytest.mark.parametrize("bound", [1, 5, 1 << 16])
def test_counts_over_all_documents(spark, libraries, bound, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_PAIRS", 100)
    texts = [t for _, t in odd_texts()] + syllables(9, 60) + ODD
    docs = frame(spark, texts).withColumn(ROW, F.col("doc_id"))
    found = align(docs, A_PATH, B_PATH, outputs=("n_a", "pairs")).cache()
    counts = pair_counts(found).cache()
    links = {i: by_hand(libraries, t)[3] for i, t in enumerate(texts)}
    total = Counter(link for own in links.values() for link in own)
    highest = Counter()
    for (_, b), n in total.items():
        highest[b] = max(highest[b], n)
    assert {(r.pair >> 32, r.pair & 0xFFFFFFFF): (r.n, r.best) for r in counts.collect()} == {k: (n, n == highest[k[1]]) for k, n in total.items()}
    rows = {r[ROW]: (r.n_best, r.count_sum) for r in link_sums(found, counts, bound).collect()}
    assert rows == {i: (sum(total[x] == highest[x[1]] for x in own), sum(total[x] for x in own)) for i, own in links.items()}


def test_frequent_pairs_are_bounded(spark):
    counts = spark.createDataFrame([(i, n, True) for i, n in enumerate([50, 30, 5, 5, 5, 5])], "pair long, n long, best boolean")
    frequent, least = alignment.frequent_pairs(counts, 4)
    assert frequent["pair"].to_pylist() == [0, 1] and least == 25
    assert alignment.frequent_pairs(counts.filter("n > 99"), 4)[0].num_rows == 0


def test_clashing_names_and_no_rows(spark):
    rows = frame(spark, [(1, "one two"), (1, "one two"), (None, None)]).withColumn("pairs", F.lit("x")).withColumn("doc", F.lit(1))
    found = align(rows, A_PATH, B_PATH)
    assert found.columns == [c for c in rows.columns if c not in ("text", "pairs")] + list(alignment.KINDS)
    assert sorted(r.n_a for r in found.collect()) == [0, 2, 2]
    none = align(rows.filter("doc_id > 5").withColumn(ROW, F.col("doc_id")), A_PATH, B_PATH)
    assert none.collect() == [] and link_sums(none, pair_counts(none)).collect() == []
