"""Small tables that the tests of this folder share."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard int, key string, run int, base string"


def frame(spark, texts, partitions=3):
    """Documents from (doc_id, text) pairs or texts alone, with further columns whose names operators use inside."""
    rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
    full = [
        (i, t, ("en", "de", None)[n % 3], (None, "a", "b")[n % 3], len(t or ""), "x", 1, "k", 2, "b")
        for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def odd_texts():
    """Nulls, empty and white texts, ties, repeated rows and ids, a long text."""
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (4, "another text under the same id"), (None, "no id here"), (None, None),
        (5, "Tie. Tie.\nTie."), (6, "Tie. Tie.\nTie."), (7, "word " * 3000), (8, "x" * 20_000), (9, "\x00a\x0bb\x85c d \U0001f600!"), (-1, "eins zwei drei"),
    ]


def syllables(seed: int, n: int, words: int = 60) -> list[str]:
    """Made-up prose with repeated passages and near copies."""
    rng = random.Random(seed)
    parts = "an the in er on re st en de la que ing ion".split()
    vocabulary = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    out = []
    for i in range(n):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(5, words)))
        if i % 5 == 0:
            text += ". " + passage
        if i % 7 == 3 and out:
            text = out[rng.randrange(len(out))].replace("the", "The", 1)
        if i % 11 == 5 and out:
            text = out[rng.randrange(len(out))]
        out.append(text)
    return out
