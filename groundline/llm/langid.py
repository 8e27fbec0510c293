"""Language identification with interpolated Kneser-Ney character models, one per language, in sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundline.llm.common import worker_memory

ORDER = 4
TRAIN_DOCS = 3000  # about so many documents of a language are learned from; one in five of them calibrates
UNKNOWN = "und"
STEP = 1 << 21  # characters scored at once
SPACE = 32

def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    memory = worker_memory()
    if "letters" not in memory:
        memory["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return memory["letters"]


def normal(text: str | None) -> np.ndarray:
    """Lower-case letters as code points, runs of anything else as one space; spaces in front fill the first contexts."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    points = np.where(letters()[points], points, SPACE) if len(points) else points
    space = points == SPACE
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    points = points[keep]
    return np.concatenate([np.full(ORDER - 1, SPACE), points, [SPACE]]).astype(np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads them (the finisher of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def keys(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit keys of n-grams given as columns of code points."""
    h = np.full(len(columns[0]), len(columns), dtype=np.uint64)
    for c in columns:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c)
    return h


@dataclass
class Table:
    """Sorted keys with a row of values per key, one for each language."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, values: np.ndarray) -> Table:
        order = np.argsort(hashes)
        return cls(hashes[order], values[order].astype(np.float32))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys, and which of them are there."""
        if not len(self.keys):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return at, self.keys[at] == hashes


@dataclass
class Model:
    """log P of each known n-gram and log of the weight that each known context gives to the next shorter one."""

    languages: list[str]
    grams: list[Table]  # by order, from 1
    weights: list[Table]  # by length of the context, from 1
    floor: float  # log P of a character that no language has
    scale: float = 1.0
    limits: np.ndarray | None = None  # by language: cross-entropy above which a text is rejected

    def log_probabilities(self, points: np.ndarray) -> np.ndarray:
        """log P of the characters from `ORDER - 1` on, given those before them: a row per character, a column per language."""
        n = len(points) - (ORDER - 1)
        out = np.zeros((n, len(self.languages)), dtype=np.float32)
        open_ = np.arange(n)
        for order in range(ORDER, 0, -1):
            columns = [points[open_ + (ORDER - order + j)] for j in range(order)]
            at, known = self.grams[order - 1].find(keys(columns))
            out[open_[known]] += self.grams[order - 1].values[at[known]]
            open_ = open_[~known]
            if not len(open_):
                return out
            if order > 1:
                at, known_context = self.weights[order - 2].find(keys([c[~known] for c in columns[:-1]]))
                out[open_[known_context]] += self.weights[order - 2].values[at[known_context]]
        out[open_] += self.floor
        return out

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text its mean -log P by language and its number of letters."""
        sums, counts, n_letters = np.zeros((len(texts), len(self.languages))), np.ones(len(texts)), np.zeros(len(texts), np.int64)
        held, owners, size = [], [], 0

        def flush():
            points = np.concatenate(held)
            logs = self.log_probabilities(points)
            start = 0
            for owner, piece in zip(owners, held):
                sums[owner] -= logs[start : start + len(piece) - (ORDER - 1)].sum(axis=0, dtype=np.float64)
                start += len(piece)

        for i, text in enumerate(texts):
            points = normal(text)
            n_letters[i] = np.count_nonzero(points != SPACE)
            counts[i] = len(points) - (ORDER - 1)
            for start in range(0, max(1, int(counts[i])), STEP):  # a very long text in pieces that share a context
                piece = points[start : start + STEP + ORDER - 1]
                held.append(piece)
                owners.append(i)
                size += len(piece)
                if size >= STEP and self.grams:
                    flush()
                    held, owners, size = [], [], 0
        if held and self.grams:
            flush()
        return sums / counts[:, None], n_letters


def _kneser_ney(grams: np.ndarray, counts: np.ndarray) -> Model:
    """A model from distinct n-grams of the highest order (rows of code points) and their counts by language."""
    n_languages = counts.shape[1]
    by_order: list[tuple[np.ndarray, np.ndarray]] = [(grams, counts.astype(np.float64))]
    for _ in range(ORDER - 1):  # the shorter ones count in how many longer ones they end
        longer, seen = by_order[0]
        shorter, owner = np.unique(longer[:, 1:], axis=0, return_inverse=True)
        sums = np.zeros((len(shorter), n_languages))
        np.add.at(sums, owner.ravel(), seen > 0)
        by_order.insert(0, (shorter, sums))
    alphabet = len(by_order[0][0]) + 1
    tables, weights = [], []
    lower: tuple[np.ndarray, np.ndarray] | None = None  # keys in order and P of the order below
    for order, (rows, seen) in enumerate(by_order, start=1):
        contexts, owner = np.unique(rows[:, :-1], axis=0, return_inverse=True) if order > 1 else (None, np.zeros(len(rows), int))
        owner = owner.ravel()
        ones, twos = (seen == 1).sum(axis=0), (seen == 2).sum(axis=0)
        discount = np.clip(np.where(ones + twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5), 0.05, 0.95)
        size = int(owner.max()) + 1 if len(owner) else 1
        total, kinds = np.zeros((size, n_languages)), np.zeros((size, n_languages))
        np.add.at(total, owner, seen)
        np.add.at(kinds, owner, seen > 0)
        backoff = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        if order == 1:
            below = np.full((len(rows), n_languages), 1.0 / alphabet)
            floor = float(np.log(backoff.min() / alphabet))
        else:
            at = np.searchsorted(lower[0], keys(list(rows[:, 1:].T)))
            below = lower[1][at]
            weights.append(Table.of(keys(list(contexts.T)), np.log(backoff)))
        p = np.maximum(seen - discount, 0) / np.maximum(total[owner], 1) + backoff[owner] * below
        hashes = keys(list(rows.T))
        order_ = np.argsort(hashes)
        lower = (hashes[order_], p[order_])
        tables.append(Table.of(hashes, np.log(p)))
    return Model([], tables, weights, floor)


def _count_grams(sample: DataFrame) -> DataFrame:
    """`(lang, gram, n)` of `sample(lang, text)`: the n-grams of highest order, counted per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(normal(text))
            for lang, held in texts.items():
                rows = np.concatenate([np.lib.stride_tricks.sliding_window_view(p, ORDER) for p in held])
                packed = np.ascontiguousarray(rows.astype(np.uint32)).view(f"V{4 * ORDER}").ravel()
                grams, counts = np.unique(packed, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), pa.array([g.tobytes() for g in grams], pa.binary()), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )

    return sample.mapInArrow(run, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, seed: int = 7) -> Model:
    """A model of the languages in `docs(doc_id, text, lang)`; rows without text or language teach nothing.

    About `train_docs` documents of each language, chosen by a hash of the id, are used whole: that bounds the model,
    which is sent to every task. Counts are summed in Spark. A fifth of these documents, never a language's only one, is left for calibration: the
    scale that turns differences of cross-entropy into probabilities has the highest likelihood there, and a text is
    rejected above the mean cross-entropy of its language's texts there plus six deviations from such means.
    """
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    turn = F.xxhash64("doc_id", F.lit(seed + 1))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(turn).alias("first")).withColumnRenamed("lang", "of")
    chance = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000))
    sample = (
        rows.join(F.broadcast(sizes), F.col("lang") == F.col("of"))  # a row per language
        .filter(chance < F.least(F.lit(1.0), train_docs / F.col("n")) * 1_000_000)
        .withColumn("calibrates", (F.pmod(turn, F.lit(5)) == 0) & (turn != F.col("first")))
    )
    grams = _count_grams(sample.filter("NOT calibrates").select("lang", "text")).toArrow()
    languages = sorted(set(grams.column("lang").to_pylist()))
    if not languages:
        return Model([], [], [], 0.0)
    points = np.frombuffer(b"".join(grams.column("gram").to_pylist()), dtype=np.uint32).reshape(-1, ORDER)
    kinds, owner = np.unique(points, axis=0, return_inverse=True)
    counts = np.zeros((len(kinds), len(languages)))
    column = np.searchsorted(languages, grams.column("lang").to_pylist())
    counts[owner.ravel(), column] = grams.column("n").to_numpy()
    model = _kneser_ney(kinds.astype(np.uint64), counts)
    model.languages = languages
    _calibrate(model, sample.filter("calibrates").select("lang", "text"))
    return model


def _calibrate(model: Model, sample: DataFrame) -> None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entropies, n = model.cross_entropies(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(entropies.tolist(), pa.list_(pa.float64())), pa.array(n)], names=["lang", "h", "n"]
            )

    found = [r for r in sample.mapInArrow(run, "lang string, h array<double>, n long").filter("n > 0").collect() if r["lang"] in model.languages]
    if not found:
        return
    h = np.array([r["h"] for r in found])
    truth = np.array([model.languages.index(r["lang"]) for r in found])
    best = (-np.inf, 1.0)
    for scale in 2.0 ** np.arange(-2, 7):
        z = -scale * (h - h.min(axis=1, keepdims=True))
        likelihood = float((z[np.arange(len(h)), truth] - np.log(np.exp(z).sum(axis=1))).mean())
        best = max(best, (likelihood, float(scale)))
    model.scale = best[1]
    own = h[np.arange(len(h)), truth]
    means = np.array([own[truth == i].mean() if (truth == i).any() else own.mean() for i in range(len(model.languages))])
    model.limits = means + 6 * np.sqrt(((own - means[truth]) ** 2).mean())


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`(doc_id, lang_pred, score, cross_entropy, rejected)` for every row of `docs`, from the whole text alone.

    The language of lowest cross-entropy per character; `score` is its calibrated probability among the languages.
    `rejected` says that the text is unlike all languages: a caller who wants a rejection as an answer takes it as
    `und`. A text that is missing or has no letter is `und` with score 0, as every text is without a trained language.
    Equal cross-entropies go to the first language in order. Map-only; repeated rows stay.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entropies, n = model.cross_entropies(batch.column(1).to_pylist())
            langs, scores, lowest, rejected = [], [], [], []
            for row, letters_ in zip(entropies, n):
                if not letters_ or not model.languages:
                    langs.append(UNKNOWN), scores.append(0.0), lowest.append(None), rejected.append(True)
                    continue
                i = int(np.argmin(row))
                langs.append(model.languages[i])
                scores.append(float(1 / np.exp(-model.scale * (row - row[i])).sum()))
                lowest.append(float(row[i]))
                rejected.append(bool(model.limits is not None and row[i] > model.limits[i]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(lowest, pa.float64()), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), text_column).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    )

