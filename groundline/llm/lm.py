"""Language-model scores: a weighted backoff automaton over words, counted and applied by exchange of packed counts.

The model is an n-gram model smoothed towards its lower orders, at last to discounted unigrams (MacKay and Peto's
hierarchical Dirichlet form); h' is the context h without its first word:

    P(w | h) = (c(h w) + K P(w | h')) / (c(h) + K),    P(w) = (c(w) - D) / N,    P(unknown word) = D V / N

As an automaton: a root, a state for the begin of a text, and a state for each context of up to `order - 1` words seen in
training. A state has an arc for each word seen after it, with its log-probability, to the longest state that ends the words
read, and a failure arc to the state of h' with weight K / (c(h) + K). The root has an arc for every word; an unknown one
leads back to the root. A text is read once from left to right: the state is carried, failure arcs are taken until the
state has an arc for the word, and the weights of all arcs add up.

The counts are as many as the corpus has n-grams, so no task ever holds all of them. Texts are taken in blocks. A block's
distinct n-grams go, as 64-bit hashes in order with their counts in the block, to the part that sums them; a part answers
each block with the counts that differ from the block's own. The states and arcs that a slice of the block's tokens can reach
are then built, and its texts run through them; the state is carried from slice to slice, so that a long text needs no larger
automaton. A frequent n-gram is one entry per block, however often it occurs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundline.llm import blobs
from groundline.llm.common import stored, whole, word_count

CONCENTRATION = 4.0  # K
DISCOUNT = 0.5  # D
BLOCK_BYTES = 12 << 20
PART_BYTES = 8 << 20  # of text per part of the counts
ORDER = 2
SLICE = 1 << 14  # tokens whose states and arcs are held at a time
# Kinds of rows in the exchange: n-grams of n words have kind n - 1, so words have 0.
WORDS, TEXTS, TYPES = 0, 100, 101
END, START = np.uint64(1), np.uint64(2)  # stand for the end of a text, and for the state before its first word
HALF = np.uint64(0x9E3779B97F4A7C15)

ROW = "block long, kind int, part int, data binary"
SCORED = "doc_id {id}, held_out boolean, n_tokens long, n_known long, base_part double, score_part double, types long"


def hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text followed by END, and the number of tokens per text."""
    parts, counts = [], np.empty(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()  # of bytes: A-Z and the six ASCII white space characters
        counts[i] = len(words) + 1
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)))
        parts.append(np.array([END]))
    return (np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)), counts


def grams(words: np.ndarray, counts: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 .. order, the hash of the n-gram that ends at each token, and whether there is one.

    The begin of a text counts as a word before its first, so its second token ends a trigram, its first none.
    """
    first = np.cumsum(counts) - counts
    place = np.arange(len(words)) - np.repeat(first, counts)
    out = [(words, np.ones(len(words), dtype=bool))]
    for n in range(2, order + 1):
        before = np.empty_like(words)
        before[1:] = out[-1][0][:-1]
        before[first] = START
        h = (before * HALF) ^ ((words << np.uint64(31)) | (words >> np.uint64(33)))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out.append((h ^ (h >> np.uint64(31)), place >= n - 2))
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Ids, flags and texts (as UTF-8) of consecutive rows, up to BLOCK_BYTES of text."""
    ids, flags, texts, size = [], [], [], 0
    for batch in batches:
        for i, flag, text in zip(*(batch.column(j).to_pylist() for j in range(3))):
            data = text.encode("utf-8", "replace")
            ids.append(i), flags.append(flag), texts.append(data)
            size += len(data) + 64
            if size >= BLOCK_BYTES:
                yield ids, flags, texts
                ids, flags, texts, size = [], [], [], 0
    if ids:
        yield ids, flags, texts


def _block_id(ids: list, texts: list[bytes]) -> int:
    """A block's name, made of what it holds."""
    digest = xxhash.xxh64(repr(ids))
    for text in texts:
        digest.update(len(text).to_bytes(8, "little"))
        digest.update(text)
    return digest.intdigest() - (1 << 63)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["block", "kind", "part", "data"])


def _own_counts(words: np.ndarray, trains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the place of each token's hash among them, and their counts in training tokens."""
    distinct, places = np.unique(words, return_inverse=True)
    return distinct, places, np.bincount(places[trains], minlength=len(distinct))


def _trains(flags: list, counts: np.ndarray) -> np.ndarray:
    return np.repeat(~np.array(flags, dtype=bool), counts)


def _send(batches: Iterator[pa.RecordBatch], parts: int, order: int) -> Iterator[pa.RecordBatch]:
    """A block's distinct n-grams with its counts, for the parts that sum them."""
    for ids, flags, texts in _blocks(batches):
        name = _block_id(ids, texts)
        words, counts = hashes(texts)
        trains = _trains(flags, counts)
        for kind, (keys, valid) in enumerate(grams(words, counts, order)):
            distinct, _, own = _own_counts(keys[valid], trains[valid])
            at = blobs.cuts(distinct, parts)
            yield _rows([(name, kind, p, blobs.pack(distinct[a:b], blobs.small(own[a:b]))) for p, (a, b) in enumerate(zip(at, at[1:]))])


def _keep_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's texts under its name, packed."""
    for ids, flags, texts in _blocks(batches):
        sink = pa.BufferOutputStream()
        table = pa.table({"doc_id": ids, "held_out": flags, "text": pa.array(texts, pa.large_binary())})
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        packed = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
        yield _rows([(_block_id(ids, texts), TEXTS, -1, packed)])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one part at a time: for each block, what differs from its own counts, by place in its list."""
    held: list[tuple] = []

    def answers():
        lists = [blobs.unpack(data) for _, _, _, data in held]
        keys = np.concatenate([k for k, _ in lists])
        distinct, places = np.unique(keys, return_inverse=True)
        sums = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(sums, places, np.concatenate([n.astype(np.int64) for _, n in lists]))
        at = 0
        for (block, kind, part, _), (own_keys, own) in zip(held, lists):
            mine = sums[places[at : at + len(own_keys)]]
            at += len(own_keys)
            changed = np.flatnonzero(mine != own).astype(np.uint64)
            yield _rows([(block, kind, part, blobs.pack(changed, blobs.small(mine[changed.astype(np.int64)])))])
        if held[0][1] == WORDS:
            yield _rows([(0, TYPES, held[0][2], int(np.count_nonzero(sums)).to_bytes(8, "little"))])

    for batch in batches:
        for row in zip(*(batch.column(j).to_pylist() for j in range(4))):
            if held and held[0][1:3] != row[1:3]:
                yield from answers()
                held = []
            held.append(row)
    if held:
        yield from answers()


class Automaton:
    """The states and arcs that the tokens a .. b of a block can reach.

    `keys[n - 1]` and `seen[n - 1]` are the hash and training count of the n-gram that ends at each token, `logs[n - 1]` the
    log-probability of the token by it. State 0 is the root, 1 the begin of a text (without contexts, texts begin at the root).
    """

    def __init__(self, keys, seen, logs, first: np.ndarray, starts: int, a: int, b: int):
        order, low = len(keys), max(a - 1, 0)  # the state carried into the slice ends at the token before
        inner = keys[0][low:b] != END
        self.fail, self.length = [0, 0], [0, 0]
        back, states, n_states = [np.zeros(1), self.weight(np.array([starts]))], [], 2
        for n in range(1, order):
            held = (seen[n - 1][low:b] > 0) & inner
            _, at, place = np.unique(keys[n - 1][low:b][held], return_index=True, return_inverse=True)
            state = np.zeros(b - low, dtype=np.int64)
            state[held] = n_states + place
            where = np.flatnonzero(held)[at]
            back.append(self.weight(seen[n - 1][low + where]))
            self.fail += states[-1][where].tolist() if states else [0] * len(where)
            self.length += [n] * len(where)
            states.append(state)
            n_states += len(where)
        self.back = np.concatenate(back).tolist()

        distinct, self.words = np.unique(keys[0][a:b], return_inverse=True)
        self.width = len(distinct)
        nowhere = np.zeros(b - low, dtype=np.int64)
        arcs = [(self.words, logs[0][a:b], (states[0] if states else nowhere)[a - low :])]
        for n in range(2, order + 1):
            at = np.flatnonzero(seen[n - 1][a:b])
            source = np.where(first[a:b][at], 1, states[n - 2][at + a - low - 1])
            arcs.append((source * self.width + self.words[at], logs[n - 1][a:b][at], states[min(n, order - 1) - 1][at + a - low]))
        labels, weights, targets = (np.concatenate(column) for column in zip(*arcs))
        labels, at = np.unique(labels, return_index=True)
        self.arcs = dict(zip(labels.tolist(), zip(weights[at].tolist(), targets[at].tolist())))
        self.ends = [0] + [int(state[0]) if a else 0 for state in states]

    @staticmethod
    def weight(counts: np.ndarray) -> np.ndarray:
        """Of the failure arcs of states that were seen so often."""
        return np.log10(CONCENTRATION / (counts + CONCENTRATION))

    def entered(self, length: int) -> int:
        """The state that a state of so many words, carried into the slice, has here."""
        return self.ends[length]

    def read(self, state: int, a: int, b: int) -> tuple[int, float]:
        """From a state through the words a .. b of the slice: the state after them and the sum of the weights."""
        arcs, width, fail, back, total = self.arcs, self.width, self.fail, self.back, 0.0
        for word in self.words[a:b].tolist():
            arc = arcs.get(state * width + word)
            while arc is None:
                total += back[state]
                state = fail[state]
                arc = arcs.get(state * width + word)
            total += arc[0]
            state = arc[1]
        return state, total


def run_texts(keys, seen, counts: np.ndarray, n: int, starts: int) -> np.ndarray:
    """Sums of log10 over each text, without the share of unknown words: one traversal in slices, the state carried."""
    ends = np.cumsum(counts)
    begins = ends - counts
    first = np.zeros(len(keys[0]), dtype=bool)
    first[begins] = True
    # an unknown word's share is added at the end
    p = np.where(seen[0] > 0, (seen[0] - DISCOUNT) / max(n, 1), 1.0)
    logs = [np.log10(p)]
    for below, own in zip(seen, seen[1:]):
        context = np.empty_like(below)
        context[1:] = below[:-1]
        context[first] = starts
        p = np.where(own > 0, (own + CONCENTRATION * p) / (context + CONCENTRATION), p)
        logs.append(np.log10(p))

    sums, length = np.zeros(len(counts)), 0
    for a in range(0, len(first), SLICE):
        b = min(a + SLICE, len(first))
        automaton = Automaton(keys, seen, logs, first, starts, a, b)
        text = int(np.searchsorted(ends, a, side="right"))
        while text < len(counts) and begins[text] < b:
            begin, end = max(int(begins[text]), a), min(int(ends[text]), b)
            state = min(1, len(keys) - 1) if begin == begins[text] else automaton.entered(length)
            state, total = automaton.read(state, begin - a, end - a)
            sums[text] += total
            length = automaton.length[state]
            text += 1
    return sums


def _score(batches: Iterator[pa.RecordBatch], parts: int, order: int, n: int, starts: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Texts of one block at a time through the states and arcs that its answers complete."""
    names = [f.split()[0] for f in SCORED.split(", ")]
    kinds = (id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())

    def result(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

    def scores(copies: list[bytes], lists: dict[tuple[int, int], bytes]):
        if len(lists) != order * parts:
            raise RuntimeError("a block of texts was read in two ways: the input changed during the job")
        for packed in copies:
            table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all()
            flags, texts = table.column("held_out").to_pylist(), table.column("text").to_pylist()
            words, counts = hashes(texts)
            del texts
            trains = _trains(flags, counts)
            keys, seen = [], []
            for kind, (hashed, valid) in enumerate(grams(words, counts, order)):
                distinct, places, own = _own_counts(hashed[valid], trains[valid])
                at = blobs.cuts(distinct, parts)
                for p in range(parts):
                    where, sums = blobs.unpack(lists[kind, p])
                    own[at[p] + where.astype(np.int64)] = sums
                everywhere = np.zeros(len(words), dtype=np.int64)
                everywhere[valid] = own[places]
                keys.append(hashed), seen.append(everywhere)
            first = np.cumsum(counts) - counts
            yield result(
                table.column("doc_id").to_pylist(), flags, counts, np.add.reduceat((seen[0] > 0).astype(np.int64), first),
                np.add.reduceat(np.log10(seen[0] + 0.5), first), run_texts(keys, seen, counts, n, starts), [None] * len(flags),
            )

    block, copies, lists = None, [], {}
    for batch in batches:
        for name, kind, part, data in zip(*(batch.column(j).to_pylist() for j in range(4))):
            if kind == TYPES:
                yield result([None], [None], [None], [None], [None], [None], [int.from_bytes(data, "little")])
                continue
            if block is not None and name != block:
                yield from scores(copies, lists)
                copies, lists = [], {}
            block = name
            if kind == TEXTS:
                copies.append(data)
            else:
                lists[kind, part] = data
    if block is not None:
        yield from scores(copies, lists)


def score(
    docs: DataFrame, held_out=None, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER, part_bytes: int = PART_BYTES
) -> DataFrame:
    """`(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)` for every row of `docs`.

    The model learns from rows for which `held_out` (a boolean column; none by default) is false, and scores all rows,
    whole, by n-grams of up to `order` words. `base_score` is the add-one-half unigram score. Both are sums of log10 over words and the end of the text.

    A missing text counts as an empty one: its only token is the end. Repeated rows are rows, in training too. With no
    row to learn from every token is unknown with probability 1, so scores are 0. No rows give no rows.
    """
    flag = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(id_column).alias("doc_id"), flag.alias("held_out"), whole(F.col(text_column)).alias("text"))
    learns = ~F.col("held_out")
    n, starts, size = rows.agg(
        F.sum(F.when(learns, word_count("text") + 1)), F.count(F.when(learns, 1)), F.sum(F.octet_length("text").cast("long"))
    ).first()
    n, parts = n or 0, max(1, min(1 << 16, -(-(size or 0) // part_bytes)))

    def send(batches):
        return _send(batches, parts, order)

    def apply(batches):
        return _score(batches, parts, order, n, starts, id_type)

    id_type = pa.schema(rows.select("doc_id").limit(0).toArrow().schema).field(0).type
    sent = rows.mapInArrow(send, ROW).repartition(parts, "kind", "part").sortWithinPartitions("kind", "part")
    answers = sent.mapInArrow(_answer, ROW)
    texts = rows.mapInArrow(_keep_texts, ROW)
    together = texts.union(answers).repartition(parts, "block").sortWithinPartitions("block", "kind", "part")
    partial = stored(together.mapInArrow(apply, SCORED.format(id=rows.schema["doc_id"].dataType.simpleString())), "lm-scores")
    types = partial.agg(F.sum("types")).first()[0] or 0
    base_total, unknown = n + 0.5 * (types + 1), DISCOUNT * types / n if n else 1.0
    return partial.filter("held_out IS NOT NULL").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_part") - F.col("n_tokens") * F.log10(F.lit(float(base_total)))).alias("base_score"),
        (F.col("score_part") + (F.col("n_tokens") - F.col("n_known")) * F.log10(F.lit(float(unknown)))).alias("score"),
    )
