"""Token counts of a word-level BPE file by heap-and-linked-list merging: pairs are merged and counted, no identifier comes out."""

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from groundline.llm.bpe import WORD_END
from groundline.llm.common import text_slices, worker_memory
from groundline.llm.pretokens import Words, byte_characters

PIECE = 1 << 16  # characters that are split into words at once; a longer word stays whole
KNOWN_WORDS = 300_000  # words whose counts a worker remembers, then it starts anew
KNOWN_LENGTH = 64  # longer words are counted each time
POSITION = (1 << 40) - 1

SPACE = re.compile(r"[\t-\r ]")


def pieces(text: str) -> Iterator[str]:
    """The text in parts of about `PIECE` characters, cut before white space only, which no word holds."""
    start = 0
    while len(text) - start > PIECE:
        cut = SPACE.search(text, start + PIECE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Counter:
    """Counts the tokens of texts as the tokenizers library does for the same file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids = model["vocab"]
        shown = byte_characters()
        self.inside = np.array([ids[c] for c in shown], dtype=np.int64)  # a byte's symbol
        self.at_end = np.array([ids[c + WORD_END] for c in shown], dtype=np.int64)  # the same as the last one of a word
        self.merges = {}  # left symbol << 32 | right symbol -> (rank, symbol of both)
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[ids[left] << 32 | ids[right]] = (rank, ids[left + right])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.words = Words(path)
        self.known: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Initial symbols minus merges: the adjacent pair of lowest rank is popped until none is left, leftmost first."""
        data = np.frombuffer(word.encode("utf-8", "replace"), dtype=np.uint8)
        symbols = self.inside[data].tolist()
        n = len(symbols)
        symbols[-1] = int(self.at_end[data[-1]])
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        table = self.merges
        heap = [found[0] << 40 | i for i in range(n - 1) if (found := table.get(symbols[i] << 32 | symbols[i + 1]))]
        heapq.heapify(heap)
        merges = 0
        while heap:
            top = heapq.heappop(heap)
            left = top & POSITION
            right = following[left]
            if symbols[left] < 0 or right >= n:
                continue  # merged into another since
            found = table.get(symbols[left] << 32 | symbols[right])
            if found is None or found[0] != top >> 40:
                continue  # one of the two has grown since
            merges += 1
            symbols[left], symbols[right] = found[1], -1
            following[left] = after = following[right]
            if after < n:
                before[after] = left
                if found := table.get(symbols[left] << 32 | symbols[after]):
                    heapq.heappush(heap, found[0] << 40 | left)
            ahead = before[left]
            if ahead >= 0 and (found := table.get(symbols[ahead] << 32 | symbols[left])):
                heapq.heappush(heap, found[0] << 40 | ahead)
        return n - merges

    def count_plain(self, text: str) -> int:
        total = 0
        for piece in pieces(text):
            words = self.words.split(piece)
            try:
                total += sum(map(self.known.__getitem__, words))
            except KeyError:
                total += sum(map(self.count_word, words))
        return total

    def count_word(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            found = self.merged(word)
            if len(word) <= KNOWN_LENGTH:
                if len(self.known) >= KNOWN_WORDS:
                    self.known.clear()
                self.known[word] = found
        return found

    def count(self, text: str) -> int:
        if self.special is None or "<|" not in text:
            return self.count_plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.count_plain, parts))


def counter(path: str) -> Counter:
    """The counter of a file, made once in a worker."""
    memory = worker_memory()
    if ("counter", path) not in memory:
        memory["counter", path] = Counter(path)
    return memory["counter", path]


def with_token_count(df: DataFrame, path: str, column: str = "text", result: str = "n_tokens") -> DataFrame:
    """`df` without `column` and with `result`, the number of tokens of the whole text, as a bigint.

    A word's bytes are symbols in a linked list; the heap gives the adjacent pair of lowest rank, the leftmost of equals,
    and a merge is one symbol less. Special strings in a text are one token each. Map-only; memory is one slice of texts,
    the vocabulary and a bounded number of remembered words; a very long text is split into words piece by piece. `path`
    is a file that every executor has. Missing and empty texts have no tokens; repeated rows stay; other columns are kept
    as they are (one named `result` is replaced); no rows give no rows.
    """
    rest = [c for c in df.columns if c not in (column, result)]
    schema = type(df.schema)([df.schema[c] for c in rest]).add(result, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, len(rest)):
            count = counter(path).count
            counts = [count(text) if text else 0 for text in part.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], pa.array(counts, pa.int64())], names=[*rest, result])

    return df.select(*rest, column).mapInArrow(run, schema)
