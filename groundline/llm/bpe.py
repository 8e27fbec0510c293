"""BPE encoding and decoding with a given vocabulary, split first where no token can reach across."""

import heapq
import json
from array import array
from collections.abc import Iterator
from operator import add

import numpy as np
import pyarrow as pa
import regex

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from groundline.llm.common import give_back, worker_memory
from groundline.llm.pretokens import Words, byte_characters

WORD_END = "</w>"  # fixed value of the file's format

NONE = 1 << 30  # no merge
ROWS = 512  # texts held as Python strings at once
REMEMBERED = 100_000  # words a task remembers per generation; two generations are kept


class Bpe:
    """Encoder and decoder for a word-level BPE file: lower case, white space dropped, words end in `</w>`."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = {c: chr(b) for b, c in enumerate(byte_characters())}

        def plain(token: str) -> str:
            """A token with every byte as the character of that number; the end mark stays as it is."""
            body = token.removesuffix(WORD_END)
            return "".join([byte[c] for c in body]) + token[len(body) :]

        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(plain(a), plain(b)): i for i, (a, b) in enumerate(pairs)}
        self.ids = {plain(token): i for token, i in model["vocab"].items()}
        self.inner = set()  # two bytes that stand next to each other inside some token
        for token in self.ids:
            body = token.removesuffix(WORD_END)
            for piece in {token, body}:
                self.inner.update(map(add, piece, piece[1:]))
        self.words = Words(path)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def cut(self, word: str) -> list[str]:
        """A word's bytes, cut between any two that no token holds side by side."""
        if self.inner.issuperset(map(add, word, word[1:])):
            return [word]
        out, start = [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.inner:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def merge(self, fragment: str, last: bool) -> list[int]:
        """Tokens of one fragment: the merge of lowest rank first, the leftmost of equals."""
        parts = list(fragment)
        if last:
            parts[-1] += WORD_END
        ranks = self.ranks
        if len(parts) <= 24:
            found = [ranks.get(pair, NONE) for pair in zip(parts, parts[1:])]
            while found and (rank := min(found)) != NONE:
                at = found.index(rank)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                del found[at]
                if at:
                    found[at - 1] = ranks.get((parts[at - 1], parts[at]), NONE)
                if at < len(found):
                    found[at] = ranks.get((parts[at], parts[at + 1]), NONE)
            return [self.ids[p] for p in parts]
        following = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = [(ranks[pair], i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
        heapq.heapify(heap)
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = following[left]
            if right >= len(parts) or (parts[left], parts[right]) != pair:
                continue  # one of the two has been merged since
            parts[left], parts[right] = pair[0] + pair[1], None
            following[left] = after = following[right]
            if after < len(parts):
                before[after] = left
                if (new := (parts[left], parts[after])) in ranks:
                    heapq.heappush(heap, (ranks[new], left, new))
            if before[left] >= 0 and (new := (parts[before[left]], parts[left])) in ranks:
                heapq.heappush(heap, (ranks[new], before[left], new))
        return [self.ids[p] for p in parts if p is not None]

    def encode_word(self, word: str) -> bytes:
        *inner, last = self.cut(word.encode("utf-8", "replace").decode("latin-1"))
        ids = []
        for fragment in inner:
            ids += self.merge(fragment, False)
        ids += self.merge(last, True)
        return array("i", ids).tobytes()

    def remember(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.encode_word(word)
            if len(word) > 64:
                return found
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[word] = found
        return found

    def encode_plain(self, text: str) -> list[bytes]:
        """Ids of a text without special tokens, as the bytes of 32-bit integers per word."""
        get, remember = self.young.get, self.remember
        out = []
        for word in self.words.split(text):
            found = get(word)
            if found is None:
                found = remember(word)
                get = self.young.get
            out.append(found)
        return out

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids; a missing text is an empty one."""
        if not text:
            return np.empty(0, dtype=np.int32)
        out, start = [], 0
        if self.specials is not None and "<|" in text:
            for match in self.specials.finditer(text):
                out += self.encode_plain(text[start : match.start()])
                out.append(array("i", [self.special[match.group()]]).tobytes())
                start = match.end()
        out += self.encode_plain(text[start:] if start else text)
        return np.frombuffer(b"".join(out), dtype=np.int32)



class Tokens:
    """Decoder: the tokens of ids, special ones too, joined by one space, as a file without a decoder has it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        known = [*spec["model"]["vocab"].items(), *((t["content"], t["id"]) for t in spec["added_tokens"])]
        self.tokens = np.empty(max(i for _, i in known) + 1, dtype=object)
        for token, i in known:
            self.tokens[i] = token

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.tokens[ids].tolist())


def load(kind: type, path: str):
    """What `kind` makes of a file, read once in a worker."""
    memory = worker_memory()
    if (kind.__name__, path) not in memory:
        memory[kind.__name__, path] = kind(path)
    return memory[kind.__name__, path]


def _map_column(df: DataFrame, column: str, result: str, kind: T.DataType, convert) -> DataFrame:
    """`df` without `column` and with `convert(column)` as `result`, Arrow batch by Arrow batch."""
    rest = [c for c in df.columns if c not in (column, result)]
    fields = [df.schema[c] for c in rest]
    schema = type(df.schema)(fields).add(result, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                new = convert(part.column(len(rest)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], new], names=[*rest, result])
            give_back()

    return df.select(*rest, column).mapInArrow(run, schema)


def encode(df: DataFrame, path: str, column: str = "text", result: str = "ids") -> DataFrame:
    """`column` replaced by `result`, the token ids of the whole text as `array<int>`.

    A word's bytes are cut wherever two neighbours stand side by side in no token: no merge can reach across, so the
    fragments are encoded on their own and put together again. Map-only; memory is one batch, the vocabulary and a
    bounded memory of words. `path` is a file that every executor has. Missing and empty texts have no ids; repeated
    rows stay; other columns are kept as they are (one named `result` is replaced).
    """

    def convert(texts: pa.Array) -> pa.Array:
        encoder = load(Bpe, path)
        ids = [encoder.encode(text) for text in texts.to_pylist()]
        offsets = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum([len(x) for x in ids], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), type=pa.int32()))

    return _map_column(df, column, result, T.ArrayType(T.IntegerType()), convert)


def decode(df: DataFrame, path: str, column: str = "ids", result: str = "text") -> DataFrame:
    """`column` replaced by `result`, the text that the ids stand for. Missing and empty ids give an empty text."""

    def convert(ids: pa.Array) -> pa.Array:
        decoder = load(Tokens, path)
        if ids.null_count:
            return pa.array([decoder.decode(np.array(x or [], dtype=np.int64)) for x in ids.to_pylist()], pa.string())
        values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()  # offsets are of the slice, values are whole
        return pa.array([decoder.decode(values[a:b]) for a, b in zip(offsets, offsets[1:])], pa.string())

    return _map_column(df, column, result, T.StringType(), convert)
