"""Removal of repeated passages: bucket-pointer refinement of suffixes, exact to the byte, over all documents.

Every byte covered by a string of 100 bytes that also starts earlier is removed. Suffixes are put into buckets by their
first 25 bytes, and buckets are refined by the identifiers of later offsets, each length reusing those of half of it:

    id25(p) = hash of 25 bytes,   id50(p) = (id25(p), id25(p + 25)),   id100(p) = (id50(p), id50(p + 50))

Identifiers are hashes of what they stand for, so equal strings have equal identifiers in every task and no ranks need to
be handed around. Three things keep the work small and are exact:

1. A window of 100 bytes holds 76 offsets of 25 bytes; the one of smallest identifier (leftmost of equals) is its pointer.
   Equal windows have equal pointers at the same place, so only pointers are put into buckets, about one in 38 bytes.
2. The windows that share a pointer are neighbours, a run. A bucket is refined by the identifier of the run's whole
   content. If that leaves one class, its first member keeps its windows and all others lose theirs.
3. Only buckets of several classes (the ends of repeated passages) are refined by id100 of each window in its runs: the
   first run of each class goes with its bytes to the part of its bucket. A bucket of very many classes (the end of a
   line that is everywhere) would gather in one part; its windows are spread over all parts by their own identifiers.

Texts are taken in blocks. A block sends one entry per bucket (or window) to the part that decides it, so a passage that
every document has is one entry per block; and the part answers the block. Texts move to where the answers are, twice.
The number of tasks of an exchange follows the bytes of text, not the session's setting.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundline.llm import blobs
from groundline.llm.common import batches_of, give_back, stored, whole, worker_memory

WINDOW, QUARTER = 100, 25
OFFSETS = WINDOW - QUARTER + 1  # places of a pointer in a window
BLOCK_BYTES = 3 << 20
PART_BYTES = 8 << 20  # of text per part
PIECE = 1 << 17  # window starts that are hashed at once; longer texts are taken in pieces that overlap
BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so that it has an inverse modulo 2 ** 64
AT_ONCE = 1 << 18  # bytes of runs that are refined at once
GATHERED = 1000  # classes of a bucket that are refined in one part
MISSING = np.uint64((1 << 64) - 1)  # a missing id comes last

TEXTS, BUCKETS, REMOVED, CONTEXTS, WINDOWS, ANSWERS, WINDOW_ANSWERS = range(7)  # kinds of rows
ROW = "block long, kind int, part int, data binary"
RESULT = "doc_id {id}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits (the finisher of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the 256 bytes, and the powers of BASE and of its inverse."""
    memory = worker_memory()
    if "powers" not in memory or len(memory["powers"][1]) < n:
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        up, down = (np.cumprod(np.full(n, b, dtype=np.uint64)) for b in (BASE, inverse))
        memory["powers"] = values, np.concatenate([[np.uint64(1)], up[:-1]]), np.concatenate([[np.uint64(1)], down[:-1]])
    return memory["powers"]


class Hashes:
    """Identifiers of substrings of some bytes."""

    def __init__(self, data: np.ndarray):
        values, up, self.down = _powers(max(PIECE + (1 << 17), len(data) + 1))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]

    def windows(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """id100 of windows, from identifiers of 25 and 50 bytes: 64 bits, and 32 more from another mixture."""
        quarter = [self.of(start + i * QUARTER, QUARTER) for i in range(4)]
        left, right = (mix(mix(quarter[i]) + np.uint64(3) * quarter[i + 1]) for i in (0, 2))
        more = mix(left * np.uint64(0x9E3779B97F4A7C15) ^ (right + (quarter[3] >> np.uint64(7))))
        return mix(left + np.uint64(5) * right), (more >> np.uint64(32)).astype(np.uint32)


@dataclass
class Runs:
    """Runs of windows that share a pointer, over the texts of a block."""

    row: np.ndarray
    low: np.ndarray  # first and last window start, in the row's text
    high: np.ndarray
    bucket: np.ndarray  # identifier of the pointer's 25 bytes
    content: np.ndarray  # identifier (48 bits) of all that the windows cover and of where in it the pointer is
    lead: np.ndarray  # bytes from the first window start to the pointer


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Bytes of several texts together, and for each part of them: row, offset in the text, start and end in the bytes."""
    held, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(len(text) - WINDOW + 1, 0), PIECE):
            part = text[offset : offset + PIECE + WINDOW - 1]
            held.append(part)
            parts.append((row, offset, size, size + len(part)))
            size += len(part)
            if size >= PIECE:
                yield np.frombuffer(b"".join(held), dtype=np.uint8), parts
                held, parts, size = [], [], 0
    if held:
        yield np.frombuffer(b"".join(held), dtype=np.uint8), parts


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :])


def find_runs(texts: list[bytes]) -> Runs:
    """All windows of the texts as runs, in order of row and place."""
    found = []
    for data, parts in _pieces(texts):
        hashes = Hashes(data)
        starts = np.arange(len(data) - QUARTER + 1)
        ids = mix(hashes.of(starts, QUARTER))
        place_bits = np.uint64(int(len(data)).bit_length())
        ordered = ((ids >> place_bits) << place_bits) | starts.astype(np.uint64)
        pointers = (_sliding_minimum(ordered, OFFSETS) & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
        ends = np.array([end for _, _, _, end in parts])
        valid = np.ones(len(pointers), dtype=bool)
        for end in ends:
            valid[end - WINDOW + 1 : end] = False
        at = np.flatnonzero(valid)
        pointer = pointers[at]
        first = np.flatnonzero(np.concatenate([[True], (pointer[1:] != pointer[:-1]) | (at[1:] != at[:-1] + 1)]))
        low, high, pointer = at[first], at[np.concatenate([first[1:], [len(at)]]) - 1], pointer[first]
        length = high + WINDOW - low
        place = (pointer - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        content = mix(mix(hashes.of(low, length)) + place + length.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        of = np.searchsorted(ends, low, side="right")
        rows, offsets, begins = (np.array([p[i] for p in parts])[of] for i in range(3))
        found.append((rows, low - begins + offsets, high - begins + offsets, ids[pointer], content >> np.uint64(16), pointer - low))
    if not found:
        return Runs(*(np.empty(0, dtype=k) for k in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64)))
    return Runs(*(np.concatenate(c) for c in zip(*found)))


def _order(ids: list, ties: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort values of the rows of a block: the id, the tie among equal ids, and each row's rank in the block."""
    docs = np.array([MISSING if i is None else np.uint64(i + (1 << 63)) for i in ids], dtype=np.uint64)
    tie = np.array(ties, dtype=np.uint32)
    rank = np.empty(len(docs), dtype=np.int64)
    rank[np.lexsort((tie, docs))] = np.arange(len(docs))
    return docs, tie, rank


@dataclass
class Buckets:
    """A block's buckets in order of identifier, as its texts alone show them."""

    keys: np.ndarray
    first: np.ndarray  # the earliest run of each bucket
    classes: np.ndarray  # how many classes its runs are of
    lost: np.ndarray  # runs whose class has an earlier run in the block
    of: np.ndarray  # each run's bucket


def group(runs: Runs, rank: np.ndarray) -> Buckets:
    order = np.lexsort((runs.low, rank[runs.row], runs.content, runs.bucket))
    bucket, content = runs.bucket[order], runs.content[order]
    new_bucket = np.concatenate([[True], bucket[1:] != bucket[:-1]]) if len(order) else np.empty(0, bool)
    new_class = new_bucket.copy()
    new_class[1:] |= content[1:] != content[:-1]
    number = np.cumsum(new_bucket) - 1
    classes = np.bincount(number[new_class]) if len(order) else np.empty(0, np.int64)
    of = np.empty(len(order), dtype=np.int64)
    of[order] = number
    return Buckets(bucket[new_bucket], order[new_bucket], classes, order[~new_class], of)


# rows of the exchange ------------------------------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], repeated: bool) -> Iterator[tuple[list, list[int], list[bytes]]]:
    ids, ties, texts, size = [], [], [], 0
    for batch in batches:
        for row in range(batch.num_rows):  # a text at a time: a batch may hold thousands
            data = batch.column(1)[row].as_py().encode("utf-8", "replace")
            ids.append(batch.column(0)[row].as_py()), texts.append(data)
            ties.append(xxhash.xxh32_intdigest(data) if repeated else 0)
            size += len(data) + 64
            if size >= BLOCK_BYTES:
                yield ids, ties, texts
                ids, ties, texts, size = [], [], [], 0
                give_back()
    if ids:
        yield ids, ties, texts
        ids, ties, texts = [], [], []
        give_back()


def _name(number: int, ids: list, texts: list[bytes]) -> int:
    """A block's name, made of the partition that it is read in, its number there, and what it holds."""
    digest = xxhash.xxh64(repr((TaskContext.get().partitionId(), number, ids)))
    for text in texts:
        digest.update(len(text).to_bytes(8, "little"))
        digest.update(text)
    return digest.intdigest() - (1 << 63)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["block", "kind", "part", "data"])


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        keys = zip(*(batch.column(j).to_pylist() for j in range(3)))
        for row, key in enumerate(keys):  # the data of one row at a time
            yield *key, batch.column(3)[row].as_py()


def _grouped(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list[tuple]]]:
    """Consecutive rows that agree in a column."""
    key, held = None, []
    for row in _values(batches):
        if held and row[column] != key:
            yield key, held
            held = []
            give_back()
        key = row[column]
        held.append(row)
    if held:
        yield key, held
        held = []
        give_back()


def _by_part(name: int, kind: int, parts: int, keys: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    at = blobs.cuts(keys, parts)
    return _rows([(name, kind, p, blobs.pack(keys[a:b], *(c[a:b] for c in columns))) for p, (a, b) in enumerate(zip(at, at[1:])) if a < b])


def _pack_texts(ids: list, ties: list[int], texts: list[bytes]) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table({"doc_id": ids, "tie": pa.array(ties, pa.uint32()), "text": pa.array(texts, pa.large_binary())})
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())


def _unpack_texts(data: bytes) -> tuple[list, list[int], list[bytes]]:
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()
    return tuple(table.column(c).to_pylist() for c in ("doc_id", "tie", "text"))


def _joined(lists: list[tuple[np.ndarray, ...]], held: list[tuple]) -> tuple[list[np.ndarray], np.ndarray]:
    """The lists of several blocks as one, and each entry's block by rank of its name."""
    names = [row[0] for row in held]
    turn = {name: i for i, name in enumerate(sorted(set(names)))}
    return [np.concatenate(c) for c in zip(*lists)], np.repeat([turn[n] for n in names], [len(x[0]) for x in lists])


def _per_block(held: list[tuple], lists: list[tuple], values: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Block, part and own stretch of `values` for each list."""
    at = 0
    for (block, _, part, _), own in zip(held, lists):
        yield block, part, values[at : at + len(own[0])]
        at += len(own[0])


def _decide_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part: for each block the buckets whose first run is lost (1) or that are refined gathered (2) or spread (3)."""
    for _, held in _grouped(batches, 2):
        lists = [blobs.unpack(row[3]) for row in held]
        (key, content, doc, tie, rank, low, classes), block = _joined(lists, held)
        order = np.lexsort((low, rank, block, tie, doc, content, key))
        key, content = key[order], content[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        number = np.cumsum(new) - 1
        total = np.bincount(number, weights=classes[order])
        mixed = np.bincount(number, weights=classes[order] > 1) > 0
        mixed[number[1:][(content[1:] != content[:-1]) & ~new[1:]]] = True
        refined = np.where(total <= GATHERED, 2, 3)
        answer = np.empty(len(order), dtype=np.uint8)
        answer[order] = np.where(mixed[number], refined[number], np.where(new, 0, 1))
        for name, part, mine in _per_block(held, lists, answer):
            places = np.flatnonzero(mine)
            if len(places):
                yield _rows([(name, ANSWERS, part, blobs.pack(places.astype(np.uint64), mine[places]))])


def _contexts(texts: list[bytes], runs: Runs, chosen: np.ndarray, docs, tie, rank, name: int, parts: int) -> pa.RecordBatch:
    """Runs with their bytes for the parts of their buckets. Neighbours in a bucket are alike, so they pack well."""
    chosen = chosen[np.lexsort((runs.content[chosen], runs.bucket[chosen]))]
    row, low, length = runs.row[chosen], runs.low[chosen], runs.high[chosen] - runs.low[chosen] + WINDOW
    keys, out = runs.bucket[chosen], []
    at = blobs.cuts(keys, parts)
    packer = zstandard.ZstdCompressor(level=3)
    for p, (a, b) in enumerate(zip(at, at[1:])):
        if a < b:
            columns = (docs[row], tie[row], *(c.astype(np.uint32) for c in (rank[row], low, runs.lead[chosen], length)))
            head = blobs.pack(keys[a:b], *(c[a:b] for c in columns))
            body = b"".join(texts[r][i : i + n] for r, i, n in zip(row[a:b].tolist(), low[a:b].tolist(), length[a:b].tolist()))
            out.append((name, CONTEXTS, p, len(head).to_bytes(8, "little") + head + packer.compress(body)))
    return _rows(out)


def _head(data: bytes) -> tuple[np.ndarray, ...]:
    return blobs.unpack(data[8 : 8 + int.from_bytes(data[:8], "little")])


def _body(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data[8 + int.from_bytes(data[:8], "little") :])


def _ranges(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. for each length, one after the other."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _late_stretches(data: np.ndarray, begin: np.ndarray, key, doc, tie, rank, low, lead, length, block) -> tuple[np.ndarray, ...]:
    """Of some runs with their bytes: stretches (run, from, to) of windows that start earlier in another run of their bucket."""
    hashes = Hashes(data[np.repeat(begin, length) + _ranges(length)])
    n = length - WINDOW + 1
    run, step = np.repeat(np.arange(len(n)), n), _ranges(n)
    ids, check = hashes.windows(np.repeat(np.cumsum(length) - length, n) + step)
    place = (np.repeat(lead, n) - step).astype(np.uint64)  # of the pointer in the window
    same = mix(key[run] + mix(ids + place * np.uint64(0x9E3779B97F4A7C15)))
    order = np.lexsort((low[run] + step, rank[run], block[run], tie[run], doc[run], check, same))
    late = np.zeros(len(order), dtype=bool)
    late[order[1:]] = (same[order[1:]] == same[order[:-1]]) & (check[order[1:]] == check[order[:-1]])
    before = np.concatenate([[False], late[:-1]]) & (step > 0)
    after = np.concatenate([late[1:], [False]]) & (step < np.repeat(n, n) - 1)
    first, last = np.flatnonzero(late & ~before), np.flatnonzero(late & ~after)
    return run[first], step[first], step[last]


def _decide_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part: for each block the stretches (run, from, to) of windows that start earlier elsewhere in their bucket.

    Whole buckets are taken together up to AT_ONCE bytes, so memory is bounded by that and by the largest bucket.
    """
    for _, held in _grouped(batches, 2):
        lists = [_head(row[3]) for row in held]
        columns, block = _joined(lists, held)
        columns = [c if c.dtype == np.uint64 else c.astype(np.int64) for c in columns]
        key, length = columns[0], columns[6]
        data = np.frombuffer(b"".join(_body(row[3]) for row in held), dtype=np.uint8)
        begin = np.cumsum(length) - length
        order = np.argsort(key, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        upto = np.concatenate([np.cumsum(length[order])[new[1:] - 1], [int(length.sum())]])  # bytes up to each bucket's end
        found, at = [], 0
        while at < len(new):
            done = upto[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(upto, done + AT_ONCE, side="right")))
            chosen = order[new[at] : new[stop] if stop < len(new) else len(order)]
            run, first, last = _late_stretches(data, begin[chosen], *(c[chosen] for c in columns), block[chosen])
            found.append((chosen[run], first, last))
            at = stop
        run, first, last = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((first, run))
        run, first, last = run[order], first[order].astype(np.uint32), last[order].astype(np.uint32)
        base = 0
        for (name, _, part, _), own in zip(held, lists):
            mine = slice(*np.searchsorted(run, [base, base + len(own[0])]))
            if mine.start < mine.stop:
                yield _rows([(name, ANSWERS, part, blobs.pack((run[mine] - base).astype(np.uint64), first[mine], last[mine]))])
            base += len(own[0])


def _decide_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part: for each block the windows that start earlier elsewhere."""
    for _, held in _grouped(batches, 2):
        lists = [blobs.unpack(row[3]) for row in held]
        (key, check, doc, tie, rank, start), block = _joined(lists, held)
        order = np.lexsort((start, rank, block, tie, doc, check, key))
        late = np.zeros(len(order), dtype=bool)
        late[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (check[order[1:]] == check[order[:-1]])
        for name, part, mine in _per_block(held, lists, late):
            places = np.flatnonzero(mine)
            if len(places):
                yield _rows([(name, WINDOW_ANSWERS, part, blobs.pack(places.astype(np.uint64)))])


def _refine(ids, ties, texts, lists: dict[int, tuple], parts: int, name: int) -> Iterator[pa.RecordBatch]:
    """Of one block: the runs that are lost, and the windows of the runs that must be refined, for their parts."""
    docs, tie, rank = _order(ids, ties)
    runs = find_runs(texts)
    buckets = group(runs, rank)
    at = blobs.cuts(buckets.keys, parts)
    state = np.zeros(len(buckets.keys), dtype=np.uint8)
    for part, (places, states) in lists.items():
        state[at[part] + places.astype(np.int64)] = states
    lost = np.zeros(len(runs.row), dtype=bool)
    lost[buckets.lost] = True
    lost[buckets.first[state == 1]] = True
    gathered, fine = (np.flatnonzero((state == s)[buckets.of] & ~lost) if len(lost) else np.empty(0, int) for s in (2, 3))
    removed = [(runs.row[lost], runs.low[lost], runs.high[lost])]
    if len(gathered):
        yield _contexts(texts, runs, gathered, docs, tie, rank, name, parts)

    windows = []
    begin, row_of = 0, runs.row
    for data, pieces in _pieces(texts):
        # runs are in order of rows and places, so those of a piece follow each other
        last_row, last_offset = pieces[-1][0], pieces[-1][1]
        inside = fine[begin:]
        ends = (row_of[inside] < last_row) | ((row_of[inside] == last_row) & (runs.low[inside] < last_offset + PIECE))
        mine = inside[: int(np.argmin(ends)) if len(ends) and not ends.all() else len(inside)]
        begin += len(mine)
        if not len(mine):
            continue
        hashes = Hashes(data)
        begins = {(row, offset): start for row, offset, start, _ in pieces}
        shift = np.array([begins[r, o] - o for r, o in zip(row_of[mine].tolist(), (runs.low[mine] // PIECE * PIECE).tolist())])
        length = runs.high[mine] - runs.low[mine] + 1
        start = np.repeat(runs.low[mine], length) + _ranges(length)
        key, check = hashes.windows(start + np.repeat(shift, length))
        windows.append((key, check, np.repeat(row_of[mine], length), start))
    if windows:
        key, check, row, start = (np.concatenate(c) for c in zip(*windows))
        order = np.lexsort((start, rank[row], check, key))
        key, check, row, start = key[order], check[order], row[order], start[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])])
        removed.append((row[~new], start[~new], start[~new]))
        key, check, row, start = key[new], check[new], row[new], start[new]
        yield _by_part(
            name, WINDOWS, parts, key, check, docs[row], tie[row], rank[row].astype(np.uint32), start.astype(np.uint32)
        )
    row, low, high = (np.concatenate(c) for c in zip(*removed))
    order = np.argsort(row, kind="stable")
    packed = blobs.pack(row[order].astype(np.uint64), low[order].astype(np.uint32), high[order].astype(np.uint32))
    yield _rows([(name, REMOVED, -1, packed)])


def cover(length: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which bytes of a text lie in a window whose start is in one of the ranges."""
    marks = np.zeros(length + 1, dtype=np.int32)
    np.add.at(marks, low, 1)
    np.add.at(marks, high + WINDOW, -1)
    return np.cumsum(marks[:-1]) > 0


def _finish(ids, texts, removed: list[tuple], id_type, names) -> pa.RecordBatch:
    row, low, high = (np.concatenate(c) for c in zip(*removed)) if removed else (np.empty(0, np.int64),) * 3
    order = np.argsort(row, kind="stable")
    row, low, high = row[order], low[order], high[order]
    at = np.searchsorted(row, np.arange(len(texts) + 1))
    out = []
    for i, (doc, text) in enumerate(zip(ids, texts)):
        a, b = at[i], at[i + 1]
        lost = spans = 0
        if a < b:
            mask = cover(len(text), low[a:b], high[a:b])
            lost = int(np.count_nonzero(mask))
            spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0])
            text = np.frombuffer(text, dtype=np.uint8)[~mask].tobytes()
        out.append((doc, len(text) + lost, lost, spans, hashlib.sha256(text).hexdigest()))
    kinds = (id_type, pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=names)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """`(doc_id, n_bytes, n_removed, n_spans, kept_sha256)` for every row of `docs`: what is left without repeated passages.

    Documents come in order of id (64-bit integer, missing ids last), equal ids in order of a text hash, equal rows in
    any order: one of them is the first. Texts below 100 bytes, empty and missing ones lose nothing. Matches never cross
    documents and are judged on the input. No rows give no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), whole(F.col(text_column)).alias("text"))
    size, n = rows.agg(F.sum(F.octet_length("text").cast("long")), F.count("*")).first()
    repeated = rows.groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    parts = max(1, min(1 << 16, -(-(size or 0) // part_bytes)))
    tasks = 2 * parts  # parts and blocks are dealt by hash: more tasks, fewer that get several
    id_type = rows.select("doc_id").limit(0).toArrow().schema.field(0).type
    names = [f.split()[0] for f in RESULT.split(", ")]

    def send_buckets(batches):
        for number, (ids, ties, texts) in enumerate(_blocks(batches, repeated)):
            docs_, tie, rank = _order(ids, ties)
            runs = find_runs(texts)
            b = group(runs, rank)
            first, single = b.first, b.classes == 1
            row = runs.row[first]
            if len(first):
                # what only a bucket of one class needs is zero for the others
                yield _by_part(
                    _name(number, ids, texts), BUCKETS, parts, b.keys, runs.content[first] * single, docs_[row] * single, tie[row] * single,
                    rank[row].astype(np.uint32) * single, runs.low[first].astype(np.uint32) * single, np.minimum(b.classes, 0xFFFF).astype(np.uint16),
                )

    def keep_texts(batches):
        for number, (ids, ties, texts) in enumerate(_blocks(batches, repeated)):
            yield _rows([(_name(number, ids, texts), TEXTS, -1, _pack_texts(ids, ties, texts))])

    def refine(batches):
        for name, held in _grouped(batches, 0):
            lists = {part: blobs.unpack(data) for _, kind, part, data in held if kind == ANSWERS}
            copies = [data for _, kind, _, data in held if kind == TEXTS]
            if not copies:
                raise RuntimeError("a block of texts was read in two ways: the input changed during the job")
            yield from _refine(*_unpack_texts(copies[0]), lists, parts, name)

    def finish(batches):
        for name, held in _grouped(batches, 0):
            copies = [data for _, kind, _, data in held if kind == TEXTS]
            of_block = [blobs.unpack(data) for _, kind, _, data in held if kind == REMOVED]
            if not copies or not of_block:
                raise RuntimeError("a block of texts was read in two ways: the input changed during the job")
            answers = {(kind, part): blobs.unpack(data) for _, kind, part, data in held if kind in (ANSWERS, WINDOW_ANSWERS)}
            ids, ties, texts = _unpack_texts(copies[0])
            row_of = np.argsort(_order(ids, ties)[2])
            for _, kind, part, data in held:
                if kind == WINDOWS and (WINDOW_ANSWERS, part) in answers:
                    late = answers[WINDOW_ANSWERS, part][0].astype(np.int64)
                    *_, rank, start = blobs.unpack(data)
                    of_block.append((row_of[rank[late]], start[late], start[late]))
                elif kind == CONTEXTS and (ANSWERS, part) in answers:
                    at, first, last = answers[ANSWERS, part]
                    _, _, _, rank, low, _, _ = _head(data)
                    at = at.astype(np.int64)
                    of_block.append((row_of[rank[at]], low[at] + first, low[at] + last))
            of_block = [tuple(c.astype(np.int64) for c in x) for x in of_block]
            yield _finish(ids, texts, of_block, id_type, names)

    sent = rows.mapInArrow(send_buckets, ROW).repartition(tasks, "part").sortWithinPartitions("part")
    texts = rows.mapInArrow(keep_texts, ROW)
    together = texts.union(sent.mapInArrow(_decide_buckets, ROW)).repartition(tasks, "block").sortWithinPartitions("block", "kind")
    with batches_of(docs.sparkSession, 1000):
        refined = stored(together.mapInArrow(refine, ROW), "repeat-windows")
    asked = {kind: refined.filter(F.col("kind") == kind).repartition(tasks, "part").sortWithinPartitions("part") for kind in (CONTEXTS, WINDOWS)}
    late = asked[CONTEXTS].mapInArrow(_decide_contexts, ROW).union(asked[WINDOWS].mapInArrow(_decide_windows, ROW))
    # what goes back to the blocks: of the bytes sent with contexts nothing is needed any more, but they pack to little
    ready = texts.union(refined).union(late).repartition(tasks, "block").sortWithinPartitions("block", "kind")
    return ready.mapInArrow(finish, RESULT.format(id=rows.schema["doc_id"].dataType.simpleString()))
