"""Document fingerprints: a homomorphic multiset hash of paragraphs, with likeness, insertion and deletion."""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundline.llm.common import whole

LANES = 256  # one for each bit of a paragraph's hash; sums are taken modulo 2 ** 32
PARAGRAPH_END = re.compile(r"(?<=\n)|(?<=[.!?] )")
SUMMED = 1 << 16  # paragraphs whose bits are held at once
ROWS_PER_RUN = 2000
MAX_RUNS = 20_000


def paragraphs(text: str) -> list[str]:
    """The pieces of a text, each with its end: after a line feed, and after a sentence end followed by a space."""
    if not text:
        return []
    if "\0" in text:
        return [p for p in PARAGRAPH_END.split(text) if p]
    for end in ("\n", ". ", "! ", "? "):
        text = text.replace(end, end + "\0")
    return [p for p in text.split("\0") if p]


def total(pieces: list[str]) -> np.ndarray:
    """The sum of the pieces' vectors modulo 2 ** 32. A piece's vector has +1 or -1 in each lane, as its hash has bits."""
    if not pieces:
        return np.zeros(LANES, dtype=np.uint32)
    ones = np.zeros(LANES, dtype=np.int64)
    for start in range(0, len(pieces), SUMMED):
        some = pieces[start : start + SUMMED]
        digests = b"".join([hashlib.blake2b(p.encode("utf-8", "replace"), digest_size=LANES // 8).digest() for p in some])
        ones += np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(len(some), -1), axis=1).sum(axis=0, dtype=np.int64)
    return (2 * ones - len(pieces)).astype(np.uint32)


def fingerprint(text: str | None) -> np.ndarray:
    return total(paragraphs(text or ""))


def insert(print_: np.ndarray, pieces: list[str]) -> np.ndarray:
    return print_ + total(pieces)


def delete(print_: np.ndarray, pieces: list[str]) -> np.ndarray:
    return print_ - total(pieces)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common paragraphs (Dice, repeats counted) from two fingerprints alone; 1 for equal ones.

    A lane's product of two sums has the number of common pairs as its mean, so the mean over lanes estimates it, with
    a deviation of about one sixteenth.
    """
    if np.array_equal(a, b):
        return 1.0
    x, y = a.view(np.int32).astype(np.float64), b.view(np.int32).astype(np.float64)
    return float(min(1.0, max(0.0, 2 * (x @ y) / (x @ x + y @ y))))


def hexadecimal(print_: np.ndarray) -> str:
    return print_.astype(">u4").tobytes().hex()


def edit(text: str, pieces: list[str], print_: np.ndarray, following: str) -> tuple[str, np.ndarray]:
    """The text with its last third replaced by the start of `following`, and that text's fingerprint.

    The fingerprint is updated: paragraphs from the one that holds the cut on are deleted, the new ones inserted.
    """
    third = len(text) // 3
    keep = len(text) - third
    edited = text[:keep] + following[:third]
    start, first = len(text), len(pieces)
    while first and start > keep:
        first -= 1
        start -= len(pieces[first])
    return edited, insert(delete(print_, pieces[first:]), paragraphs(edited[start:]))


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _ends(ids: DataFrame, rows_per_run: int) -> list[int]:
    """Ids in ascending order that end runs of about `rows_per_run` rows; the last is the largest id."""
    n, top = ids.agg(F.count("doc_id"), F.max("doc_id")).first()
    if not n:
        return []
    runs = min(MAX_RUNS, -(-n // rows_per_run))
    if runs == 1:
        return [top]
    steps = [i / runs for i in range(1, runs)]
    found = ids.agg(F.percentile_approx("doc_id", steps, max(10_000, 10 * runs))).first()[0]
    return sorted({*found, top})


def with_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """Fingerprints of every document and of its text edited with the next document (descending id; the first after the last).

    `n_chars, edited_sha256, fingerprint, edited_fingerprint` (eight hexadecimal digits a lane) and the likeness of the
    document's fingerprint to the edited one and to the next document's.

    Ids that end runs of a few thousand rows are taken from approximate quantiles; being ids of the table, they are also
    the ids of the runs' first rows, so those rows are sent to the run before as well, and one shuffle (texts
    compressed) brings every document to its next one. Runs are read as sorted streams, two texts at a time.

    A missing or empty text has no paragraphs: fingerprint 0. Equal ids are ordered by text hash, missing ids come
    last; equal rows are each other's next. One row is its own next document. No rows give no rows.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole(F.col(text_column)).alias("text"))
    ends = np.array(_ends(rows.select("doc_id"), rows_per_run), dtype=np.int64)
    nulls = rows.filter("doc_id IS NULL").limit(1).count() > 0
    last_run = -1 if nulls or not len(ends) else 0  # runs count down to it

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for i, text in zip(ids, texts):
                data = text.encode("utf-8", "replace")
                row = (i, packer.compress(data), hashlib.md5(data).digest())
                run = -1 if i is None else int(np.searchsorted(ends, i))
                out.append((run, False, *row))
                if i is None or i == ends[run]:  # may be the first row of its run
                    before = run + 1 if (run + 1 < len(ends)) else last_run
                    out.append((before, True, *row))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["run", "guest", "doc_id", "data", "key"]
            )

    dealt = rows.mapInArrow(deal, "run int, guest boolean, doc_id long, data binary, key binary")
    runs = dealt.repartition("run").sortWithinPartitions("run", "guest", F.col("doc_id").desc_nulls_last(), "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        held = None  # run, id, text, pieces, fingerprint of the last row that still waits for its next one
        for batch in batches:
            out: list[tuple] = []
            run_ids, guests, ids, data = (batch.column(j).to_pylist() for j in range(4))
            for run, guest, i, packed in zip(run_ids, guests, ids, data):
                if guest and (held is None or held[0] != run):
                    continue  # another first row of the next run: only one is needed
                text = unpacker.decompress(packed).decode("utf-8") if packed else ""
                pieces = paragraphs(text)
                own = total(pieces)
                if held is not None and held[0] == run:
                    _, before, text_before, pieces_before, print_before = held
                    edited, edited_print = edit(text_before, pieces_before, print_before, text)
                    out.append(
                        (
                            before,
                            len(text_before),
                            hashlib.sha256(edited.encode("utf-8")).hexdigest(),
                            hexadecimal(print_before),
                            hexadecimal(edited_print),
                            likeness(print_before, edited_print),
                            likeness(print_before, own),
                        )
                    )
                held = None if guest else (run, i, text, pieces, own)
            if out:
                kinds = (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names=[f.split()[0] for f in RESULT.split(", ")]
                )

    return runs.select("run", "guest", "doc_id", "data").mapInArrow(compare, RESULT)
