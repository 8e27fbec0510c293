"""Alignment of two tokenizers over the same bytes, and how often their tokens meet in the whole corpus.

Arrow columns from end to end: token lists are flattened with their parents, byte ends are segmented cumulative sums,
and an Acero hash join on (document, end) finds where both tokenizers end a token. Pairs are counted by `Table.group_by`
in each task and the partial counts are summed by Spark.
"""

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundline.llm.common import batches_of, give_back, stored, text_slices, worker_memory
from groundline.llm.pretokens import byte_characters

# Between a character and a space before a letter, digit or ASCII sign both tokenizers always cut.
CUT = re.compile(r"(?<=\S) (?=[!-~\w])")
UNSAFE = r"(?:^|[\s\p{Z}\x0b\x1c-\x1f\x{85}]) | (?:$|[^!-~\p{L}\p{N}])|^$"  # a text has a space that is no such place, or nothing
START = re.compile(r"[!-~\w]")
SPACE_MARK = "▁"
FREQUENT = 1 << 16  # pairs that a task may look up by itself: more than this many cannot each have so large a share of all links
KEPT_PAIRS = 1 << 20  # distinct pairs that a task counts before it passes them on
TOGETHER = 256  # stretches that are encoded as one text
SLICE = 1 << 20  # bytes of text whose tokens are joined at once
BATCH = 1000  # rows of links that a task gets at once
KNOWN_CHUNKS = 1 << 18  # stretches whose tokens a worker remembers, then it starts anew
ROW = "__row"

def lists(values: list[list[int]]) -> pa.ListArray:
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(chain.from_iterable(values), type=pa.int32()))


def cut_lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    """Consecutive lists of the given sizes."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


class Tokenizers:
    """A byte-level BPE file (A) and a sentencepiece model (B), with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = {c: i for i, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
        self.bytes = [pa.array(x, pa.binary()) for x in (a_bytes, b_bytes)]
        self.lengths = [pc.cast(pc.binary_length(x), pa.int64()) for x in self.bytes]
        self.digits = [pa.array(map(str, range(len(x))), pa.string()) for x in self.bytes]
        with open(a_path, encoding="utf-8") as file:
            splitter = json.load(file)["pre_tokenizer"]
        # A's own words begin at a space; no piece of B may reach from a character over a space.
        cuts = splitter["type"] == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
        self.cuts = cuts and not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.tokens = [lists([]), lists([])]
        self.same = np.empty(0, dtype=bool)

    def chunks(self, texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
        """The texts cut where both tokenizers always cut: each chunk's text by number, and the chunk without the space of its cut."""
        texts = pc.fill_null(texts, "")
        if not self.cuts:
            full = pc.not_equal(texts, "")
            return np.flatnonzero(full.to_numpy(zero_copy_only=False)), texts.filter(full).dictionary_encode()
        mixed = pc.match_substring_regex(texts, UNSAFE)
        parts = pc.split_pattern(texts.filter(pc.invert(mixed)), " ")
        some = np.flatnonzero(mixed.to_numpy(zero_copy_only=False))
        owner = np.delete(np.arange(len(texts)), some)[pc.list_parent_indices(parts).to_numpy()]
        chunks = pc.list_flatten(parts)
        if len(some):
            others = [CUT.split(text) if text else [] for text in texts.filter(mixed).to_pylist()]
            owner = np.concatenate([owner, np.repeat(some, [len(o) for o in others])])
            chunks = pa.concat_arrays([chunks, pa.array(chain.from_iterable(others), pa.string())])
        coded = chunks.dictionary_encode()
        if len(some):
            order = np.argsort(owner, kind="stable")
            owner, coded = owner[order], coded.take(pa.array(order))
        return owner, coded

    def spelled(self, texts: list[str]) -> tuple[list[pa.ListArray], np.ndarray]:
        """Tokens of each text with a space before it, and whether both tokenizers give its bytes."""
        spaced = [" " + text for text in texts]
        found = [
            lists([x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]),
            lists(self.b.encode(texts, num_threads=1)),
        ]
        whole = pa.array(spaced, pa.string()).cast(pa.binary())
        same = np.ones(len(texts), dtype=bool)
        for tokens, of in zip(found, self.bytes):
            joined = pc.binary_join(pa.ListArray.from_arrays(tokens.offsets, of.take(tokens.values)), b"")
            same &= pc.equal(joined, whole).to_numpy(zero_copy_only=False)
        return found, same

    def learn(self, chunks: list[str]) -> None:
        """Tokens of new chunks. Those between which both tokenizers cut are encoded as one text and parted at their byte ends."""
        plain = [bool(chunk) and not chunk[-1].isspace() and START.match(chunk) is not None for chunk in chunks] if self.cuts else [False] * len(chunks)
        inner = [chunk for chunk, ok in zip(chunks, plain) if ok]
        texts = [inner[i : i + TOGETHER] for i in range(0, len(inner), TOGETHER)]
        found, same = self.spelled([" ".join(t) for t in texts])
        odd = [chunk for chunk, ok in zip(chunks, plain) if not ok] + [c for t, ok in zip(texts, same) if not ok for c in t]
        good = pa.array(same)
        inner = [c for t, ok in zip(texts, same) if ok for c in t]
        byte_ends = np.cumsum(pc.binary_length(pa.array(inner, pa.string())).to_numpy().astype(np.int64) + 1)
        parts = []
        for tokens, lengths in zip(found, self.lengths):
            ids = pc.list_flatten(tokens.filter(good))
            last = np.searchsorted(np.cumsum(lengths.take(ids).to_numpy()), byte_ends) + 1
            parts.append(cut_lists(ids, np.diff(last, prepend=0)))
        alone, alone_same = self.spelled(odd)
        added = inner + odd
        self.known.update(zip(added, range(len(self.known), len(self.known) + len(added))))
        self.tokens = [pa.concat_arrays(three) for three in zip(self.tokens, parts, alone)]
        self.same = np.concatenate([self.same, np.ones(len(inner), dtype=bool), alone_same])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, list[pa.ListArray]]:
        """For each chunk of the texts that both tokenizers spell as it is: the text's number, and its tokens in A and in B."""
        owner, coded = self.chunks(texts)
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > KNOWN_CHUNKS:
            self.forget()
        new = [chunk for chunk in distinct if chunk not in self.known]
        if new:
            self.learn(new)
        place = np.fromiter(map(self.known.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        at = place[coded.indices.to_numpy()] if len(coded) else np.empty(0, dtype=np.int64)
        odd = np.zeros(len(texts), dtype=bool)
        odd[owner[~self.same[at]]] = True
        kept = ~odd[owner]
        places = pa.array(at[kept])
        return owner[kept], [tokens.take(places) for tokens in self.tokens]


def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """The two tokenizers, made once in a worker."""
    memory = worker_memory()
    if ("alignment", a_path, b_path) not in memory:
        memory["alignment", a_path, b_path] = Tokenizers(a_path, b_path)
    return memory["alignment", a_path, b_path]


def ends(owner: np.ndarray, tokens: pa.ListArray, lengths: pa.Array, n: int) -> tuple[pa.Table, np.ndarray]:
    """A row per token: document, byte end inside it, byte end over all documents, id; and the documents' numbers of tokens."""
    ids = pc.list_flatten(tokens)
    doc = pa.array(owner).take(pc.list_parent_indices(tokens))
    total = pc.cumulative_sum(lengths.take(ids))
    counts = np.bincount(doc.to_numpy(), minlength=n)
    last = np.cumsum(counts)
    starts = np.concatenate([[0], total.to_numpy()])[last - counts]  # bytes before a document's first token
    return pa.table({"doc": doc, "end": pc.subtract(total, pa.array(starts).take(doc)), "total": total, "id": ids}), counts


def aligned(both: Tokenizers, texts: pa.Array) -> dict[str, pa.Array]:
    """The columns that `align` has for the texts."""
    n = len(texts)
    owner, tokens = both.encode(texts)
    (a, n_a), (b, n_b) = (ends(owner, t, lengths, n) for t, lengths in zip(tokens, both.lengths))
    met = a.rename_columns({"total": "a_total", "id": "a"}).join(
        b.rename_columns({"total": "b_total", "id": "b"}), keys=["doc", "end"], join_type="full outer", use_threads=False
    )
    met = met.append_column("total", pc.coalesce(met["a_total"], met["b_total"]))
    met = met.select(["doc", "total", "a", "b"]).take(pc.sort_indices(met["total"])).combine_chunks()
    doc = met["doc"].combine_chunks()
    ends_a, ends_b = pc.is_valid(met["a"]).to_numpy(), pc.is_valid(met["b"]).to_numpy()
    cut = np.flatnonzero(ends_a & ends_b)
    listed = []
    for flags, name, digits in ((ends_a, "a", both.digits[0]), (ends_b, "b", both.digits[1])):
        sizes = np.diff(np.cumsum(flags)[cut], prepend=0)  # tokens of each group
        listed.append(pc.binary_join(cut_lists(digits.take(pc.drop_null(met[name].combine_chunks())), sizes), ","))
    numbers = doc.to_numpy()
    groups = pc.binary_join(cut_lists(pc.binary_join_element_wise(*listed, "|"), np.bincount(numbers[cut], minlength=n)), ";")
    # Between two ends that follow each other lies one token of A and one of B: the next of each to end.
    a_ids, b_ids = (pc.fill_null_backward(met[name].combine_chunks()).cast(pa.int64()) for name in "ab")
    pairs = cut_lists(pc.bit_wise_or(pc.shift_left(a_ids, 32), b_ids), np.bincount(numbers, minlength=n))
    return {
        "n_a": pa.array(n_a, pa.int64()),
        "n_b": pa.array(n_b, pa.int64()),
        "a_ids": cut_lists(a["id"].combine_chunks(), n_a),
        "b_ids": cut_lists(b["id"].combine_chunks(), n_b),
        "groups": groups,
        "pairs": pairs,
    }


KINDS = {
    "n_a": T.LongType(),
    "n_b": T.LongType(),
    "a_ids": T.ArrayType(T.IntegerType()),
    "b_ids": T.ArrayType(T.IntegerType()),
    "groups": T.StringType(),
    "pairs": T.ArrayType(T.LongType()),
}


def align(df: DataFrame, a_path: str, b_path: str, column: str = "text", outputs: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """`df` without `column` and with the alignment of its whole texts; `outputs` names the columns that are wanted.

    `a_ids`, `b_ids`: the tokens, `n_a` and `n_b` of them. `groups`: the smallest runs of tokens that end together, as
    `a1,a2|b1;a3|b2,b3`. `pairs`: for each two occurrences whose bytes overlap, in order, `a << 32 | b`. Missing and empty
    texts and those that a tokenizer does not spell byte by byte have no tokens: zeros, empty lists and an empty string.
    Map-only. Long texts are encoded in chunks between which both tokenizers always cut, equal chunks of a task once. A
    text's lists have to fit a task. Repeated rows stay; columns of these names are replaced; no rows give no rows.
    """
    rest = [c for c in df.columns if c not in (column, *outputs)]
    schema = type(df.schema)([df.schema[c] for c in rest])
    for name in outputs:
        schema = schema.add(name, KINDS[name])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)
        for part in text_slices(batches, len(rest), SLICE):
            found = aligned(both, part.column(len(rest)))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], *(found[name] for name in outputs)], names=[*rest, *outputs])
        both.forget()
        give_back()

    return df.select(*rest, column).mapInArrow(run, schema)


def flat_pairs(batch: pa.RecordBatch) -> pa.Table:
    """A row per link: the number of its row in the batch, and its pair."""
    pairs = batch.column("pairs")
    return pa.table({"doc": pc.list_parent_indices(pairs), "pair": pc.list_flatten(pairs)})


def pair_counts(links: DataFrame) -> DataFrame:
    """`(pair, n, best)` of `links(pairs)`: the number of links of each pair, and whether no other pair of its id in B has more.

    Tasks count by `Table.group_by`; Spark sums the partial counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        for batch in batches:
            part = flat_pairs(batch).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
            held.append(part)
            if sum(t.num_rows for t in held) > KEPT_PAIRS:
                held = [merged()]
                if held[0].num_rows > KEPT_PAIRS // 2:
                    yield from held[0].to_batches()
                    held = []
        if held:
            yield from merged().to_batches()

    with batches_of(links.sparkSession, BATCH):
        counts = links.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        counts = stored(counts, "alignment-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))
    return counts.withColumn("b", b).join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def frequent_pairs(counts: DataFrame, bound: int) -> tuple[pa.Table, int]:
    """The pairs that have more than one `bound`th of all links, so fewer than `bound`, and the count they exceed."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = total // bound
    return counts.filter(F.col("n") > least).toArrow(), least


def link_sums(links: DataFrame, counts: DataFrame, bound: int = FREQUENT) -> DataFrame:
    """`(__row, n_best, count_sum)` of `links(__row, pairs)`: links whose pair is its B id's most frequent, and the sum of the links' counts.

    Frequent pairs, fewer than `bound` by the share that each must have, are looked up in the tasks; all others meet
    their counts in a shuffle join, where none has more rows than one `bound`th of all links. Rows need a number of their own.
    """
    frequent, least = frequent_pairs(counts, bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = flat_pairs(batch).join(frequent, keys="pair", join_type="left outer", use_threads=False)
            known = pc.is_valid(met["n"])
            sums = met.filter(known).append_column("one", pc.cast(met["best"].filter(known), pa.int64()))
            sums = sums.group_by("doc", use_threads=False).aggregate([("one", "sum"), ("n", "sum")])
            rare = met.filter(pc.invert(known)).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
            rare = rare.take(pc.sort_indices(rare["doc"])).combine_chunks()
            best, total = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(2))
            at = sums["doc"].to_numpy()
            best[at], total[at] = sums["one_sum"].to_numpy(), sums["n_sum"].to_numpy()
            sizes = np.bincount(rare["doc"].to_numpy(), minlength=batch.num_rows)
            pairs, ns = (cut_lists(rare[c].combine_chunks(), sizes) for c in ("pair", "count_all"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), pa.array(best), pa.array(total), pairs, ns], names=[ROW, "n_best", "count_sum", "rare", "ns"]
            )

    schema = f"{ROW} long, n_best long, count_sum long, rare array<long>, ns array<long>"
    with batches_of(links.sparkSession, BATCH):
        known = stored(links.select(ROW, "pairs").mapInArrow(run, schema), "alignment-sums")
    rare = known.select(ROW, F.explode(F.arrays_zip("rare", "ns")).alias("x")).select(ROW, "x.rare", "x.ns")
    others = counts.filter(F.col("n") <= least)
    found = (
        rare.join(others, rare["rare"] == others["pair"])
        .select(ROW, F.when(F.col("best"), F.col("ns")).otherwise(0).alias("n_best"), (F.col("ns") * F.col("n")).alias("count_sum"))
        .unionByName(known.select(ROW, "n_best", "count_sum"))
    )
    return found.groupBy(ROW).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
