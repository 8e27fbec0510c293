"""SimHash near-duplicates: fingerprints of word shingles, multi-index hashing, classes of linked fingerprints."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundline.llm.common import stored
from groundline.llm.components import components

BITS, DISTANCE = 64, 2  # links of at most two bits
SEGMENTS = 2  # so one of them differs in one bit at most
CROWD = 64  # fingerprints that may share a segment's value
SHINGLE = 3
SEED = 42
WEIGHED = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a whole text, as a signed number: a bit is set if over half the shingle hashes have it."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), dtype=">u8", count=len(shingles))
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), WEIGHED):
        part = hashes[start : start + WEIGHED]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def with_fingerprint(docs: DataFrame, text_column: str = "text", result: str = "fingerprint") -> DataFrame:
    """`docs` without the text and with its SimHash as a bigint. A missing text counts as one without words: 0."""
    rest = [c for c in docs.columns if c not in (text_column, result)]
    schema = type(docs.schema)([docs.schema[c] for c in rest]).add(result, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text) for text in batch.column(len(rest)).to_pylist()]
            columns = [*batch.columns[: len(rest)], pa.array(prints, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, result])

    return docs.select(*rest, text_column).mapInArrow(run, schema)


def ball(value: Column, start: int, width: int, radius: int) -> Column:
    """`value` and all that differ from it in at most `radius` of `width` bits from `start` on."""
    none = F.lit(0).cast("long")
    masks = [0]
    for n in range(1, radius + 1):
        masks += [sum(1 << i for i in bits) for bits in combinations(range(start, start + width), n)]
    signed = [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]
    return F.transform(F.array(none, *[F.lit(m).cast("long") for m in signed[1:]]), lambda mask: value.bitwiseXOR(mask))


def links(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """Edges `(a, b)` between distinct fingerprints of `prints(fingerprint)` that connect all that differ in at most `distance` bits.

    Multi-index hashing: there is a table for each segment of bits, keyed by the segment's value. Of two fingerprints at
    that distance, some segment differs in at most `distance // segments` bits, so each fingerprint asks every table for
    the small ball around its own value; what it fetches is verified by the complete distance.

    A value that more than `crowd` fingerprints share is no key: its members, and all whose balls touch it, are linked by
    whole fingerprints instead. There balls of half the distance meet exactly if the distance is kept; those that meet at
    one are linked each with the next, so a crowd of n gives a ball of entries each and never its pairs; for that the
    distance has to be even. No link is lost:
    the segment in which two fingerprints are near is keyed by one of them, and either that key is asked or both are in the crowd.
    """
    if distance % 2:
        raise ValueError("crowds are linked by balls of half the distance, so it has to be even")
    width = BITS // segments
    spans = [(s * width, width if s < segments - 1 else BITS - s * width) for s in range(segments)]

    def value(print_: Column, start: int, size: int) -> Column:
        mask = ((1 << size) - 1) << start
        return print_.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long"))

    print_ = F.col("fingerprint")
    tables = F.array(*[F.struct(F.lit(s).alias("segment"), value(print_, *span).alias("value")) for s, span in enumerate(spans)])
    table = prints.select("fingerprint", F.explode(tables).alias("key")).select("fingerprint", "key.*")
    crowded = table.groupBy("segment", "value").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("segment", "value")
    crowded = stored(crowded, "simhash-crowded")  # fewer than one for `crowd` entries of the tables
    def asks(s: int, span: tuple[int, int]) -> Column:
        values = ball(value(print_, *span), *span, distance // segments)
        return F.transform(values, lambda v: F.struct(F.lit(s).alias("segment"), v.alias("value")))

    asked = F.concat(*[asks(s, span) for s, span in enumerate(spans)])
    asked = prints.select(print_.alias("asks"), F.explode(asked).alias("key")).select("asks", "key.*")
    key = ["segment", "value"]
    fetched = asked.join(table.join(crowded, key, "left_anti"), key)
    near = F.bit_count(F.col("asks").bitwiseXOR(F.col("fingerprint"))) <= distance
    found = fetched.filter((F.col("asks") > F.col("fingerprint")) & near).select(F.col("asks").alias("a"), F.col("fingerprint").alias("b"))
    if not crowded.isEmpty():
        inside = asked.join(crowded, key, "left_semi").select(F.col("asks").alias("fingerprint")).distinct()
        found = found.union(_crowd_links(inside, distance))
    return found.distinct()


def _crowd_links(prints: DataFrame, distance: int) -> DataFrame:
    """`links` by whole fingerprints: balls of half the distance around both, which meet at a common entry."""
    entries = prints.select("fingerprint", F.explode(ball(F.col("fingerprint"), 0, BITS, distance // 2)).alias("entry"))
    previous = F.lag("fingerprint").over(Window.partitionBy("entry").orderBy("fingerprint"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return entries.select(F.col("fingerprint").alias("a"), previous.alias("b")).filter(near)


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`(doc_id, key, fingerprint, class, component_id)`, a row per document: the smallest id that its links reach, its own included.

    `key` is the md5 of the text (NULL for a missing one), `class` the smallest fingerprint that the links reach. Equal texts share a fingerprint and are never paired; classes
    are found among distinct fingerprints that have a link at all. Empty and missing texts have fingerprint 0, which links
    like any other. A missing id never becomes a class id unless its class has no other. Repeated rows stay. No rows give
    no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.md5(F.col(text_column).cast("binary")).alias("key"), F.col(text_column).alias("text"))
    rows = stored(with_fingerprint(rows), "simhash-rows")
    prints = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-prints")
    joined = stored(components(stored(links(prints), "simhash-links")), "simhash-classes")  # (node, class)
    smallest = (
        joined.join(prints, joined["node"] == prints["fingerprint"])
        .groupBy("class")
        .agg(F.min("first_id").alias("component_id"))
    )
    linked = joined.join(smallest, "class").select(F.col("node").alias("fingerprint"), "class", "component_id")
    known = prints.join(linked, "fingerprint", "left").select(
        "fingerprint",
        F.coalesce("class", "fingerprint").alias("class"),
        F.coalesce("component_id", "first_id").alias("component_id"),
    )
    return rows.join(stored(known, "simhash-known"), "fingerprint", "left").select("doc_id", "key", "fingerprint", "class", "component_id")


def hex_print(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def one_per_class(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` without near-duplicates: of each class the row of smallest id, then of smallest text hash, once."""
    chosen = (
        classes(docs, id_column, text_column)
        .groupBy("class")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.coalesce("key", F.lit("")).alias("key"))).alias("kept"))
        .select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.key").alias("kept_key"))
    )
    rows = docs.select(
        F.col(id_column).alias("row_id"),
        F.coalesce(F.md5(F.col(text_column).cast("binary")), F.lit("")).alias("row_key"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
    )
    same = F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_key") == F.col("kept_key"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["row_id", "row_key"]).select("row.*")
