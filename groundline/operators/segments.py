"""Heading chunks of documents that are larger than a task: a document is many segments of lines.

Each segment is cut at its own headings. What a segment tells the next is small: how many sections it opened and which
titles are in force at its end. A scan over these summaries gives every segment the titles and the section number that it
starts with; the lines before its first heading are joined to the section that was open. Texts are shuffled to their
section, never to their document.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundline.functions.text import let, non_empty_lines, strip
from groundline.operators.chunk import HEADERS

SEGMENT_LINES = 5000


def to_segments(lines: DataFrame, lines_per_segment: int = SEGMENT_LINES) -> DataFrame:
    """`(doc_id, segment_no, text)` of `lines(doc_id, line_no, line)`: line numbers rise through a document and are unique in it."""
    number = F.floor(F.col("line_no") / lines_per_segment).alias("segment_no")
    held = F.sort_array(F.collect_list(F.struct("line_no", "line")))  # the lines of one segment
    return lines.groupBy("doc_id", number).agg(F.array_join(held["line"], "\n").alias("text"))


def segment_sections(text: Column, headers=HEADERS) -> Column:
    """The sections of a segment: `struct<titles, carried, own, body>`, the first one without a heading of its own.

    `titles` by level; where `carried` says so, the title in force before the segment counts instead. Cut as in
    `heading_chunks`: at one level inside the parts of the level above.
    """
    normal = F.concat(F.lit("\n"), F.array_join(non_empty_lines(text), "\n"))

    def section(part: Column, titles: list[Column], first: list[Column]) -> Column:
        body = F.when(F.instr(part, "\n") > 0, F.substring(part, F.instr(part, "\n") + 1, F.length(part)))
        carried = [reduce(lambda a, b: a & b, first[: level + 1]) for level in range(len(headers))]
        return F.array(
            F.struct(
                F.array(*titles).alias("titles"),
                F.array(*carried).alias("carried"),
                F.coalesce(*reversed(titles)).alias("own"),
                F.coalesce(body, F.lit("")).alias("body"),
            )
        )

    def split_level(part: Column, level: int, titles: list[Column], first: list[Column]) -> Column:
        if level == len(headers):
            return section(part, titles, first)
        marker = headers[level][0]
        pieces = F.split(part, rf"\n(?=\Q{marker}\E(?: |\n|\z))", -1)

        def under(piece: Column, i: Column) -> Column:
            first_line = F.substring_index(piece, "\n", 1)
            title = F.when(i > 0, strip(F.substring(first_line, len(marker) + 1, F.length(first_line))))
            return split_level(piece, level + 1, [*titles, title], [*first, i == 0])

        return F.flatten(F.transform(pieces, under))

    return split_level(normal, 0, [], [])


def chunk_segments(segments: DataFrame, headers=HEADERS, keep_heading_only: bool = True) -> DataFrame:
    """`(doc_id, chunk_no, content, headers)` of `segments(doc_id, segment_no, text)`, as `chunk_by_heading` has for the whole text.

    A document's text is its segments in order with a line end between each two; missing and blank ones hold no line.
    Only a section has to fit a task. The scans over a document's segments and sections see numbers and titles, not texts.
    """
    cut = segments.select("doc_id", "segment_no", segment_sections(F.coalesce("text", F.lit("")), headers).alias("sections"))
    last = F.element_at("sections", -1)
    summary = cut.select(
        "doc_id",
        "segment_no",
        (F.size("sections") - 1).alias("opened"),
        *[F.when(~last["carried"][i], F.struct(last["titles"][i].alias("title"))).alias(f"set_{i}") for i in range(len(headers))],
    )
    before = Window.partitionBy("doc_id").orderBy("segment_no").rowsBetween(Window.unboundedPreceding, -1)
    titles = F.array(*[F.last(f"set_{i}", ignorenulls=True).over(before)["title"] for i in range(len(headers))])
    opened = F.coalesce(F.sum("opened").over(before), F.lit(0))
    carried = summary.select("doc_id", "segment_no", opened.alias("opened_before"), titles.alias("titles_before"))

    # null-safe, so that no filter is put below one side alone and both read the same shuffle
    same = F.col("c.doc_id").eqNullSafe(F.col("s.doc_id")) & F.col("c.segment_no").eqNullSafe(F.col("s.segment_no"))
    pieces = cut.alias("s").join(carried.alias("c"), same).select(
        "s.doc_id", "s.segment_no", "titles_before", "opened_before", F.posexplode("sections").alias("i", "section")
    )

    def in_force(t: Column, level: Column) -> Column:
        return F.when(F.col("section.carried")[level], F.get("titles_before", level)).otherwise(t)

    pieces = pieces.select(
        "doc_id",
        (F.col("opened_before") + F.col("i")).alias("section_no"),
        "segment_no",
        F.when((F.col("i") > 0) | (F.col("opened_before") == 0), F.struct(F.transform("section.titles", in_force).alias("titles"), F.col("section.own").alias("own"))).alias("head"),
        F.col("section.body").alias("body"),
    )
    # a section's parts: one in the segment that opens it, then one in each that goes on with it
    parts = F.sort_array(F.collect_list(F.when(F.col("body") != "", F.struct("segment_no", "body"))))
    sections = pieces.groupBy("doc_id", "section_no").agg(
        F.array_join(F.transform(parts, lambda p: p["body"]), "\n").alias("body"), F.first("head", ignorenulls=True).alias("head")
    )
    own = F.col("head.own") if keep_heading_only else F.lit(None).cast("string")
    content = F.coalesce(F.when(F.col("body") != "", F.col("body")), own, F.lit(""))
    names = F.array(*[F.lit(name) for _, name in headers])
    path = let(F.col("head.titles"), lambda t: F.map_filter(F.map_from_arrays(names, t), lambda _, title: title.isNotNull()))
    full = sections.select("doc_id", "section_no", content.alias("content"), path.alias("headers")).filter("content <> ''")
    order = Window.partitionBy("doc_id").orderBy("section_no")
    numbers = full.select("doc_id", "section_no").withColumn("chunk_no", F.row_number().over(order) - 1)
    same = F.col("f.doc_id").eqNullSafe(F.col("n.doc_id")) & F.col("f.section_no").eqNullSafe(F.col("n.section_no"))
    return full.alias("f").join(numbers.alias("n"), same).select("f.doc_id", "chunk_no", "content", "headers")
