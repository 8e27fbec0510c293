"""Chunking. All of it happens inside the row: a document is one value, so nothing is shuffled."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundline.functions.text import SPACE_CLASS, let, non_empty_lines, strip

# Heading markers and the names of the levels.
HEADERS = (
    ("#", "Header 1"),
    ("##", "Header 2"),
    ("###", "Header 3"),
)


def heading_chunks(text: Column, headers=HEADERS, keep_heading_only: bool = True) -> Column:
    """Array of `struct<content string, headers map<string,string>>`, one entry per section.

    The text is split at the first level's heading lines, each part at the second level's, and so
    on. A part therefore knows the heading it stands under at every level, and a heading resets the
    deeper levels, without any running state.

    Lines are stripped and blank ones dropped. A heading line is the marker followed by a space or
    the line end; it goes to `headers`, not to `content`. A section with no other line keeps its
    heading text as content, or is left out with `keep_heading_only=False`.
    """
    # every line, the first too, now follows a newline
    normal = F.concat(F.lit("\n"), F.array_join(non_empty_lines(text), "\n"))

    def section(part: Column, titles: list[Column]) -> Column:
        body = let(F.instr(part, "\n"), lambda end: F.when(end > 0, F.substring(part, end + 1, F.length(part))))
        own_title = F.coalesce(*reversed(titles)) if keep_heading_only else F.lit(None).cast("string")
        content = F.coalesce(let(body, lambda text: F.when(text != "", text)), own_title, F.lit(""))
        names = F.array(*[F.lit(name) for _, name in headers])
        path = F.map_from_arrays(names, F.array(*titles))
        return F.array(
            F.struct(content.alias("content"), F.map_filter(path, lambda _, title: title.isNotNull()).alias("headers"))
        )

    def split_level(part: Column, level: int, titles: list[Column]) -> Column:
        if level == len(headers):
            return section(part, titles)
        marker = headers[level][0]
        heading = rf"\n(?=\Q{marker}\E(?: |\n|\z))"
        # the pattern is compiled for every part, so only for parts that can match
        pieces = F.when(F.contains(part, F.lit(f"\n{marker}")), F.split(part, heading, -1)).otherwise(F.array(part))

        def under(piece: Column, i: Column) -> Column:
            first_line = F.substring_index(piece, "\n", 1)
            title = F.when(i > 0, strip(F.substring(first_line, len(marker) + 1, F.length(first_line))))
            # every section below takes the title from here
            return let(title, lambda known: split_level(piece, level + 1, [*titles, known]))

        return F.flatten(F.transform(pieces, under))

    return F.filter(split_level(normal, 0, []), lambda chunk: chunk["content"] != "")


def chunk_by_heading(
    docs: DataFrame, text_col: str = "text", headers=HEADERS, keep_heading_only: bool = True
) -> DataFrame:
    """`(doc_id, chunk_no, content, headers)`, `chunk_no` dense from 0 in text order."""
    chunks = heading_chunks(F.col(text_col), headers, keep_heading_only)
    return docs.select("doc_id", F.posexplode(chunks).alias("chunk_no", "chunk")).select(
        "doc_id", "chunk_no", "chunk.content", "chunk.headers"
    )


def chunk_json(chunks: DataFrame) -> DataFrame:
    """Add `json`: content and headers as JSON text, non-ASCII kept readable."""
    return chunks.withColumn("json", F.to_json(F.struct("content", "headers")))


def chunk_by_tokens(docs: DataFrame, size: int, text_col: str = "text", overlap: int = 0) -> DataFrame:
    """Runs of `size` whitespace-separated tokens, joined by single spaces.

    With `overlap`, a run begins with the last so many tokens of the one before. The last run is the first that reaches the
    end, so none lies wholly inside another.
    """
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be shorter than a run")

    def pieces(words: Column) -> Column:
        last = F.greatest(F.size(words) - overlap, F.lit(1))
        starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), last, F.lit(size - overlap)))
        return F.transform(starts, lambda start: F.array_join(F.slice(words, start, F.lit(size)), " "))

    words = F.filter(F.split(F.col(text_col), rf"(?U){SPACE_CLASS}+", -1), lambda w: w != "")
    return docs.select("doc_id", F.posexplode(let(words, pieces)).alias("chunk_no", "content"))


def chunk_by_paragraph(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Non-empty parts between blank lines, stripped."""
    parts = F.filter(F.transform(F.split(F.col(text_col), "\n\n", -1), strip), lambda p: p != "")
    return docs.select("doc_id", F.posexplode(parts).alias("chunk_no", "content"))
