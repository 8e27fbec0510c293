"""Documents as pages, and the marked-up view that the fixtures are given."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundline.functions.cleaning import PAGE_BREAK, SOFT_HYPHEN


def page_range(docs: DataFrame, first: int = 5, last: int = 19, text_col: str = "text") -> DataFrame:
    """Pages `first..last` (zero-based, inclusive) as rows `(doc_id, page_no, page)`."""
    pages = F.split(F.col(text_col), PAGE_BREAK, -1)
    numbered = docs.select("doc_id", F.posexplode(pages).alias("page_no", "page"))
    return numbered.filter(F.col("page_no").between(first, last))


def marked(documents: DataFrame) -> DataFrame:
    """`(doc_id, md)`: each line of a document gets a marker by its position, in turns of twelve.

    The given documents carry no markup at all; this puts in what the cleaning steps look for.
    """

    def mark(line, i):
        texts = (
            F.concat(F.lit("# "), line),
            F.concat(F.lit("1. "), line),
            F.concat(F.lit("□ "), line),
            F.concat(F.lit("ㅇ "), line),
            F.concat(line, F.lit(" [3)]")),
            F.concat(line, F.lit(" (A, B)")),
            F.concat(F.lit("표 1 "), line, F.lit(" | a | b |")),
            F.concat(F.lit("syntax error: "), line),
            F.concat(F.lit("※ "), line, F.lit(SOFT_HYPHEN)),
            F.lit(PAGE_BREAK),
            F.concat(F.lit("3) "), line),
            F.concat(F.lit("#### "), line, F.lit(" →’24☞▲「x」")),
        )
        marked_line = F.when(i % 12 == 0, texts[0])
        for turn, text in enumerate(texts[1:], start=1):
            marked_line = marked_line.when(i % 12 == turn, text)
        return marked_line

    lines = F.transform(F.split("text", "\n", -1), mark)
    return documents.select("doc_id", F.array_join(lines, "\n").alias("md"))
