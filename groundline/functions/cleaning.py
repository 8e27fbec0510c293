"""Text cleaning as `Column -> Column` steps, in the order in which they have to run.

Every step is a built-in expression on one row, so a cleaning job is map-only. The patterns are
written so that no step backtracks more than linearly over a text: line patterns are anchored at
the line start, character runs are possessive, and strip is a character trim instead of a regex.

Flag notes: `(?d)` makes only `\\n` a line end, `(?U)` makes `\\s` cover Unicode, `\\p{Nd}` is any
decimal digit.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundline.functions.text import NON_SPACE_CLASS, SPACE_CLASS, let, replace_text, strip

PAGE_BREAK = "-----"
SOFT_HYPHEN = "\u00ad"

# Symbol rewrites, applied in this order.
SYMBOLS = (
    ("ㅇ", "- "),
    ("→", " 에서 "),
    ("’", "20"),
    ("☞", "- "),
)

# Characters that are deleted.
DELETED_CHARACTERS = "*[]▲「」"


def _replace_near(text: Column, mark: str, pattern: str, replacement: str) -> Column:
    """Regex replacement for a pattern that cannot match without the literal `mark`.

    Looking for the mark is a byte search; texts without it skip the pattern.
    """
    return let(
        text, lambda t: F.when(F.contains(t, F.lit(mark)), F.regexp_replace(t, pattern, replacement)).otherwise(t)
    )


def drop_syntax_error_lines(text: Column) -> Column:
    return _replace_near(text, "syntax error", r"(?dm)^.*syntax error.*\n?", "")


def split_pages(text: Column) -> Column:
    return F.split(text, PAGE_BREAK, -1)


def remove_footnotes(pages: Column, anchored: bool = False) -> Column:
    """Cut each page at its first `digits) `; with `anchored`, only where that starts a line."""
    start = r"(?dm)^" if anchored else r"(?<!\p{Nd})"
    pattern = start + r"(?s:\p{Nd}++\) .*)"
    return F.transform(pages, lambda page: strip(_replace_near(page, ") ", pattern, "")))


def remove_references(pages: Column) -> Column:
    """Delete in-text footnote marks such as `[12)]`."""
    return F.transform(pages, lambda page: strip(_replace_near(page, ")]", r"\[\p{Nd}++\)\]", "")))


def join_pages(pages: Column) -> Column:
    return F.array_join(pages, f"\n\n{PAGE_BREAK}\n")


def control_to_space(text: Column) -> Column:
    return replace_text(text, "\x01", " ")


def fold_deep_heading(text: Column) -> Column:
    return replace_text(text, "####", "#")


def numbered_lines_to_headings(text: Column) -> Column:
    return _replace_near(text, ". ", r"(?dm)^(\p{Nd}+)\. ", r"## $1. ")


def boxed_lines_to_headings(text: Column) -> Column:
    return _replace_near(text, "□", r"(?dm)^□", "### ")


def rewrite_symbols(text: Column, symbols=SYMBOLS) -> Column:
    return reduce(lambda acc, pair: replace_text(acc, *pair), symbols, text)


def delete_characters(text: Column) -> Column:
    # a byte search per character is cheaper than `translate`, which rebuilds every text
    return reduce(lambda acc, character: replace_text(acc, character, ""), DELETED_CHARACTERS, text)


def drop_comma_parentheses(text: Column) -> Column:
    """Delete innermost parentheses that hold a comma; parentheses without one stay."""
    return _replace_near(text, "(", r"\([^(),]*+,[^()]*+\)", "")


def drop_page_breaks(text: Column) -> Column:
    return replace_text(text, PAGE_BREAK, "")


def drop_blank_line_pairs(text: Column) -> Column:
    return replace_text(text, "\n\n", "")


def fold_double_spaces(text: Column) -> Column:
    return replace_text(text, "  ", " ")


def break_before_headings(text: Column) -> Column:
    return _replace_near(text, "#", r"(#+)", "\n\n$1")


def repair_c_sharp(text: Column) -> Column:
    return _replace_near(text, "#", rf"(?U)C{SPACE_CLASS}*#", "C#")


def break_before_list_items(text: Column) -> Column:
    return _replace_near(strip(text), "- ", rf"(?U)- (?={NON_SPACE_CLASS})", "\n\n- ")


def break_before_table_labels(text: Column) -> Column:
    return _replace_near(text, "표 ", r"(표 \p{Nd})", "\n\n$1")


def break_after_table_labels(text: Column) -> Column:
    """Break before the first `|` that follows a table label on the same line.

    The text is cut at `|`; a part gets the break if its last line holds a label, so each part is looked at once.
    """

    def broken(parts: Column) -> Column:
        last = F.size(parts) - 1
        label = lambda part: F.substring_index(part, "\n", -1).rlike(r"표 \p{Nd}")
        return F.array_join(
            F.transform(parts, lambda part, i: F.when((i < last) & label(part), F.concat(part, F.lit("\n\n"))).otherwise(part)), "|"
        )

    def near(t: Column) -> Column:
        return F.when(t.contains("표 ") & t.contains("|"), let(F.split(t, r"\|", -1), broken)).otherwise(t)

    return let(text, near)


def drop_side_notes(text: Column) -> Column:
    """Replace each `※` note, up to and including its soft hyphen, by a newline.

    Only the part up to the last soft hyphen can hold a closed note, so the pattern runs on that part.
    """

    def cut(t: Column) -> Column:
        tail = F.substring_index(t, SOFT_HYPHEN, -1)
        head = F.substring(t, F.lit(1), F.length(t) - F.length(tail))
        note = f"※[^{SOFT_HYPHEN}]*+{SOFT_HYPHEN}"
        return F.concat(F.regexp_replace(head, note, "\n"), tail)

    return let(text, cut)


STEPS = (
    drop_syntax_error_lines,
    split_pages,
    remove_footnotes,
    remove_references,
    join_pages,
    control_to_space,
    fold_deep_heading,
    numbered_lines_to_headings,
    boxed_lines_to_headings,
    rewrite_symbols,
    delete_characters,
    drop_comma_parentheses,
    drop_page_breaks,
    drop_blank_line_pairs,
    fold_double_spaces,
    break_before_headings,
    repair_c_sharp,
    break_before_list_items,
    break_before_table_labels,
    break_after_table_labels,
    drop_side_notes,
)


def clean_through(text: Column, last_step: int, anchored: bool = False, symbols=SYMBOLS) -> Column:
    """The text after steps 1..last_step. Steps 2 to 4 work on the array of pages.

    `anchored` cuts footnotes only where they start a line; `symbols` are the pairs that step 10 rewrites.
    """
    options = {remove_footnotes: {"anchored": anchored}, rewrite_symbols: {"symbols": symbols}}
    return reduce(lambda acc, step: step(acc, **options.get(step, {})), STEPS[:last_step], text)


def clean_text(text: Column, **options) -> Column:
    return clean_through(text, len(STEPS), **options)


def clean(df: DataFrame, text_col: str = "text", out_col: str | None = None, **options) -> DataFrame:
    """For `df.transform(clean, "md")`: replace (or add) a cleaned text column."""
    return df.withColumn(out_col or text_col, clean_text(F.col(text_col), **options))
