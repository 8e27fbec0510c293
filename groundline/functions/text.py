"""Small text helpers shared by the cleaning, chunking and token functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.strip() and `\s` treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a Java regex class; needs the (?U) flag.
SPACE_CLASS = r"[\s\x1c-\x1f]"
NON_SPACE_CLASS = r"[^\s\x1c-\x1f]"


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (`trim` alone removes spaces only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def replace_text(col: Column, search: str, replacement: str) -> Column:
    return F.replace(col, F.lit(search), F.lit(replacement))


def let(col: Column, body) -> Column:
    """Evaluate `col` once per row and hand it to `body`, which may use it any number of times."""
    return F.transform(F.array(col), body)[0]


def present(col: Column) -> Column:
    """Generator that gives one row per non-NULL value and none for NULL.

    For costly columns: a filter on one is pushed below the projection and evaluates it a second time.
    """
    return F.explode(F.array_compact(F.array(col)))


def non_empty_lines(col: Column) -> Column:
    """Lines of a text, stripped, without the blank ones."""
    return F.filter(F.transform(F.split(col, "\n", -1), strip), lambda line: line != "")
