"""Text and header functions over string columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line boundaries, as Python's splitlines sees them.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: What stands for the currency marker in headers.
CURRENCY_SIGNS = "\u20b9`"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is made once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_plain(v: Column) -> Column:
    """Is every character a visible one of ASCII? Most cells are, and need none of the slower patterns for all white space."""
    return ~v.rlike("[^!-~]")


def strip(v: Column) -> Column:
    """Without white space (of any kind) at both ends."""
    return let(v, lambda x: F.when(is_plain(x), x).otherwise(F.regexp_replace(x, r"(?U)^\s+|\s+\z", "")))


def collapse(v: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return let(v, lambda x: F.when(is_plain(x), x).otherwise(F.trim(F.regexp_replace(x, r"(?U)\s+", " "))))


def lines(v: Column) -> Column:
    """The stripped lines of a cell that are not blank."""
    return F.filter(F.transform(F.split(v, LINE_END), strip), lambda x: x != "")


def pack_tokens(v: Column) -> Column:
    """Lines of a cell; a line of several whole numbers gives each of them."""
    return F.flatten(F.transform(lines(v), lambda x: F.when(x.rlike(r"^\d+(\s+\d+)+\z"), F.split(x, r"\s+")).otherwise(F.array(x))))


def normalize_header(v: Column) -> Column:
    """Lower case, currency signs as the word inr, all else but a-z, 0-9 as single spaces."""
    marked = F.regexp_replace(F.lower(v), f"[{CURRENCY_SIGNS}]", " inr ")
    return F.trim(F.regexp_replace(F.regexp_replace(marked, r"[^a-z0-9 ]+", " "), r" +", " "))


def _marked(normalized: Column, markers: list[str], fold) -> Column:
    """``fold`` of an array of markers and a test of one: the header is made once, however many markers are sought."""
    words = F.array(*(F.lit(f" {m} ") for m in markers)) if markers else F.array().cast("array<string>")
    return let(F.concat(F.lit(" "), normalized, F.lit(" ")), lambda h: fold(words, lambda m: F.contains(h, m)))


def has_any_marker(normalized: Column, markers: list[str]) -> Column:
    """Does one of the markers stand in the normalized header as whole words?"""
    return F.coalesce(_marked(normalized, markers, F.exists), F.lit(False))


def marker_count(normalized: Column, markers: list[str]) -> Column:
    return F.coalesce(_marked(normalized, markers, lambda words, test: F.size(F.filter(words, test))), F.lit(0))


def longest(cells: Column) -> Column:
    """The first of the longest strings of an array; empty if there is none."""
    return F.aggregate(cells, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
