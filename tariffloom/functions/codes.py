"""Item code functions over string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .prices import parse_price
from .text import collapse, is_plain, let, strip

UNITS = "MA|A|V|KV|W|KW|MW|VA|KVA|HZ"
#: Shapes that look like codes and are none, by what they are.
REJECTED = {
    "unit": r"^\d+(?:\.\d+)?(?:MA|A|P|V|KV|W|KW|MW|HZ|KA)\z",
    "pole": r"^\d+[\-\s]?(?:P|POLE|POLES)\z",
    "protection": r"^IP\d{1,3}(?:/IK\d{1,3})?\z",
    "dimension": r"^\d{1,4}X\d{1,4}(?:/\d{1,4})+\z",
    "named dimension": r"^[A-Z]{1,12}\d{2,4}X\d{2,4}(?:X\d{2,4})+(?:-\d{2,4})?\z",
    "voltage heading": r"^[A-Z]{5,}\d{2,4}K?V\z",
    "rating": rf"^\d+(?:\.\d+)?(?:\s*(?:TO|[-–—/])\s*\d+(?:\.\d+)?(?:\s*(?:{UNITS}))?)+\s*(?:{UNITS})?\z",
    "range": r"^\d+(?:\.\d+)?\s?(?:TO|[-–—]|//)\s?\d+(?:\.\d+)?\z",
}
CODE = r"^(?=.*[A-Za-z])(?=.*\d)[A-Za-z0-9][A-Za-z0-9\-_/.]{2,}\z"


def clean_code(v: Column) -> Column:
    """Upper case without white space."""
    return let(v, lambda x: F.when(is_plain(x), F.upper(x)).otherwise(F.regexp_replace(F.upper(strip(x)), r"(?U)\s+", "")))


def strip_footnote(v: Column) -> Column:
    """Without one footnote digit and ")" behind a code."""
    raw = strip(v)
    head = F.regexp_extract(raw, r"^([A-Za-z0-9][A-Za-z0-9\-_/.]*?)[0-9¹²³⁰-⁹]\)\s*\z", 1)
    return F.when(head != "", head).otherwise(raw)


def looks_like_code(v: Column, numeric: bool = False) -> Column:
    """Letters and digits, three characters at least, and none of the rejected shapes.

    ``numeric``: 5 to 12 digits count as well. Null and empty are none.
    """
    def holds(x: Column) -> Column:
        good = x.rlike(CODE) | x.rlike(r"^\d{5,12}\z") if numeric else x.rlike(CODE)
        for shape in REJECTED.values():
            good = good & ~x.rlike(f"(?i){shape}")
        return F.coalesce(good, F.lit(False))

    return let(v, holds)


def is_code_line(v: Column) -> Column:
    """Is the line one token that looks like a code?"""
    one = lambda raw: (is_plain(raw) | ~raw.rlike(r"(?U)\s")) & looks_like_code(clean_code(raw))
    return let(strip(v), one)


def spaced_code(v: Column) -> Column:
    """Two groups of digits as one code; a 1, 2 or 3 that ends a right group of three is a footnote."""
    left, right = F.regexp_extract(strip(v), r"^(\d+)[ \t]+(\d+)\z", 1), F.regexp_extract(strip(v), r"^(\d+)[ \t]+(\d+)\z", 2)
    cut = F.concat(left, F.substring(right, 1, 2))
    footnote = right.rlike(r"^\d{2}[123]\z") & looks_like_code(cut, numeric=True)
    return F.when(footnote, cut).otherwise(clean_code(v))


def is_strong_code(v: Column, numeric: bool = False) -> Column:
    """A code with digits enough to overrule a weak one."""
    digits = F.length(F.regexp_replace(v, r"[^0-9]", ""))
    all_digits = v.rlike(r"^\d+\z")
    word = v.rlike(r"(?i)^[A-Z]{3,}(?:-[A-Z]{2,})*-\d{1,2}\z")
    chain = v.rlike(r"(?i)^\d+(?:[./-]\d+)+[A-Z]{0,3}\z") | v.rlike(r"(?i)^\d+(?:\.\d+)?[A-Z]{1,3}(?:[/-]\d+(?:\.\d+)?[A-Z]{1,3})+\z")
    strong = F.when(all_digits, F.lit(numeric) & (F.length(v) >= 5)).otherwise(~chain & (digits >= 3))
    return F.coalesce(looks_like_code(v, numeric) & ~word & strong, F.lit(False))


def is_section_heading(v: Column) -> Column:
    """Three words or more, all of letters, neither code nor price."""
    text = collapse(v)
    return text.rlike(r"^[A-Za-z&()'.-]+( [A-Za-z&()'.-]+){2,}\z") & ~is_code_line(text) & parse_price(text).isNull()


def sheet_code(v: Column) -> Column:
    """Code of the sheet-matching path: upper case without white space, "-", "_" and "/"."""
    return F.regexp_replace(strip(F.upper(F.coalesce(v, F.lit("")))), r"(?U)[\s\-_/]+", "")


def is_sheet_code(v: Column) -> Column:
    code = sheet_code(v)
    return (F.length(code) >= 4) & code.rlike(r"\p{L}") & code.rlike(r"\d")
