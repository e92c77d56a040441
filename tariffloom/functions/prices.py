"""Price functions over string columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, let, lines, strip

#: Glyphs that mean "price on request".
ON_REQUEST = "\uf06e\uf0b7\u25a0\u25cf\u2022"
NUMBER = r"\d+(?:,\d{3})*(?:\.\d+)?"
PRICE = r"(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?"
#: Several numbers are one price only as groups of thousands parted by white space.
THOUSANDS = r"\d{1,3}(?:\s+\d{3})+(?:\.\d+)?"
#: What is taken out of a cell before it is read as a number, in order: (pattern, what stands there then).
TIDY = [(" ", ""), (",,", ","), (r"\.-$", ""), (r"^\.+|\.+$", "")]
LOWEST, HIGHEST = 50.0, 500_000.0
#: Nominal ratings that leak into price columns.
RATINGS = [0.1, 0.16, 0.25, 0.4, 0.63, 1, 1.6, 2.5, 4, 5, 6, 7, 9, 10, 12, 16, 18, 20, 22, 25, 28, 32, 40, 50, 54, 60, 63, 65, 70, 80, 85, 100, 120, 125, 160, 185, 200, 240, 250, 260, 300, 320, 330, 400, 520, 630, 800, 1000, 1250, 1600]
#: The ratings that the deduplication does not know.
NOT_IN_DEDUP = [65, 85, 120, 185, 240, 260, 300, 330, 520, 1250, 1600]
DEDUP_RATINGS = [r for r in RATINGS if r not in NOT_IN_DEDUP]


def on_request(v: Column) -> Column:
    return v.rlike(f"[{ON_REQUEST}]")


def parse_price(v: Column) -> Column:
    """The price that a cell states, or null.

    Letters and on-request glyphs rule a price out. Several numbers are one
    price only as groups of thousands parted by white space. A trailing ".-"
    and dots at the ends are dropped.
    """
    def tidy(one: Column) -> Column:
        for pattern, instead in TIDY:
            plain = re.escape(pattern).replace("\\ ", " ") == pattern
            one = F.replace(one, F.lit(pattern), F.lit(instead)) if plain else F.regexp_replace(one, pattern, instead)
        return one

    def stated(raw: Column) -> Column:
        grouped = F.replace(raw, F.lit(","), F.lit(""))
        spaced = let(grouped, lambda g: F.when(g.rlike(rf"(?U)^\s*{THOUSANDS}\s*$"), F.regexp_replace(g, r"(?U)\s+", "")))
        one = F.when(F.regexp_count(raw, F.lit(NUMBER)) <= 1, raw).otherwise(spaced)
        number = let(tidy(one), lambda x: F.when(x.rlike(rf"^{PRICE}\z"), F.replace(x, F.lit(","), F.lit(""))))
        return F.when(raw.rlike("[A-Za-z]") | on_request(raw), None).otherwise(number).try_cast("double")

    return let(strip(v), stated)


def rating_like(v: Column, ratings: list[float] = RATINGS) -> Column:
    return F.bround(v, 2).isin([float(r) for r in ratings])


def last_price(v: Column) -> Column:
    """The last number of a text that is a price."""
    found = F.filter(F.transform(F.regexp_extract_all(v, F.lit(f"({NUMBER})"), 1), parse_price), lambda p: p.isNotNull())
    return F.bround(F.try_element_at(found, F.lit(-1)), 2)


def trailing_price(v: Column) -> Column:
    """The number that ends a text, if no letter or digit touches it and it is 50 at least."""
    text = collapse(v)
    number = F.regexp_extract(text, rf"(?:^|[^A-Za-z0-9])({NUMBER})\s*\z", 1)
    price = F.when(~text.rlike(r"^\d{3,6}\s+\d{2,6}\z") & (number != ""), parse_price(number))
    return F.when(price >= LOWEST, F.bround(price, 2))


def inline_price_and_pack(v: Column) -> Column:
    """struct(price, pack) of the first line that ends with a price and a pack of the form a/b or a/b/c."""
    shape = rf"(?<!\d)({NUMBER})\s+(\d{{1,2}}\s*/\s*\d{{1,3}}(?:\s*/\s*\d{{1,3}})?)\s*\z"
    def read(line: Column) -> Column:
        flat = collapse(line)
        return F.struct(parse_price(F.regexp_extract(flat, shape, 1)).alias("price"), F.regexp_extract(flat, shape, 2).alias("pack"))

    found = F.filter(F.transform(lines(v), read), lambda s: s["price"] >= LOWEST)
    first = F.get(found, F.lit(0))
    pack = F.when(collapse(first["pack"]).rlike(r"^[A-Za-z0-9\-_/\.xX]+\z"), collapse(first["pack"])).otherwise("")
    return F.struct(F.bround(first["price"], 2).alias("price"), F.coalesce(pack, F.lit("")).alias("pack"))


def best_price(prices: Column) -> Column:
    """The greatest price that is no rating, else the greatest."""
    return F.bround(F.coalesce(F.array_max(F.filter(prices, lambda p: ~rating_like(p))), F.array_max(prices)), 2)


def line_prices(v: Column) -> Column:
    """Prices of 50 at least that lines of a cell state."""
    return F.filter(F.transform(lines(v), parse_price), lambda p: p >= LOWEST)


def sheet_price(v: Column) -> Column:
    """Price text of the sheet-matching path: without commas and closing dashes."""
    out = F.coalesce(v, F.lit(""))
    for mark in (",", "/-", ".-"):
        out = F.replace(out, F.lit(mark), F.lit(""))
    return strip(out)


def is_sheet_price(v: Column) -> Column:
    return sheet_price(v).rlike(r"^(\d+\.?\d*|\.\d+)\z")
