"""Pack size functions over string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import is_code_line
from .prices import parse_price
from .text import collapse, pack_tokens

#: The unit words of a pack line.
PACK_LINE = r"(?i)^(?:\d+\s*/\s*\d+|\d+(?:\.\d+)?\s*(?:nos?|pcs?|pc|set|box|pkt|unit|uom))\z"
#: Points of a line of a pack cell by what it shows; a line that is a code shows nothing else.
POINTS = {"code": -4, "slash": 5, "unit": 3, "small": 2, "word": -2}
#: Signs that make a line look like a pack, the share of lines that must, and the points for that.
LIKE, LIKE_SHARE, LIKE_POINTS = ("slash", "unit", "small"), 0.7, 4
#: Ranks of a pack value by the first that holds.
RANKS = {"empty": 0, "code": -3, "slash": 3, "digits": 2, "token": 1}


def clean_pack(v: Column) -> Column:
    """The pack if it is one token of letters, digits and "-_/.", else empty."""
    flat = collapse(v)
    return F.when(flat.rlike(r"^[A-Za-z0-9\-_/.]+\z"), flat).otherwise("")


def is_pack_token(v: Column) -> Column:
    return collapse(v).rlike(r"^\d{1,2}(\s*/\s*\d{1,2})?\z")


def pack_value_quality(v: Column) -> Column:
    """Rank of a pack value: -3 for a code, 3 with "/", 2 for digits, 1 for a token, else 0."""
    holds = {"empty": v == "", "code": v.rlike("[A-Za-z]") & is_code_line(v), "slash": F.contains(v, F.lit("/")), "digits": v.rlike(r"^\d+\z"), "token": v.rlike(r"^[A-Za-z0-9\-_/.]+\z")}
    out = F.lit(0)
    for name, rank in reversed(RANKS.items()):
        out = F.when(holds[name], rank).otherwise(out)
    return out


def row_quality(pack: Column, particulars: Column) -> Column:
    return pack_value_quality(pack) + (particulars != "").cast("int")


def _small_whole(line: Column) -> Column:
    p = parse_price(line)
    return F.coalesce((p == F.floor(p)) & (p > 0) & (p <= 100), F.lit(False))


def pack_line_count(v: Column) -> Column:
    return F.size(F.filter(pack_tokens(v), lambda x: x.rlike(PACK_LINE) | _small_whole(x)))


def pack_column_quality(v: Column) -> Column:
    """How much the lines of a cell look like pack sizes: points for each, and four for 70 percent of them."""
    def points(line: Column) -> Column:
        slash = F.contains(line, F.lit("/"))
        shown = {"slash": slash, "unit": line.rlike(PACK_LINE), "small": _small_whole(line), "word": line.rlike("[A-Za-z]") & ~slash}
        score = sum((F.when(shown[n] & (~slash if n == "small" else F.lit(True)), POINTS[n]).otherwise(0) for n in shown), F.lit(0))
        like = sum((shown[n].cast("int") for n in LIKE), F.lit(0))
        code = is_code_line(line)
        return F.struct(F.when(code, POINTS["code"]).otherwise(score).alias("score"), F.when(code, 0).otherwise(like).alias("like"))

    scored = F.transform(pack_tokens(v), points)
    total = F.aggregate(scored, F.struct(F.lit(0).alias("score"), F.lit(0).alias("like")), lambda s, x: F.struct((s["score"] + x["score"]).alias("score"), (s["like"] + x["like"]).alias("like")))
    n = F.size(scored)
    return F.when(n == 0, 0).otherwise(total["score"] + F.when(total["like"] >= LIKE_SHARE * n, LIKE_POINTS).otherwise(0))
