"""Driver queries of the layout parsers: tables and cells made from ``part``, with what was put into them as SQL.

A shape is a table whose cells hold placeholders; each row of ``part`` fills
it with codes and prices of its own. The SQL states the rows that must come
out, from the numbers that were put in: it knows nothing of parsing.
Placeholders of item k: c a code of six digits or more, s the same as it is
printed (4 digits and the rest; 5 and 2 if there are seven), a a code with
letters, p a price.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.operators.layouts.engine import extract_prices, normalize_tables
from tariffloom.operators.layouts.readings import read_cells, read_labels, read_layouts
from tariffloom.plans.profile import Profile
from tariffloom.queries import query, read, spread

PROFILE = Profile({
    "alias": ["reference", "ref no", "item code", "catalog no", "cat.nos", "cat nos"], "purchase": ["mrp", "unit mrp", "price", "purchase", "rate"],
    "particulars": ["item description", "description"], "pack": ["std pkg", "pack", "nos", "uom"],
})


def _value(kind: str, k: int) -> str:
    """A placeholder as an expression that both engines read."""
    code = f"cast(400000 + p_partkey * 6 + {k} as varchar(12))"
    return {
        "c": code, "s": f"concat(substr({code}, 1, 4), ' ', substr({code}, 5))", "a": f"concat('AB', {code})",
        "p": f"cast(10010 + (p_partkey * 7 + {k} * 111) % 80000 as varchar(12))",
    }[kind]


def _text(template: str, value: Callable[[str, int], str] = _value) -> str:
    """A cell with placeholders as an SQL expression."""
    parts = [value(x[1], int(x[2])) if re.fullmatch(r"\{[csap]\d\}", x) else "'" + x.replace("'", "''") + "'" for x in re.split(r"(\{[csap]\d\})", template) if x]
    return f"concat({', '.join(parts)}, '')" if parts else "''"


def _printed(kind: str, k: int) -> str:
    """A placeholder as tables print it.

    Codes have seven digits from part 100,000 on. Only these are printed with
    five digits before the space: a group of three that ends in 1, 2 or 3 is
    by rule a group of two and a flattened footnote. With more digits before
    the space than four, codes of nine would have a group beyond the six that
    are read.
    """
    code = _value("c", k)
    left = f"case when length({code}) = 7 then 5 else 4 end"
    return f"concat(substr({code}, 1, {left}), ' ', substr({code}, {left} + 1))" if kind == "s" else _value(kind, k)


def _cell(template: str) -> Column:
    lines = [F.expr(_text(x, _printed)) for x in template.split("\n")]
    return F.concat_ws("\n", *lines)


def tables_of(spark: SparkSession, sf_dir: str, *shapes: list[list[str]]) -> DataFrame:
    """A page for each row of ``part`` with a table for each shape."""
    part = read(spark, sf_dir, "part").select("p_partkey")
    made = [part.select(F.col("p_partkey").cast("string").alias("doc_id"), F.lit(0).alias("page_idx"), F.lit(k).alias("table_idx"), F.array(*(F.array(*map(_cell, row)) for row in shape)).alias("matrix")) for k, shape in enumerate(shapes)]
    out = made[0]
    for other in made[1:]:
        out = out.unionByName(other)
    return out


def rows_sql(rows: list[tuple[str, str, str, str]], table: int = 0) -> str:
    """The rows (particulars, code, price, pack) that a table must give."""
    return " union all ".join(
        f"select p_partkey as id, cast({table} as int) as table_idx, {_text(words)} as particulars, {_text(code)} as alias, cast({_text(price)} as double) as purchase, {_text(pack)} as pack from part"
        for words, code, price, pack in rows
    )


def normalized(spark: SparkSession, sf_dir: str, shapes: list[list[list[str]]], words: bool, packs: bool) -> DataFrame:
    rows = normalize_tables(tables_of(spark, sf_dir, *shapes), PROFILE, include_particulars=words, include_pack=packs)
    return rows.select(F.col("doc_id").cast("bigint").alias("id"), "table_idx", "particulars", "alias", "purchase", "pack")


NAMES = ["Power supply one", "Relay two", "Module three", "Socket four"]
PACKS = ["1", "10", "5", "1/12"]
HEAD = ["Cat.Nos", "Description", "MRP", "Pack"]
BODY = [[f"{{s{k}}}", NAMES[k], f"{{p{k}}}", PACKS[k]] for k in range(4)]
FOUR = [(NAMES[k], f"{{c{k}}}", f"{{p{k}}}", PACKS[k]) for k in range(4)]
BARE = [("", f"{{c{k}}}", f"{{p{k}}}", "") for k in range(6)]
LETTERS = [("", f"{{a{k}}}", f"{{p{k}}}", "") for k in range(4)]

#: By name: the shape, with descriptions?, with packs?, and the rows that must come out.
SHAPES = {
    "mapped_table": ([HEAD, *BODY], True, True, FOUR),
    "split_header": ([["", "", "MRP*", ""], ["Cat.Nos", "Description", "` /", "Pack"], ["", "", "Unit", ""], *BODY], True, True, FOUR),
    "repeated_blocks": (
        [["3P Cat.Nos", "MRP*/ /Unit", "Pack", "4P Cat.Nos", "MRP*/ /Unit", "Pack"], *([f"{{s{k}}}", f"{{p{k}}}", "5", f"{{s{k + 1}}}", f"{{p{k + 1}}}", "10"] for k in (0, 2, 4))],
        False, True, [("", f"{{c{k}}}", f"{{p{k}}}", "10" if k % 2 else "5") for k in range(6)],
    ),
    "horizontal_blocks": (
        [["Label", "1M", "2M", "4M"], ["Reference No.", "{a0}", "{a1}", "{a2}"], ["Unit MRP", "{p0}.-", "{p1}.-", "{p2}.-"], ["Std. Pkg.", "10", "20", "5"],
         ["Label", "8M", "12M", "16M"], ["Reference No.", "{a3}", "{a4}", "{a5}"], ["Unit MRP", "{p3}.-", "{p4}.-", "{p5}.-"], ["Std. Pkg.", "1", "2", "4"]],
        True, True, [("1M", "{a0}", "{p0}", "10"), ("2M", "{a1}", "{p1}", "20"), ("4M", "{a2}", "{p2}", "5"), ("8M", "{a3}", "{p3}", "1"), ("12M", "{a4}", "{p4}", "2"), ("16M", "{a5}", "{p5}", "4")],
    ),
    "compact_horizontal": ([["", "Switches"], ["", "Reference No.\n{a0}\n{a1}"], ["", "Unit MRP\n{p0}\n{p1}"], ["", "More"], ["", "Reference No.\n{a2}\n{a3}"], ["", "Unit MRP\n{p2}\n{p3}"]], False, True, LETTERS),
    "compact_vertical": (
        [["", "", "", "Cat.Nos", "", "MRP / Unit\nPack"], *(["", "", "16", f"{{s{k}}}", "", f"{{p{k}}}\n{pack}\n-"] for k, pack in enumerate(("1", "1", "5", "10")))],
        False, True, [("", f"{{c{k}}}", f"{{p{k}}}", pack) for k, pack in enumerate(("1", "1", "5", "10"))],
    ),
    "dense_column": (
        [["", "Cat.Nos / Description / MRP", "", ""], *(["", f"{{s{k}}}\n{{p{k}}}", pack, ""] for k, pack in enumerate(("1", "1", "5", "10")))],
        False, True, [("", f"{{c{k}}}", f"{{p{k}}}", pack) for k, pack in enumerate(("1", "1", "5", "10"))],
    ),
    "sparse_rows": (
        [["{a0}", "Switch one", "{p0}.50"], ["{a1}", "Switch two", "{p1}.50"], ["", "with a frame", ""], ["{a2}", "Switch three", "{p2}.50"]],
        True, False, [("Switch one", "{a0}", "{p0}.50", ""), ("Switch two with a frame", "{a1}", "{p1}.50", ""), ("Switch three", "{a2}", "{p2}.50", "")],
    ),
    "packed_lines": ([["{a0}\n{a1}\n{a2}\n{a3}", "{p0}\n{p1}\n{p2}\n{p3}"], ["", ""]], False, False, LETTERS),
    "collapsed_fragments": ([["{a0}", ""], ["{a1}", ""], ["", "{p0}"], ["", "{p1}"], ["{a2}", ""], ["", "{p2}"]], False, False, LETTERS[:3]),
    "stream_pairs": ([["DPX 250", "{s0}", "{p0}", "{s1}", "{p1}", "{s2} {p2} {s3} {p3}", ""], ["DPX 1600", "{s4}", "{p4}", "{s5}", "{p5}", "-", ""]], False, False, BARE),
    "stream_lines": ([["", "", "{s0}\n{p0}\n{s1}\n{p1}"], ["", "", "{s2} {p2} {s3} {p3}"], ["", "", "{s4}\n{p4}\n{s5}\n{p5}"]], False, False, BARE),
    "dual_role_column": ([["Description", "Cat.Nos / Price", "Pack"], *([NAMES[k], f"{{p{k}}}\n{{s{k}}}", PACKS[k]] for k in range(3))], True, True, FOUR[:3]),
    "code_stack": ([["", "Cat.Nos", "Description", "MRP"], ["", "{s0}\n{s1}\n{s2}", "Supply", "{p0}"], ["", "{s3}", "Relay", "{p3}"]], True, False, [*(("Supply", f"{{c{k}}}", "{p0}", "") for k in range(3)), ("Relay", "{c3}", "{p3}", "")]),
    "split_rows": ([["Cat.Nos", "Description", "MRP"], ["{a0}", "Power supply", ""], ["", "", "{p0}"], ["{a1}", "Relay", ""], ["", "", "{p1}"], ["{a2}", "Module", ""], ["", "", "{p2}"]], True, False, [("Power supply", "{a0}", "{p0}", ""), ("Relay", "{a1}", "{p1}", ""), ("Module", "{a2}", "{p2}", "")]),
    "neighbour_price": ([["Cat.Nos", "Description", "", "MRP"], ["{a0}", "Power supply", "{p0}", ""], ["{a1}", "Relay", "{p1}", ""], ["{a2}", "Module", "{p2}", ""]], True, False, [("Power supply", "{a0}", "{p0}", ""), ("Relay", "{a1}", "{p1}", ""), ("Module", "{a2}", "{p2}", "")]),
    "on_request_rows": ([HEAD, BODY[0], ["{s1}", "Supply", "On request", "1"], ["{s2}", "Supply", "■", "1"], BODY[3]], True, True, [FOUR[0], FOUR[3]]),
    "swapped_columns": ([HEAD, *([f"{{s{k}}}", "Supply", str(k + 1), f"{{p{k}}}"] for k in range(6))], True, True, [("Supply", f"{{c{k}}}", f"{{p{k}}}", str(k + 1)) for k in range(6)]),
    "prices_in_text": ([["Cat.Nos", "Description", "MRP"], *([f"{{a{k}}}", f"{NAMES[k]} {{p{k}}} 1/10", ""] for k in range(3))], False, True, [("", f"{{a{k}}}", f"{{p{k}}}", "1/10") for k in range(3)]),
    "blank_rows": ([["", "", "", ""], HEAD, ["", "", "", ""], BODY[0], ["", " ", "", ""], BODY[1], ["", "\n", "", ""], BODY[2]], True, True, FOUR[:3]),
    "one_row_table": ([HEAD], True, True, []),
}


def _add(name: str) -> None:
    shape, words, packs, rows = SHAPES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalized(spark, sf_dir, [shape], words, packs)

    run.__name__ = f"layout_{name}"
    run.__doc__ = f"Tables of the shape {name.replace('_', ' ')}, one for each row of part."
    query(rows_sql(rows) if rows else rows_sql(FOUR[:1]) + " where false")(run)


for _name in SHAPES:
    _add(_name)


MORE = [[f"{{s{k}}}", f"Part {k}", f"{{p{k}}}", "2"] for k in (4, 5)]


@query(rows_sql(FOUR) + " union all " + rows_sql([(f"Part {k}", f"{{c{k}}}", f"{{p{k}}}", "2") for k in (4, 5)], 1))
def layout_carry_forward(spark, sf_dir):
    """A table without a header takes the columns of the one before it on its page."""
    return normalized(spark, sf_dir, [[HEAD, *BODY], MORE], True, True)


@query(f"""
select alias, max(purchase) as purchase, first(pack order by contains(pack, '/') desc, table_idx) as pack from ({rows_sql(FOUR)} union all {rows_sql([(n, c, p, '1/12') for n, c, p, _ in FOUR[:2]], 1)}) r group by alias
""")
def layout_best_prices(spark, sf_dir):
    """The same codes in two tables: one row for each, that with the better pack."""
    again = [HEAD, *([s, n, p, "1/12"] for s, n, p, _ in BODY[:2])]
    return extract_prices(tables_of(spark, sf_dir, [HEAD, *BODY], again), PROFILE, include_particulars=True, include_pack=True).select("alias", "purchase", "pack")


_LAYOUTS = {
    "mapped_table": (0, HEAD, '[{"alias": 0, "pack": 3, "particulars": 1, "purchase": 2}]'),
    "split_header": (1, None, '[{"alias": 0, "pack": 3, "particulars": 1, "purchase": 2}]'),
    "repeated_blocks": (0, SHAPES["repeated_blocks"][0][0], '[{"alias": 0, "pack": 2, "purchase": 1}, {"alias": 3, "pack": 5, "purchase": 4}]'),
    "neighbour_price": (0, SHAPES["neighbour_price"][0][0], '[{"alias": 0, "particulars": 1, "purchase": 3}]'),
}


@query(" union all ".join(f"select p_partkey as id, cast({k} as int) as table_idx, cast({at} as int) as header_row, '{maps}' as mappings from part" for k, (at, _, maps) in enumerate(_LAYOUTS.values())))
def layout_headers(spark, sf_dir):
    """The header row and the columns of each role, of four shapes."""
    tables = tables_of(spark, sf_dir, *(SHAPES[n][0] for n in _LAYOUTS))
    return read_layouts(spread(tables), PROFILE).select(F.col("doc_id").cast("bigint").alias("id"), "table_idx", "layout.header_row", "layout.mappings")


# --- cells ------------------------------------------------------------------


def cells_of(spark: SparkSession, sf_dir: str, shapes: list[str]) -> DataFrame:
    """The readings of a cell of each shape for each row of ``part``: id, shape, reading."""
    part = read(spark, sf_dir, "part").select("p_partkey")
    made = part.select(F.col("p_partkey").alias("id"), F.posexplode(F.array(*map(_cell, shapes))).alias("shape", "cell"))
    return read_cells(spread(made), "cell", PROFILE).select("id", "shape", "reading")


def cells_sql(columns: list[tuple[str, str]], rows: list[list[str | None]]) -> str:
    """For each shape the values of the columns (name, type); None is null."""
    one = lambda v, t: f"cast({_text(v) if v is not None else 'null'} as {t})"
    return " union all ".join(f"select p_partkey as id, cast({k} as int) as shape, " + ", ".join(f"{one(v, t)} as {n}" for v, (n, t) in zip(row, columns, strict=True)) + " from part" for k, row in enumerate(rows))


_CODES = [
    ("{s0}", [None, "{c0}", "{c0}", "{c0}", "{c0}", "{c0}", "true"]),
    ("{a0}", ["{a0}", "{a0}", "{a0}", "{a0}", None, None, "true"]),
    ("{s0}\n{s1}", [None, "{c0}", "{c0}", "{c0}", "{c0}", "{c1}", "true"]),
    ("{s0} {p0}", [None, "{c0}", "{c0}", "{c0}", "{c0}", "{c0}", "true"]),
    ("3P 63 A {s0}", [None, "{c0}", None, None, "{c0}", "{c0}", "true"]),
    ("On request", [None, None, None, None, None, None, "false"]),
    ("", [None, None, None, None, None, None, "false"]),
]


@query(cells_sql([("code", "varchar(40)"), ("numeric_code", "varchar(40)"), ("leading_code", "varchar(40)"), ("strong_code", "varchar(40)"), ("group_code", "varchar(40)"), ("tail_code", "varchar(40)"), ("has_code", "boolean")], [v for _, v in _CODES]))
def cell_codes(spark, sf_dir):
    """Codes in a cell: anywhere, at its start, as digit groups, at its end; and whether there is any evidence of one."""
    return cells_of(spark, sf_dir, [t for t, _ in _CODES]).select("id", "shape", *(f"reading.{c}" for c in ("code", "numeric_code", "leading_code", "strong_code", "group_code", "tail_code", "has_code")))


_PAIRS = [
    ("{s0} {p0}", ["{c0}", "{p0}", "{c0}", "{p0}", "1", "{c0}", "{p0}"]),
    ("{s0} {p0} {s1} {p1}", ["{c1}", "{p1}", "{c0}", "{p1}", "2", "{c1}", "{p1}"]),
    ("{s0}\n{p0}", [None, None, None, None, "1", "{c0}", "{p0}"]),
    ("Set of 2\n{s0}\n{p0}", [None, None, None, None, "1", "{c0}", "{p0}"]),
    ("{s0}", [None, None, None, None, "0", None, None]),
    ("On request", [None, None, None, None, "0", None, None]),
]


@query(cells_sql([("inline_code", "varchar(40)"), ("inline_price", "double"), ("mixed_code", "varchar(40)"), ("mixed_price", "double"), ("pairs", "int"), ("last_code", "varchar(40)"), ("last_price", "double")], [v for _, v in _PAIRS]))
def cell_pairs(spark, sf_dir):
    """Codes with their prices in a cell: on one line, within words, and all of a stream."""
    r = cells_of(spark, sf_dir, [t for t, _ in _PAIRS])
    last = F.get("reading.pairs", F.size("reading.pairs") - 1)
    return r.select("id", "shape", F.col("reading.inline.code").alias("inline_code"), F.col("reading.inline.price").alias("inline_price"), F.col("reading.mixed.code").alias("mixed_code"), F.col("reading.mixed.price").alias("mixed_price"), F.size("reading.pairs").alias("pairs"), last["code"].alias("last_code"), last["price"].alias("last_price"))


_PRICES = [
    ("{p0}", ["{p0}", "{p0}", "{p0}", "1", "{p0}", "{p0}", "{p0}", ""]),
    ("{p0}\n1/10", ["10", None, "{p0}", "1", "{p0}", "{p0}", "{p0}", "1/10"]),
    ("{s0}\n{p0}", ["{p0}", None, None, "1", "{p0}", "{p0}", None, ""]),
    ("Power supply {p0}", ["{p0}", None, None, "0", None, None, None, "POWERSUPPLY"]),
    ("Input 230 V", ["230", None, None, "0", None, None, None, ""]),
    ("On request", [None, None, None, "0", None, None, None, ""]),
    ("", [None, None, None, "0", None, None, None, ""]),
]


@query(cells_sql([("last_number", "double"), ("token_price", "double"), ("leading_price", "double"), ("prices", "int"), ("best_price", "double"), ("dense_price", "double"), ("stacked_price", "double")], [v[:7] for _, v in _PRICES]))
def cell_prices(spark, sf_dir):
    """Prices in a cell: the last number, a single one, the first, all lines, the best, beside a code, above a pack."""
    r = cells_of(spark, sf_dir, [t for t, _ in _PRICES])
    return r.select("id", "shape", "reading.last_number", "reading.token_price", "reading.leading_price", F.size("reading.line_prices").alias("prices"), "reading.best_price", "reading.dense_price", F.col("reading.stacked.price").alias("stacked_price"))


_WORDS = [
    ("{a0}\nwith base\n{a1}\nwith lid", ["2", "{a0}", "with base", "{a1}", "with base / with lid", "false", "false"]),
    ("{a0}", ["1", "{a0}", "", None, None, "false", "false"]),
    ("Accessories for switches", ["0", None, None, None, None, "true", "false"]),
    ("63 A\nwith base", ["0", None, None, None, None, "false", "true"]),
    ("IEC 60947 parts", ["0", None, None, None, None, "false", "true"]),
    ("", ["0", None, None, None, None, "false", "false"]),
]


@query(cells_sql([("entries", "int"), ("first_code", "varchar(40)"), ("first_words", "varchar(60)"), ("second_code", "varchar(40)"), ("second_words", "varchar(60)"), ("is_heading", "boolean"), ("is_technical", "boolean")], [v for _, v in _WORDS]))
def cell_words(spark, sf_dir):
    """Codes with the words beside them, section headings and technical continuations."""
    r = cells_of(spark, sf_dir, [t for t, _ in _WORDS])
    entry = lambda k: F.get("reading.entries", F.lit(k))
    return r.select("id", "shape", F.size("reading.entries").alias("entries"), entry(0)["code"].alias("first_code"), entry(0)["words"].alias("first_words"), entry(1)["code"].alias("second_code"), entry(1)["words"].alias("second_words"), "reading.is_heading", "reading.is_technical")


_LABELS = [
    ("Reference No.", "alias", "alias"), ("Unit MRP", "purchase", "purchase"), ("Std. Pkg.", "pack", "pack"), ("Item description", None, "particulars"), ("MRP*", "purchase", "purchase"), ("Rated Current", None, None), ("", None, None),
]


@query(" union all ".join(
    f"select p_partkey as id, cast({k} as int) as shape, cast({'null' if role is None else repr(role)} as varchar(20)) as role, "
    + ", ".join(f"{str(named == r).lower()} as {r}_named, {str(named == r).lower()} as {r}_whole" for r in ("alias", "purchase", "particulars", "pack")) + " from part"
    for k, (_, role, named) in enumerate(_LABELS)
))
def header_labels(spark, sf_dir):
    """The role that a label names; whole words of a synonym score 100."""
    part = read(spark, sf_dir, "part").select("p_partkey")
    made = part.select(F.col("p_partkey").alias("id"), F.posexplode(F.array(*(F.lit(t) for t, _, _ in _LABELS))).alias("shape", "label"))
    r = read_labels(spread(made), "label", PROFILE)
    each = [c for role in ("alias", "purchase", "particulars", "pack") for c in (F.col(f"reading.{role}_named"), (F.col(f"reading.{role}_score") == 100).alias(f"{role}_whole"))]
    return r.select("id", "shape", "reading.role", *each)
