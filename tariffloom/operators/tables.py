"""Operators over rows and cells of tables: carry-forward, merging, statistics, pairing, unpivoting.

Cells come long, as (table keys, row_idx, col_idx, cell), or rows come with an
explicit order column. Window partitions are single tables or pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffloom.functions.codes import is_code_line
from tariffloom.functions.packs import clean_pack
from tariffloom.functions.prices import parse_price, rating_like
from tariffloom.functions.text import collapse, lines, strip


def carry_forward(rows: DataFrame, part: list[str], order: str, value: str, out: str) -> DataFrame:
    """``out``: the last value before a row that is not null, within its part."""
    before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.last(value, ignorenulls=True).over(before))


def merge_continuations(rows: DataFrame, part: list[str], order: str, text: str, continues: Column) -> DataFrame:
    """Join the text of continuation rows to the row they follow; one that leads a part stays a row."""
    w = Window.partitionBy(*part).orderBy(order)
    head = ~continues | (F.row_number().over(w) == 1)
    marked = rows.withColumn("_head", head).withColumn("_block", F.sum(F.col("_head").cast("int")).over(w))
    blocks = marked.groupBy(*part, "_block").agg(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text)))).alias("all"))
    return blocks.select(*part, F.col("all")[0][order].alias(order), F.array_join(F.transform("all", lambda x: x[text]), " ").alias(text), F.size("all").alias("n_rows"))


def following_count(rows: DataFrame, part: list[str], order: str, flag: Column, ahead: int, out: str) -> DataFrame:
    """``out``: how many of the next ``ahead`` rows of the part have the flag."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(1, ahead)
    return rows.withColumn(out, F.coalesce(F.sum(flag.cast("int")).over(w), F.lit(0)))


def seen_before(rows: DataFrame, part: list[str], order: str, key: str, flag: Column, out: str) -> DataFrame:
    """``out``: did a row at or before this one, with the same key, have the flag?"""
    w = Window.partitionBy(*part, key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(out, F.max(flag).over(w))


def is_small_whole(price: Column) -> Column:
    return (price == F.floor(price)) & (price > 0) & (price <= 100)


def column_stats(cells: DataFrame, keys: list[str]) -> DataFrame:
    """For each column: cells with codes, numbers, packs and text, small whole numbers, richness and pack strength.

    A cell that is a code counts as nothing else.
    """
    def coded(v: Column) -> Column:
        code = is_code_line(v)
        return F.struct(v.alias("v"), code.alias("code"), F.when(~code, parse_price(v)).alias("price"))

    def shown(r: Column) -> Column:
        v, other, letters = r["v"], ~r["code"], r["v"].rlike("[A-Za-z]")
        pack, number = other & (clean_pack(v) != ""), other & r["price"].isNotNull()
        words = other & r["price"].isNull() & letters
        strength = F.when(~pack, 0).when(v.rlike(r"^\d+\s*/\s*\d+\z"), 4).when(v.rlike(r"^\d+\z"), 3).when(letters, -2).otherwise(0)
        return F.struct(
            r["code"].cast("int").alias("codes"), number.cast("int").alias("numbers"), pack.cast("int").alias("packs"), words.cast("int").alias("texts"),
            F.coalesce(number & is_small_whole(r["price"]), F.lit(False)).cast("int").alias("small"), F.when(words, F.regexp_count(v, F.lit("[A-Za-z]"))).otherwise(0).alias("richness"), strength.alias("pack_strength"),
        )

    # lambdas keep the many patterns out of the generated method, which would grow too large to be compiled to machine code
    rows = cells.select(*keys, "col_idx", collapse(F.col("cell")).alias("v")).where(F.col("v") != "")
    read = F.get(F.transform(F.transform(F.array("v"), coded), shown), F.lit(0))
    names = ["codes", "numbers", "packs", "texts", "small", "richness", "pack_strength"]
    return rows.withColumn("read", read).groupBy(*keys, "col_idx").agg(*(F.sum(f"read.{n}").cast("int").alias(n) for n in names))


def price_columns(stats: DataFrame, support: int = 3, small_share: float = 0.7) -> DataFrame:
    """Columns with numbers enough of which not most are small whole ones."""
    return stats.where((F.col("numbers") >= support) & (F.col("small") < small_share * F.col("numbers")))


def cooccurrence(cells: DataFrame, keys: list[str], other: str = "price") -> DataFrame:
    """(keys, code_col, ``other``_col, n): rows where one column has a code and another a price, or a pack."""
    v = strip(F.col("cell"))
    second = parse_price(v).isNotNull() if other == "price" else clean_pack(v) != ""
    flat = cells.select(*keys, "row_idx", "col_idx", is_code_line(v).alias("code"), second.alias("second"))
    codes = flat.where("code").select(*keys, "row_idx", F.col("col_idx").alias("code_col"))
    others = flat.where("second").select(*keys, "row_idx", F.col("col_idx").alias(f"{other}_col"))
    met = codes.join(others, [*keys, "row_idx"]).where(F.col("code_col") != F.col(f"{other}_col"))
    return met.groupBy(*keys, "code_col", f"{other}_col").agg(F.count("*").alias("n"))


def first_filled_row(matrix: Column) -> Column:
    """The first row of a matrix with a cell that is not blank; an empty row if there is none."""
    return F.coalesce(F.get(F.filter(matrix, lambda row: F.exists(row, lambda c: F.coalesce(strip(c), F.lit("")) != "")), F.lit(0)), F.array().cast("array<string>"))


def nearest(target: Column, choices: Column, prefer_right: bool = False) -> Column:
    """The choice at the least distance; ties go to the first of the list, or to the right."""
    if prefer_right:
        ranked = F.transform(choices, lambda c: F.struct(F.abs(c - target).alias("d"), F.when(c >= target, 0).otherwise(1).alias("side"), c.alias("c")))
    else:
        ranked = F.transform(choices, lambda c, i: F.struct(F.abs(c - target).alias("d"), i.alias("side"), c.alias("c")))
    return F.array_min(ranked)["c"]


def swapped_roles(rows: DataFrame, keys: list[str], purchase: str, pack: str) -> DataFrame:
    """For each table: do the columns for price and pack hold each other's values?"""
    share = lambda cond, of: F.avg(F.when(F.col(of).isNotNull(), F.when(cond, 1.0).otherwise(0.0)))
    stats = rows.groupBy(*keys).agg(
        F.count(purchase).alias("n_purchase"), F.count(pack).alias("n_pack"), share(F.col(purchase) <= 200, purchase).alias("low_share"),
        share(F.col(pack) >= 500, pack).alias("high_share"), F.max(purchase).alias("top_purchase"), F.max(pack).alias("top_pack"),
    )
    swap = (F.col("n_purchase") >= 5) & (F.col("n_pack") >= 5) & (F.col("low_share") >= 0.7) & (F.col("high_share") >= 0.5) & (F.col("top_pack") > 2 * F.col("top_purchase"))
    return stats.select(*keys, "n_purchase", "n_pack", F.coalesce(swap, F.lit(False)).alias("swap"))


def band_join(anchors: DataFrame, words: DataFrame, keys: list[str], *, dy: float = 22.0, left: float = 10.0, right: float = 260.0) -> DataFrame:
    """Words within a band right of each anchor on the same page (x, y): range join with cells of the band's height.

    Only words whose cell of height ``dy`` is the anchor's or next to it meet
    it, so a page with many words is no all-pairs join. The tables are merged,
    never broadcast: estimates don't see how many words a page explodes into.
    """
    slots = anchors.select(*keys, F.col("anchor_id"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.explode(F.sequence(F.floor(F.col("y") / dy) - 1, F.floor(F.col("y") / dy) + 1)).alias("slot"))
    own = words.select(*keys, "word_id", "x", "y", F.floor(F.col("y") / dy).alias("slot"))
    met = slots.join(own.hint("merge"), [*keys, "slot"])
    return met.where((F.abs(F.col("y") - F.col("ay")) <= dy) & (F.col("x") >= F.col("ax") - left) & (F.col("x") <= F.col("ax") + right)).select(*keys, "anchor_id", "word_id", "x", "y")


def unpivot_blocks(cells: DataFrame, keys: list[str], role: Column) -> DataFrame:
    """Horizontal tables: blocks of role rows become one row for each column.

    ``role`` of a row's label is alias, purchase, pack or null. A new alias row
    opens a new block once the block has two roles, alias among them; the first
    row of a role counts within a block.
    """
    table = Window.partitionBy(*keys).orderBy("row_idx")
    labels = cells.where("col_idx = 0").select(*keys, "row_idx", role.alias("role")).where(F.col("role").isNotNull())
    # alias rows number the runs; a run opens a block if the run before it brought another role
    labels = labels.withColumn("run", F.sum((F.col("role") == "alias").cast("int")).over(table))
    runs = labels.groupBy(*keys, "run").agg(F.count_distinct("role").alias("roles"), F.min("row_idx").alias("first"))
    order = Window.partitionBy(*keys).orderBy("run")
    opens = F.coalesce(F.lag("roles").over(order), F.lit(1))
    runs = runs.withColumn("opens", ((opens >= 2) & (F.lag("run").over(order) > 0)).cast("int")).withColumn("block", F.sum("opens").over(order))
    placed = labels.join(runs.select(*keys, "run", "block"), [*keys, "run"])
    rows = placed.groupBy(*keys, "block", "role").agg(F.min("row_idx").alias("row_idx"))
    body = rows.join(cells.where("col_idx > 0"), [*keys, "row_idx"])
    value = lambda r: F.max(F.when(F.col("role") == r, F.col("cell")))
    return body.groupBy(*keys, "block", "col_idx").agg(value("alias").alias("alias"), value("purchase").alias("purchase"), value("pack").alias("pack"))


def zip_lines(rows: DataFrame, keep: list[str], code_cell: str, price_cell: str) -> DataFrame:
    """The i-th code line of one cell with the i-th line of another: (keep, idx, alias, purchase)."""
    codes = F.filter(lines(F.col(code_cell)), is_code_line)
    pairs = F.arrays_zip(codes.alias("code"), lines(F.col(price_cell)).alias("price"))
    out = rows.select(*keep, F.posexplode(pairs).alias("idx", "pair"))
    return out.select(*keep, "idx", F.col("pair.code").alias("alias"), parse_price(F.col("pair.price")).alias("purchase")).where("alias is not null and purchase is not null")


def collapse_table(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Each column's cells in order of rows, joined by line feeds, for tables of 4 rows or more of which 2 are sparse."""
    full = cells.withColumn("cell", strip(F.col("cell")))
    sizes = full.groupBy(*keys, "row_idx").agg(F.sum((F.col("cell") != "").cast("int")).alias("n"))
    wide = sizes.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum((F.col("n") <= 1).cast("int")).alias("sparse")).where("rows >= 4 and sparse >= 2").select(*keys)
    own = full.where("cell <> ''").join(wide, keys, "left_semi")
    return own.groupBy(*keys, "col_idx").agg(F.array_sort(F.collect_list(F.struct("row_idx", "cell"))).alias("all")).select(*keys, "col_idx", F.array_join(F.transform("all", lambda x: x["cell"]), "\n").alias("cell"))


def price_direction(rows: DataFrame, part: list[str], order: str) -> DataFrame:
    """For each table: do prices without a code stand in the row before or after the codes without a price?

    Rows have code (or null), purchase (or null) and text (letters in the code cell).
    """
    w = Window.partitionBy(*part).orderBy(order)
    can = F.coalesce((F.col("purchase") >= 50) & ~rating_like(F.col("purchase")) & F.col("code").isNull() & ~F.col("text"), F.lit(False))
    rows = rows.withColumn("can", can)
    at = lambda k: F.coalesce(F.lag("can", k).over(w) if k > 0 else F.lead("can", -k).over(w), F.lit(False))
    rows = rows.select(*part, (F.col("code").isNotNull() & F.col("purchase").isNull()).alias("needs"), at(1).alias("p1"), at(2).alias("p2"), at(-1).alias("n1"), at(-2).alias("n2"))
    p1, n1 = F.col("p1"), F.col("n1")
    before = F.when(p1 & ~n1, 2).when(p1 & n1 & F.col("p2"), 1).otherwise(0)
    after = F.when(n1 & ~p1, 2).when(p1 & n1 & F.col("n2"), 1).otherwise(0)
    votes = rows.groupBy(*part).agg(F.sum(F.when(F.col("needs"), before).otherwise(0)).alias("before"), F.sum(F.when(F.col("needs"), after).otherwise(0)).alias("after"))
    way = F.when((F.col("before") >= 2) & (F.col("before") > F.col("after")), "previous").when((F.col("after") >= 2) & (F.col("after") > F.col("before")), "next")
    return votes.select(*part, "before", "after", way.alias("direction"))


def stack_order(rows: DataFrame, part: list[str], order: str, first: int = 8) -> DataFrame:
    """For each table: does the price or the code come first in two-number stacks (arrays ``stack``)?

    Of the first stacks, the side with fewer distinct values holds the prices.
    """
    w = Window.partitionBy(*part).orderBy(order)
    some = rows.where(F.size("stack") >= 2).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= first)
    stats = some.groupBy(*part).agg(F.count("*").alias("n"), F.count_distinct(F.col("stack")[0]).alias("a"), F.count_distinct(F.element_at("stack", -1)).alias("b"))
    way = F.when(F.col("n") < 2, None).when(F.col("a") < F.col("b"), "price_first").when(F.col("b") < F.col("a"), "alias_first")
    return stats.select(*part, "n", way.alias("stack_order"))


def header_fold(scores: Column, lead: int = 100) -> Column:
    """Index of the header among ordered (idx, score): a later row must lead the best so far by more than ``lead``."""
    start = F.struct(F.lit(0).alias("idx"), F.lit(-1).alias("score"))

    def step(best: Column, x: Column) -> Column:
        better = (x["score"] > best["score"] + lead) | ((x["score"] >= best["score"]) & (x["idx"] <= best["idx"]))
        return F.struct(F.when(better, x["idx"]).otherwise(best["idx"]).alias("idx"), F.when(better, x["score"]).otherwise(best["score"]).alias("score"))

    return F.aggregate(scores, start, step, lambda b: F.when(b["score"] >= 0, b["idx"]))


def keep_first_matrix(tables: DataFrame, part: list[str], matrix: str, order: str) -> DataFrame:
    """Union with exact dedup: the first table of each distinct matrix of a page."""
    w = Window.partitionBy(*part, matrix).orderBy(order)
    return tables.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
