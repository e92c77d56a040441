"""Tables cut from words with geometry: areas below a header, bands side by side, and which result of a page counts.

Areas and columns come from header blocks (``readers.header_groups``); what
lies in them is put into rows by height and into columns by the header's
places. No renderer is needed, and words meet areas by page only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .readers import TABLES, has_code_price_signal

KEYS = ["doc_id", "page_idx"]
#: Words whose heights differ by no more stand in one row.
LINE = 6.0


def anchored_areas(groups: DataFrame, width: Column, height: Column) -> DataFrame:
    """The area below each header block: left, right, top and bottom, in units from the page's upper left corner.

    It reaches from 45 units left of the code column to 150 right of the last
    one, and from 35 units above the header to 320 below it, but not under the
    last 45 % of the page; areas that come out too small are widened.
    """
    y = F.col("alias_y")
    last = F.greatest(*(F.col(c) for c in ("particulars_x", "purchase_x", "pack_x") if c in groups.columns))
    top = F.greatest(y - 35, F.lit(0.0))
    low = F.least(y + 320, 0.55 * height)
    bottom = F.when(low - top < 120, F.least(top + 220, height)).otherwise(low)
    left, right = F.greatest(F.col("alias_x") - 45, F.lit(0.0)), F.least(last + 150, width)
    return groups.withColumns({"left": left, "right": F.when(right - left < 120, F.least(left + 220, width)).otherwise(right), "top": top, "bottom": bottom})


def clipped_tables(words: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, page_idx, table_idx, matrix): the words in each area as a table.

    ``areas`` have anchor_id, left, right, top, bottom and the header's places
    (alias_x and others): a column reaches from its place to the next one's. A
    row begins where the height differs by more than ``LINE`` from the word
    before. Tables are numbered in order of their anchors' places.
    """
    places = [c for c in ("alias_x", "particulars_x", "purchase_x", "pack_x") if c in areas.columns]
    starts = F.array_sort(F.array_compact(F.array(*places)))
    own = areas.select(*KEYS, "anchor_id", "left", "right", "top", "bottom", starts.alias("starts"))
    inside = words.join(own.hint("merge"), KEYS).where((F.col("x0") >= F.col("left")) & (F.col("x0") <= F.col("right")) & (F.col("y0") >= F.col("top")) & (F.col("y0") <= F.col("bottom")))
    table = [*KEYS, "anchor_id"]
    order = Window.partitionBy(*table).orderBy("y0", "x0", "word_id")
    column = F.greatest(F.size(F.filter("starts", lambda s: s <= F.col("x0") + 1)) - 1, F.lit(0))
    placed = inside.withColumns({"new": F.coalesce((F.col("y0") - F.lag("y0").over(order) > LINE).cast("int"), F.lit(1)), "col": column})
    placed = placed.withColumn("row", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    words_of = F.array_sort(F.collect_list(F.struct("x0", "word_id", "text")))
    cells = placed.groupBy(*table, "starts", "row", "col").agg(F.array_join(F.transform(words_of, lambda w: w["text"]), " ").alias("cell"))
    rows = cells.groupBy(*table, "starts", "row").agg(F.map_from_entries(F.collect_list(F.struct("col", "cell"))).alias("by_col"))
    full = F.transform(F.sequence(F.lit(0), F.size("starts") - 1), lambda c: F.coalesce(F.try_element_at("by_col", c), F.lit("")))
    tables = rows.withColumn("cells", full).groupBy(*table).agg(F.array_sort(F.collect_list(F.struct("row", "cells"))).alias("rows"))
    numbered = tables.withColumn("table_idx", (F.row_number().over(Window.partitionBy(*KEYS).orderBy("anchor_id")) - 1).cast("int"))
    return numbered.select(*KEYS, "table_idx", F.transform("rows", lambda r: r["cells"]).alias("matrix"))


def distinct_tables(*parts: DataFrame) -> DataFrame:
    """The tables of all parts, in order; of equal ones on a page the first."""
    every = None
    for k, part in enumerate(parts):
        own = part.select(*KEYS, F.struct(F.lit(k).alias("part"), "table_idx").alias("place"), "matrix")
        every = own if every is None else every.unionByName(own)
    firsts = every.groupBy(*KEYS, "matrix").agg(F.min("place").alias("place"))
    number = F.row_number().over(Window.partitionBy(*KEYS).orderBy("place")) - 1
    return firsts.select(*KEYS, number.cast("int").alias("table_idx"), "matrix")


def settled_tables(lattice: DataFrame, stream: DataFrame, repeated: DataFrame, anchored: DataFrame) -> DataFrame:
    """The tables of each page that count, by the automatic rule, from four extractions of ``TABLES``.

    Two or more repeated header regions replace the lattice tables. If there is
    none then, or all have three columns or fewer, stream tables replace them
    where there are any. If now no table has a code with a price, anchored
    tables with such a signal are added, each distinct one once.
    """
    assert TABLES.startswith("doc_id")
    page = Window.partitionBy(*KEYS)
    several = repeated.withColumn("n", F.count("*").over(page)).where("n >= 2").drop("n")
    first = lattice.join(several.select(*KEYS).distinct(), KEYS, "left_anti").unionByName(several)
    wide = F.array_max(F.transform("matrix", lambda row: F.size(row)))
    enough = first.withColumn("widest", wide).groupBy(*KEYS).agg(F.max("widest").alias("widest")).where("widest > 3").select(*KEYS)
    instead = stream.join(enough, KEYS, "left_anti")
    chosen = first.join(instead.select(*KEYS).distinct(), KEYS, "left_anti").unionByName(instead)
    told = chosen.where(has_code_price_signal(F.col("matrix"))).select(*KEYS).distinct()
    more = anchored.where(has_code_price_signal(F.col("matrix"))).join(told, KEYS, "left_anti")
    plain = chosen.join(more.select(*KEYS).distinct(), KEYS, "left_anti")
    mixed = distinct_tables(chosen.join(more.select(*KEYS).distinct(), KEYS, "left_semi"), more)
    return plain.unionByName(mixed)


#: A table of a layout service: rows of cells whose text is given as stretches of the page's text.
SEGMENTED = "doc_id string, page_idx int, table_idx int, full_text string, header_rows array<array<array<struct<start: int, stop: int>>>>, body_rows array<array<array<struct<start: int, stop: int>>>>"


def assembled_tables(segmented: DataFrame) -> DataFrame:
    """Tables from a layout service's answer: header rows, then body rows, each cell its stretches with single spaces.

    A stretch without a start begins at 0; a cell without stretches is empty.
    """
    def cell(segments: Column) -> Column:
        start = lambda s: F.coalesce(s["start"], F.lit(0))
        pieces = F.transform(segments, lambda s: F.substring("full_text", start(s) + 1, F.greatest(s["stop"] - start(s), F.lit(0))))
        return F.trim(F.regexp_replace(F.array_join(pieces, ""), r"(?U)\s+", " "))

    none = F.array().cast("array<array<array<struct<start: int, stop: int>>>>")
    rows = F.concat(F.coalesce("header_rows", none), F.coalesce("body_rows", none))
    return segmented.select("doc_id", "page_idx", "table_idx", F.transform(rows, lambda row: F.transform(row, cell)).alias("matrix"))
