"""Driver queries of sources: extraction results, model answers, header geometry, profiles and exports, from ``part``.

As in ``layout_queries``, the SQL states what was put into the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.layout_queries import HEAD, PROFILE, _cell, _text
from tariffloom.operators import match, tables, triage
from tariffloom.plans.jobs import from_text, price_list
from tariffloom.plans.settings import Settings
from tariffloom.queries import query, read, spread
from tariffloom.sources import readers, regions, sinks

ID = "cast(doc_id as bigint) as id"


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey")


def page_texts(spark: SparkSession, sf_dir: str, *templates: str) -> DataFrame:
    """A document for each row of ``part`` with a page for each template."""
    made = part(spark, sf_dir).select(F.col("p_partkey").cast("string").alias("doc_id"), F.posexplode(F.array(*map(_cell, templates))).alias("page_idx", "text"))
    return spread(made.select("doc_id", F.col("page_idx").cast("int").alias("page_idx"), "text"))


TABLE_TEXT = "Price list\n" + "\n".join([" | ".join(HEAD), "{s0} | Supply | {p0} | 1", "{s1} | Relay | {p1} | 10", "{s2} | Module | {p2} | 5"]) + "\nend"
COVER = "cover | 1\n9999 99 | 500"


@query("select p_partkey as id, cast(k as int) as page_idx, cast(0 as int) as table_idx, case when k = 0 then 'no_rows' else 'success' end as status, cast(case when k = 0 then 0 else 4 end as int) as n_rows, k = 1 as signal from part cross join (values (0), (1)) v(k)")
def extraction_results(spark, sf_dir):
    """Tables that a backend cuts from page text, with status and the test for a code beside a price."""
    found = readers.extract_tables(page_texts(spark, sf_dir, "only words", TABLE_TEXT), readers.delimited_backend())
    return found.select(F.col("doc_id").cast("bigint").alias("id"), "page_idx", "table_idx", "status", F.size("matrix").alias("n_rows"), F.coalesce(readers.has_code_price_signal(F.col("matrix")), F.lit(False)).alias("signal"))


@query("select p_partkey as id, cast(0 as int) as table_idx, 'error' as status, concat('page ', cast(p_partkey as varchar)) as message from part")
def extraction_errors(spark, sf_dir):
    """A page that a backend can't read is told with its message."""

    def extract(pages):
        for doc, _, _ in pages:
            raise ValueError(f"page {doc}")
        yield

    found = readers.extract_tables(page_texts(spark, sf_dir, "x"), readers.Backend("broken", extract))
    return found.select(F.col("doc_id").cast("bigint").alias("id"), "table_idx", "status", "message")


def _prices_sql(where: str = "true") -> str:
    return " union all ".join(f"select {_text(f'{{c{k}}}')} as alias, cast({_text(f'{{p{k}}}')} as double) as purchase, '{pack}' as pack, cast(2 as int) as source_page from part where {where}" for k, pack in enumerate(("1", "10", "5")))


@query(_prices_sql())
def text_to_prices(spark, sf_dir):
    """The whole way: triage, tables from page text, normalization, best prices; the cover page is not read."""
    out = from_text(page_texts(spark, sf_dir, COVER, TABLE_TEXT), readers.delimited_backend(), PROFILE, Settings(include_pack=True))
    return out.select("alias", "purchase", "pack", "source_page")


@query(_prices_sql())
def target_page_prices(spark, sf_dir):
    """Prices of the second page alone, with the columns that the sink keeps."""
    pages = page_texts(spark, sf_dir, TABLE_TEXT.replace("{s", "9{s"), TABLE_TEXT)
    found = readers.extract_tables(pages, readers.delimited_backend()).where("status = 'success'")
    out = price_list(pages, found, PROFILE, Settings(include_pack=True), target_page=2)
    return out.select(*sinks.price_columns(include_pack=True))


@query("select p_partkey as id, cast(k as int) as page_idx from part cross join (values (1), (2)) v(k)")
def triage_page_limit(spark, sf_dir):
    """The first two candidates of each document."""
    pages = page_texts(spark, sf_dir, COVER, *[TABLE_TEXT.replace("Pack", f"Pack pass {k}") for k in range(4)])
    found = triage.candidates(pages, PROFILE, max_pages=2)
    return found.select(F.col("doc_id").cast("bigint").alias("id"), "page_idx")


@query("""
select p_partkey as id, case p_partkey % 4 when 0 then 'success' when 1 then 'error' when 2 then 'no_rows' else 'error' end as status, cast(case p_partkey % 4 when 0 then 2 when 2 then 0 end as int) as n_rows,
       case when p_partkey % 4 = 0 then concat('AB', cast(p_partkey as varchar)) end as code, cast(case when p_partkey % 4 = 0 then 0.5 end as double) as confidence from part
""")
def model_answers(spark, sf_dir):
    """Answers of a model: rows, broken JSON, an empty list, and JSON without rows."""
    made = part(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.expr("""
        case p_partkey % 4 when 0 then concat('{"rows": [{"code": "AB', p_partkey, '", "price": "5", "confidence": 0.5}, {"code": "CD"}]}') when 1 then '{"rows": [' when 2 then '{"rows": []}' else '{"other": 1}' end
    """).alias("answer"))
    rows = readers.extracted_rows(made)
    return rows.select("id", "status", F.size("rows").cast("int").alias("n_rows"), F.get("rows", F.lit(0))["code"].alias("code"), F.get("rows", F.lit(0))["confidence"].alias("confidence"))


@query(f"select p_partkey as id, {_text('Cat.Nos MRP')} as first_line, {_text('Type {c0} 5 A')} as second_line, {_text('')} as third_line from part")
def layout_service_tables(spark, sf_dir):
    """Matrices from a layout service's stretches of text: white space becomes single, parts of a cell are joined."""
    text = F.concat(F.lit("Cat.Nos \n MRP;"), _cell("Type\t{c0}  5 A"))
    stretch = lambda a, b: F.struct(F.lit(a).cast("int").alias("start"), F.lit(b).cast("int").alias("stop"))
    segment = "array<array<array<struct<start: int, stop: int>>>>"
    made = part(spark, sf_dir).select(
        F.col("p_partkey").cast("string").alias("doc_id"), F.lit(0).alias("page_idx"), F.lit(0).alias("table_idx"), text.alias("full_text"),
        F.array(F.array(F.array(stretch(None, 10), stretch(10, 13)))).cast(segment).alias("header_rows"), F.array(F.array(F.array(stretch(14, 40))), F.array(F.array().cast("array<struct<start: int, stop: int>>"))).cast(segment).alias("body_rows"),
    )
    got = regions.assembled_tables(made)
    return got.select(F.col("doc_id").cast("bigint").alias("id"), *(F.col("matrix")[k][0].alias(n) for k, n in enumerate(("first_line", "second_line", "third_line"))))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of a page with two header blocks, or one (odd ids), and two rows below each."""
    block = [(10, 100, "'Cat.Nos'"), (80, 104, "'MRP'"), (120, 96, "'Pack'"), (10, 140, _text("{s0}")), (80, 141, _text("{p0}")), (120, 139, "'1'"), (10, 160, _text("{s1}")), (80, 160, _text("{p1}"))]
    far = [(x + 390, y, t) for x, y, t in block]
    low = [(10, 760, "'Cat.Nos'"), (60, 300, "'Pack'"), (500, 40, "'MRP'")]
    every = [(x, y, t, False) for x, y, t in block] + [(x, y, t, True) for x, y, t in far] + [(x, y, t, False) for x, y, t in low]
    items = ", ".join(f"named_struct('word_id', cast({k} as bigint), 'x0', cast({x} as double), 'y0', cast({y} as double), 'text', {t}, 'second', {str(two).lower()})" for k, (x, y, t, two) in enumerate(every))
    made = part(spark, sf_dir).select(F.col("p_partkey").cast("string").alias("doc_id"), F.lit(0).alias("page_idx"), F.explode(F.expr(f"array({items})")).alias("w"), F.col("p_partkey"))
    return made.where("not (w.second and p_partkey % 2 = 1)").select("doc_id", "page_idx", "w.word_id", "w.x0", "w.y0", F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), "w.text")


def _groups(spark: SparkSession, sf_dir: str, least: int) -> DataFrame:
    return readers.header_groups(_words(spark, sf_dir), {r: PROFILE.markers(r) for r in ("alias", "purchase", "pack")}, F.lit(800.0), min_groups=least)


@query("""
select p_partkey as id, cast(x as double) as alias_x, cast(100 as double) as alias_y, cast(x + 70 as double) as purchase_x, cast(x + 110 as double) as pack_x
from part cross join (values (10), (400)) v(x) where x < 100 or p_partkey % 2 = 0
""")
def header_blocks(spark, sf_dir):
    """Header blocks by geometry; a code word near the foot is none."""
    return _groups(spark, sf_dir, 1).select(F.col("doc_id").cast("bigint").alias("id"), "alias_x", "alias_y", "purchase_x", "pack_x")


@query("select p_partkey as id, cast(x as double) as alias_x, cast(case when x < 100 then 0 else 260 end as double) as band_left, cast(case when x < 100 then 260 else 600 end as double) as band_right from part cross join (values (10), (400)) v(x) where p_partkey % 2 = 0")
def repeated_header_bands(spark, sf_dir):
    """Pages with two header blocks or more, and the stretch that belongs to each."""
    return readers.header_bands(_groups(spark, sf_dir, 2), 600.0).select(F.col("doc_id").cast("bigint").alias("id"), "alias_x", "band_left", "band_right")


@query(" union all ".join(f"select p_partkey as id, cast({k} as int) as table_idx, {_text('{s0}')} as code, {_text('{p0}')} as price, {_text('{p1}')} as second_price, cast({4 - k} as int) as n_rows, true as signal from part{where}" for k, where in ((0, ""), (1, " where p_partkey % 2 = 0"))))
def anchored_tables(spark, sf_dir):
    """Tables cut from the words below each header block."""
    areas = regions.anchored_areas(_groups(spark, sf_dir, 1), F.lit(600.0), F.lit(800.0))
    got = regions.clipped_tables(_words(spark, sf_dir), areas)
    cell = lambda r, c: F.try_element_at(F.try_element_at("matrix", F.lit(r)), F.lit(c))
    return got.select(F.col("doc_id").cast("bigint").alias("id"), "table_idx", cell(2, 1).alias("code"), cell(2, 2).alias("price"), cell(3, 2).alias("second_price"), F.size("matrix").alias("n_rows"), readers.has_code_price_signal(F.col("matrix")).alias("signal"))


@query("""
select p_partkey as id, cast(row_number() over (partition by p_partkey order by k) - 1 as int) as table_idx, name from (
    select p_partkey, 1 as k, 'repeated' as name from part where p_partkey % 3 = 0 union all select p_partkey, 2, 'repeated' from part where p_partkey % 3 = 0
    union all select p_partkey, 0, 'lattice' from part where p_partkey % 3 <> 0 and p_partkey % 2 = 0 union all select p_partkey, 0, 'stream' from part where p_partkey % 3 <> 0 and p_partkey % 2 = 1
    union all select p_partkey, 3, 'anchored' from part where p_partkey % 3 <> 0 and p_partkey % 2 = 1) t
""")
def settled_tables(spark, sf_dir):
    """Which extraction of a page counts: repeated regions, wide lattice tables, stream tables, and anchored ones where no price is seen."""
    ids = part(spark, sf_dir)

    def made(name: str, where: str, *cells: str, k: int = 0) -> DataFrame:
        row = F.array(F.lit(name), *(F.lit(c) for c in cells))
        return ids.where(where).select(F.col("p_partkey").cast("string").alias("doc_id"), F.lit(0).alias("page_idx"), F.lit(k).alias("table_idx"), F.array(row).alias("matrix"))

    lattice = made("lattice", "p_partkey % 2 = 0", "4149 45", "990", "x").unionByName(made("lattice", "p_partkey % 2 = 1", "x"))
    repeated = made("repeated", "p_partkey % 3 = 0", "4149 45", "990", "a").unionByName(made("repeated", "p_partkey % 3 = 0", "4149 46", "990", "b", k=1)).unionByName(made("repeated", "p_partkey % 3 = 1", "one alone", "x", "y"))
    got = regions.settled_tables(lattice, made("stream", "true", "no price"), repeated, made("anchored", "true", "4149 47 990"))
    return got.select(F.col("doc_id").cast("bigint").alias("id"), "table_idx", F.col("matrix")[0][0].alias("name"))


@query(f"select p_partkey as id, case when p_partkey % 2 = 0 then {_text('{c0}')} else '' end as first_cell, cast(case when p_partkey % 2 = 0 then 2 else 0 end as int) as n_cells from part")
def first_filled_row(spark, sf_dir):
    rows = F.array(F.array(F.lit(""), F.lit(" ")), F.when(F.col("p_partkey") % 2 == 0, F.array(_cell("{c0}"), F.lit("x"))).otherwise(F.array(F.lit("\n"))))
    got = part(spark, sf_dir).select(F.col("p_partkey").alias("id"), tables.first_filled_row(rows).alias("row"))
    return got.select("id", F.coalesce(F.get("row", F.lit(0)), F.lit("")).alias("first_cell"), F.size("row").alias("n_cells"))


@query("select o_orderkey as page_number, status, provider, cast(count(*) over (partition by provider) as bigint) as of_provider from (select o_orderkey, 'success' as status, 'primary' as provider from orders where o_orderkey % 3 = 0 union all select o_orderkey, 'success', 'fallback' from orders where o_orderkey % 3 <> 0 and o_orderkey % 2 = 0) r")
def provider_counts(spark, sf_dir):
    """Results of two sources, the second only where the first failed, with counts for each."""
    from pyspark.sql import Window

    orders = read(spark, sf_dir, "orders")
    primary = orders.select(F.col("o_orderkey").alias("page_number"), F.when(F.col("o_orderkey") % 3 == 0, "success").otherwise("error").alias("status"), F.lit("primary").alias("provider"))
    second = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("page_number"), F.lit("success").alias("status"), F.lit("fallback").alias("provider"))
    return match.chosen_source(primary, second).withColumn("of_provider", F.count("*").over(Window.partitionBy("provider")))
