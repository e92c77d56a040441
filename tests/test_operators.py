"""Operators on Spark: against DuckDB on the given tables, against the table functions, and on odd rows."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tariffloom import layout_queries, queries as catalog, source_queries  # noqa: F401
from tariffloom.functions import codes, packs, prices, text
from tariffloom.operators import dedup, match, tables, triage
from tariffloom.operators.layouts import cells
from tariffloom.operators.layouts.engine import extract_prices, normalize_tables
from tariffloom.plans.profile import Profile
from tariffloom.sources import readers, regions, sinks

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in catalog.TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    cur = duck.execute(catalog.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted((tuple(plain(r[names.index(c)]) for c in got.columns) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in got.collect()), key=repr) == want


def stated_number(s):
    """A number by the reference's grammar: its value, None if it is no price, False if it is no number."""
    whole, dot, rest = s.partition(".")
    first, *groups = whole.split(",")
    digits = lambda x: x.isascii() and x.isdigit()
    if not digits(first) or (dot and not digits(rest)) or not all(digits(g) and len(g) == 3 for g in groups):
        return False
    return None if groups and len(first) > 3 else float(s.replace(",", ""))


def trailing_by_hand(v):
    flat = " ".join(v.split())
    parts = flat.split(" ")
    if len(parts) == 2 and all(p.isdigit() for p in parts) and 3 <= len(parts[0]) <= 6 and 2 <= len(parts[1]) <= 6:
        return None
    for k in range(len(flat)):
        if (k == 0 or not flat[k - 1].isalnum()) and (value := stated_number(flat[k:])) is not False:
            return value if value is not None and value >= 50 else None
    return None


def inline_by_hand(v):
    for line in v.split("\n"):
        flat = " ".join(line.split())
        number, _, pack = flat.rpartition(" ")
        sides = pack.split("/")
        if len(sides) not in (2, 3) or not all(p.isdigit() and len(p) <= (3 if k else 2) for k, p in enumerate(sides)):
            continue
        found = [stated_number(number[k:]) for k in range(len(number)) if k == 0 or not number[k - 1].isdigit()]
        value = next((x for x in found if x is not False), None)
        if value is not None and value >= 50:
            return value, pack
    return None, ""


def test_text_prices_of_all_shapes(spark):
    """Every row of part, all twelve shapes, against a reading of the reference's rules without expressions."""
    given = {r.id: r.v for r in catalog.given(spark, DATA, catalog.PRICE_TEXTS).collect()}
    got = {r.id: (r.trailing, r.inline_price, r.inline_pack) for r in catalog.QUERIES["text_prices"](spark, DATA).collect()}
    assert len(got) == spark.read.parquet(f"{DATA}/part.parquet").count() and {i % 12 for i in got} == set(range(12))
    assert got == {i: (trailing_by_hand(v), *inline_by_hand(v)) for i, v in given.items()}


TEXTS = ["", " ", "1995.-", "1,995.50", "15 670", "63\n125", "4222 39 3190", "₹ 5", "5ST30101)", "ac 12/3", "IP54", "1/12", "10 Nos", "- ", "4122 761", "Unit MRP* `", "2220 1/10/100\nx", "Bell 1736 1/20", "a b c", "12P", "x.5", "9..", "SOCKET-3", "6/16A", "1 1 1", "5ST38140RC\n5ST3", "1.5.", "12,34"]


def test_columns_agree_with_cells(spark):
    """Native functions and the table functions read alike."""
    rng = random.Random(4)
    some = TEXTS + ["".join(rng.choice([*"0123456789AXPVst/-., \n", "kW", "to"]) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in some], "v string")
    v, c = F.col("v"), codes.clean_code(F.col("v"))
    inline = prices.inline_price_and_pack(v)
    got = df.select("v", prices.parse_price(v), codes.looks_like_code(c), codes.looks_like_code(c, True), codes.is_code_line(v), codes.is_strong_code(c, True), packs.clean_pack(v), packs.pack_column_quality(v), packs.pack_line_count(v), prices.last_price(v), prices.trailing_price(v), inline["price"], F.coalesce(inline["pack"], F.lit("")), packs.is_pack_token(v), text.lines(v)).collect()
    for r in got:
        t, k = r[0], cells.clean(r[0])
        assert tuple(r[1:]) == (cells.price(t), cells.is_code(k), cells.is_code(k, True), cells.is_code_line(t), cells.is_strong(k, True), cells.clean_pack(t), cells.pack_rank(t), cells.count_packs(t), cells.last_number(t), cells.trailing_price(t), *cells.price_and_pack(t), cells.is_pack_token(t), list(cells.lines(t))), t


def rows_of(spark, rows):
    return spark.createDataFrame([(a, float(p), w, k, n) for n, (a, p, w, k) in enumerate(rows)], "alias string, purchase double, particulars string, pack string, ord int")


def test_dedup_pools_and_ties(spark):
    rows = [("A1", 63, "", ""), ("A1", 990, "", ""), ("B1", 63, "", ""), ("C1", 75, "", "1/2"), ("C1", 300, "", ""), ("D1", 200.5, "", ""), ("D1", 201.5, "", "1/5"), ("E1", 5, "x", ""), ("E1", 5, "", "1"), ("15670", 15670, "", ""), ("F1", 15670, "", ""), ("F1", 77.5, "", "")]
    got = {r.alias: (r.purchase, r.particulars, r.pack) for r in dedup.deduplicate(rows_of(spark, rows).repartition(3)).collect()}
    assert got == {"A1": (990, "", ""), "B1": (63, "", ""), "C1": (300, "", ""), "D1": (201.5, "", "1/5"), "E1": (5, "", "1"), "F1": (77.5, "", "")}
    again = dedup.deduplicate(dedup.deduplicate(rows_of(spark, rows)))
    assert {r.alias: r.purchase for r in again.collect()} == {k: v[0] for k, v in got.items()}
    assert dedup.deduplicate(rows_of(spark, rows).limit(0)).count() == 0


def test_footnote_chains_follow_order(spark):
    chain = [("123456", 9, "", ""), ("1234567", 9, "", ""), ("12345678", 9, "", "")]
    left = lambda rows: {r.alias for r in dedup.drop_footnotes(rows_of(spark, rows)).collect()}
    assert left(chain) == {"123456", "12345678"} and left(chain[::-1]) == {"123456"}
    four = [("400001", 9, "", ""), ("4000011", 9, "", ""), ("40000112", 9, "", ""), ("400001123", 9, "", "")]
    assert left(four) == {"400001", "40000112"}
    rng = random.Random(2)
    for _ in range(5):
        rows = [("123456" + "7890"[:n], 9, "", "") for n in range(5) if rng.random() < 0.8]
        rng.shuffle(rows)
        there = {r[0] for r in rows}
        for alias, *_ in rows:
            if len(alias) >= 7 and alias[:-1] in there:
                there.discard(alias)
        assert left(rows) == there


def test_footnote_chains_with_doubled_rows(spark):
    """A code and price that stand twice are one base, in the place of the first."""
    left = lambda rows: sorted((r.alias, r.purchase) for r in dedup.drop_footnotes(rows_of(spark, rows)).collect())
    chain = [("123456", 9, "", ""), ("1234567", 9, "", ""), ("12345678", 9, "", ""), ("1234567", 9, "", "")]
    assert left(chain) == [("123456", 9), ("12345678", 9)]
    rng = random.Random(3)
    rows = [(f"{400000 + k}" + "7890"[:n], 9 + rng.randint(0, 1), "", "") for k in range(60) for n in range(5) for _ in range(rng.choice([0, 1, 1, 2, 3]))]
    rng.shuffle(rows)
    there = {r[:2] for r in rows}
    for alias, price, *_ in rows:
        if len(alias) >= 7 and (alias[:-1], price) in there:
            there.discard((alias, price))
    assert left(rows) == sorted(r[:2] for r in rows if r[:2] in there)


def test_code_tokens_equal_the_pattern(spark):
    """Runs from the last to the first count what the whole pattern finds, in lines of any length."""
    import re
    import time

    whole = re.compile(r"\b(?=[A-Za-z0-9\-_/.]{5,}\b)(?=.*[A-Za-z])(?=.*\d)[A-Za-z0-9][A-Za-z0-9\-_/.]*\b")
    rng = random.Random(3)
    some = ["".join(rng.choice(["AB12", "34567", "x", "-", "_", "/", ".", " ", " ", "\n", "é", "abcde", "9"]) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    got = spark.createDataFrame([(t,) for t in some], "t string").select("t", triage.code_tokens(F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in got} == {t: len(whole.findall(t)) for t in some}
    began = time.time()
    long = spark.createDataFrame([("12345 " * 50_000 + "A",)], "t string").select(triage.code_tokens(F.col("t")).alias("n")).first().n
    assert long == 50_000 and time.time() - began < 20


@pytest.mark.parametrize("alias, price, same", [("1E5", 100000, True), ("1_000", 1000, True), ("12D", 12, False), ("500", 500, True), ("AB", 1, False), ("5.50", 5.5, True)])
def test_codes_that_are_the_price(spark, alias, price, same):
    df = rows_of(spark, [(alias, price, "", "")])
    assert df.select(dedup.self_priced(F.col("alias"), F.col("purchase"))).first()[0] is same


def test_validation_and_matching(spark):
    rows = [("AB-12", "1,200/-", " d1 ", 0.7), ("AB", "5", "dd", 1.0), ("AB123", "n/a", "dd", 1.0), ("AB124", "5.0", "dd", 0.69), ("AB125", "5", " d ", 1.0), ("ab_12", "7", "later", 0.9), (None, None, None, None)]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "code string, price string, description string, confidence double, ord int")
    got = [r.review_reason for r in match.validated(df).orderBy("ord").collect()]
    assert got == ["accepted", "invalid_code", "invalid_price", "low_confidence", "missing_description", "accepted", "invalid_code"]
    sheet = spark.createDataFrame([("ab 12", 1), ("AB12", 2), ("XY99", 3), (None, 4), ("plain", 5)], "Alias string, ord int")
    matched = match.match_sheet(sheet, match.validated(df).where("review_reason = 'accepted'"))
    assert sorted((r.Alias, r.price) for r in matched.collect()) == [("", None), ("AB12", "1200"), ("XY99", None), ("ab 12", "1200"), ("plain", None)]
    assert [r.Alias for r in match.unmatched(matched).collect()] == ["XY99"]
    assert {"ord_excel", "ord_extracted"} <= set(matched.columns)


def test_triage_gate_and_fallback(spark):
    profile = Profile()
    good = "Reference No MRP Description Std Pkg AB123 100"
    pages = spark.createDataFrame([("a", 0, "cover"), ("a", 1, good), ("a", 2, None), ("b", 0, "price"), ("b", 1, "nothing"), ("b", 2, "mrp price")], readers.PAGES)
    got = sorted((r.doc_id, r.page_idx) for r in triage.candidates(pages, profile, fallback=2).collect())
    assert got == [("a", 1), ("b", 0), ("b", 2)]
    assert [r.page_idx for r in triage.candidates(pages, profile, target_page=2).where("doc_id = 'a'").collect()] == [1]
    assert triage.candidates(pages.limit(0), profile).count() == 0


def test_header_fold_equals_loop(spark):
    rng = random.Random(1)
    for _ in range(5):
        scores = sorted((k, rng.randint(-1, 400)) for k in rng.sample(range(40), 12))
        best, at = -1, 0
        for k, s in scores:
            if s > best + 100 or (s >= best and k <= at):
                best, at = s, k
        df = spark.createDataFrame([(scores,)], "s array<struct<idx: int, score: int>>")
        assert df.select(tables.header_fold(F.col("s"))).first()[0] == (at if best >= 0 else None)


MATRIX = [["Cat.Nos", "Description", "MRP", "Pack"], ["4149 45", "Power Supply", "10904", "1"], ["4149 46", "Relay", "1,250.50", "10"], ["4149 47", "On request", "■", "1"]]
PROFILE = Profile({"alias": ["cat.nos"], "purchase": ["mrp"], "particulars": ["description"], "pack": ["pack"]})


def test_tables_to_prices(spark, tmp_path):
    more = [["4150 10", "Adapter", "990", "2"], ["4149 45", "Power Supply", "10904", ""]]
    some = spark.createDataFrame([("d", 0, 0, MATRIX), ("d", 0, 1, more), ("d", 1, 0, [[None, "x"], None, []]), ("e", 0, 0, [])], readers.TABLES)
    rows = normalize_tables(some.repartition(4), PROFILE, include_particulars=True, include_pack=True)
    got = sorted((r.doc_id, r.table_idx, r.alias, r.purchase, r.source_page) for r in rows.collect())
    assert got == [("d", 0, "414945", 10904.0, 1), ("d", 0, "414946", 1250.5, 1), ("d", 1, "414945", 10904.0, 1), ("d", 1, "415010", 990.0, 1)]
    best = extract_prices(some, PROFILE, include_particulars=True, include_pack=True)
    assert sorted((r.alias, r.purchase, r.pack) for r in best.collect()) == [("414945", 10904.0, "1"), ("414946", 1250.5, "10"), ("415010", 990.0, "2")]
    told = sinks.export_prices(best, str(tmp_path / "out"), include_pack=True)
    assert told.get["rows"] == 3 and spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["alias", "purchase", "pack", "source_page"]
    assert normalize_tables(some.limit(0), PROFILE).count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "doc").mkdir()
    (tmp_path / "doc" / "2.txt").write_text("title\n4149 45 | Supply | 990\n4149 46 | Relay | 880\n\nend")
    pages = readers.read_page_texts(spark, str(tmp_path))
    assert [(r.doc_id, r.page_idx) for r in pages.collect()] == [("doc", 1)]
    found = readers.extract_tables(pages, readers.delimited_backend()).select("table_idx", "matrix", "status", readers.has_code_price_signal(F.col("matrix")).alias("signal")).first()
    assert (found.status, found.signal, len(found.matrix)) == ("success", True, 2)
    broken = readers.Backend("broken", lambda p: 1 / 0)
    assert readers.extract_tables(pages, broken).first().status == "error"
    answers = spark.createDataFrame([('{"rows": [{"code": "AB12", "price": "5", "confidence": 0.9}]}',), ("no json",), ('{"rows": []}',)], "answer string")
    assert [r.status for r in readers.extracted_rows(answers).collect()] == ["success", "error", "no_rows"]


def test_header_geometry(spark):
    words = [("d", 0, k, float(x), float(y), 0.0, 0.0, t) for k, (x, y, t) in enumerate([(10, 100, "Cat.Nos"), (80, 104, "MRP"), (120, 96, "Pack"), (400, 100, "Cat.Nos"), (480, 100, "MRP"), (520, 100, "Pack"), (10, 760, "Cat.Nos"), (60, 300, "MRP")])]
    df = spark.createDataFrame(words, readers.WORDS)
    groups = readers.header_groups(df, {r: PROFILE.markers(r) for r in ("alias", "purchase", "pack")}, F.lit(800.0))
    got = [(r.alias_x, r.purchase_x, r.pack_x, r.band_left, r.band_right) for r in readers.header_bands(groups, 600.0).orderBy("alias_x").collect()]
    assert got == [(10.0, 80.0, 120.0, 0.0, 260.0), (400.0, 480.0, 520.0, 260.0, 600.0)]


def test_streams_settle_prices(spark, tmp_path):
    from tariffloom.streaming.watch import current_prices, watch_pages, watch_tables

    place = {k: str(tmp_path / k) for k in ("in", "store", "prices", "check", "pages")}
    spark.createDataFrame([("d", 0, 0, MATRIX)], readers.TABLES).write.mode("append").parquet(place["in"])
    run = lambda: watch_tables(spark, place["in"], place["store"], place["prices"], place["check"], PROFILE).awaitTermination()
    run()
    spark.createDataFrame([("e", 0, 0, [MATRIX[0], ["4149 46", "Relay", "63", "1"], ["4150 10", "Adapter", "990", "2"]])], readers.TABLES).write.mode("append").parquet(place["in"])
    run()
    assert {r.alias: r.purchase for r in current_prices(spark, place["prices"]).collect()} == {"414945": 10904.0, "414946": 1250.5, "415010": 990.0}
    assert watch_pages(spark, place["in"], PROFILE).isStreaming


def _joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin")


def test_words_are_never_broadcast(spark):
    # a page explodes into many words of which estimates know nothing; these few rows would be broadcast
    groups = source_queries._groups(spark, DATA, 1)
    assert _joins(groups) == (3, 0)


def test_words_of_several_header_blocks_are_never_broadcast(spark):
    assert _joins(readers.header_bands(source_queries._groups(spark, DATA, 2), 600.0)) == (3, 0)


def test_clipped_words_are_never_broadcast(spark):
    areas = regions.anchored_areas(source_queries._groups(spark, DATA, 1), F.lit(600.0), F.lit(800.0))
    assert _joins(regions.clipped_tables(source_queries._words(spark, DATA), areas)) == (4, 0)


def test_stream_rows_meet_mapped_rows_by_equality(spark):
    """All rows of a page at one price: the join makes no pairs but those that share a form."""
    mapped = [("p", "500001AB", 500.0), ("p", "500002", 500.0), ("p", "7500003", 500.0), ("p", "ÜB", 500.0), ("p", None, 500.0), (None, "500009N", 500.0)]
    stream = [("p", a, 500.0) for a in ("500001", "500001A", "500001AB", "5000022", "50000222", "500003", "00003", "Ü", "", None, "500004")] + [("q", "500001", 500.0), ("p", "500001", None), (None, "500009", 500.0)]
    kind = "page string, alias string, purchase double"
    got = dedup.suppress_stream(spark.createDataFrame(mapped, kind), spark.createDataFrame(stream, kind), ["page"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and plan.count("m_form") > 0
    # "" stands before the letters of a code that has no others
    assert sorted(((r.page, r.alias) for r in got.collect()), key=repr) == sorted([("p", "500001AB"), ("p", "50000222"), ("p", None), ("p", "500004"), ("q", "500001"), (None, "500009")], key=repr)
