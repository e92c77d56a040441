"""Layout queries on parts from 100,000 on, whose made codes have seven digits."""

from collections import Counter

import duckdb
import pytest

from tariffloom import layout_queries as layouts
from tariffloom.operators.layouts.engine import TableEngine
from tariffloom.queries import QUERIES, SQL

PARTS = [0, 99_999, *range(100_000, 100_010), 119_999, 1_199_999]
#: Rows of the SQL whose code the footnote rule cuts if it is printed 4 + 3, for ``PARTS``.
LONG = {
    "carry_forward": 18,
    "code_stack": 12,
    "compact_vertical": 12,
    "dense_column": 12,
    "dual_role_column": 8,
    "mapped_table": 12,
    "on_request_rows": 6,
    "repeated_blocks": 18,
    "split_header": 12,
}


@pytest.fixture(scope="module")
def parts(tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    db = duckdb.connect()
    db.execute(f"copy (select unnest({PARTS})::bigint as p_partkey) to '{folder}/part.parquet' (format parquet)")
    db.execute(f"create view part as from '{folder}/part.parquet'")
    return str(folder), db


@pytest.mark.parametrize("name", LONG)
def test_long_codes_come_out_as_the_sql_says(spark, parts, name):
    folder, db = parts
    got = [tuple(r) for r in QUERIES[f"layout_{name}"](spark, folder).collect()]
    assert Counter(got) == Counter(db.sql(SQL[f"layout_{name}"]).fetchall())


@pytest.mark.parametrize("name", LONG)
def test_long_codes_printed_with_three_digits_apart_follow_the_footnote_rule(parts, name):
    """The queries don't print so; the parsers then give the SQL's rows with the cut codes, and no others."""
    _, db = parts
    shape, words, packs = layouts.SHAPES[name][:3] if name in layouts.SHAPES else ([layouts.HEAD, *layouts.BODY], True, True)
    tables = [shape] if name in layouts.SHAPES else [shape, layouts.MORE]
    printed = [f"concat_ws(chr(10), {', '.join(map(layouts._text, cell.split(chr(10))))})" for t in tables for row in t for cell in row]
    engine, got = TableEngine(layouts.PROFILE, words, packs), set()
    for part, *texts in db.sql(f"select p_partkey, {', '.join(printed)} from part").fetchall():
        left = iter(texts)
        matrices = [[[next(left) for _ in row] for row in t] for t in tables]
        got |= {(part, k, *row) for k, rows in enumerate(engine.page(matrices)) for row in rows}
    stated = db.sql(SQL[f"layout_{name}"]).fetchall()
    cut = lambda code: code[:6] if len(code) == 7 and code[-1] in "123" else code
    assert got == {(*r[:3], cut(r[3]), *r[4:]) for r in stated}
    assert sum(cut(r[3]) != r[3] for r in stated) == LONG[name]
