"""Layout queries on parts whose made codes have eight digits or more: far shifted keys."""

from collections import Counter

import duckdb
import pytest

from tariffloom import layout_queries as layouts
from tariffloom.queries import QUERIES, SQL

#: Codes of 8 (2,000,000), 9 (16,600,000 on) and 10 digits (166,600,000 on).
PARTS = [2_000_000, 16_599_999, *range(16_600_000, 16_600_005), 20_000_000, 166_600_000, 200_000_003, 1_666_599_998]


@pytest.fixture(scope="module")
def parts(tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    db = duckdb.connect()
    db.execute(f"copy (select unnest({PARTS})::bigint as p_partkey) to '{folder}/part.parquet' (format parquet)")
    db.execute(f"create view part as from '{folder}/part.parquet'")
    return str(folder), db


@pytest.mark.parametrize("name", ["compact_vertical", "dense_column", "dual_role_column"])
def test_longer_codes_come_out_as_the_sql_says(spark, parts, name):
    folder, db = parts
    got = [tuple(r) for r in QUERIES[f"layout_{name}"](spark, folder).collect()]
    assert Counter(got) == Counter(db.sql(SQL[f"layout_{name}"]).fetchall())


def test_only_codes_of_seven_digits_are_printed_otherwise():
    """4 + 3 is no print for them, by the footnote rule; all others are printed as the placeholder says."""
    plain, shown = (layouts._text("{s0}", v) for v in (layouts._value, layouts._printed))
    lengths = duckdb.sql(f"select distinct length((400000 + p_partkey * 6)::varchar) from (select unnest({[0, 99_999, 100_000, 1_599_999, *PARTS]})::bigint as p_partkey) where {plain} <> {shown}").fetchall()
    assert lengths == [(7,)]
