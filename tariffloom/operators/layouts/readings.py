"""What the layout parsers read in single cells, labels and tables, as columns."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffloom.plans.profile import ROLES, Profile

from . import cells
from .columns import _dense_price, _entries, _stacked
from .engine import TableEngine
from .headers import HeaderReader
from .mapped import _technical
from .streams import _leading_price, _tail_code, _token_price, pairs_in

CELL = (
    "code string, numeric_code string, leading_code string, strong_code string, group_code string, tail_code string, has_code boolean, "
    "inline struct<code: string, price: double>, mixed struct<code: string, price: double>, pairs array<struct<code: string, price: double>>, entries array<struct<code: string, words: string>>, "
    "last_number double, token_price double, leading_price double, line_prices array<double>, best_price double, dense_price double, stacked struct<price: double, pack: string>, is_heading boolean, is_technical boolean"
)


def _reading(text: str, headers: HeaderReader) -> dict:
    pair = lambda p: None if p is None else {"code": p[0], "price": p[1]}
    found, (value, pack) = cells.line_prices(text), _stacked(text)
    return {
        "code": cells.find_code(text) or None, "numeric_code": cells.find_code(text, True) or None, "leading_code": cells.leading_code(text, True), "strong_code": cells.strong_leading(text, True),
        "group_code": cells.group_code(text), "tail_code": _tail_code(text), "has_code": bool(cells.has_code_evidence(text)), "inline": pair(cells.inline_pair(text)), "mixed": pair(cells.mixed_pair(text)),
        "pairs": [pair(p) for p in pairs_in(text)], "entries": [{"code": c, "words": w} for c, w in _entries(text)], "last_number": cells.last_number(text), "token_price": _token_price(text),
        "leading_price": _leading_price(text), "line_prices": found, "best_price": cells.best(found), "dense_price": _dense_price(text, headers), "stacked": {"price": value, "pack": pack},
        "is_heading": bool(cells.is_heading(text)), "is_technical": bool(_technical(text)),
    }


def _mapped(function, schema: str, *columns: Column) -> Column:
    """``function`` of each row of the columns; only they go to Python."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            got = [function(*values) for values in zip(*(c.to_pylist() for c in (batch if isinstance(batch, tuple) else (batch,))), strict=True)]
            yield pa.array(got, kind)

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(schema))
    if len(columns) == 1:
        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from run(batches)

        return F.arrow_udf(one, schema).asNondeterministic()(*columns)
    return F.arrow_udf(run, schema).asNondeterministic()(*columns)


def read_cells(df: DataFrame, text: str, profile: Profile, out: str = "reading") -> DataFrame:
    """Add ``out``: codes, prices, pairs and kinds of words in the cell ``text`` (null counts as empty)."""
    headers = HeaderReader(profile)
    return df.withColumn(out, _mapped(lambda t: _reading(t or "", headers), CELL, F.col(text)))


def read_labels(df: DataFrame, label: str, profile: Profile, out: str = "reading") -> DataFrame:
    """Add ``out``: the role that a label names, and for each role its score and whether words of it occur."""
    headers = HeaderReader(profile)

    def reading(t: str | None) -> dict:
        t = t or ""
        return {"role": headers.role_of_label(t)} | {f"{r}_score": headers.score(t, r) for r in ROLES} | {f"{r}_named": bool(headers.marks_role(t, r)) for r in ROLES}

    schema = ", ".join(["role string", *(f"{r}_score int" for r in ROLES), *(f"{r}_named boolean" for r in ROLES)])
    return df.withColumn(out, _mapped(reading, schema, F.col(label)))


def read_layouts(tables: DataFrame, profile: Profile, out: str = "layout") -> DataFrame:
    """Add ``out``: the header row of ``matrix``, its titles after enrichment, and the column mappings as JSON."""
    engine = TableEngine(profile)

    def reading(matrix: list | None) -> dict:
        at, titles, mappings = engine.layout([[c or "" for c in row or []] for row in matrix or []])
        return {"header_row": at, "titles": titles, "mappings": json.dumps(mappings, sort_keys=True)}

    return tables.withColumn(out, _mapped(reading, "header_row int, titles array<string>, mappings string", F.col("matrix")))
