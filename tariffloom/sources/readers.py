"""Sources: page text, words with geometry, table matrices, extracted rows and master sheets.

Reading PDFs, OCR and spreadsheets needs libraries that a cluster may lack.
They plug in as a ``Backend``: a function from the pages of one task to
tables. Everything behind it is declared on the schemas below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES = "doc_id string, page_idx int, text string"
WORDS = "doc_id string, page_idx int, word_id bigint, x0 double, y0 double, x1 double, y1 double, text string"
TABLES = "doc_id string, page_idx int, table_idx int, matrix array<array<string>>"
RESULTS = "doc_id string, page_idx int, table_idx int, matrix array<array<string>>, status string, message string"
EXTRACTED = "code string, description string, price string, confidence double, source_page int, evidence_text string, provider string"


def read_page_texts(spark: SparkSession, path: str) -> DataFrame:
    """Pages from text files named <doc>/<page from 1>.txt; one row for each file."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("file"))
    return files.select(F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("doc_id"), (F.regexp_extract("file", r"(\d+)\.txt$", 1).try_cast("int") - 1).alias("page_idx"), F.col("value").alias("text")).where("page_idx is not null")


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    """Tables from lines of JSON."""
    return spark.read.schema(TABLES).json(path)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A master sheet from CSV with a header, or from Parquet; its Alias is text."""
    sheet = spark.read.option("header", True).csv(path) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)
    if "Alias" not in sheet.columns:
        raise ValueError("the sheet must have a column Alias")
    return sheet.withColumn("Alias", F.col("Alias").cast("string"))


def extracted_rows(answers: DataFrame, column: str = "answer") -> DataFrame:
    """Rows of model answers: JSON objects with a list "rows". What is no such JSON gives status error."""
    parsed = answers.withColumn("_rows", F.from_json(column, f"struct<rows: array<struct<{EXTRACTED.replace(' ', ': ').replace(',:', ',')}>>>"))
    status = F.when(F.col("_rows").isNull() | F.col("_rows.rows").isNull(), "error").when(F.size("_rows.rows") == 0, "no_rows").otherwise("success")
    return parsed.withColumn("status", status).select(*answers.columns, "status", F.col("_rows.rows").alias("rows"))


@dataclass(frozen=True)
class Backend:
    """A table extractor: its name, whether triage pays for it, and its function.

    The function takes (doc_id, page_idx, text) of the pages of one task and
    gives (doc_id, page_idx, list of matrices); a page that it can't read is
    told with its message, not lost.
    """

    name: str
    extract: Callable[[Iterable[tuple[str, int, str]]], Iterator[tuple[str, int, list[list[list[str]]]]]]
    wants_triage: bool = True


def extract_tables(pages: DataFrame, backend: Backend) -> DataFrame:
    """Tables of pages with status and message; a page without tables has status no_rows."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for page in zip(pdf["doc_id"], pdf["page_idx"], pdf["text"], strict=True):
                try:
                    found = [(d, p, k, m, "success", "") for d, p, ms in backend.extract([page]) for k, m in enumerate(ms)]
                    out += found or [(page[0], page[1], 0, [], "no_rows", "")]
                except Exception as e:  # noqa: BLE001  the page is told, its neighbours go on
                    out.append((page[0], page[1], 0, [], "error", str(e)[:500]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULTS.split(", ")])

    return pages.select("doc_id", "page_idx", "text").mapInPandas(run, RESULTS)


def delimited_backend(separator: str = "|") -> Backend:
    """Tables from plain text: blocks of lines that hold the separator."""

    def extract(pages):
        for doc, page, text in pages:
            tables, block = [], []
            for line in [*(text or "").splitlines(), ""]:
                if separator in line:
                    block.append([c.strip() for c in line.split(separator)])
                elif block:
                    tables.append(block)
                    block = []
            yield doc, page, tables

    return Backend("delimited", extract)


def has_code_price_signal(matrix: Column) -> Column:
    """Does a row of the matrix hold a spaced code and a number within price bounds?"""

    def row(cells: Column) -> Column:
        text = F.array_join(cells, " ", "")
        numbers = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), 1), lambda n: n.try_cast("double"))
        return text.rlike(r"\b\d{3,6}[ \t]\d{2,6}\b") & F.exists(numbers, lambda n: (n >= 50) & (n <= 500_000))

    return F.exists(matrix, row)


def header_groups(words: DataFrame, markers: dict[str, list[str]], page_height: Column, *, dy: float = 22.0, left: float = 10.0, right: float = 260.0, min_groups: int = 1, spread: float = 40.0) -> DataFrame:
    """Header blocks on pages: a code word with the nearest words for the other roles right of it on its line.

    Words are (doc_id, page_idx, word_id, x0, y0, text); a block needs words
    for price and pack. Blocks below four fifths of the page are none; of
    anchors within eight units of each other the first counts. Pages with fewer
    than ``min_groups`` blocks give none; where several are asked for, they must
    stand within ``spread`` units of height. Words are merged with anchors,
    whatever the planner believes their number to be.
    """
    from tariffloom.functions.text import has_any_marker, normalize_header
    from tariffloom.operators.tables import band_join

    keys = ["doc_id", "page_idx"]
    said = normalize_header(F.col("text"))
    marked = words.withColumns({"height": page_height, **{f"is_{r}": has_any_marker(said, m) for r, m in markers.items()}}).withColumns({"x": F.col("x0"), "y": F.col("y0")})
    upper = marked.where(F.col("y0") <= 0.9 * F.col("height"))
    anchors = upper.where(F.col("is_alias") & (F.col("y0") <= 0.8 * F.col("height"))).withColumnRenamed("word_id", "anchor_id")
    near = band_join(anchors, upper, keys, dy=dy, left=left, right=right)
    near = near.join(upper.select(*keys, "word_id", *(f"is_{r}" for r in markers)).hint("merge"), [*keys, "word_id"])
    near = near.join(anchors.select(*keys, "anchor_id", F.col("x").alias("alias_x"), F.col("y").alias("alias_y")).hint("merge"), [*keys, "anchor_id"])
    first = lambda r: F.min(F.when(F.col(f"is_{r}") & (F.col("x") > F.col("alias_x")), F.col("x"))).alias(f"{r}_x")
    groups = near.groupBy(*keys, "anchor_id", "alias_x", "alias_y").agg(*(first(r) for r in markers if r != "alias")).where("purchase_x is not null and pack_x is not null")
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy("alias_y", "alias_x", "anchor_id")
    close = (F.abs(F.col("alias_x") - F.lag("alias_x").over(order)) <= 8) & (F.abs(F.col("alias_y") - F.lag("alias_y").over(order)) <= 8)
    groups = groups.withColumn("_close", F.coalesce(close, F.lit(False))).where("not _close").drop("_close")
    page = Window.partitionBy(*keys)
    counted = groups.withColumns({"_n": F.count("*").over(page), "_apart": F.max("alias_y").over(page) - F.min("alias_y").over(page)})
    enough = (F.col("_n") >= min_groups) & ((F.col("_apart") <= spread) if min_groups >= 2 else F.lit(True))
    return counted.where(enough).drop("_n", "_apart")


def header_bands(groups: DataFrame, page_width: float) -> DataFrame:
    """The stretch of the page that belongs to each of several blocks side by side, by midpoints between them."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id", "page_idx").orderBy("alias_x")
    end = F.greatest("purchase_x", "pack_x")
    low = F.coalesce((F.lag(end).over(w) + F.col("alias_x")) / 2, F.lit(0.0))
    high = F.coalesce((end + F.lead("alias_x").over(w)) / 2, F.lit(page_width))
    return groups.withColumns({"band_left": low, "band_right": high})
