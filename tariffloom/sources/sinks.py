"""Sinks: price rows and the review files of a matching run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def price_columns(include_particulars: bool = False, include_pack: bool = False) -> list[str]:
    return ["alias", "purchase", *(["particulars"] if include_particulars else []), *(["pack"] if include_pack else []), "source_page"]


def export_prices(rows: DataFrame, path: str, *, include_particulars: bool = False, include_pack: bool = False, kind: str = "csv", order: str = "ord") -> Observation:
    """Write price rows in order, with prices of two digits; gives counts once it has run.

    Rows are range-partitioned by their order: files are in order, and no
    single task holds them all.
    """
    told = Observation("export")
    ordered = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order)
    ordered = ordered.observe(told, F.count("*").alias("rows"), F.max("source_page").alias("last_page")).select(*price_columns(include_particulars, include_pack)).withColumn("purchase", F.bround("purchase", 2))
    writer = ordered.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return told


def export_run(path: str, **frames: DataFrame) -> dict[str, str]:
    """Write each frame (page_manifest, accepted_rows, ...) as CSV below the path; arrays and structs become JSON."""
    out = {}
    for name, df in frames.items():
        flat = df.select(*(F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c) for c, kind in df.dtypes))
        out[name] = f"{path.rstrip('/')}/{name}"
        flat.write.mode("overwrite").option("header", True).csv(out[name])
    return out
