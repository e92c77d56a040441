"""Watching folders (an extension): triage and normalization of what arrives, prices settled by batch.

Triage and normalization have no state. The best price of a code depends on
all its candidates, so each batch settles the codes that it touches anew over
all candidates kept so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tariffloom.operators.dedup import deduplicate
from tariffloom.operators.layouts.engine import normalize_tables
from tariffloom.operators.triage import is_table_page, scored
from tariffloom.plans.profile import Profile
from tariffloom.sources.readers import PAGES, TABLES


def watch_pages(spark: SparkSession, path: str, profile: Profile, min_score: int = 2) -> DataFrame:
    """A stream of the pages (Parquet files) that pass the triage gate."""
    pages = spark.readStream.schema(PAGES).parquet(path)
    return scored(pages, profile).where(is_table_page(min_score)).select("doc_id", "page_idx", "text", "score")


def watch_tables(spark: SparkSession, path: str, store: str, prices: str, checkpoint: str, profile: Profile) -> StreamingQuery:
    """Normalize tables (Parquet files) as they arrive; keep candidates in ``store`` and best prices in ``prices``.

    A batch that is run again replaces its own candidates, so nothing counts
    twice. Prices are partitioned by batch; the latest row of a code holds.
    """
    tables = spark.readStream.schema(TABLES).parquet(path)

    def settle(batch: DataFrame, number: int) -> None:
        rows = normalize_tables(batch, profile, include_particulars=True, include_pack=True)
        rows.write.mode("overwrite").parquet(f"{store}/batch={number}")
        every = batch.sparkSession.read.option("basePath", store).parquet(f"{store}/batch=*")
        touched = every.where(F.col("batch") == number).select("alias").distinct()
        mine = every.where(F.col("batch") <= number).join(touched, "alias", "left_semi")
        ordered = mine.withColumn("ord", F.struct("batch", "doc_id", "page_idx", "table_idx", "emit_idx"))
        best = deduplicate(ordered.drop("batch", "doc_id", "page_idx", "table_idx", "emit_idx"))
        best.select("alias", "purchase", "particulars", "pack", "source_page").write.mode("overwrite").parquet(f"{prices}/batch={number}")

    return tables.writeStream.foreachBatch(settle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_prices(spark: SparkSession, prices: str) -> DataFrame:
    """The latest settled row of each code."""
    rows = spark.read.option("basePath", prices).parquet(f"{prices}/batch=*")
    others = [c for c in rows.columns if c not in ("alias", "batch")]
    return rows.groupBy("alias").agg(F.max_by(F.struct(*others), "batch").alias("r")).select("alias", *(F.col(f"r.{c}").alias(c) for c in others))
