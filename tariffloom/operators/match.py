"""Validation of extracted rows and matching with a master sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffloom.functions.codes import is_sheet_code, sheet_code
from tariffloom.functions.prices import is_sheet_price, sheet_price
from tariffloom.functions.text import strip

MIN_CONFIDENCE, MIN_DESCRIPTION = 0.70, 2


def review_reason() -> Column:
    """The first rule that a row (code, price, confidence, description) breaks, or "accepted"."""
    bad = F.coalesce(F.length(strip(F.coalesce("description", F.lit("")))) < MIN_DESCRIPTION, F.lit(True))
    return (
        F.when(~is_sheet_code(F.col("code")), "invalid_code").when(~is_sheet_price(F.col("price")), "invalid_price")
        .when(F.coalesce(F.col("confidence") < MIN_CONFIDENCE, F.lit(True)), "low_confidence").when(bad, "missing_description").otherwise("accepted")
    )


def validated(rows: DataFrame) -> DataFrame:
    """Rows with normalized_code, trimmed description, normalized price and review_reason."""
    return rows.withColumn("review_reason", review_reason()).withColumns({
        "normalized_code": sheet_code(F.col("code")), "description": strip(F.coalesce("description", F.lit(""))), "price": sheet_price(F.col("price")),
    })


def chosen_source(primary: DataFrame, fallback: DataFrame, key: str = "page_number") -> DataFrame:
    """Page results (key, status, ...): the fallback's where the primary's is error or no_rows."""
    weak = F.col("status").isin("error", "no_rows")
    return primary.where(~weak).unionByName(fallback.join(primary.where(weak).select(key), key, "left_semi"))


def keep_first(rows: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The first row of each key, in the order given."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def match_sheet(sheet: DataFrame, accepted: DataFrame, order: str = "ord") -> DataFrame:
    """Left join of a sheet (with Alias) to the first accepted row of each code.

    Sheet columns that clash with an accepted one get the ending _excel, the
    others _extracted. Spark picks the join by size: no hint, as both sides may
    be large.
    """
    if "Alias" not in sheet.columns:
        raise ValueError("the sheet must have a column Alias")
    alias = F.coalesce(F.col("Alias").cast("string"), F.lit(""))
    left = sheet.withColumns({"Alias": alias, "alias_non_empty": strip(alias) != "", "alias_code_like": is_sheet_code(alias), "normalized_alias": sheet_code(alias)})
    right = keep_first(accepted, ["normalized_code"], order)
    clash = set(left.columns) & set(right.columns)
    left = left.withColumnsRenamed({c: f"{c}_excel" for c in clash})
    right = right.withColumnsRenamed({c: f"{c}_extracted" for c in clash})
    code = "normalized_code_extracted" if "normalized_code" in clash else "normalized_code"
    return left.join(right, left["normalized_alias"] == right[code], "left")


def unmatched(matched: DataFrame) -> DataFrame:
    """Sheet rows that look like a code and found none."""
    return matched.where(F.col("alias_code_like") & F.col("normalized_code").isNull())


def summary(candidates: DataFrame, accepted: DataFrame, review: DataFrame, matched: DataFrame, pages: DataFrame) -> DataFrame:
    """One row of counts; matched_rows counts sheet rows with a code."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    out = count(pages, "total_pages")
    for df, name in ((candidates, "candidate_rows"), (accepted, "accepted_rows"), (review, "review_rows")):
        out = out.crossJoin(count(df, name))  # one row each
    return out.crossJoin(matched.agg(F.count("normalized_code").alias("matched_rows")))
