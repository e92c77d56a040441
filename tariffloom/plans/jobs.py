"""The two jobs: tables to best prices, and extracted rows to a matched sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.operators import match, triage
from tariffloom.operators.layouts.engine import extract_prices
from tariffloom.sources import readers, sinks

from .profile import Profile
from .settings import Settings


def price_list(pages: DataFrame | None, tables: DataFrame, profile: Profile, settings: Settings, *, weights: dict[str, int] | None = None, target_page: int | None = None) -> DataFrame:
    """Best prices of tables; with ``pages``, only of pages that triage chooses, so that no parser sees others."""
    if pages is not None:
        chosen = triage.candidates(pages, profile, min_score=settings.min_score, weights=weights, max_pages=settings.max_pages, target_page=target_page)
        tables = tables.join(chosen.select("doc_id", "page_idx"), ["doc_id", "page_idx"], "left_semi")
    return extract_prices(tables, profile, include_particulars=settings.include_particulars, include_pack=settings.include_pack)


def from_text(pages: DataFrame, backend: readers.Backend, profile: Profile, settings: Settings) -> DataFrame:
    """Triage, table extraction by a backend, normalization and deduplication."""
    if backend.wants_triage:
        chosen = triage.candidates(pages, profile, min_score=settings.min_score, max_pages=settings.max_pages)
        pages = pages.join(chosen.select("doc_id", "page_idx"), ["doc_id", "page_idx"], "left_semi")
    found = readers.extract_tables(pages, backend).where("status = 'success'")
    return price_list(None, found, profile, settings)


def match_run(primary: DataFrame, fallback: DataFrame, sheet: DataFrame, manifest: DataFrame, path: str) -> tuple[DataFrame, dict[str, str]]:
    """Page results (page_number, status, rows) of two sources, validated, matched with a sheet and exported.

    Gives the summary and the place of each file.
    """
    results = match.chosen_source(primary, fallback)
    rows = results.select("page_number", F.posexplode("rows").alias("place", "row")).select("row.*", F.struct("page_number", "place").alias("ord"))
    judged = match.validated(rows)
    good = F.col("review_reason") == "accepted"
    accepted, review = judged.where(good), judged.where(~good)
    matched = match.match_sheet(sheet, accepted)
    files = sinks.export_run(path, page_manifest=manifest, all_candidate_rows=rows.drop("ord"), accepted_rows=accepted.drop("ord"), review_rows=review.drop("ord"), matched_rows=matched.drop("ord"), unmatched_excel_rows=match.unmatched(matched).drop("ord"))
    return match.summary(rows, accepted, review, matched, manifest), files
