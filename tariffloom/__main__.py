"""python -m tariffloom --tables IN --out OUT: best prices of tables in lines of JSON."""

from __future__ import annotations

import argparse
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

from tariffloom.plans.jobs import price_list
from tariffloom.plans.profile import find_profile
from tariffloom.plans.settings import Settings
from tariffloom.sources import readers, sinks


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tariffloom")
    p.add_argument("--tables", required=True, help="lines of JSON: doc_id, page_idx, table_idx, matrix")
    p.add_argument("--pages", help="page texts (<doc>/<page>.txt) for triage")
    p.add_argument("--out", required=True)
    p.add_argument("--profile", help="a profile file")
    p.add_argument("--profiles", default="profiles", help="folder with <name>.json and default.json")
    p.add_argument("--target-page", type=int)
    p.add_argument("--max-pages", type=int)
    p.add_argument("--include-particulars", action="store_true")
    p.add_argument("--include-pack", action="store_true")
    a = p.parse_args(argv)
    settings = Settings.read()
    settings = replace(settings, max_pages=a.max_pages or settings.max_pages, include_particulars=a.include_particulars or settings.include_particulars, include_pack=a.include_pack or settings.include_pack)
    spark = SparkSession.builder.appName("tariffloom").getOrCreate()
    pages = readers.read_page_texts(spark, a.pages) if a.pages else None
    best = price_list(pages, readers.read_tables(spark, a.tables), find_profile(Path(a.tables).name, a.profiles, a.profile), settings, target_page=a.target_page)
    told = sinks.export_prices(best, a.out, include_particulars=settings.include_particulars, include_pack=settings.include_pack, kind=settings.output_kind)
    print(f"{told.get['rows']} prices in {a.out}")


if __name__ == "__main__":
    main()
