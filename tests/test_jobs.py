"""Settings and the two jobs end to end."""

import json

from tariffloom.__main__ import main
from tariffloom.plans.jobs import from_text, match_run
from tariffloom.plans.profile import Profile
from tariffloom.plans.settings import Settings
from tariffloom.sources import readers

PROFILE = Profile({"alias": ["cat.nos"], "purchase": ["mrp"], "particulars": ["description"], "pack": ["pack"]})


def test_settings_fall_back():
    got = Settings.read({"TARIFF_MIN_SCORE": "-3", "TARIFF_MAX_PAGES": "x", "TARIFF_PACK": "Yes", "TARIFF_PARTICULARS": "maybe", "TARIFF_OUTPUT": "xlsx"})
    assert got == Settings(2, None, False, True, "csv") and Settings.read({"TARIFF_MAX_PAGES": "7"}).max_pages == 7


def test_text_to_prices(spark):
    table = "Cat.Nos | Description | MRP | Pack\n4149 45 | Supply | 990 | 1\n4149 46 | Relay | 880 | 1"
    pages = spark.createDataFrame([("d", 0, "cover | 1\n9999 99 | 500"), ("d", 1, table)], readers.PAGES)
    got = from_text(pages, readers.delimited_backend(), PROFILE, Settings(include_pack=True)).collect()
    assert sorted((r.alias, r.purchase, r.source_page) for r in got) == [("414945", 990.0, 2), ("414946", 880.0, 2)]


def test_command_line(spark, tmp_path):
    row = {"doc_id": "d", "page_idx": 0, "table_idx": 0, "matrix": [["Code", "Rate"], ["AB101", "150"], ["AB102", "250"]]}
    (tmp_path / "in.json").write_text(json.dumps(row) + "\n")
    main(["--tables", str(tmp_path / "in.json"), "--out", str(tmp_path / "out"), "--profiles", str(tmp_path / "none")])
    got = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted((r.alias, r.purchase) for r in got.collect()) == [("AB101", "150.0"), ("AB102", "250.0")]


def test_matching_run(spark, tmp_path):
    schema = f"page_number int, status string, rows array<struct<{', '.join(f'{n}: {t}' for n, t in (c.split() for c in readers.EXTRACTED.split(', ')))}>>"
    row = lambda code, price, conf=0.9: (code, "words", price, conf, 1, "", "p")
    primary = spark.createDataFrame([(1, "success", [row("AB-101", "5/-"), row("x", "5")]), (2, "error", []), (3, "no_rows", [])], schema)
    fallback = spark.createDataFrame([(1, "success", [row("ZZ-1000", "1")]), (2, "success", [row("CD202", "7", 0.5), row("CD203", "8")])], schema)
    sheet = spark.createDataFrame([("ab 101",), ("CD203",), ("QQ999",)], "Alias string")
    manifest = spark.createDataFrame([(1, 10), (2, 20), (3, 0)], "page_number int, native_text_length int")
    summary, files = match_run(primary, fallback, sheet, manifest, str(tmp_path))
    assert summary.first().asDict() == {"total_pages": 3, "candidate_rows": 4, "accepted_rows": 2, "review_rows": 2, "matched_rows": 2}
    assert len(files) == 6 and spark.read.option("header", True).csv(files["unmatched_excel_rows"]).first().Alias == "QQ999"


def test_service(spark, tmp_path):
    import threading
    import urllib.error
    import urllib.request

    from tariffloom.service import server

    schema = f"page_number int, status string, rows array<struct<{', '.join(f'{n}: {t}' for n, t in (c.split() for c in readers.EXTRACTED.split(', ')))}>>"
    row = ("AB-101", "words", "5/-", 0.9, 1, "", "p")
    place = {k: str(tmp_path / k) for k in ("primary", "fallback", "sheet", "manifest", "out")}
    spark.createDataFrame([(1, "success", [row])], schema).write.parquet(place["primary"])
    spark.createDataFrame([], schema).write.parquet(place["fallback"])
    spark.createDataFrame([("ab 101",)], "Alias string").write.parquet(place["sheet"])
    spark.createDataFrame([(1, 10)], "page_number int, native_text_length int").write.parquet(place["manifest"])
    running = server(spark, port=0)
    threading.Thread(target=running.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{running.server_address[1]}"

    def post(body):
        try:
            return json.load(urllib.request.urlopen(urllib.request.Request(f"{base}/v1/process", json.dumps(body).encode())))
        except urllib.error.HTTPError as e:
            return e.code

    try:
        assert json.load(urllib.request.urlopen(f"{base}/health")) == {"status": "ok"}
        got = post(place)
        assert got["matched_rows"] == got["accepted_rows"] == 1 and len(got["files"]) == 6
        assert post({"primary": "x"}) == 422 and post(place | {"primary": str(tmp_path / "nowhere")}) == 500
    finally:
        running.shutdown()


def test_keyword_files(tmp_path):
    import pytest

    from tariffloom.plans.profile import find_profile, read_keyword_weights

    (tmp_path / "w.json").write_text('{" Extra ": 9, "": 1, "x": "y", "mrp": 0}')
    (tmp_path / "list.json").write_text("[]")
    assert read_keyword_weights(tmp_path / "w.json") == {"extra": 9, "mrp": 0}
    with pytest.raises(ValueError):
        read_keyword_weights(tmp_path / "list.json")
    with pytest.raises(FileNotFoundError):
        find_profile("a.pdf", tmp_path / "none", required=True)
