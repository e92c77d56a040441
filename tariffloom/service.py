"""A small HTTP service around the matching job: GET /health, and POST /v1/process with the places of its inputs.

The body is JSON with the paths ``primary``, ``fallback`` (page results as
Parquet), ``sheet`` (CSV or Parquet), ``manifest`` (Parquet) and ``out``; the
answer is the summary with the files that were written. Each request runs one
job on the shared session.
"""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession

from tariffloom.plans.jobs import match_run
from tariffloom.sources import readers

INPUTS = ("primary", "fallback", "sheet", "manifest", "out")


def process(spark: SparkSession, body: dict) -> dict:
    """Run the job; raises ValueError if a path is missing."""
    if missing := [k for k in INPUTS if not isinstance(body.get(k), str) or not body[k]]:
        raise ValueError(f"missing: {', '.join(missing)}")
    primary, fallback, manifest = (spark.read.parquet(body[k]) for k in ("primary", "fallback", "manifest"))
    summary, files = match_run(primary, fallback, readers.read_sheet(spark, body["sheet"]), manifest, body["out"])
    return summary.first().asDict() | {"files": files}


def server(spark: SparkSession, host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """The service, ready for ``serve_forever``; port 0 takes any free one."""

    class Handler(BaseHTTPRequestHandler):
        def answer(self, status: int, body: dict) -> None:
            data = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:
            self.answer(*((200, {"status": "ok"}) if self.path == "/health" else (404, {"error": "not found"})))

        def do_POST(self) -> None:
            if self.path != "/v1/process":
                return self.answer(404, {"error": "not found"})
            try:
                body = json.loads(self.rfile.read(int(self.headers.get("Content-Length", 0))) or b"{}")
                self.answer(200, process(spark, body if isinstance(body, dict) else {}))
            except (ValueError, json.JSONDecodeError) as e:
                self.answer(422, {"error": str(e)})
            except Exception as e:  # noqa: BLE001  a job that fails is told, the service goes on
                self.answer(500, {"error": str(e)[:500]})

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
