"""Fetching against a local server with errors, delays and missing ids."""

import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import lineup
from pitchlake.sources import fetch


@pytest.fixture(scope="module")
def server():
    asked = Counter()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            name = self.path.rpartition("/")[2]
            if not self.path.startswith("/bra.1/"):
                name = "4"
            asked[name] += 1
            if name == "slow":
                time.sleep(3)
            code = 404 if name == "4" else 500 if name == "5" or name == "6" and asked[name] == 1 else 200
            body = b"<html>" if name == "7" else b"\xff\xfe" if name == "8" else json.dumps({"athlete": {"id": name, "displayName": f"P{name} é"}}).encode()
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_address[1]}/{{league}}/athletes/{{id}}", asked
    s.shutdown()


def test_profiles_from_a_server(spark, server):
    pattern, asked = server
    ids = spark.createDataFrame([(x,) for x in ("1", "2", "2", "4", "5", "6", "7", "8", "slow", "a b/c")], "requested_id string")
    got = {r["requested_id"]: r for r in fetch.profiles(ids, pattern, "BRA-Brasileirao", parts=3, delay=0.01, timeout=1.0, attempts=2).collect()}
    assert set(got) == {"1", "2", "4", "5", "6", "7", "8", "slow", "a b/c"}
    assert {k for k, r in got.items() if r["_raw"] is None} == {"4", "5", "7", "8", "slow"}
    assert got["6"]["athlete"]["displayName"] == "P6 é" and got["a b/c"]["athlete"]["id"] == "a%20b%2Fc"
    assert (asked["2"], asked["4"], asked["5"], asked["6"]) == (1, 1, 2, 2)
    rows = {r["espn_athlete_id"]: r["display_name"] for r in lineup.profile_rows(fetch.profiles(ids.filter("requested_id in ('1', '4')"), pattern, "BRA-Brasileirao", parts=2, delay=0.0)).collect()}
    assert rows == {1: "P1 é", 4: None}


def test_pauses_and_dead_servers(spark):
    asked = spark.range(6).select(F.col("id").cast("string").alias("requested_id"), F.lit("http://127.0.0.1:9/").alias("url")).union(spark.createDataFrame([(None, None), ("x", "nowhere:x")], "requested_id string, url string"))
    began = time.perf_counter()
    got = fetch.fetched(asked, parts=2, delay=0.2).collect()
    assert len(got) == 8 and not any(r["body"] or r["status"] for r in got) and time.perf_counter() - began >= 0.6
    assert fetch.fetched(asked.limit(0)).count() == 0
