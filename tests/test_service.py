"""The service as a data source, against stored pages and a small server."""

import json
import threading
from collections import Counter
from datetime import date
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nomograph.sources import service
from nomograph.sources.corpus import Corpus
from tests.conftest import DATA

SCHEMA = "work_uri string, celex string, doc_date date, in_force boolean, n long"


def test_stored_pages_are_the_table(spark, tmp_path):
    works = Corpus(spark, DATA)["works"].select("work_uri", "celex", "doc_date", "in_force", F.length("work_uri").cast("long").alias("n"))
    service.store_pages(works, str(tmp_path), "works", rows=100)
    got = service.read(spark, str(tmp_path), "works", SCHEMA)
    assert sorted(got.collect(), key=str) == sorted(works.collect(), key=str) and got.rdd.getNumPartitions() > 1
    some = lambda df: df.where((F.col("celex") >= "31995") & (F.col("n") > 5) & F.col("in_force") & (F.col("doc_date") < F.lit("1997-01-01").cast("date")))
    assert sorted(some(got).collect(), key=str) == sorted(some(works).collect(), key=str) and some(works).count() > 0
    assert got.where(F.col("celex").isin("none", "nothing")).count() == 0
    # a comparison with a value is the source's to check, others stay Spark's
    plan = got.where((F.col("n") == 25) & F.col("celex").rlike("^3"))._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" in plan and "= 25" not in plan


@pytest.mark.parametrize(
    ("status", "body", "reason"),
    [
        (200, '{"results": {"bindings": []}}', None), (400, "bad", "invalid_query"), (404, "", "not_found"), (500, "", "unavailable"), (429, "", "unavailable"), (504, "", "timeout"), (200, " <!DOCTYPE html><html>", "unavailable"), (200, "Virtuoso error: transaction timeout", "timeout"), (200, "syntax error at SELECT", "invalid_query"),
        (200, '{"results": {"bindings": [{"x": {"type": "literal", "value": "an error <timeout>"}}]}}', None),
    ],
)
def test_answers_are_told_apart(status, body, reason):
    error = service.of_status(status, body)
    assert (error and error.reason) == reason


@pytest.mark.parametrize("body", ["", "{}", "[1]", '{"results": 3}', '{"results": {"bindings": [1]}}', "not json"])
def test_what_is_no_result_document(body):
    with pytest.raises(service.ServiceError) as e:
        service.bindings(body)
    assert e.value.reason == "unavailable" and e.value.transient


def test_only_what_may_pass_is_tried_again():
    pauses, left = [], ["unavailable", "timeout"]

    def flaky():
        if left:
            raise service.ServiceError(left.pop(), "x")
        return "answer"

    assert service.retried(flaky, 3, 100, pauses.append) == "answer" and pauses == [0.1, 0.2]
    for reason, calls in (("unavailable", 3), ("invalid_query", 1), ("not_found", 1)):
        made = []

        def failing(reason=reason, made=made):
            made.append(1)
            raise service.ServiceError(reason, "x")

        with pytest.raises(service.ServiceError):
            service.retried(failing, 3, 0, lambda s: None)
        assert len(made) == calls


def test_paths_are_escaped():
    assert service.path_of("32016R0679 (01)", "a/b", "é+%") == "32016R0679%20%2801%29/a%2Fb/%C3%A9%2B%25"


@pytest.fixture
def server():
    seen, rows = Counter(), [{"celex": {"type": "literal", "value": f"3{k}"}, "n": {"type": "literal", "value": str(k) if k % 5 else "five"}, "in_force": {"type": "literal", "value": ("true", "0", "perhaps")[k % 3]}} for k in range(40)]

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            url = urlparse(self.path)
            asked = parse_qs(url.query)
            seen[url.path] += 1
            seen["filters"] += any(k.startswith("gt.n") for k in asked)
            status, body = 200, json.dumps({"results": {"bindings": rows[int(asked["part"][0]) :: int(asked["of"][0])]}})
            if url.path == "/flaky%20table" and seen[url.path] <= 2:
                body = "<html>wait</html>"
            if url.path == "/wrong":
                status, body = 400, "no such thing"
            if url.path == "/down":
                status, body = 503, ""
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *args):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", seen
    s.shutdown()


def test_a_service_over_http(spark, server):
    url, seen = server
    read = lambda table, **o: service.read(spark, url, table, "celex string, n long, in_force boolean, gone date", pause_ms=1, **o)
    got = {tuple(r) for r in read("works", partitions=3).collect()}
    assert got == {(f"3{k}", k if k % 5 else None, (True, False, None)[k % 3], None) for k in range(40)} and seen["/works"] == 3
    assert {r.n for r in read("works").where("n > 30").collect()} == {k for k in range(31, 40) if k % 5} and seen["filters"] >= 4
    assert read("flaky table", partitions=1, attempts=3).count() == 40 and seen["/flaky%20table"] == 3


@pytest.mark.parametrize(("table", "reason", "calls"), [("wrong", "invalid_query", 1), ("down", "unavailable", 2)])
def test_failures_of_a_service(spark, server, table, reason, calls):
    url, seen = server
    with pytest.raises(PySparkException) as e:
        service.read(spark, url, table, "celex string", partitions=1, attempts=2, pause_ms=1).collect()
    assert reason in str(e.value) and seen[f"/{table}"] == calls


def test_kinds():
    assert service._typed("date", "2020-02-30") is None and service._typed("date", "2020-02-29") == date(2020, 2, 29)
    assert [service._typed("boolean", x) for x in ("true", "1", "false", "0", "yes", None)] == [True, True, False, False, None, None]
