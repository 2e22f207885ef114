"""Traces worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import AS_OF, batch, by_cid, document, log, logs_frame
from tracemill.functions.traces import normalize_request_path
from tracemill.operators.rows import flat_rows
from tracemill.operators.traces import trace_features
from tracemill.config import EngineConfig

GOLDEN = [
    log("t1", "Request started", logger="gateway", at=1, method="GET", path="/users/42/orders",
        status=500),
    log("t1", "TimeoutError: upstream 10.0.0.7:8080 silent for 42 ms at 0x1f", "ERROR", "auth", 2),
    log("t2", "Order 17 shipped", at=10, method="GET", path="/orders/17", status=200),
    log("t3", "Order 18 shipped", at=20, method="GET", path="/orders/18", status=200),
    log("t4", "Order 19 not found", "WARNING", at=30, method="GET", path="/orders/19", status=404),
    log("t5", "Retrying call 7, fallback used", logger="auth", at=40),
    log("t6", "12:30 clock tick", logger="auth", at=50),
    log("t7", "sweep 9 done", "debug", "cron", 60),
    log("t8", "anything", "trace", at=70),
    log("t9", "anything", at=80, meta="[1]"),
]


@pytest.fixture(scope="module")
def outcome(spark):
    return batch(spark, GOLDEN)


def test_features(outcome):
    f = by_cid(outcome.features)
    t1 = f["t1"]
    assert (t1.outcome, t1.severity_score, t1.fingerprint) == ("failure", 10, "TRC-66556BA9")
    assert t1.error_types == ["TimeoutError"] and t1.suspicious_keywords == ["timeout"]
    assert t1.request_path_pattern == "/users/{id}/orders" and t1.services == ["gateway", "auth"]
    assert t1.levels_present == ["error", "info"] and t1.has_errors and not t1.has_warnings
    assert (f["t2"].outcome, f["t2"].severity_score, f["t2"].fingerprint) == (
        "success", 2, "TRC-D03E92EA")
    assert f["t3"].fingerprint == f["t2"].fingerprint
    assert (f["t4"].outcome, f["t4"].severity_score, f["t4"].fingerprint) == (
        "client_error", 4, "TRC-91B27D2C")
    assert f["t5"].suspicious_keywords == ["retry", "retrying", "fallback"]
    assert f["t5"].fingerprint == "TRC-49083575"
    assert f["t6"].error_types == ["12"] and f["t6"].fingerprint == "TRC-00DC1BC7"
    assert (f["t7"].outcome, f["t7"].severity_score, f["t7"].fingerprint) == (
        "success", 1, "TRC-41F2765F")


def test_verdicts(outcome):
    v = by_cid(outcome.verdicts)
    assert {cid: row.tier for cid, row in v.items()} == {
        "t1": "tier0_severity", "t2": "tier5_cold_start", "t3": "tier5_cold_start",
        "t4": "tier5_cold_start", "t5": "tier1_keywords", "t6": "tier1_error_types",
        "t7": "default",
    }
    assert (v["t2"].operation, v["t3"].operation) == ("insert", "repeat")
    assert v["t1"].reason == "severity_score=10 >= 7"
    assert v["t3"].reason == "building baseline for /orders/{id} (1/3 fingerprints known)"
    assert v["t4"].reason == "building baseline for /orders/{id} (1/3 fingerprints known)"
    assert v["t5"].reason == "suspicious keywords: ['retry', 'retrying', 'fallback']"
    assert v["t7"].action == "DROP"


def test_documents(outcome):
    d = by_cid(outcome.documents)
    assert set(d) == {"t1", "t2", "t4", "t5", "t6"}
    assert (d["t2"].occurrence_count, d["t2"].last_seen) == (2, AS_OF)
    assert (d["t1"].occurrence_count, d["t1"].last_seen) == (1, d["t1"].timestamp_unix)
    assert d["t1"].semantic_text == (
        "GET /users/{id}/orders. Flow: gateway → auth. Request started. TimeoutError: upstream "
        "10.0.0.7:8080 silent for 42 ms at 0x1f. Outcome: failure, 500"
    )
    assert d["t5"].semantic_text == (
        "Service: auth. Retrying call 7, fallback used. Outcome: success"
    )
    assert len(d["t1"].embedding) == 384
    assert d["t2"].error_types is None and d["t6"].error_types == ["12"]


def test_failures(outcome):
    q = by_cid(outcome.quarantine)
    assert {cid: row.last_error for cid, row in q.items()} == {
        "t8": "invalid_level", "t9": "invalid_meta"}
    m = outcome.metrics.first()
    assert (m.promoted, m.dropped, m.failed, m.total, m.tripped) == (5, 2, 2, 9, False)


@pytest.mark.parametrize("path, pattern", [
    ("/users/2", "/users/{id}"), ("/orders/ORD-123", "/orders/{id}"),
    ("/api/v2/products", "/api/v2/products"), ("/x/deadbeef/y", "/x/{id}/y"),
    ("/x/--------", "/x/{id}"), ("/", "/"), ("users/7/", "users/{id}/"), ("/a//9", "/a//{id}"),
    ("", None), (None, None), ("/1/2/3", "/{id}/{id}/{id}"), ("7", "{id}"),
    ("/abcdefghij0123456789", "/{id}"), ("/AB-12x", "/AB-12x"), ("/٣", "/{id}"),
])
def test_paths(spark, path, pattern):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(normalize_request_path(F.col("p"))).first()[0] == pattern


STORED = [document("p", f"s{i}", fp, "/orders/{id}") for i, fp in
          enumerate(["TRC-D03E92EA", "TRC-AAAAAAA1", "TRC-AAAAAAA2"])]
KNOWN = dict(message="Order 17 shipped", method="GET", path="/orders/17", status=200)
NEW = dict(message="Order packed", method="GET", path="/orders/17", status=200)
RECENT = [("p", AS_OF - 600)]


def judged(spark, entry, commits=(), documents=tuple(STORED)):
    return batch(spark, [log("x", **entry)], documents, commits).verdicts.first()


def test_stable_endpoint(spark):
    assert judged(spark, KNOWN).tier == "default"
    fresh = judged(spark, NEW)
    assert (fresh.tier, fresh.operation) == ("tier3_new_fingerprint", "insert")
    assert fresh.reason.endswith("on stable endpoint /orders/{id} (known: 3 fingerprints)")


def test_deploy_window(spark):
    fresh = judged(spark, NEW, RECENT)
    assert (fresh.tier, fresh.operation) == ("tier2_deploy_new_fp", "insert")
    assert judged(spark, KNOWN, RECENT).tier == "default"
    assert judged(spark, NEW, [("p", AS_OF - 3601)]).tier == "tier3_new_fingerprint"
    assert judged(spark, NEW, [("p", AS_OF + 5)]).tier == "tier2_deploy_new_fp"
    assert judged(spark, NEW, [("q", AS_OF)]).tier == "tier3_new_fingerprint"


def test_deploy_window_failure_of_known_fingerprint(spark):
    rows = flat_rows(logs_frame(spark, [log("x", **{**KNOWN, "status": 404})]), AS_OF)
    fingerprint = trace_features(rows, EngineConfig()).first().fingerprint
    stored = [*STORED, document("p", "s9", fingerprint, "/orders/{id}")]
    verdict = judged(spark, {**KNOWN, "status": 404}, RECENT, stored)
    assert (verdict.tier, verdict.operation) == ("tier2_deploy_window", "repeat")
    assert verdict.reason == "outcome=client_error within 60min of deploy"


def test_fingerprint_of_another_path(spark):
    stored = [document("p", f"s{i}", f"TRC-0000000{i}", "/orders/{id}") for i in range(3)]
    stored.append(document("p", "elsewhere", "TRC-D03E92EA", "/other"))
    outcome = batch(spark, [log("x", **KNOWN), log("y", **KNOWN, at=5)], stored)
    for row in by_cid(outcome.verdicts).values():
        assert (row.tier, row.operation, row.keeper) == (
            "tier3_new_fingerprint", "repeat", "elsewhere")
    assert by_cid(outcome.documents)["elsewhere"].occurrence_count == 3


def test_merge_of_a_stored_trace(spark):
    stored = [*STORED[:2], document("p", "x", "TRC-AAAAAAA2", "/orders/{id}")]
    logs = logs_frame(spark, [log("x", "Order packed", at=-60, method="GET", path="/orders/17"),
                              log("x", "Order packed", at=0)])
    rows = flat_rows(logs.withColumn("in_batch", F.col("rowSeq") >= 0), AS_OF)
    outcome = batch(spark, rows, stored)
    verdict = outcome.verdicts.first()
    assert (verdict.tier, verdict.operation) == ("tier5_cold_start", "insert")
    replaced = by_cid(outcome.documents)["x"]
    assert replaced.log_count == 2 and replaced.fingerprint != "TRC-AAAAAAA2"


def test_merge_that_is_dropped_loses_its_document(spark):
    stored = [*STORED, document("p", "x", "TRC-AAAAAAA3", "/orders/{id}")]
    logs = logs_frame(spark, [log("x", **KNOWN, at=-60), log("x", "Order 5 shipped", at=0)])
    rows = flat_rows(logs.withColumn("in_batch", F.col("rowSeq") >= 0), AS_OF)
    outcome = batch(spark, rows, stored)
    assert outcome.verdicts.first().action == "DROP"
    assert set(by_cid(outcome.documents)) == {"s0", "s1", "s2"}
