"""Adversarial rows: validity, defaults, order, JSON, Unicode."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import AS_OF, START, by_cid, log, logs_frame
from tracemill.config import SUSPICIOUS_KEYWORDS, EngineConfig
from tracemill.functions import messages as M
from tracemill.operators import traces as O
from tracemill.operators.rows import flat_rows, is_json_non_object, nested_rows
from tracemill.sources.logs import scan_raw_traces

CFG = EngineConfig()


def features(spark, *entries):
    return by_cid(O.trace_features(flat_rows(logs_frame(spark, list(entries)), AS_OF), CFG))


@pytest.mark.parametrize("entry, error", [
    (dict(level="trace"), "invalid_level"),
    (dict(level=None), "invalid_level"),
    (dict(level=" Warning "), None),
    (dict(level=" CRITICAL\x1c"), None),
    (dict(logger=None), "missing_logger"),
    (dict(logger=""), None),
    (dict(meta="[1]"), "invalid_meta"),
    (dict(meta=" 7 "), "invalid_meta"),
    (dict(meta='"text"'), "invalid_meta"),
    (dict(meta="true"), "invalid_meta"),
    (dict(meta="NaN"), "invalid_meta"),
    (dict(meta=""), None),
    (dict(meta="null"), None),
    (dict(meta="not json"), None),
    (dict(meta="[1"), None),
    (dict(meta='{"a": 1}'), None),
    (dict(exception="[]"), "invalid_exception"),
    (dict(project=None), "missing_project"),
    (dict(level="trace", logger=None), "invalid_level, missing_logger"),
])
def test_validity(spark, entry, error):
    assert features(spark, log("c", "m", **entry))["c"].error == error


def test_one_bad_row_fails_the_trace(spark):
    got = features(spark, log("c", "fine"), log("c", None, at=1), log("d", "fine"))
    assert got["c"].error == "missing_message" and got["d"].error is None


def test_project_of_first_row_counts(spark):
    got = features(spark, log("c", "m", project="a"), log("c", "m", project=None, at=1))
    assert got["c"].project_id == "a" and got["c"].error is None


def test_missing_correlation_ids_form_one_failed_trace(spark):
    got = features(spark, *[log(None, f"{i}: x", at=i) for i in range(5)])
    assert got[None].error == "missing_correlation_id" and got[None].log_count == 5


def test_missing_columns_get_defaults(spark):
    bare = logs_frame(spark, [log("c", "m")]).drop("level", "message", "projectId", "meta")
    row = flat_rows(bare, AS_OF).first()
    assert (row.level, row.message, row.project_id, row.error_bits) == ("info", "", "", 0)
    without_logger = logs_frame(spark, [log("c", "m")]).drop("loggerName")
    got = by_cid(O.trace_features(flat_rows(without_logger, AS_OF), CFG))
    assert got["c"].error == "missing_logger"


def test_request_needs_method_or_path(spark):
    got = features(spark, log("c", "m", method="", path="", status=503),
                   log("d", "m", path="/x", status=503))
    assert got["c"].request_status_code is None and got["c"].outcome == "success"
    assert got["d"].request_status_code == 503 and got["d"].outcome == "server_error"


def test_unusable_time_becomes_as_of(spark):
    got = features(spark, log("c", "m", timestamp=None))
    assert got["c"].timestamp_unix == AS_OF


def test_equal_times_keep_row_order(spark):
    entries = [log("c", f"User {i}", logger=name, seq=i, timestamp=START)
               for i, name in enumerate(["b", "a", "c", "a"])]
    got = features(spark, *reversed(entries))["c"]
    assert got.services == ["b", "a", "c"] and got.fingerprint_message == "User 3"


def test_service_falls_back_to_first_row_then_project(spark):
    got = features(spark, log("c", "m", logger="gateway"), log("c", "m", logger="", at=1),
                   log("d", "m", logger="", project="shop"), log("e", "m", logger="", project=""))
    assert got["c"].services == ["gateway"]
    assert got["d"].services == ["shop"] and got["e"].services == ["unknown-service"]


def test_fingerprint_message_choice(spark):
    got = features(
        spark,
        log("a", "retry later"), log("a", "bad", "error", at=1), log("a", "done", at=2),
        log("b", "start"), log("b", "retry one", at=1), log("b", "retry two", at=2),
        log("c", "start"), log("c", "end", at=1),
    )
    assert [got[c].fingerprint_message for c in "abc"] == ["bad", "retry one", "end"]


def test_shared_correlation_id_merges_projects(spark):
    got = features(spark, log("c", "m", project="a"), log("c", "m", project="b", at=1))
    assert (got["c"].project_id, got["c"].log_count) == ("a", 2)


@pytest.mark.parametrize("message, meta, expected", [
    ("java.io.IOException: boom", None, "IOException"),
    ("got ConnectionRefused from db", None, "ConnectionRefused"),
    ("xTimeoutError here", None, None),
    ("12:30 clock", None, "12"),
    ("two words: x", None, None),
    (" padded : x", None, "padded"),
    ("x" * 51 + ": y", None, None),
    (":x", '{"error_type": "Lost"}', ""),
    ("plain", '{"error_type": "Lost"}', "Lost"),
    ("plain", '{"error_type": null}', "None"),
    ("plain", '{"error_type": true}', "True"),
    ("plain", '{"error_type": 5}', "5"),
    ("plain", '{"other": "error_type"}', None),
    ("plain", "not json error_type", None),
])
def test_error_types(spark, message, meta, expected):
    df = spark.createDataFrame([(message, meta)], "m string, j string")
    assert df.select(M.extract_error_type(F.col("m"), F.col("j"), 50)).first()[0] == expected


@pytest.mark.parametrize("message, template, norm", [
    ("id 550e8400-e29b-41d4-a716-446655440000 x", "id <UUID> x", "id x"),
    ("at 0xDEADbeef", "at <HEX_ADDR>", "at"),
    ("from 10.0.0.7:8080 in 42 ms", "from <IP> in <NUM> ms", "from ...: in ms"),
    ("v2 has 7  items", "v2 has <NUM> items".replace(" items", "  items"), "v2 has items"),
    ("count ٣", "count <NUM>", "count"),
    ("  Padded Text ", "  Padded Text ", "padded text"),
])
def test_message_forms(spark, message, template, norm):
    df = spark.createDataFrame([(message,)], "m string")
    got = df.select(M.normalize_message(F.col("m")), M.normalize_for_dedup(F.col("m"))).first()
    assert tuple(got) == (template, norm)


def test_keywords_are_substrings_in_list_order(spark):
    df = spark.createDataFrame([("retrying in the room, typeof x",), ("fine",)], "lowered string")
    joined = M.matched_keywords("lowered", SUSPICIOUS_KEYWORDS)
    got = [r[0] for r in df.select(M.split_keywords(joined)).collect()]
    assert got == [["eof", "oom", "retry", "retrying"], []]


def test_keywords_with_quotes(spark):
    df = spark.createDataFrame([("can't \\ stop",)], "lowered string")
    joined = M.matched_keywords("lowered", ("can't", "\\ s", "other"))
    assert df.select(M.split_keywords(joined)).first()[0] == ["can't", "\\ s"]


def test_keyword_order_is_by_log_first(spark):
    got = features(spark, log("c", "denied"), log("c", "timeout and denied", at=1))["c"]
    assert got.suspicious_keywords == ["denied", "timeout"]
    got = by_cid(O.suspicious_keywords(flat_rows(logs_frame(
        spark, [log("c", "denied"), log("c", "timeout and denied", at=1)]), AS_OF), CFG))
    assert got["c"].suspicious_keywords == ["denied", "timeout"]


def test_json_kinds(spark):
    cases = {"[1]": True, "{}": False, "null": False, "nul": False, "1.5e3": True, "-": False,
             '"a': False, "": False, "Infinity": True, "\n[]": True}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r[0]: r[1] for r in df.select("t", is_json_non_object(F.col("t"))).collect()}
    assert got == cases


def nested(tmp_path, spark, *traces):
    path = tmp_path / "traces.json"
    path.write_text("\n".join(json.dumps(t) for t in traces))
    return nested_rows(scan_raw_traces(spark, str(path)), AS_OF)


def trace(cid, logs, **fields):
    entry = dict(timestamp="2024-01-05T10:00:00Z", level="info", message="m", loggername="svc")
    return dict(
        dict(projectName="Shop", project_id="p", environment="prod", correlationId=cid,
             startedAt="2024-01-05T10:00:00Z"),
        logs=[{**entry, **changes} for changes in logs], **fields,
    )


def test_nested_traces(tmp_path, spark):
    rows = nested(
        tmp_path, spark,
        trace("a", [{}, {"level": "ERROR", "timestamp": "2024-01-05T09:59:59+00:00"}],
              request={"method": "GET", "path": "/x", "statusCode": "500"}, durationMs=12.0),
        trace("b", []),
        trace("c", [{}], durationMs=1.5),
        trace("d", [{"meta": "text"}]),
        trace("e", [{"meta": {"k": "v"}, "loggername": ""}], component="worker"),
        trace("f", [{"timestamp": "soon"}]),
        trace("g", [{}], request={"method": "", "path": "", "statusCode": 404}),
    )
    got = by_cid(O.trace_features(rows, CFG))
    assert "b" not in got
    assert (got["a"].duration_ms, got["a"].request_status_code) == (12, 500)
    assert got["a"].project_name == "Shop" and got["a"].environment == "prod"
    assert got["a"].timestamp_unix == 1704448799
    assert got["c"].error == "invalid_integer" and got["d"].error == "invalid_meta"
    assert got["e"].services == ["worker"] and got["f"].timestamp_unix == AS_OF
    assert got["g"].outcome == "client_error"


def test_positions_across_time_buckets(spark):
    entries = [log("c", str(i), at=i * 1800, seq=i) for i in range(10)]
    entries += [log(None, str(i), at=i, seq=i) for i in range(3)]
    ranked = O.chronological_logs(flat_rows(logs_frame(spark, entries), AS_OF))
    got = {(r.correlation_id, int(r.message)): r.position for r in ranked.collect()}
    assert got == {**{("c", i): i + 1 for i in range(10)}, **{(None, i): i + 1 for i in range(3)}}


def test_single_features_agree_with_the_combined_ones(spark):
    entries = [log(f"c{i % 5}", f"{['ok', 'retry', 'IOError: x'][i % 3]} {i}",
                   ["info", "warn", "error", "debug"][i % 4], f"s{i % 3}", i) for i in range(60)]
    rows = flat_rows(logs_frame(spark, entries), AS_OF)
    combined = by_cid(O.trace_features(rows, CFG))
    for single in (O.services_in_order(rows), O.error_types(rows, CFG), O.level_features(rows),
                   O.suspicious_keywords(rows, CFG)):
        for cid, row in by_cid(single).items():
            for name, value in row.asDict().items():
                assert combined[cid][name] == value
