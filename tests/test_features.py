"""Texts in pieces, models per worker, commits as of a trace, sessions, nested streams, projects."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import AS_OF, START, batch, by_cid, commits_frame, log, logs_frame
from tracemill import schemas as S
from tracemill.config import EngineConfig
from tracemill.operators import documents as D
from tracemill.operators import gate as G
from tracemill.operators.embed import embed_documents
from tracemill.operators.rows import flat_rows
from tracemill.operators.traces import trace_features, valid_traces
from tracemill.sources import logs as L
from tracemill.streaming.ingest import run_stream
from tracemill.streaming.nested import NestedStore, run_nested, stream_raw_traces
from tracemill.streaming.sessions import run_sessions
from tracemill.streaming.store import TraceStore

CFG = EngineConfig()
BEGIN = int(START.timestamp()) if START.tzinfo else 1704448800


# ---- texts -----------------------------------------------------------------

LONG = [log("long", f"step {'abcdefghij'[i % 10] * (i % 40)} é{chr(97 + i % 26)}{chr(97 + i // 26)}", at=0, seq=i,
            meta=json.dumps({f"k{i % 3}": i}), method="GET", path="/x/1") for i in range(300)]
SHORT = [log("short", "only line", at=1), log("bare", " ", at=2, duration=None)]


def texts(spark, entries, cfg=CFG):
    rows = flat_rows(logs_frame(spark, entries), AS_OF)
    traces = valid_traces(trace_features(rows, cfg))
    return traces, rows


@pytest.mark.parametrize("size", [1, 7, 100, 100_000])
def test_pieces_are_the_text(spark, size):
    traces, rows = texts(spark, LONG[: 300 if size > 1 else 5] + SHORT)
    whole = {r.correlation_id: r.semantic_text for r in D.semantic_text(traces, rows, CFG).collect()}
    pieces = D.text_pieces(traces, rows, CFG, size).collect()
    for cid, text in whole.items():
        own = sorted((r.piece, r.text, r.chars) for r in pieces if r.correlation_id == cid)
        assert [t for _, t, _ in own] == [text[i : i + size] for i in range(0, len(text), size)]
        assert [n for n, _, _ in own] == list(range(len(own))) and own[-1][2] == len(text)


def test_long_texts_stay_in_pieces(spark):
    cfg = EngineConfig(whole_text_chars=500)
    traces, rows = texts(spark, LONG + SHORT, cfg)
    whole = {r.correlation_id: r.semantic_text for r in D.semantic_text(traces, rows, cfg).collect()}
    assert "only line" in whole["short"] and "step" not in whole["long"] and whole["long"].startswith("GET ")
    pieces = D.text_pieces(traces, rows, cfg, 64)
    full = D.semantic_text(traces, rows, CFG).where("correlation_id = 'long'").first().semantic_text
    assert {r.correlation_id for r in D.whole_texts(pieces, 500).collect()} == {"short", "bare"}
    put = {r.correlation_id: r.semantic_text for r in D.whole_texts(pieces, len(full)).collect()}
    assert put["long"] == full and put["short"] == whole["short"]


# ---- models ----------------------------------------------------------------


def test_a_worker_loads_its_model_once(spark, tmp_path):
    """Texts come 64 at a time, and tasks of one worker share what the first one loaded."""
    note = str(tmp_path / "loads")

    def load():
        import os

        with open(note, "a") as out:
            out.write(f"{os.getpid()}\n")

        def encode(batch):
            assert 0 < len(batch) <= 64
            return [[float(len(t)), float(os.getpid())] for t in batch]

        return encode

    texts = spark.range(1000).repartition(8).select(F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("semantic_text"))
    rows = embed_documents(texts, EngineConfig(vector_size=2), load).collect()
    assert len(rows) == 1000 and all(r.embedding[0] == len(r.semantic_text) for r in rows)
    loads = open(note).read().split()
    assert len(loads) == len(set(loads)) == len({r.embedding[1] for r in rows}) <= 4


# ---- commits ---------------------------------------------------------------


def test_commits_count_as_of_the_trace(spark):
    entries = [log("before", "m", at=0), log("at", "m", at=60), log("soon", "m", at=3600), log("late", "m", at=3661),
               log("again", "m", at=9000), log("other", "m", at=9000, project="q")]
    commits = commits_frame(spark, ("p", BEGIN + 60), ("p", BEGIN + 8000), ("p", BEGIN + 10**6), ("r", BEGIN))
    features = valid_traces(trace_features(flat_rows(logs_frame(spark, entries), AS_OF), CFG))
    got = {r.correlation_id: (r.latest_commit and r.latest_commit - BEGIN, r.in_deploy)
           for r in G.deployed_traces(features, commits, CFG).collect()}
    assert got == {"before": (None, False), "at": (60, True), "soon": (60, True), "late": (60, False),
                   "again": (8000, True), "other": (None, False)}
    replayed = G.candidates(features, commits, AS_OF, EngineConfig(deploy_as_of_trace=True))
    assert {r.correlation_id for r in replayed.where("in_deploy").collect()} == {"at", "soon", "again"}
    now = G.candidates(features, commits, BEGIN + 10**6, CFG)
    assert {r.correlation_id for r in now.where("in_deploy").collect()} == {"before", "at", "soon", "late", "again"}


# ---- streams ---------------------------------------------------------------


def put(spark, entries, path):
    logs_frame(spark, entries).coalesce(1).write.mode("append").parquet(path)


def test_sessions_end_at_pauses_and_wait_for_late_rows(spark, tmp_path):
    incoming, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, [log("a", "m", at=0), log("a", "boom", "error", at=500), log("a", "m", at=3000), log("b", "m", at=4000)], incoming)
    put(spark, [log("a", "late", at=900), log("b", "m", at=90_000)], incoming)
    # Rows are dropped by the watermark of the batch before the last one.
    put(spark, [log("b", "m", at=190_000)], incoming)
    put(spark, [log("a", "too late", at=700), log("b", "m", at=290_000)], incoming)
    run_sessions(L.stream_logs(spark, incoming, max_files=1), out, "10 minutes", "2 hours").awaitTermination()
    found = spark.read.parquet(f"{out}/sessions").collect()
    seconds = lambda t: int((t.replace(tzinfo=None) - START).total_seconds())
    assert sorted((r.correlationId, seconds(r.start), seconds(r.end), r.log_count, r.errors) for r in found) == [
        ("a", 0, 1500, 3, 1), ("a", 3000, 3600, 1, 0), ("b", 4000, 4600, 1, 0), ("b", 90_000, 90_600, 1, 0),
        ("b", 190_000, 190_600, 1, 0)]


def nested(cid, **changes):
    entry = {"timestamp": "2024-01-05T10:00:00Z", "level": "info", "message": "hello", "loggername": "orders"}
    return {"projectName": "p", "project_id": "p", "environment": "", "correlationId": cid, "component": "c",
            "startedAt": "2024-01-05T10:00:00Z", "logs": [entry | changes]}


def test_a_broken_line_costs_itself_alone(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    lines = [json.dumps(nested("a")), '{"correlationId": "cut', json.dumps(nested("b", level="odd")), "[1, 2]", json.dumps(nested("c"))]
    (incoming / "1.json").write_text("\n".join(lines) + "\n")
    store = NestedStore(spark, str(tmp_path / "store"))

    def drain():
        run_nested(stream_raw_traces(spark, str(incoming), max_files=1), store, lambda batch_id: AS_OF).awaitTermination()

    drain()
    (incoming / "2.json").write_text(json.dumps(nested("a", message="again")) + "\n")
    drain()
    documents = by_cid(store.documents())
    assert set(documents) == {"a", "c"} and "again" in documents["a"].semantic_text
    rejected = {(r.correlation_id, r.record) for r in store.rejected().collect() if r.error == "invalid_json"}
    assert (None, '{"correlationId": "cut') in rejected
    assert [r.error for r in store.rejected().where("correlation_id = 'b'").collect()] == ["invalid_level"]


def test_projects_that_share_an_id(spark, tmp_path):
    incoming = str(tmp_path / "in")
    put(spark, [log("x", "boom", "error", project="p"), log("x", "bang", "error", project="q"), log(None, "m", at=5)], incoming)
    put(spark, [log("x", "boom again", at=9, project="p", seq=9)], incoming)

    def documents(cfg, name):
        store = TraceStore(spark, str(tmp_path / name))
        run_stream(L.stream_logs(spark, incoming, max_files=1), store, lambda: commits_frame(spark), cfg,
                   as_of=lambda batch_id: AS_OF).awaitTermination()
        return sorted((r.project_id, r.correlation_id, r.log_count) for r in store.documents().collect())

    assert documents(EngineConfig(group_by_project=True), "apart") == [("p", "p/x", 2), ("q", "q/x", 1)]
    assert documents(CFG, "together") == [("p", "x", 3)]


def test_batch_without_rows(spark):
    assert batch(spark, []).new_documents.count() == 0
    assert S.DOCUMENTS.names[0] == "project_id"
