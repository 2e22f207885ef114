"""Slices, quarantine and the streaming job."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import AS_OF, START, batch, by_cid, commits_frame, log, logs_frame
from tracemill import schemas as S
from tracemill.config import EngineConfig
from tracemill.operators import gate as G
from tracemill.operators import quarantine as Q
from tracemill.sources import logs as L
from tracemill.session import delete_folder
from tracemill.streaming.history import JSON, arrived, stored_rows
from tracemill.streaming.ingest import BatchHalted, process_batch, run_stream
from tracemill.streaming.store import TraceStore

CFG = EngineConfig()


def seqs(df):
    return sorted(r.rowSeq for r in df.collect())


def test_slice_and_trim(spark):
    entries = [log(c, "m", at=i, seq=i) for i, c in enumerate("abacc")]
    table = logs_frame(spark, entries)
    four = L.batch_slice(table, 4)
    assert seqs(four) == [0, 1, 2, 3]
    assert seqs(L.trim_split_tail(four, 4)) == [0, 1, 2]
    assert seqs(L.trim_split_tail(four, 5)) == [0, 1, 2, 3]
    one = logs_frame(spark, [log("a", "m", at=i, seq=i) for i in range(3)])
    assert seqs(L.trim_split_tail(one, 3)) == [0, 1, 2]


def test_marks(spark):
    table = logs_frame(spark, [log(c, "m", at=i, seq=i) for i, c in enumerate("abac")])
    failed = spark.createDataFrame([("b",)], "correlationId string")
    nothing = failed.where("false")
    start = "1970-01-01 00:00:00.000"
    assert L.high_water_mark(table, start).first().mark == START + timedelta(seconds=3)
    assert L.high_water_mark(table.where("false"), start).first().mark.year == 1970
    assert L.safe_high_water_mark(table, start, failed).first().mark == START
    assert L.safe_high_water_mark(table, start, nothing).first().mark == START + timedelta(seconds=3)
    first = spark.createDataFrame([("a",)], "correlationId string")
    assert L.safe_high_water_mark(table, start, first).first().mark.year == 1970


def test_incremental_bounds(spark):
    table = logs_frame(spark, [log("a", "m", at=i, seq=i) for i in range(5)])
    got = L.incremental_filter(table, "2024-01-05 10:00:01", "2024-01-05 10:00:03.000")
    assert seqs(got) == [2, 3]


def test_poison_after_three_failures(spark):
    records = spark.createDataFrame([], S.FAILURES)
    quarantine = spark.createDataFrame([], S.QUARANTINE)
    failed = spark.createDataFrame([("c", "invalid_level")], "correlation_id string, error string")
    became = []
    for step in range(4):
        records = Q.failures(failed, AS_OF + step)
        entries = Q.record_failures(quarantine, records, CFG)
        row = entries.first()
        became.append(row.became_poison)
        quarantine = spark.createDataFrame(entries.drop("became_poison").collect(), S.QUARANTINE)
    assert became == [False, False, True, False]
    assert quarantine.first()["count"] == 4
    outcome = batch(spark, [log("c", "m", "bogus"), log("d", "m", "error")],
                    quarantine=quarantine.collect())
    m = outcome.metrics.first()
    assert (m.promoted, m.dropped, m.failed, m.total) == (1, 0, 0, 2)
    assert Q.clear(quarantine, failed).count() == 0


# ---- streaming state -------------------------------------------------------

ENTRIES = [
    log("a", "Order 1 shipped", at=0, path="/orders/1", method="GET"),
    log("b", "boom 1", "error", at=10, path="/orders/2", method="GET"),
    log("c", "Order 3 shipped", at=20, path="/orders/3", method="GET"),
    log("d", "bogus level", "trace", at=30),
    log("e", "boom 2", "error", at=40, path="/orders/5", method="GET"),
    log("f", "retry 9", at=50),
    log("g", "idle", at=60),
]


def as_sets(df):
    return {(r.correlation_id, r.fingerprint, r.log_count, r.occurrence_count, r.last_seen,
             r.semantic_text) for r in df.collect()}


def store_of(spark, tmp_path, *batches):
    """The store after one micro-batch per entry list, from one start."""
    incoming, store = str(tmp_path / "in"), TraceStore(spark, str(tmp_path / "state"))
    for entries in batches:
        logs_frame(spark, entries).coalesce(1).write.mode("append").parquet(incoming)
    drain(spark, store, incoming)
    return store


def drain(spark, store, incoming, as_of=AS_OF, commits=()):
    stream = L.stream_logs(spark, incoming, max_files=1)
    run_stream(stream, store, lambda: commits_frame(spark, *commits), CFG,
               as_of=lambda batch_id: as_of).awaitTermination()


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    whole = as_sets(batch(spark, ENTRIES).documents)
    incoming = str(tmp_path / "in")
    store = TraceStore(spark, str(tmp_path / "state"))

    for part in (ENTRIES[:3], ENTRIES[3:5], ENTRIES[5:]):
        logs_frame(spark, part).coalesce(1).write.mode("append").parquet(incoming)
        drain(spark, store, incoming)
    drain(spark, store, incoming)
    assert as_sets(store.documents()) == whole
    assert sorted(r.batch_id for r in store.committed().collect()) == [0, 1, 2]


def test_split_trace_becomes_one_document(spark, tmp_path):
    split = [log("b", "boom again", at=100, seq=100), log("h", "boom 7", "error", at=110)]
    store = store_of(spark, tmp_path, ENTRIES, split)
    documents = by_cid(store.documents())
    assert documents["b"].log_count == 2 and documents["b"].occurrence_count == 2
    assert "e" not in documents and "h" not in documents


def test_replay_keeps_the_time_of_the_first_attempt(spark, tmp_path):
    """A clock that moves on must not move what a replayed batch wrote."""
    store = store_of(spark, tmp_path, ENTRIES)
    again = ENTRIES + [log("e2", "boom 9", "error", at=45, path="/orders/9", method="GET", seq=45)]
    for now in (AS_OF, AS_OF + 7200, AS_OF + 90000):
        process_batch(store, logs_frame(spark, again), 1, commits_frame(spark, ("p", AS_OF)), now, CFG)
        seen = as_sets(store.documents())
        assert seen == locals().get("first", seen)
        first = seen
    assert store.batch("started", 1).first().as_of == AS_OF


def test_nothing_staged_is_left(spark, tmp_path):
    import os

    from tracemill.session import shared_dir

    folder = f"{shared_dir(spark)}/staged"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    store_of(spark, tmp_path, ENTRIES, ENTRIES[:2])
    assert set(os.listdir(folder)) <= before


def test_refetch_keeps_repeated_lines(spark):
    """Three equal heartbeats at different times, the last one in the batch; then at one time."""
    beats = [log("a", "heartbeat ok", at=i) for i in (0, 60, 120)] + [log("b", "heartbeat ok", at=60, seq=i) for i in (1, 2, 3)]
    table = logs_frame(spark, beats).drop("rowSeq")
    last = table.where("timestamp >= '2024-01-05 10:02:00'").unionByName(table.where("correlationId = 'b'").limit(1))
    rows = L.refetch_partial_traces(last, table)
    counted = rows.groupBy("correlationId").agg(F.count("*").alias("n"), F.count_if("in_batch").alias("own")).collect()
    assert {(r.correlationId, r.n, r.own) for r in counted} == {("a", 3, 1), ("b", 3, 1)}


def test_replay_changes_nothing(spark, tmp_path):
    """A batch that ran but was not recorded runs again on the state of the batch before it."""
    late = [log("b", "boom again", at=100, seq=100), log("a", "Order 8 shipped", at=105, seq=105)]
    store = store_of(spark, tmp_path, ENTRIES, late)
    before = as_sets(store.documents())
    delete_folder(spark, f"{store.checkpoint}/commits/1")
    drain(spark, store, str(tmp_path / "in"), as_of=AS_OF + 7200)
    assert as_sets(store.documents()) == before
    counts = {r.correlationId: r.n for r in stored_rows(spark, store.checkpoint).collect()}
    assert counts == {c: 2 if c in "ab" else 1 for c in "abcdefg"}


def test_a_batch_reads_the_histories_it_touches_alone(spark, tmp_path, monkeypatch):
    """No plan of a micro-batch reads rows or counts of earlier batches; all rows come from the state."""
    import tracemill.streaming.ingest as ingest

    plans, judge = [], ingest.run_batch

    def noted(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return judge(rows, *args, **options)

    monkeypatch.setattr(ingest, "run_batch", noted)
    store = store_of(spark, tmp_path, ENTRIES, [log("b", "boom again", at=100, seq=100)])
    assert len(plans) == 2 and all("/seen" not in p and p.count("FileScan parquet") == 1 for p in plans)
    assert by_cid(store.documents())["b"].log_count == 2
    assert not (tmp_path / "state" / "archive").exists()


def test_a_batch_reads_few_columns_of_the_stored_documents(spark, tmp_path):
    """The gate's lookups carry keys, not texts or vectors, and do not deal out the documents."""
    store = store_of(spark, tmp_path, ENTRIES)
    found = store.live_documents(before=1).select(*S.DOCUMENTS.names)
    keys = spark.range(1).select(F.lit("p").alias("project_id"), F.lit("f").alias("fingerprint"))
    text = G.stored_fingerprints(found.join(keys, list(keys.columns), "left_semi"))._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in text.splitlines() if "FileScan" in line and "fingerprint" in line]
    assert reads and "semantic_text" not in text and "embedding" not in text
    assert "BroadcastHashJoin" in text and "batch_id" in reads[0]


def test_state_keeps_every_field(spark):
    """Rows come out of the packed form as they went in: microseconds, nulls, odd text."""
    from datetime import datetime

    entries = [log("a", 'é "quoted" \\ \n\t \u2028', at=0, meta='{"k": [1]}', timestamp=datetime(2024, 1, 5, 1, 2, 3, 456789)),
               log("a", None, level=None, logger=None, timestamp=None, status=404, duration=2**40)]
    rows = arrived(logs_frame(spark, entries))
    packed = rows.select(F.to_json(F.struct(*S.LOGS.names), JSON).alias("row"))
    again = packed.select(F.from_json("row", S.LOGS, JSON).alias("row")).select("row.*")
    assert sorted(again.collect(), key=str) == sorted(rows.collect(), key=str)


def test_long_histories_are_appended_in_parts(spark, tmp_path, monkeypatch):
    import tracemill.streaming.history as history

    monkeypatch.setattr(history, "APPENDED", 2)
    store = store_of(spark, tmp_path, [log("a", f"step {i}", at=i, seq=i) for i in range(5)],
                     [log("a", "boom", "error", at=9, seq=9)])
    assert {r.correlationId: r.n for r in stored_rows(spark, store.checkpoint).collect()} == {"a": 6}
    assert by_cid(store.documents())["a"].log_count == 6


def test_metrics_are_observed(spark):
    """Counts come from the passes that wrote the tables, also where there is nothing to count."""
    outcome = batch(spark, ENTRIES)
    runs = []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("metrics", "metrics")
    try:
        counts = outcome.counts
        runs = tracker.getJobIdsForGroup("metrics")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == {"promoted": 3, "dropped": 3, "failed": 1, "total": 7, "tripped": False} and not runs
    nothing = batch(spark, []).counts
    assert nothing == {"promoted": 0, "dropped": 0, "failed": 0, "total": 0, "tripped": False}


def test_bad_batch_halts_until_its_traces_are_skipped(spark, tmp_path):
    bad = [log(f"x{i}", "m", "bogus", at=i) for i in range(3)] + [log("ok", "bad", "error", at=9)]
    store = TraceStore(spark, str(tmp_path)).create()

    def attempt():
        process_batch(store, logs_frame(spark, bad), 0, commits_frame(spark), AS_OF, CFG)

    for _ in range(3):
        with pytest.raises(BatchHalted):
            attempt()
    assert store.committed().count() == 0
    attempt()
    assert set(by_cid(store.documents())) == {"ok"}
    assert store.committed().first().total == 4


def test_failed_merge_keeps_the_old_document(spark, tmp_path):
    store = store_of(spark, tmp_path, [log("b", "boom", "error")], [log("b", "x", "bogus", at=5)])
    assert by_cid(store.documents())["b"].log_count == 1


def test_rows_without_order_column(spark, tmp_path):
    table = logs_frame(spark, [log("a", "boom", "error"), log("a", "bang", "error")]).drop("rowSeq")
    store = TraceStore(spark, str(tmp_path)).create()
    process_batch(store, table, 0, commits_frame(spark), AS_OF, CFG)
    assert by_cid(store.documents())["a"].log_count == 2
    assert arrived(table).where("rowSeq is null").count() == 0
