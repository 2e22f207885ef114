"""What keeps steps in proportion to larger tables."""

from pyspark.sql import functions as F

from tests.helpers import log, logs_frame
from tests.test_plans import plan
from tracemill.sources import logs as L


def test_refetch_sorts_rows_for_one_join(spark):
    """A task has the sorters of one join of rows, whatever the tables' sizes; both tables meet in one aggregate."""
    table = logs_frame(spark, [log(c, f"m {i}", at=i, seq=i) for i, c in enumerate("abcabd")] + [log(None, "m", at=9, seq=9)] * 2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = L.refetch_partial_traces(table.where("rowSeq > 3"), table)
        assert plan(found).count("SortMergeJoin") <= 2
        rows = found.groupBy("correlationId").agg(F.count("*").alias("n"), F.count_if("in_batch").alias("own")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {(r.correlationId, r.n, r.own) for r in rows} == {("b", 2, 1), ("d", 1, 1), (None, 2, 2)}


def test_histories_are_kept_without_a_call_for_each_trace(spark, tmp_path):
    """The state is read and written inside Spark; a Python worker answered several calls a trace."""
    from tracemill.streaming.history import with_history

    logs_frame(spark, [log("a", "m")]).write.parquet(str(tmp_path / "in"))
    found = with_history(L.stream_logs(spark, str(tmp_path / "in")))
    text = found._jdf.queryExecution().analyzed().toString()
    assert "Python" not in text and "Aggregate" in text


def test_large_parts_are_many_files(spark, sf, monkeypatch):
    """One task wrote each part of the incoming folder, whatever its size."""
    from pathlib import Path

    from catalog import queries as Q

    table = Q.logs(spark, sf)
    early = table.where(Q.is_early()).count()
    monkeypatch.setattr(Q, "FILE_ROWS", 100)
    path, files = Q.log_files(table, Q.is_early(), ~Q.is_early())
    assert files > 1
    for part, n in ((0, early), (1, table.count() - early)):
        folder = f"{path}/part={part}".removeprefix("file:")
        assert len(list(Path(folder).glob("*.parquet"))) == files
        assert spark.read.parquet(folder).count() == n


def test_pieces_read_the_traces_once(spark, sf):
    """Features of traces are worked out once for the two places that need them."""
    from catalog import queries as Q
    from tracemill.operators import documents as D
    from tracemill.session import staged

    labels = []

    def stage(df, label):
        labels.append((label, plan(df).count("partial_bit_or(")))
        return staged(df, label)

    D.text_pieces(Q.valid(spark, sf), Q.rows(spark, sf), Q.CFG, 100, stage)
    assert [label for label, _ in labels] == ["traces", "ranges"] and labels[1][1] == 0


def test_states_hold_rows_and_not_text(spark, tmp_path):
    """Every row of a touched trace was written as JSON and read back, its earlier rows with each batch."""
    from tracemill.streaming.history import with_history

    logs_frame(spark, [log("a", "m")]).write.parquet(str(tmp_path / "in"))
    found = with_history(L.stream_logs(spark, str(tmp_path / "in")))
    text = found._jdf.queryExecution().analyzed().toString()
    assert "to_json" not in text and "from_json" not in text


def test_partial_traces_are_counted_without_a_join(spark):
    """Every row of the table went through the driver, or was shuffled and sorted for a join."""
    table = logs_frame(spark, [log(c, f"m {i}", at=i, seq=i) for i, c in enumerate("abcabd")] + [log(None, "m", at=9, seq=9)] * 2)
    batch = table.where("rowSeq > 3").unionByName(logs_frame(spark, [log("new", "m", at=5, seq=20)]))
    found = L.partial_traces(batch, table)
    text = plan(found)
    assert "Join" not in text and "BroadcastExchange" not in text and text.count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in found.select("correlationId", "n", "total").collect()] == [("b", 1, 2)]


ODD_ROWS = [
    log("a", "TimeoutError: upstream 10.0.0.1 silent", "error", at=3), log("a", "Retrying, FALLBACK used", "warning", at=2, logger=""),
    log("a", "oom: retry", at=2, seq=9), log("a", "oom: retry", at=2, seq=9), log("a", "x", "debug", at=2, seq=1, logger="b"),
    log("b", None, at=1), log("b", "panic", "bogus", at=2, logger=None), log("c", "User did", None, at=5, meta="[1]"),
    log("d", "calm", at=5, meta='{"error_type": "Disk"}', status=503, path="/users/7", method="GET"),
    log("d", "CrashFailure", "critical", timestamp=None, seq=3), log("e", ": blank", at=1), log("e", "Straße ΟΔΟΣ", at=4, meta="not json"),
    log(None, "deadlock", at=1), log("f", "no project", at=1, project=None), log("f", "12:30 tick", at=1, seq=0, exception="[2]"),
    log("g", "wait", at=7, meta="NaN"), log("g", "bad\x01level", "trace", at=8), log("g", "fine", "warn", at=9),
]


def packed_table(spark, entries):
    """Rows as the streaming job hands them on, every other one from an earlier batch."""
    from tracemill import schemas as S
    from tracemill.operators.rows import packed_rows
    from tests.helpers import AS_OF

    at = F.timestamp_seconds(F.when(F.col("rowSeq") % 2 == 0, 100).otherwise(50))
    item = F.struct(at.alias("at"), F.struct(*S.LOGS.names).alias("row"))
    lists = logs_frame(spark, entries).groupBy("correlationId").agg(F.collect_list(item).alias("items"), F.count("*").alias("n"))
    return packed_rows(lists.withColumn("batch_at", F.timestamp_seconds(F.lit(100))), AS_OF)


def test_packed_traces_have_the_features_of_their_rows(spark, monkeypatch):
    from tracemill.config import EngineConfig
    from tracemill.operators import traces as O
    from tracemill.operators.rows import unpacked

    packed = packed_table(spark, ODD_ROWS)
    expected = sorted(map(str, O.trace_features(unpacked(packed), EngineConfig()).collect()))
    assert len(expected) == 8
    for longest in (10_000, 2, 0):
        monkeypatch.setattr(O, "LONG_TRACE", longest)
        assert sorted(map(str, O.trace_features(packed, EngineConfig()).collect())) == expected


def test_packed_traces_are_folded_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Rows of a trace came out of the state together, and were dealt out and sorted twice to be together again."""
    import tracemill.streaming.ingest as ingest
    from tests.test_state import ENTRIES, store_of
    from tracemill.config import EngineConfig
    from tracemill.operators.rows import is_packed
    from tracemill.operators.traces import folded_lists

    given, judge = [], ingest.run_batch

    def noted(rows, *args, **options):
        text = plan(folded_lists(rows, EngineConfig()))
        given.append(is_packed(rows) and "Exchange" not in text and "Sort " not in text)
        return judge(rows, *args, **options)

    monkeypatch.setattr(ingest, "run_batch", noted)
    store_of(spark, tmp_path, ENTRIES, ENTRIES[:2])
    assert given == [True, True]
