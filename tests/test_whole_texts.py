"""Documents hold every line of their trace, however long they are together."""

import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from catalog import queries as Q
from tests.helpers import AS_OF, log, logs_frame
from tests.test_features import nested
from tracemill.config import EngineConfig
from tracemill.operators import documents as D
from tracemill.operators.rows import flat_rows
from tracemill.operators.traces import trace_features, valid_traces
from tracemill.streaming.nested import NestedStore, run_nested, stream_raw_traces


def test_long_lines_are_in_the_text(spark):
    """Lines of more than 16,777,216 characters together were left out, all of them."""
    size, cfg = 6_000_000, EngineConfig()
    rows = flat_rows(logs_frame(spark, [log("c", k, at=i) for i, k in enumerate("abc")]), AS_OF)
    rows = rows.withColumn("message", F.concat("message", F.repeat(F.lit("z"), size))).withColumn("lowered", F.col("message"))
    text = D.semantic_text(valid_traces(trace_features(rows, cfg)), rows, cfg).first().semantic_text
    assert text == f"Service: orders. {'. '.join(k + 'z' * size for k in 'abc')}. Outcome: success"


def events(spark, path):
    """One trace with a row before the cut of two micro-batches and one after it, and a row for each third of the month."""
    ts = [datetime(2024, 1, 16, 11), datetime(2024, 1, 16, 13), datetime(2024, 1, 2), datetime(2024, 1, 30)]
    rows = [(5, ts[0], 1, "error", 1.0, '{"k": 9, "a": "first entry"}'), (10, ts[1], 1, "error", 2.0, '{"k": 9, "b": "second entry"}'),
            (15, ts[2], 2, "error", 3.0, '{"k": 10}'), (20, ts[3], 3, "error", 4.0, '{"k": 11}')]
    table = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    table.write.parquet(f"{path}/events.parquet")


@pytest.mark.parametrize("name", ["idempotent_replay", "late_rows", "merge_on_duplicate", "stream_ingest"])
def test_streamed_documents_are_whole(spark, tmp_path, monkeypatch, name):
    """A trace with more characters of lines than a limit lost them, and nothing else held them."""
    events(spark, str(tmp_path))
    monkeypatch.setattr(Q, "STREAM_CFG", replace(Q.STREAM_CFG, whole_text_chars=10))
    texts = {r.correlation_id: r.semantic_text for r in Q.registered()[name](spark, str(tmp_path)).collect()}
    assert texts["cid-1-2024-01-16"] == (
        "POST /orders/{id}. Context: k=9; a=first entry; b=second entry. Flow: auth → orders. "
        "TimeoutError: upstream 10.0.0.9:8080 silent for 5 ms at 0x1009. Outcome: failure, 404, 10ms"
    )
    assert len(texts) == 3 and all("TimeoutError" in text for text in texts.values())


def test_nested_documents_are_whole(spark, tmp_path):
    incoming, store = tmp_path / "in", NestedStore(spark, str(tmp_path / "store"))
    incoming.mkdir()
    (incoming / "1.json").write_text(json.dumps(nested("a", message="a message of its own")) + "\n")
    cfg = replace(EngineConfig.standalone(), whole_text_chars=10)
    run_nested(stream_raw_traces(spark, str(incoming)), store, lambda batch_id: AS_OF, cfg).awaitTermination()
    assert [r.semantic_text for r in store.documents().collect()] == ["Service: orders. a message of its own. Outcome: success"]
