"""Document text."""

import hashlib
from dataclasses import replace

from tests.helpers import AS_OF, batch, by_cid, log, logs_frame
from tracemill.config import EngineConfig
from tracemill.operators import documents as D
from tracemill.operators.embed import embed_documents
from tracemill.operators.rows import flat_rows
from tracemill.operators.traces import trace_features, valid_traces
from tracemill.plans.batch import prepare_documents

CFG = EngineConfig()


def texts(spark, entries, cfg=CFG):
    rows = flat_rows(logs_frame(spark, entries), AS_OF)
    traces = valid_traces(trace_features(rows, cfg))
    return {c: r.semantic_text for c, r in by_cid(D.semantic_text(traces, rows, cfg)).items()}


def test_meta_values(spark):
    meta = """{"s": "text", "i": 7, "b": true, "n": null, "o": {"x": 1}, "f": 1.5,
      "l": ["a", 1, true, null], "long": [1,2,3,4,5,6], "q": ["it's"], "Level": "x",
      "correlationId": "kept", "correlation_id": "skipped", "empty": []}"""
    got = texts(spark, [log("c", "m", meta=meta)])["c"]
    assert got == (
        "Context: s=text; i=7; b=True; f=1.5; l=['a', 1, True, None]; long=[1, 2, 3, 4, 5, 6]; "
        "q=[\"it's\"]; correlationId=kept; empty=[]. Service: orders. m. Outcome: success"
    )
    short = texts(spark, [log("c", "m", meta=meta)], replace(CFG, max_listed_values=5))["c"]
    assert short == got.replace("long=[1, 2, 3, 4, 5, 6]; ", "")


def test_first_usable_value_claims_the_key(spark):
    got = texts(spark, [log("c", "m", meta='{"k": {"x": 1}, "a": 1}'),
                        log("c", "m", meta='{"k": "v", "a": 2}', at=1)])["c"]
    assert got.startswith("Context: a=1; k=v. ")


def test_messages_are_deduplicated_by_form(spark):
    got = texts(spark, [log("c", " User 1 in "), log("c", "user 2 IN", at=1), log("c", "  ", at=2),
                        log("c", "User out", at=3)])["c"]
    assert got == "Service: orders. User 1 in. User out. Outcome: success"


def test_operation_and_outcome(spark):
    got = texts(spark, [
        log("a", "m", method="GET", path="/x/9", status=404, duration=12),
        log("b", "m", method="GET"), log("c", "m", duration=3), log("d", "m", path="/x"),
    ])
    assert got["a"] == "GET /x/{id}. Service: orders. m. Outcome: client error, 404, 12ms"
    assert got["b"] == "GET. Service: orders. m. Outcome: success"
    assert got["c"] == "Trace executed. Service: orders. m. Outcome: success, 3ms"
    assert got["d"] == "Service: orders. m. Outcome: success"


def test_level_tags_are_optional(spark):
    entries = [log("c", "slow", "warning"), log("c", "ok", at=1), log("c", "bad", "critical", at=2)]
    assert "slow. ok. bad" in texts(spark, entries)["c"]
    tagged = texts(spark, entries, replace(CFG, tag_levels=True))["c"]
    assert "[WARN] slow. ok. [FATAL] bad" in tagged


def test_long_text_is_whole_unless_a_budget_is_set(spark):
    budget = replace(CFG, max_semantic_chars=2000)
    got = texts(spark, [log("c", "é" * 3000)])["c"]
    assert got == "Service: orders. " + "é" * 3000 + ". Outcome: success"
    assert texts(spark, [log("c", "é" * 3000)], budget)["c"] == got[:2000] + "..."
    exact = texts(spark, [log("c", "x" * (2000 - 17 - len(". Outcome: success")))], budget)["c"]
    assert len(exact) == 2000 and not exact.endswith("...")


def test_budget_cuts_the_whole_text(spark):
    """A plain join is the yardstick, with lines of one letter and of uneven lengths."""
    lines = [chr(0x4E00 + i) * (1 + i % 7 * (i % 3)) for i in range(900)]
    entries = [log("c", line, at=i) for i, line in enumerate(lines)]
    plain = ". ".join(["Service: orders", *lines, "Outcome: success"])
    assert texts(spark, entries)["c"] == plain
    for budget in (10, 500, 2000):
        cut = replace(CFG, max_semantic_chars=budget)
        assert texts(spark, entries, cut)["c"] == plain[:budget] + "..."


def test_prefix_length_is_a_parameter(spark):
    rows = flat_rows(logs_frame(spark, [log("c", "x" * 60 + ": failed")]), AS_OF)
    assert by_cid(trace_features(rows, CFG))["c"].error_types == []
    wide = replace(CFG, error_prefix_chars=80)
    assert by_cid(trace_features(rows, wide))["c"].error_types == ["x" * 60]


def test_prepare_only_mode_has_no_gate(spark):
    rows = flat_rows(logs_frame(spark, [log("c", "sweep", "debug"), log("d", "x", "bogus"),
                                        log("e", "access denied")]), AS_OF)
    got = by_cid(prepare_documents(rows))
    assert set(got) == {"c", "e"} and got["e"].suspicious_keywords is None


def test_plugged_in_encoder(spark):
    def load():
        return lambda texts: [[float(len(t))] * 4 for t in texts]

    cfg = replace(CFG, vector_size=4)
    outcome = batch(spark, [log("c", "boom", "error")], cfg=cfg, load_encoder=load)
    row = outcome.new_documents.first()
    assert row.embedding == [float(len(row.semantic_text))] * 4


def test_vector_of_wrong_size_fails(spark):
    outcome = batch(spark, [log("c", "boom", "error")],
                    load_encoder=lambda: lambda texts: [[1.0]] * len(texts))
    try:
        outcome.new_documents.collect()
    except Exception as error:
        assert "vector of 1 values, not 384" in str(error)
    else:
        raise AssertionError("wrong size accepted")


def test_default_embedding_holds_hashed_term_counts(spark):
    lines = ["GET /x. Service: a a", "a service: GET /x. A", "GET /y. Service: a", "  ", ""]
    df = spark.createDataFrame([(t,) for t in lines], "semantic_text string")
    got = [r.embedding for r in embed_documents(df, CFG).collect()]
    for text, vector in zip(lines, got):
        counts = [0] * CFG.vector_size
        for word in text.lower().split():
            counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % CFG.vector_size] += 1
        length = sum(c * c for c in counts) ** 0.5 or 1
        assert all(abs(v - c / length) < 1e-6 for v, c in zip(vector, counts))
    assert got[0] != got[2]
