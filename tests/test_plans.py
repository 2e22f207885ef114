"""What the physical plans may and may not contain."""

import re

import pytest
from pyspark.sql import functions as F

from catalog import fixtures
from catalog import queries as Q
from tests.helpers import AS_OF, document, documents_frame
from tracemill.config import EngineConfig
from tracemill.operators import buckets as B
from tracemill.operators import documents as D
from tracemill.operators import gate as G
from tracemill.operators.rows import flat_rows
from tracemill.operators.traces import chronological_logs, level_features, trace_features
from tracemill.plans.batch import run_batch
from tracemill.sources.logs import incremental_filter

CFG = EngineConfig()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Every plan that a batch writes or returns."""
    from tracemill.session import staged

    plans = {}

    def stage(df, label):
        plans[label] = plan(df)
        return staged(df, label)

    outcome = run_batch(
        Q.rows(spark, sf), Q.stored_documents(spark, sf), fixtures.commits(spark, sf),
        Q.S.empty_table(spark, Q.S.QUARANTINE), AS_OF, CFG, stage=stage,
    )
    for name in ("new_documents", "documents", "metrics", "repeats", "verdicts", "quarantine"):
        plans[name] = plan(getattr(outcome, name))
    return plans


def test_no_python_and_no_unbounded_joins(stages):
    for name, text in stages.items():
        assert "EvalPython" not in text and "InPandas" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        assert "CollectLimit" not in text, name


def test_filters_and_columns_reach_the_scan(spark, sf):
    table = fixtures.LOGS_SQL
    spark.read.parquet(f"{sf}/events.parquet").createOrReplaceTempView("events")
    text = plan(
        incremental_filter(spark.sql(table), "2024-01-10 00:00:00", "2024-01-12 00:00:00")
        .select("correlationId", "timestamp")
    )
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThan(ts" in pushed and "LessThanOrEqual(ts" in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_levels_read_no_text(spark, sf):
    text = plan(level_features(Q.rows(spark, sf)))
    assert "parseJson" not in text and "AS message" not in text and "partial_max" in text


def test_traces_are_combined_before_each_shuffle(spark, sf):
    text = plan(trace_features(Q.rows(spark, sf), CFG))
    # Two levels of aggregation, each with a partial step below its exchange: by
    # facet, so that no list holds combinations of them, then by trace.
    assert text.count("partial_bit_or(") == 4
    assert re.search(r"Exchange hashpartitioning\(correlation_id#\d+, kind#\d+, value#", text)
    assert len(re.findall(r"Exchange hashpartitioning\(correlation_id", text)) == 2
    assert "Exchange hashpartitioning(correlation_id#" in text and "SinglePartition" not in text


LAZY = (
    "incremental_filter", "fetch_cid", "bulk_count_cids", "validate_trace", "resolve_service", "chronological_logs",
    "enrich_trace", "error_types", "detect_suspicious_keywords", "semantic_text", "vector_metadata", "meta_context",
    "dedup_messages", "trim_split_tail", "refetch_partial_traces", "gatekeeper_without_store", "parse_meta",
)


@pytest.mark.parametrize("name", LAZY)
def test_registered_queries_do_not_deal_the_table_out_again(spark, sf, name):
    assert "RoundRobin" not in plan(Q.registered()[name](spark, sf))


def test_one_project_is_read_by_its_partition(spark, sf, tmp_path):
    path = D.write_documents(Q.whole(spark, sf).documents, str(tmp_path / "store"))
    text = plan(D.read_documents(spark, path, project="proj-1"))
    assert re.search(r"PartitionFilters: \[[^\]]*proj-1", text)


def test_positions_are_ranked_per_range(spark, sf):
    text = plan(chronological_logs(Q.rows(spark, sf)))
    assert re.search(r"Window \[.*sum\(position#.*correlation_id#\d+, span#", text)
    assert "BroadcastExchange" in text and "CartesianProduct" not in text


def test_a_bucketed_store_is_not_dealt_out(spark, sf, tmp_path):
    documents = documents_frame(spark, *[document("p", f"c{i}", f"f{i}") for i in range(50)])
    path, threshold = str(tmp_path / "buckets"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    B.write_buckets(documents.where("correlation_id < 'c3'"), "bucketed_store", path, 8)
    B.write_buckets(documents.where("correlation_id >= 'c3'"), "bucketed_store", path, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = G.stored_fingerprints(B.open_buckets(spark, "bucketed_store", path, 8))
        # A constant project would leave the join with the fingerprint alone.
        keys = spark.range(100).select(F.substring(F.concat(F.lit("p"), "id"), 1, 1).alias("project_id"), F.concat(F.lit("f"), "id").alias("fingerprint"))
        found = keys.join(stored, ["project_id", "fingerprint"])
        text = plan(found)
        assert "Bucketed: true" in text and text.count("Exchange") == 1
        assert "Exchange" not in text.split("Range (")[1]
        assert {r.keeper for r in found.collect()} == {f"c{i}" for i in range(50)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE bucketed_store")
