"""The set form of the gate against a plain one-by-one evaluation.

Every project is an independent random history, so one Spark job covers many.
"""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from tests.helpers import AS_OF, commits_frame, document, documents_frame
from tracemill.config import EngineConfig
from tracemill.operators import documents as D
from tracemill.operators import gate as G

FEATURES = T.StructType([
    T.StructField("project_id", T.StringType()), T.StructField("correlation_id", T.StringType()),
    T.StructField("entered_at", T.TimestampType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("request_path_pattern", T.StringType()), T.StructField("outcome", T.StringType()),
    T.StructField("severity_score", T.IntegerType()), T.StructField("has_errors", T.BooleanType()),
    T.StructField("error_types", T.ArrayType(T.StringType())),
    T.StructField("suspicious_keywords", T.ArrayType(T.StringType())),
    T.StructField("is_merge", T.BooleanType()),
])
START = datetime(2024, 1, 5)


def random_project(rng, project):
    fingerprints = [f"f{i}" for i in range(rng.randint(1, 6))]
    paths = [None, "/a", "/b"]
    stored = [
        (f"{project}-s{i}", rng.choice(fingerprints), rng.choice(paths), rng.randint(1, 4),
         START - timedelta(days=1, seconds=-i))
        for i in range(rng.randint(0, 6))
    ]
    traces = []
    for i in range(rng.randint(5, 30)):
        outcome = rng.choice(["success"] * 4 + ["warning", "client_error"])
        traces.append(dict(
            cid=f"{project}-{rng.randint(0, 99):02d}-{i}",
            at=START + timedelta(seconds=rng.randint(0, 20000)),
            fp=rng.choice(fingerprints), path=rng.choice(paths), outcome=outcome,
            severity=rng.choice([2, 2, 2, 2, 8]),
            types=["E"] if rng.random() < 0.1 else [], merge=rng.random() < 0.15,
        ))
    return project, stored, traces, rng.random() < 0.4


def one_by_one(stored, traces, in_deploy, baseline):
    """Evaluate traces in order against a store that changes as they are kept."""
    store = [dict(cid=c, fp=f, path=p, count=n) for c, f, p, n, _ in stored]
    results = {}
    for t in sorted(traces, key=lambda t: (t["at"], t["cid"])):
        known = {d["fp"] for d in store if d["path"] == t["path"]} if t["path"] else set()
        if t["severity"] >= 7:
            tier = "tier0_severity"
        elif t["types"]:
            tier = "tier1_error_types"
        elif t["path"] and len(known) < baseline:
            tier = "tier5_cold_start"
        elif in_deploy and t["outcome"] != "success":
            tier = "tier2_deploy_window"
        elif in_deploy and t["path"] and t["fp"] not in known:
            tier = "tier2_deploy_new_fp"
        elif t["path"] and known and t["fp"] not in known:
            tier = "tier3_new_fingerprint"
        else:
            tier = "default"
        same = [d for d in store if d["fp"] == t["fp"]]
        if tier == "default":
            operation = "none"
        elif same and not t["merge"]:
            operation = "repeat"
            same[0]["count"] += 1
        else:
            operation = "insert"
            store.append(dict(cid=t["cid"], fp=t["fp"], path=t["path"], count=1))
        results[t["cid"]] = (tier, operation, len(known))
    return results, {d["cid"]: d["count"] for d in store}


@pytest.mark.parametrize("baseline, seed", [(1, 1), (2, 2), (3, 3), (4, 4)])
def test_set_form_equals_sequence(spark, baseline, seed):
    rng = random.Random(seed)
    cfg = replace(EngineConfig(), cold_start_baseline_count=baseline)
    projects = [random_project(rng, f"p{i}") for i in range(150)]
    features = spark.createDataFrame([
        (p, t["cid"], t["at"], t["fp"], t["path"], t["outcome"], t["severity"], False, t["types"],
         [], t["merge"])
        for p, _, traces, _ in projects for t in traces
    ], FEATURES)
    documents = documents_frame(spark, *[
        document(p, cid, fp, path, n, at) for p, stored, _, _ in projects
        for cid, fp, path, n, at in stored
    ])
    commits = commits_frame(spark, *[(p, AS_OF - 60) for p, _, _, deploy in projects if deploy])

    traces = G.candidates(features, commits, AS_OF, cfg)
    moments, pairs = G.history(traces, documents, cfg)
    verdicts = G.explain_new(G.evaluate(traces, moments, cfg), pairs).cache()
    got = {r.correlation_id: r for r in verdicts.collect()}
    new = verdicts.where("operation = 'insert'").selectExpr(
        "project_id", "correlation_id", "fingerprint",
        "nullif(path_key, '') AS request_path_pattern",
        "1L AS occurrence_count", "0L AS last_seen", "entered_at",
    )
    after = D.increment_occurrence(D.upsert(documents, new), D.repeats(verdicts, AS_OF))
    counts = {r.correlation_id: r.occurrence_count for r in after.collect()}
    verdicts.unpersist()

    expected_counts = {}
    for project, stored, traces, deploy in projects:
        expected, kept = one_by_one(stored, traces, deploy, baseline)
        expected_counts |= kept
        for cid, (tier, operation, known) in expected.items():
            assert (got[cid].tier, got[cid].operation) == (tier, operation), (project, cid)
            if tier == "tier3_new_fingerprint":
                assert got[cid].reason.endswith(f"(known: {known} fingerprints)")
            if tier == "tier5_cold_start":
                assert f"({known}/{baseline} fingerprints known)" in got[cid].reason
    assert counts == expected_counts
