"""The promote/drop gate and fingerprint dedup as aggregates and joins.

Evaluating traces one by one, each promoted trace changes what the next one
sees. The same answers follow from *when* things become known:

* a fingerprint exists in its project from its first *eligible* trace on
  (or always, if stored);
* a (path, fingerprint) pair is known from the trace that inserted the
  fingerprint, if that trace has this path, or from the first re-evaluated
  trace with the pair;
* an endpoint has k known fingerprints from the k-th such moment on.

These moments are aggregates over distinct (project, path, fingerprint) triples.
The trace table is joined once, to one row per triple.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tracemill.config import EngineConfig
from tracemill.functions.messages import bracketed
from tracemill.functions.traces import FAILED_OUTCOMES
from tracemill.operators.counting import count_before
from tracemill.operators.ranges import running
from tracemill.session import staged

PROMOTE, DROP = "PROMOTE", "DROP"
# Fixed value: the reason of a drop.
DROP_REASON = "healthy_traffic — no promotion criteria met"
INSERT, REPEAT, NONE = "insert", "repeat", "none"

TRIPLE = ("project_id", "path_key", "fingerprint")
VERDICT_KEY = ("project_id", "correlation_id", "entered_at", "fingerprint")


def moment() -> Column:
    """Place of a trace in the evaluation order."""
    return F.struct("entered_at", "correlation_id")


def always() -> Column:
    """A moment before every trace: the state of things already stored."""
    early = F.lit("0001-01-01 00:00:00").cast("timestamp")
    return F.struct(early.alias("entered_at"), F.lit("").alias("correlation_id"))


def gate_inputs(features: DataFrame) -> DataFrame:
    """The columns of the trace features that verdicts depend on."""
    return features.select(
        *VERDICT_KEY, "request_path_pattern", "outcome", "severity_score", "has_errors",
        "error_types", "suspicious_keywords", "is_merge", "error",
    )


# ---- history-free tiers ----------------------------------------------------


def severity_tier(cfg: EngineConfig) -> Column:
    return (
        F.when(F.col("severity_score") >= cfg.severity_threshold, "tier0_severity")
        .when(F.col("outcome").isin(*FAILED_OUTCOMES), "tier0_outcome")
        .when(F.col("has_errors"), "tier0_has_errors")
    )


def content_tier() -> Column:
    return F.when(F.size("error_types") > 0, "tier1_error_types").when(
        F.size("suspicious_keywords") > 0, "tier1_keywords"
    )


# ---- history ---------------------------------------------------------------


def deployed_projects(commits: DataFrame, as_of: int, cfg: EngineConfig) -> DataFrame:
    """Projects whose latest commit is inside the window; later commits count too."""
    return (
        commits.where(F.col("timestamp_unix") >= as_of - cfg.deploy_window_seconds)
        .select("project_id")
        .distinct()
        .withColumn("in_deploy", F.lit(True))
    )


def commits_as_of(traces: DataFrame, commits: DataFrame, stage=staged) -> DataFrame:
    """``traces`` with ``latest_commit``, the project's last one at or before the trace.

    Traces and commits are one sorted table per project, over which the last commit is
    carried on; a project with a third of all traces is spread over ranges of time. This
    is what a replay of old batches needs: later commits do not count.
    """
    at = F.unix_micros("entered_at").alias("at")
    timeline = traces.select("*", at, F.lit(1).alias("after"), F.lit(None).cast("bigint").alias("commit")).unionByName(
        commits.select("project_id", (F.col("timestamp_unix") * 1_000_000).alias("at"), F.lit(0).alias("after"),
                       F.col("timestamp_unix").alias("commit")),
        allowMissingColumns=True,
    )
    # A commit at the trace's own time stands before it.
    found = running(timeline, ["project_id"], ["at", "after"], stage, lasts={"latest_commit": F.col("commit")})
    return found.where("after = 1").select(*traces.columns, "latest_commit")


def deployed_traces(traces: DataFrame, commits: DataFrame, cfg: EngineConfig, stage=staged) -> DataFrame:
    """``traces`` with ``latest_commit`` and ``in_deploy`` as of their own time."""
    age = F.unix_micros("entered_at") - F.col("latest_commit") * 1_000_000
    near = F.coalesce(age <= cfg.deploy_window_seconds * 1_000_000, F.lit(False))
    return commits_as_of(traces, commits, stage).withColumn("in_deploy", near)


def stored_fingerprints(documents: DataFrame) -> DataFrame:
    """Oldest stored document per (project, fingerprint)."""
    oldest = F.min(F.struct("entered_at", "correlation_id"))["correlation_id"]
    return (
        documents.where(F.col("fingerprint") != "")
        .groupBy("project_id", "fingerprint")
        .agg(oldest.alias("keeper"))
    )


def known_fingerprints(documents: DataFrame) -> DataFrame:
    """Distinct fingerprints stored per (project, endpoint)."""
    return (
        documents.where((F.col("fingerprint") != "") & F.col("request_path_pattern").isNotNull())
        .select("project_id", F.col("request_path_pattern").alias("path_key"), "fingerprint")
        .distinct()
    )


def candidates(
    features: DataFrame, commits: DataFrame, as_of: int, cfg: EngineConfig, stage=staged
) -> DataFrame:
    """What the gate needs of each valid trace, and no more.

    ``own_tier`` is the tier that needs no history, ``eligible`` says whether the
    trace is promoted whenever its fingerprint is new to the project.
    """
    if cfg.deploy_as_of_trace:
        joined = deployed_traces(features, commits, cfg, stage)
    else:
        projects = deployed_projects(commits, as_of, cfg)
        joined = features.join(projects, "project_id", "left").withColumn(
            "in_deploy", F.coalesce("in_deploy", F.lit(False))
        )
    has_path = F.col("request_path_pattern").isNotNull()
    relaxed = F.col("in_deploy") & (F.col("outcome") != "success")
    return joined.select(
        *VERDICT_KEY, "outcome", "severity_score", "error_types", "suspicious_keywords",
        "is_merge", "in_deploy",
        F.coalesce(F.col("request_path_pattern"), F.lit("")).alias("path_key"),
        F.coalesce(severity_tier(cfg), content_tier()).alias("own_tier"),
        "request_path_pattern",
    ).withColumn("eligible", F.col("own_tier").isNotNull() | has_path | relaxed).drop(
        "request_path_pattern"
    )


def triples(traces: DataFrame) -> DataFrame:
    """First eligible and first re-evaluated trace per (project, path, fingerprint)."""
    return traces.groupBy(*TRIPLE).agg(
        F.min(F.when(F.col("eligible"), moment())).alias("first_eligible"),
        F.min(F.when(F.col("is_merge"), moment())).alias("first_merge"),
    )


def fingerprint_since(batch: DataFrame, documents: DataFrame) -> DataFrame:
    """When each promotable fingerprint of the batch starts to exist in its project.

    ``keeper`` is the document that repeats are counted on, ``insert_path`` the
    endpoint under which the batch first inserts the fingerprint.
    """
    key = ["project_id", "fingerprint"]
    first = (
        batch.where(F.col("first_eligible").isNotNull())
        .groupBy(*key)
        .agg(F.min(F.struct(F.col("first_eligible").alias("at"), "path_key")).alias("first"))
    )
    # Only the stored documents with a fingerprint of the batch are aggregated.
    relevant = documents.join(first.select(*key), key, "left_semi")
    is_stored = F.col("keeper").isNotNull()
    return first.join(stored_fingerprints(relevant), key, "left").select(
        *key,
        F.when(is_stored, always()).otherwise(F.col("first.at")).alias("exists_since"),
        F.coalesce("keeper", F.col("first.at.correlation_id")).alias("keeper"),
        F.when(~is_stored, F.col("first.path_key")).alias("insert_path"),
    )


def pair_since(batch: DataFrame, since: DataFrame, documents: DataFrame) -> DataFrame:
    """When each (endpoint, fingerprint) becomes known, for endpoints of the batch."""
    on_path = batch.where(F.col("path_key") != "")
    endpoints = on_path.select(
        "project_id", F.col("path_key").alias("request_path_pattern")
    ).distinct()
    relevant = documents.join(endpoints, ["project_id", "request_path_pattern"], "left_semi")
    stored = known_fingerprints(relevant)
    inserted = F.when(F.col("insert_path") == F.col("path_key"), F.col("exists_since"))
    fresh = (
        on_path.join(since, ["project_id", "fingerprint"])
        .select(*TRIPLE, F.least(inserted, F.col("first_merge")).alias("since"))
        .where(F.col("since").isNotNull())
    )
    both = stored.select(*TRIPLE, always().alias("since")).unionByName(fresh)
    return both.groupBy(*TRIPLE).agg(F.min("since").alias("known_since"))


def baselines(pairs: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The first K moments at which an endpoint gained a known fingerprint."""
    by_moment = Window.partitionBy("project_id", "path_key").orderBy("known_since", "fingerprint")
    return (
        pairs.withColumn("nth", F.row_number().over(by_moment))
        .where(F.col("nth") <= cfg.cold_start_baseline_count)
        .groupBy("project_id", "path_key")
        .agg(F.sort_array(F.collect_list("known_since")).alias("baseline"))
    )


def history(
    traces: DataFrame, documents: DataFrame, cfg: EngineConfig, stage=staged
) -> tuple[DataFrame, DataFrame]:
    """One row of moments per triple of the batch, and the known pairs.

    Triples and pairs are staged: each is read several times, and both are far
    smaller than the trace table they come from.
    """
    batch = stage(triples(traces), "triples")
    since = fingerprint_since(batch, documents)
    pairs = stage(pair_since(batch, since, documents), "pairs")
    moments = (
        batch.select(*TRIPLE)
        .join(since.drop("insert_path"), ["project_id", "fingerprint"], "left")
        .join(pairs, list(TRIPLE), "left")
        .join(baselines(pairs, cfg), ["project_id", "path_key"], "left")
    )
    return moments, pairs


# ---- verdicts --------------------------------------------------------------


def before_now(moment_column: str) -> Column:
    return F.coalesce(F.col(moment_column) < moment(), F.lit(False))


def known_in_baseline() -> Column:
    """Known fingerprints of the endpoint, counted up to the baseline size."""
    counted = F.size(F.filter("baseline", lambda at: at < moment()))
    return F.when(F.col("baseline").isNull(), 0).otherwise(counted)


def history_tier(cfg: EngineConfig) -> Column:
    on_path = F.col("path_key") != ""
    size = cfg.cold_start_baseline_count
    reached = F.coalesce(F.get("baseline", F.lit(size - 1)) < moment(), F.lit(False))
    is_new = ~before_now("known_since")
    any_known = F.coalesce(F.get("baseline", F.lit(0)) < moment(), F.lit(False))
    return (
        F.when(on_path & ~reached, "tier5_cold_start")
        .when(F.col("in_deploy") & (F.col("outcome") != "success"), "tier2_deploy_window")
        .when(F.col("in_deploy") & on_path & is_new, "tier2_deploy_new_fp")
        .when(on_path & any_known & is_new, "tier3_new_fingerprint")
    )


def reason_text(cfg: EngineConfig) -> Column:
    """Explanation of a verdict; the count of tier 3 is added by ``explain_new``."""
    threshold, size = cfg.severity_threshold, cfg.cold_start_baseline_count

    def text(template: str, *columns) -> Column:
        return F.format_string(template, *columns)

    # Tier names and the wording of their reasons.
    by_tier = {
        "tier0_severity": text(f"severity_score=%d >= {threshold}", "severity_score"),
        "tier0_outcome": text("outcome=%s", "outcome"),
        "tier0_has_errors": F.lit("trace contains ERROR/FATAL logs"),
        "tier1_error_types": text(
            "error_types detected: %s", bracketed(F.col("error_types"))
        ),
        "tier1_keywords": text("suspicious keywords: %s", bracketed(F.col("suspicious_keywords"))),
        "tier5_cold_start": text(
            f"building baseline for %s (%d/{size} fingerprints known)",
            "path_key", known_in_baseline(),
        ),
        "tier2_deploy_window": text(
            f"outcome=%s within {cfg.deploy_window_minutes}min of deploy", "outcome"
        ),
        "tier2_deploy_new_fp": text("new fingerprint %s within deploy window", "fingerprint"),
        "tier3_new_fingerprint": text(
            "new fingerprint %s on stable endpoint %s", "fingerprint", "path_key"
        ),
    }
    reason = F.lit(DROP_REASON)
    for tier, wording in by_tier.items():
        reason = F.when(F.col("tier") == tier, wording).otherwise(reason)
    return reason


def own_verdicts(features: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Verdicts of the tiers that need no history, for use without a store."""
    judged = features.withColumns({
        "path_key": F.coalesce("request_path_pattern", F.lit("")),
        "baseline": F.array().cast("array<struct<entered_at:timestamp,correlation_id:string>>"),
        "tier": F.coalesce(severity_tier(cfg), content_tier(), F.lit("default")),
    })
    return judged.select(
        *features.columns, "tier",
        F.when(F.col("tier") == "default", DROP).otherwise(PROMOTE).alias("action"),
        reason_text(cfg).alias("reason"),
    )


def evaluate(traces: DataFrame, moments: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Tier, action and store operation of every candidate trace.

    ``operation`` says what a promoted trace does to the store: insert a
    document, or count a repeat on ``keeper``. Re-evaluated traces always insert.
    """
    judged = traces.join(moments, list(TRIPLE), "left").withColumn(
        "tier", F.coalesce("own_tier", history_tier(cfg), F.lit("default"))
    )
    promoted = F.col("tier") != "default"
    repeat = ~F.col("is_merge") & before_now("exists_since")
    operation = F.when(~promoted, NONE).when(repeat, REPEAT).otherwise(INSERT)
    return judged.select(
        *VERDICT_KEY, "path_key", "is_merge", "tier",
        F.when(promoted, PROMOTE).otherwise(DROP).alias("action"),
        reason_text(cfg).alias("reason"),
        operation.alias("operation"),
        F.when(promoted & repeat, F.col("keeper")).alias("keeper"),
    )


def gatekeeper(
    features: DataFrame, documents: DataFrame, commits: DataFrame, as_of: int, cfg: EngineConfig
) -> DataFrame:
    """Verdicts of valid traces against the stored documents."""
    traces = candidates(features, commits, as_of, cfg)
    moments, _ = history(traces, documents, cfg)
    return evaluate(traces, moments, cfg)


def explain_new(verdicts: DataFrame, pairs: DataFrame, stage=staged) -> DataFrame:
    """Add the number of known fingerprints to the reasons of tier 3.

    Only those rows are joined; the others pass through.
    """
    is_fresh = F.col("tier") == "tier3_new_fingerprint"
    fresh = verdicts.where(is_fresh)
    counted = count_before(
        fresh.select("project_id", "path_key", "correlation_id", "entered_at"),
        pairs.select("project_id", "path_key", "known_since"),
        ["project_id", "path_key"], "known_since", stage,
    ).select("project_id", "correlation_id", "known")
    suffix = F.format_string(" (known: %d fingerprints)", "known")
    explained = fresh.join(counted, ["project_id", "correlation_id"]).withColumn(
        "reason", F.concat("reason", suffix)
    )
    return verdicts.where(~is_fresh).unionByName(explained.select(*verdicts.columns))


def dropped_only(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.col("action") == DROP)


def promoted_only(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.col("action") == PROMOTE)
