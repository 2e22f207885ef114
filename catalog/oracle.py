"""DuckDB SQL with the expected result of each registered query.

The statements share a chain of common table expressions: rows, traces, gate,
documents. The gate is written with counting subqueries instead of the
k-smallest arrays that the engine uses.
"""

from __future__ import annotations

from catalog.fixtures import AS_OF, COMMIT_HISTORY_SQL, COMMITS_SQL, LOGS_SQL
from tracemill.config import CRITICAL_KEYWORDS, STANDALONE_KEYWORDS, SUSPICIOUS_KEYWORDS

MID_DAY = "2024-01-16 12:00:00"
SLICE_AFTER, SLICE_UPTO = "2024-01-10 00:00:00", "2024-01-20 12:00:00"
SLICE_ROWS = 1000

# Patterns of dynamic parts, error names and path segments.
UUID = r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b"
ERROR_NAME = (
    r"\b([A-Z][A-Za-z0-9]*(?:Error|Exception|Timeout|Failure|Refused|Denied|Overflow|Violation))\b"
)
ID_SEGMENT = r"(\d+|[0-9a-fA-F-]{8,}|[A-Za-z]+-\d+|[A-Za-z0-9]{20,})"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _replace(expr: str, *steps: tuple[str, str]) -> str:
    for pattern, text in steps:
        expr = f"regexp_replace({expr}, '{pattern}', '{text}', 'g')"
    return expr


TEMPLATE = _replace(
    "{0}", (UUID.replace("{", "{{").replace("}", "}}"), "<UUID>"), ("0x[0-9a-fA-F]+", "<HEX_ADDR>"),
    (r"\b\d{{1,3}}(\.\d{{1,3}}){{3}}(:\d+)?\b", "<IP>"), (r"\b\d+\b", "<NUM>"),
)
DEDUP = (
    "trim("
    + _replace(
        "trim(lower({0}))", (UUID.replace("{", "{{").replace("}", "}}"), ""),
        ("0x[0-9a-fA-F]+", ""), (r"\b\d+\b", ""), (r"\s+", " "),
    )
    + ")"
)
LEVEL = """CASE WHEN lower(trim({0})) IN ('warn', 'warning') THEN 'warn'
  WHEN lower(trim({0})) IN ('fatal', 'critical') THEN 'fatal'
  WHEN lower(trim({0})) IN ('info', 'error', 'debug') THEN lower(trim({0})) END"""
RANK = """CASE {0} WHEN 'debug' THEN 0 WHEN 'info' THEN 1 WHEN 'warn' THEN 2
  WHEN 'error' THEN 3 WHEN 'fatal' THEN 4 END"""
JSON_KIND = "CASE WHEN json_valid({0}) THEN json_type({0}) END"
ERROR_TYPE = f"""CASE WHEN regexp_extract(msg, '{ERROR_NAME}', 1) <> ''
    THEN regexp_extract(msg, '{ERROR_NAME}', 1)
  WHEN contains(msg, ':') AND NOT contains(trim(split_part(msg, ':', 1)), ' ')
    AND length(trim(split_part(msg, ':', 1))) <= 50 THEN trim(split_part(msg, ':', 1))
  WHEN kind = 'OBJECT' THEN json_extract_string(meta, '$.error_type') END"""
PATTERN = (
    "CASE WHEN {0} <> '' THEN array_to_string(list_transform(string_split({0}, '/'), "
    "lambda s: CASE WHEN regexp_full_match(s, '"
    + ID_SEGMENT.replace("{", "{{").replace("}", "}}")
    + "') THEN '{{id}}' ELSE s END), '/') END"
)


def trace_ctes(p: str, source: str, keywords=SUSPICIOUS_KEYWORDS) -> dict[str, str]:
    """Rows and traces of ``source`` (the log columns plus ``in_batch``)."""
    w = "OVER (PARTITION BY cid ORDER BY ts, rs)"
    return {
        f"{p}rows0": f"""
          SELECT correlationId cid, rowSeq rs, timestamp ts, projectId pid, loggerName logger,
            message msg, meta, durationMs dur, sessionStartedAt started, in_batch,
            requestMethod method, requestPath path,
            CASE WHEN requestMethod <> '' OR requestPath <> '' THEN statusCode END status,
            {LEVEL.format('level')} lvl, {JSON_KIND.format('meta')} kind FROM {source}""",
        f"{p}rows": f"""
          SELECT *, {RANK.format('lvl')} rnk, row_number() {w} pos,
            coalesce(nullif(logger, ''), nullif(first_value(logger) {w}, ''),
                     nullif(first_value(pid) {w}, ''), 'unknown-service') service,
            coalesce(kind NOT IN ('OBJECT', 'NULL'), false) bad_meta, {ERROR_TYPE} et,
            list_filter({_list(keywords)}, lambda k: contains(lower(msg), k)) kws,
            len(list_filter({_list(CRITICAL_KEYWORDS)}, lambda k: contains(lower(msg), k))) > 0 crit
          FROM {p}rows0""",
        f"{p}services": f"""
          SELECT cid, list(service ORDER BY place) services FROM
            (SELECT cid, service, min(pos) place FROM {p}rows GROUP BY ALL) GROUP BY cid""",
        f"{p}types": f"""
          SELECT cid, list(et ORDER BY place) types FROM
            (SELECT cid, et, min(pos) place FROM {p}rows WHERE et <> '' GROUP BY ALL) GROUP BY cid""",
        f"{p}hits": f"""
          SELECT cid, pos, unnest(kws) kw, generate_subscripts(kws, 1) i
          FROM {p}rows WHERE len(kws) > 0""",
        f"{p}kws": f"""
          SELECT cid, list(kw ORDER BY place) kws FROM
            (SELECT cid, kw, min(pos * 1000 + i) place FROM {p}hits GROUP BY ALL) GROUP BY cid""",
        f"{p}traces0": f"""
          SELECT cid, count(*) n, max(rnk) mr, bool_or(coalesce(rnk = 2, false)) warned,
            max(CASE WHEN pos = 1 THEN pid END) pid, max(CASE WHEN pos = 1 THEN logger END) component,
            max(CASE WHEN pos = 1 THEN method END) method, max(CASE WHEN pos = 1 THEN path END) path,
            max(CASE WHEN pos = 1 THEN status END) status, max(CASE WHEN pos = 1 THEN dur END) dur,
            max(CASE WHEN pos = 1 THEN started END) started,
            min(ts) first_ts, max(ts) last_ts,
            max(CASE WHEN pos = 1 THEN msg END) first_msg, arg_max(msg, pos) last_msg,
            min(ts) FILTER (in_batch) entered, bool_or(NOT in_batch) is_merge,
            bool_or(crit) crit, coalesce(list_sort(list(DISTINCT lvl) FILTER (lvl IS NOT NULL)), []) levels,
            concat_ws(', ', CASE WHEN bool_or(lvl IS NULL) THEN 'invalid_level' END,
                            CASE WHEN bool_or(bad_meta) THEN 'invalid_meta' END) error,
            coalesce(arg_min(msg, pos) FILTER (rnk >= 3), arg_min(msg, pos) FILTER (len(kws) > 0),
                     arg_max(msg, pos)) fp_msg
          FROM {p}rows GROUP BY cid""",
        f"{p}traces1": f"""
          SELECT t.*, s.services, coalesce(e.types, []) types, coalesce(k.kws, []) kws,
            ['debug', 'info', 'warn', 'error', 'fatal'][coalesce(mr, 0) + 1] max_level,
            CASE WHEN mr >= 3 THEN 'failure' WHEN status >= 500 THEN 'server_error'
                 WHEN status >= 400 THEN 'client_error' WHEN mr = 2 THEN 'warning'
                 ELSE 'success' END outcome,
            {PATTERN.format('path')} pattern
          FROM {p}traces0 t JOIN {p}services s USING (cid)
          LEFT JOIN {p}types e USING (cid) LEFT JOIN {p}kws k USING (cid)""",
        f"{p}traces": f"""
          SELECT *,
            least(least([1, 2, 4, 7, 9][mr + 1] + CASE WHEN crit THEN 2 ELSE 0 END, 10)
              + CASE WHEN outcome IN ('server_error', 'failure') THEN 1 ELSE 0 END, 10) severity,
            'TRC-' || upper(substr(md5(array_to_string(list_sort(list_distinct(services)), '→')
              || '|' || max_level || '|' || {TEMPLATE.format('fp_msg')}), 1, 8)) fp
          FROM {p}traces1""",
        f"{p}valid": f"SELECT * FROM {p}traces WHERE error = ''",
    }


def gate_ctes(p: str, stored: str) -> dict[str, str]:
    """Verdicts of ``{p}valid``. ``stored`` has pid, cid, pattern, fp and entered."""
    return {
        f"{p}kept": f"""
          SELECT * FROM {stored} d WHERE NOT EXISTS
            (SELECT 1 FROM {p}valid v WHERE v.is_merge AND v.pid = d.pid AND v.cid = d.cid)""",
        f"{p}cand": f"""
          SELECT v.*, row_number() OVER (ORDER BY entered, cid) seq,
            coalesce({AS_OF} - c.latest <= 3600, false) in_deploy,
            CASE WHEN severity >= 7 THEN 'tier0_severity'
                 WHEN outcome IN ('server_error', 'failure') THEN 'tier0_outcome'
                 WHEN mr >= 3 THEN 'tier0_has_errors'
                 WHEN len(types) > 0 THEN 'tier1_error_types'
                 WHEN len(kws) > 0 THEN 'tier1_keywords' END own
          FROM {p}valid v LEFT JOIN
            (SELECT project_id, max(timestamp_unix) latest FROM commits GROUP BY 1) c
            ON c.project_id = v.pid""",
        f"{p}first": f"""
          SELECT pid, fp, min(seq) since FROM (
            SELECT pid, fp, 0 seq FROM {p}kept UNION ALL
            SELECT pid, fp, seq FROM {p}cand WHERE own IS NOT NULL OR pattern IS NOT NULL
              OR (in_deploy AND outcome <> 'success')) GROUP BY ALL""",
        f"{p}pairs": f"""
          SELECT pid, pattern, fp, min(seq) since FROM (
            SELECT pid, pattern, fp, 0 seq FROM {p}kept WHERE pattern IS NOT NULL UNION ALL
            SELECT c.pid, c.pattern, c.fp, c.seq FROM {p}cand c JOIN {p}first f
              ON f.pid = c.pid AND f.fp = c.fp AND f.since = c.seq
              WHERE c.pattern IS NOT NULL UNION ALL
            SELECT pid, pattern, fp, seq FROM {p}cand WHERE is_merge AND pattern IS NOT NULL)
          GROUP BY ALL""",
        f"{p}judged": f"""
          SELECT c.*, coalesce(k.since < c.seq, false) is_known, coalesce(f.since < c.seq, false) is_old,
            (SELECT count(*) FROM {p}pairs p WHERE p.pid = c.pid AND p.pattern = c.pattern
               AND p.since < c.seq) known
          FROM {p}cand c LEFT JOIN {p}first f ON f.pid = c.pid AND f.fp = c.fp
          LEFT JOIN {p}pairs k ON k.pid = c.pid AND k.pattern = c.pattern AND k.fp = c.fp""",
        f"{p}tiers": f"""
          SELECT *, CASE WHEN own IS NOT NULL THEN own
            WHEN pattern IS NOT NULL AND known < 3 THEN 'tier5_cold_start'
            WHEN in_deploy AND outcome <> 'success' THEN 'tier2_deploy_window'
            WHEN in_deploy AND pattern IS NOT NULL AND NOT is_known THEN 'tier2_deploy_new_fp'
            WHEN pattern IS NOT NULL AND known > 0 AND NOT is_known THEN 'tier3_new_fingerprint'
            ELSE 'default' END tier FROM {p}judged""",
        f"{p}verdicts": f"""
          SELECT *, CASE WHEN tier = 'default' THEN 'DROP' ELSE 'PROMOTE' END action,
            CASE WHEN tier = 'default' THEN 'none' WHEN NOT is_merge AND is_old THEN 'repeat'
                 ELSE 'insert' END operation,
            CASE tier
              WHEN 'tier0_severity' THEN 'severity_score=' || severity || ' >= 7'
              WHEN 'tier0_outcome' THEN 'outcome=' || outcome
              WHEN 'tier0_has_errors' THEN 'trace contains ERROR/FATAL logs'
              WHEN 'tier1_error_types'
                THEN 'error_types detected: [''' || array_to_string(types, ''', ''') || ''']'
              WHEN 'tier1_keywords'
                THEN 'suspicious keywords: [''' || array_to_string(kws, ''', ''') || ''']'
              WHEN 'tier5_cold_start' THEN 'building baseline for ' || pattern || ' (' || known
                || '/3 fingerprints known)'
              WHEN 'tier2_deploy_window' THEN 'outcome=' || outcome || ' within 60min of deploy'
              WHEN 'tier2_deploy_new_fp' THEN 'new fingerprint ' || fp || ' within deploy window'
              WHEN 'tier3_new_fingerprint' THEN 'new fingerprint ' || fp || ' on stable endpoint '
                || pattern || ' (known: ' || known || ' fingerprints)'
              ELSE 'healthy_traffic — no promotion criteria met' END reason
          FROM {p}tiers""",
        f"{p}repeats": f"""
          SELECT pid, fp, count(*) more FROM {p}verdicts WHERE operation = 'repeat' GROUP BY ALL""",
    }


# What a stored document carries besides its counts, by its name in the trace tables.
CARRIED = (
    "method, path, status, services, max_level, outcome, severity, mr, warned, n, levels, dur, types, kws"
)


def docs_ctes(p: str) -> dict[str, str]:
    """Stored documents after the verdicts of ``{p}``."""
    return {
        f"{p}alldocs": f"""
          SELECT pid, cid, pattern, fp, entered, occurrences, seen, unix, txt, {CARRIED}, 0 fresh
          FROM {p}kept UNION ALL
          SELECT pid, cid, pattern, fp, entered, 1, CAST(floor(epoch(first_ts)) AS BIGINT),
            CAST(floor(epoch(first_ts)) AS BIGINT), semantic_text, {CARRIED}, 1
          FROM {p}verdicts JOIN {p}texts USING (cid) WHERE operation = 'insert'""",
        f"{p}docs": f"""
          SELECT d.pid, d.cid, d.pattern, d.fp, d.entered, unix, txt, {CARRIED},
            occurrences + CASE WHEN oldest THEN coalesce(more, 0) ELSE 0 END occurrences,
            CASE WHEN oldest AND more > 0 THEN {AS_OF} ELSE seen END seen
          FROM (SELECT *, row_number() OVER (PARTITION BY pid, fp ORDER BY fresh, entered, cid) = 1
                  oldest FROM {p}alldocs) d
          LEFT JOIN {p}repeats r ON r.pid = d.pid AND r.fp = d.fp""",
    }


def text_ctes(p: str, wanted: str, max_list: int | None = None, max_chars: int | None = None) -> dict[str, str]:
    """Semantic text of the traces in ``wanted`` (columns of ``{p}traces``)."""
    value = """CASE json_type(meta, '$.' || key) WHEN 'BOOLEAN'
        THEN CASE json_extract_string(meta, '$.' || key) WHEN 'true' THEN 'True' ELSE 'False' END
        WHEN 'ARRAY' THEN '[' || array_to_string(list_transform(
          CAST(json_extract(meta, '$.' || key) AS JSON[]), lambda x: CASE json_type(x)
            WHEN 'VARCHAR' THEN '''' || json_extract_string(x, '$') || ''''
            WHEN 'BOOLEAN' THEN CASE CAST(x AS VARCHAR) WHEN 'true' THEN 'True' ELSE 'False' END
            ELSE coalesce(nullif(CAST(x AS VARCHAR), 'null'), 'None') END), ', ') || ']'
        ELSE json_extract_string(meta, '$.' || key) END"""
    lists = "true" if max_list is None else (
        f"(json_type(meta, '$.' || key) <> 'ARRAY' OR json_array_length(meta, '$.' || key) <= {max_list})"
    )
    cut = "txt" if max_chars is None else (
        f"CASE WHEN length(txt) > {max_chars} THEN substr(txt, 1, {max_chars}) || '...' ELSE txt END"
    )
    return {
        f"{p}lines0": f"""
          SELECT cid, {DEDUP.format('msg')} norm, min(pos) pos FROM {p}rows
          WHERE trim(msg) <> '' GROUP BY ALL""",
        f"{p}lines": f"""
          SELECT l.cid, l.pos, trim(r.msg) line FROM {p}lines0 l JOIN {p}rows r
            ON r.cid = l.cid AND r.pos = l.pos""",
        f"{p}digest": f"""
          SELECT cid, string_agg(line, '. ' ORDER BY pos) digest FROM {p}lines GROUP BY cid""",
        f"{p}keys": f"""
          SELECT cid, pos, meta, unnest(json_keys(meta)) key,
            generate_subscripts(json_keys(meta), 1) i FROM {p}rows WHERE kind = 'OBJECT'""",
        f"{p}entries0": f"""
          SELECT cid, key, pos * 1000 + i AS place, {value} v FROM {p}keys
          WHERE lower(key) NOT IN ('logger', 'loggername', 'correlation_id', 'level', 'timestamp')
            AND json_type(meta, '$.' || key) NOT IN ('NULL', 'OBJECT') AND {lists}""",
        f"{p}entries": f"""
          SELECT cid, key || '=' || arg_min(v, place) entry, min(place) place
          FROM {p}entries0 GROUP BY cid, key""",
        f"{p}context": f"""
          SELECT cid, string_agg(entry, '; ' ORDER BY place) context FROM {p}entries GROUP BY cid""",
        f"{p}texts0": f"""
          SELECT t.cid, concat_ws('. ',
            CASE WHEN method <> '' THEN trim(method || ' ' || coalesce(pattern, path, ''))
                 WHEN dur IS NOT NULL THEN 'Trace executed' END,
            'Context: ' || context,
            CASE WHEN len(services) > 1 THEN 'Flow: ' || array_to_string(services, ' → ')
                 ELSE 'Service: ' || services[1] END,
            digest,
            'Outcome: ' || concat_ws(', ', replace(outcome, '_', ' '), status, dur || 'ms')) txt
          FROM {wanted} t LEFT JOIN {p}context USING (cid) LEFT JOIN {p}digest USING (cid)""",
        f"{p}texts": f"SELECT cid, {cut} semantic_text FROM {p}texts0",
    }


NO_DOCUMENTS = """SELECT '' pid, '' cid, '' pattern, '' fp, TIMESTAMP '2024-01-01' entered,
  1::BIGINT occurrences, 0::BIGINT seen, 0::BIGINT unix, '' txt, '' "method", '' path, 0 status,
  [''] services, '' max_level, '' outcome, 0 severity, 0 mr, false warned, 0::BIGINT n, [''] levels,
  0::BIGINT dur, [''] types, [''] kws WHERE false"""


def _source(where: str) -> str:
    return f"(SELECT *, true in_batch FROM logs WHERE {where})"


def _split(first: str, second: str) -> dict[str, str]:
    """Two batches; the second re-evaluates the traces it shares with the first."""
    return {
        "one_src": f"SELECT *, true in_batch FROM logs WHERE {first}",
        **trace_ctes("one_", "one_src"),
        **gate_ctes("one_", "no_documents"),
        **text_ctes("one_", "one_verdicts"),
        **docs_ctes("one_"),
        "two_src": f"""
          SELECT *, true in_batch FROM logs WHERE {second} UNION ALL
          SELECT *, false FROM logs WHERE {first} AND correlationId IN
            (SELECT correlationId FROM logs WHERE {second})""",
        **trace_ctes("two_", "two_src"),
        **gate_ctes("two_", "one_docs"),
        **text_ctes("two_", "two_verdicts"),
        **docs_ctes("two_"),
    }


COMMON = {"logs": LOGS_SQL, "commits": COMMITS_SQL, "no_documents": NO_DOCUMENTS}
WHOLE = {
    **COMMON,
    "all_src": "SELECT *, true in_batch FROM logs",
    **trace_ctes("", "all_src"),
    **gate_ctes("", "no_documents"),
    **text_ctes("", "traces"),
    **docs_ctes(""),
}
BUDGET = {
    **COMMON,
    "all_src": "SELECT *, true in_batch FROM logs",
    **trace_ctes("", "all_src"),
    **text_ctes("", "valid", max_list=5, max_chars=2000),
}
EARLY, LATE = f"timestamp <= TIMESTAMP '{MID_DAY}'", f"timestamp > TIMESTAMP '{MID_DAY}'"
SPLIT = {**COMMON, **_split(EARLY, LATE)}
REVERSED = {**COMMON, **_split(LATE, EARLY)}
STANDALONE = {
    **COMMON,
    "all_src": "SELECT *, true in_batch FROM logs",
    **trace_ctes("", "all_src", STANDALONE_KEYWORDS),
    **text_ctes("", "valid"),
}


def statement(ctes: dict[str, str], select: str) -> str:
    chain = ",\n".join(f"{name} AS ({body})" for name, body in ctes.items())
    return f"WITH {chain}\n{select}"


def logs_sql(select: str) -> str:
    return statement(COMMON, select)


def whole(select: str) -> str:
    return statement(WHOLE, select)


def split(select: str) -> str:
    return statement(SPLIT, select)


SLICE = f"""(SELECT *, row_number() OVER (ORDER BY timestamp, correlationId, rowSeq) nth FROM logs
  WHERE timestamp > TIMESTAMP '{SLICE_AFTER}' AND timestamp <= TIMESTAMP '{SLICE_UPTO}'
  ORDER BY timestamp, correlationId, rowSeq LIMIT {SLICE_ROWS})"""
WINDOW = f"""(SELECT *, row_number() OVER (ORDER BY timestamp, correlationId, rowSeq) nth FROM logs
  WHERE timestamp > TIMESTAMP '{SLICE_AFTER}' AND timestamp <= TIMESTAMP '{SLICE_UPTO}')"""
FAILED = "SELECT cid, error FROM traces WHERE error <> ''"
# Failures of the early traces count twice before the whole table is recorded.
QUARANTINE = f"""
  SELECT f.cid, CASE WHEN e.cid IS NULL THEN 1 ELSE 3 END::BIGINT cnt, f.error, {AS_OF}::BIGINT last_seen,
    CASE WHEN e.cid IS NULL THEN {AS_OF} ELSE {AS_OF} - 7200 END::BIGINT first_seen
  FROM ({FAILED}) f LEFT JOIN
    (SELECT DISTINCT cid FROM rows WHERE ts <= TIMESTAMP '{MID_DAY}'
       AND cid IN (SELECT cid FROM one_traces WHERE error <> '')) e ON e.cid = f.cid"""
EVERYTHING = {**WHOLE, **_split(EARLY, LATE)}
ISO_TEXT = """CASE WHEN rowSeq % 17 = 0 THEN 'not a time'
  ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') || CASE WHEN rowSeq % 2 = 0 THEN 'Z' ELSE '' END END"""


def _documents(p: str) -> str:
    return f"""SELECT pid AS project_id, cid AS correlation_id, pid AS project_name, fp AS fingerprint,
      txt AS semantic_text, coalesce("method", '') AS request_method, coalesce(path, '') AS request_path,
      coalesce(pattern, '') AS request_path_pattern,
      CAST(coalesce(status, -1) AS BIGINT) AS request_status_code,
      array_to_string(services, ' > ') AS services, max_level, outcome,
      CAST(severity AS BIGINT) AS severity_score, mr >= 3 AS has_errors, warned AS has_warnings,
      n AS log_count, array_to_string(levels, '|') AS levels_present, '' AS environment,
      CAST(coalesce(dur, -1) AS BIGINT) AS duration_ms, unix AS timestamp_unix,
      array_to_string(types, '|') AS error_types, array_to_string(kws, '|') AS suspicious_keywords,
      CAST(occurrences AS BIGINT) AS occurrence_count, CAST(seen AS BIGINT) AS last_seen,
      epoch_us(entered) AS entered_us, 384::BIGINT AS dimensions
    FROM {p}docs"""


FEATURES = """SELECT cid AS correlation_id, pid AS project_id,
  array_to_string(services, ' > ') AS services, max_level, outcome,
  CAST(severity AS BIGINT) AS severity_score, fp AS fingerprint,
  array_to_string(types, '|') AS error_types, array_to_string(kws, '|') AS suspicious_keywords,
  coalesce(pattern, '') AS request_path_pattern, array_to_string(levels, '|') AS levels_present,
  mr >= 3 AS has_errors, warned AS has_warnings, n AS log_count FROM valid"""


def _tier(prefix: str) -> str:
    return split(
        "SELECT cid AS correlation_id, pid AS project_id, tier, operation FROM two_verdicts "
        f"WHERE tier LIKE '{prefix}%'"
    )


def oracles() -> dict[str, str]:
    new_documents = """SELECT cid AS correlation_id, semantic_text FROM {0}texts
      JOIN {0}verdicts USING (cid) WHERE operation = 'insert'"""
    return {
        # sources
        "scan_logs": logs_sql(
            """SELECT rowSeq AS row_seq, projectId AS project_id, correlationId AS correlation_id,
            epoch_us(timestamp) AS ts_us, level, loggerName AS logger_name, message,
            coalesce(meta, '') AS meta, durationMs AS duration_ms FROM logs"""
        ),
        "incremental_filter": logs_sql(
            f"""SELECT rowSeq AS row_seq, correlationId AS correlation_id,
            epoch_us(timestamp) AS ts_us FROM logs WHERE timestamp > TIMESTAMP '{SLICE_AFTER}'
            AND timestamp <= TIMESTAMP '{SLICE_UPTO}'"""
        ),
        "batch_slice": logs_sql(
            f"SELECT rowSeq AS row_seq, correlationId AS correlation_id FROM {SLICE}"
        ),
        "trim_split_tail": logs_sql(
            f"""SELECT rowSeq AS row_seq, correlationId AS correlation_id FROM {SLICE} s
            WHERE correlationId <> (SELECT correlationId FROM {SLICE} ORDER BY nth DESC LIMIT 1)
              OR (SELECT count(*) FROM {SLICE}) < {SLICE_ROWS}"""
        ),
        "fetch_cid": logs_sql(
            f"""SELECT rowSeq AS row_seq, correlationId AS correlation_id FROM logs
            WHERE correlationId IN (SELECT correlationId FROM {WINDOW})"""
        ),
        "latest_commit": logs_sql(
            """SELECT l.projectId AS project_id, count(*) AS log_rows,
            coalesce(max(c.latest), 0)::BIGINT AS latest_commit FROM logs l LEFT JOIN
            (SELECT project_id, max(timestamp_unix) latest FROM commits GROUP BY 1) c
            ON c.project_id = l.projectId GROUP BY 1"""
        ),
        "read_documents": split(
            """SELECT cid AS correlation_id, fp AS fingerprint FROM one_docs
            WHERE pid = 'proj-1'"""
        ),
        "high_water_mark": logs_sql(f"SELECT max(epoch_us(timestamp)) AS mark_us FROM {WINDOW}"),
        "safe_high_water_mark": whole(
            f"""SELECT coalesce(max(epoch_us(timestamp)), epoch_us(TIMESTAMP '{SLICE_AFTER}'))
              AS mark_us FROM {WINDOW} WHERE nth < (SELECT min(nth) FROM {WINDOW}
                WHERE correlationId IN (SELECT cid FROM ({FAILED})))"""
        ),
        "process_one_trace": statement(
            STANDALONE,
            """SELECT cid AS correlation_id, fp AS fingerprint, semantic_text,
            array_to_string(kws, '|') AS suspicious_keywords, n AS log_count
            FROM valid JOIN texts USING (cid)""",
        ),
        # state
        "upsert_documents": split(_documents("two_")),
        "delete_by_cid": split(
            "SELECT pid AS project_id, cid AS correlation_id, fp AS fingerprint FROM two_kept"
        ),
        "increment_occurrence": whole(_documents("")),
        "batch_metrics": whole(
            """SELECT (SELECT count(*) FROM verdicts WHERE operation = 'insert') AS promoted,
            (SELECT count(*) FROM verdicts WHERE operation <> 'insert') AS dropped,
            (SELECT count(*) FROM traces WHERE error <> '') AS failed,
            (SELECT count(*) FROM traces) AS total,
            (SELECT count(*) FROM traces WHERE error <> '') >= 3 AS tripped"""
        ),
        "quarantine_record": statement(
            EVERYTHING,
            f"""SELECT cid AS correlation_id, cnt AS count, error AS last_error, first_seen,
            last_seen, cnt >= 3 AS became_poison FROM ({QUARANTINE})""",
        ),
        "quarantine_clear": statement(
            EVERYTHING,
            f"""SELECT cid AS correlation_id, cnt AS count FROM ({QUARANTINE})
            WHERE error <> 'invalid_meta'""",
        ),
        "documents_schema": whole(
            """SELECT cid AS correlation_id, 384::BIGINT AS dimensions FROM verdicts
            WHERE operation = 'insert'"""
        ),
        "batch_failure_gate": whole(
            f"SELECT count(*) AS failed, count(*) >= 3 AS tripped FROM ({FAILED})"
        ),
        # rows
        "parse_meta": logs_sql(
            f"""SELECT rowSeq AS row_seq,
            CASE WHEN {JSON_KIND.format('meta')} = 'OBJECT'
              THEN array_to_string(json_keys(meta), '|') ELSE '' END AS keys,
            CASE WHEN {JSON_KIND.format('meta')} = 'OBJECT'
              THEN coalesce(json_extract_string(meta, '$.k'), '') ELSE '' END AS k,
            coalesce({JSON_KIND.format('meta')} NOT IN ('OBJECT', 'NULL'), false) AS invalid
            FROM logs"""
        ),
        "parse_exception": logs_sql(
            f"""SELECT rowSeq AS row_seq,
            CASE WHEN {JSON_KIND.format('meta')} = 'OBJECT'
              THEN coalesce(json_extract_string(meta, '$.order'), '') ELSE '' END AS ord,
            coalesce({JSON_KIND.format('meta')} NOT IN ('OBJECT', 'NULL'), false) AS invalid
            FROM logs"""
        ),
        "normalize_level": logs_sql(
            f"""SELECT rowSeq AS row_seq, coalesce({LEVEL.format('level')}, '') AS level,
            CAST(coalesce({RANK.format('(' + LEVEL.format('level') + ')')}, -1) AS BIGINT) AS level_rank FROM logs"""
        ),
        "validate_trace": whole("SELECT cid AS correlation_id, error FROM traces"),
        "validate_gaps": logs_sql(
            f"""SELECT correlationId AS correlation_id, concat_ws(', ',
              CASE WHEN bool_or(rowSeq % 101 = 1 OR {LEVEL.format('level')} IS NULL) THEN 'invalid_level' END,
              CASE WHEN bool_or(rowSeq % 103 = 2) THEN 'missing_message' END,
              CASE WHEN bool_or(rowSeq % 107 = 3) THEN 'missing_logger' END,
              CASE WHEN bool_or(coalesce({JSON_KIND.format('meta')} NOT IN ('OBJECT', 'NULL'), false))
                THEN 'invalid_meta' END,
              CASE WHEN bool_or(rowSeq % 109 = 4) THEN 'invalid_exception' END) AS error,
            coalesce(CASE WHEN arg_min(rowSeq, {{'at': timestamp, 'seq': rowSeq}}) % 3 = 0
              THEN regexp_replace(strftime(min(timestamp), '%Y-%m-%d %H:%M:%S.%f'), '\\.?0+$', '') END, '')
              AS ended_at
            FROM logs GROUP BY 1"""
        ),
        "build_request": whole(
            """SELECT rs AS row_seq, coalesce(method, '') AS method, coalesce(path, '') AS path,
            CAST(coalesce(status, -1) AS BIGINT) AS status FROM rows"""
        ),
        "trace_context": whole(
            """SELECT cid AS correlation_id, pid AS project_id, pid AS project_name,
            '' AS environment, component, CAST(started AS VARCHAR) AS started_at FROM traces"""
        ),
        "log_defaults": logs_sql(
            """SELECT rowSeq AS row_seq, 'info' AS level, '' AS message,
            loggerName AS logger_name FROM logs"""
        ),
        "resolve_service": whole("SELECT rs AS row_seq, service FROM rows"),
        "normalize_timestamp": logs_sql(
            f"""SELECT rowSeq AS row_seq,
            CASE WHEN rowSeq % 17 = 0 THEN '2024-01-31T00:00:00'
              ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') END AS iso,
            CASE WHEN rowSeq % 17 = 0 THEN {AS_OF}
              ELSE CAST(floor(epoch(timestamp)) AS BIGINT) END AS unix_seconds,
            rowSeq % 17 <> 0 AS ts_valid FROM logs"""
        ),
        "request_context": whole(
            """SELECT cid AS correlation_id, coalesce(method, '') AS request_method,
            coalesce(path, '') AS request_path, CAST(coalesce(status, -1) AS BIGINT) AS request_status_code
            FROM traces"""
        ),
        "flatten_trace": whole(
            "SELECT cid AS correlation_id, pos - 1 AS row_seq, msg AS message, lvl AS level FROM rows"
        ),
        "skip_empty_traces": whole(
            """SELECT cid AS correlation_id, n AS log_count FROM traces
            WHERE extract('day' FROM first_ts) % 2 = 0"""
        ),
        "skip_poison": statement(
            EVERYTHING,
            f"""SELECT cid AS correlation_id, count(*) AS n FROM rows WHERE cid NOT IN
            (SELECT cid FROM ({QUARANTINE}) WHERE cnt >= 3) GROUP BY 1""",
        ),
        "promoted_only": whole(
            "SELECT cid AS correlation_id, tier FROM verdicts WHERE action = 'PROMOTE'"
        ),
        "dropped_only": whole(
            "SELECT cid AS correlation_id, tier FROM verdicts WHERE action = 'DROP'"
        ),
        # lookups
        "detect_partial_traces": split(
            f"""SELECT correlationId AS correlation_id, n, total FROM
            (SELECT correlationId, count(*) n FROM logs WHERE {LATE} GROUP BY 1)
            JOIN (SELECT correlationId, count(*) total FROM logs GROUP BY 1) USING (correlationId)
            WHERE total > n"""
        ),
        "refetch_without_order": logs_sql(
            f"""SELECT correlationId AS correlation_id,
            (count(*) + count(*) FILTER (rowSeq % 3 = 0))::BIGINT AS log_count,
            (count(*) FILTER ({LATE}) + count(*) FILTER ({LATE} AND rowSeq % 3 = 0))::BIGINT AS in_batch
            FROM logs GROUP BY 1 HAVING count(*) FILTER ({LATE}) > 0"""
        ),
        "refetch_partial_traces": split(
            "SELECT cid AS correlation_id, n AS log_count, is_merge FROM two_traces0"
        ),
        "fingerprint_exists": split(
            """SELECT cid AS correlation_id, EXISTS (SELECT 1 FROM two_kept k
            WHERE k.pid = v.pid AND k.fp = v.fp) AS is_stored FROM two_valid v"""
        ),
        "known_fingerprints": split(
            """SELECT pid AS project_id, pattern AS request_path_pattern, fp AS fingerprint
            FROM one_docs WHERE pattern IS NOT NULL GROUP BY ALL"""
        ),
        "fingerprint_buckets": split(
            """SELECT v.cid AS correlation_id, coalesce((SELECT arg_min(d.cid, (d.entered, d.cid)) FROM one_docs d
              WHERE d.pid = v.pid AND d.fp = v.fp), '') AS keeper FROM two_valid v"""
        ),
        "deploy_as_of_trace": whole(
            f"""SELECT cid AS correlation_id, coalesce(c.timestamp_unix, -1) AS latest_commit,
              coalesce(epoch_us(entered) - c.timestamp_unix * 1000000 <= 36000000000, false) AS in_deploy
            FROM valid v ASOF LEFT JOIN (SELECT project_id, timestamp_unix, timestamp_unix * 1000000 AS at
              FROM ({COMMIT_HISTORY_SQL})) c ON v.pid = c.project_id AND epoch_us(v.entered) >= c.at"""
        ),
        "deploy_window_join": whole("SELECT cid AS correlation_id, in_deploy FROM cand"),
        "dedup_split": split(
            """SELECT cid AS correlation_id, operation FROM two_verdicts
            WHERE action = 'PROMOTE'"""
        ),
        # aggregates
        "reassemble_traces": whole(
            """SELECT cid AS correlation_id, pid AS project_id, component, n AS log_count,
            epoch_us(first_ts) AS first_us, epoch_us(last_ts) AS last_us,
            first_msg AS first_message, last_msg AS last_message FROM traces"""
        ),
        "first_row_context": whole(
            """SELECT cid AS correlation_id, pid AS project_id, coalesce(method, '') AS request_method,
            coalesce(path, '') AS request_path, dur AS duration_ms FROM traces"""
        ),
        "bulk_count_cids": logs_sql(
            f"""SELECT correlationId AS correlation_id, count(*) AS n FROM logs
            WHERE correlationId IN (SELECT correlationId FROM {WINDOW}) GROUP BY 1"""
        ),
        "batch_row_counts": logs_sql(
            f"""SELECT correlationId AS correlation_id, count(*) AS n FROM {WINDOW} GROUP BY 1"""
        ),
        "chronological_logs": whole(
            "SELECT cid AS correlation_id, rs AS row_seq, pos AS position FROM rows"
        ),
        "tied_positions": logs_sql(
            f"""SELECT projectId AS correlation_id, rowSeq AS row_seq, row_number() OVER (PARTITION BY projectId
              ORDER BY CASE WHEN rowSeq % 2 = 0 THEN TIMESTAMP '{MID_DAY}' ELSE timestamp END, rowSeq) AS position FROM logs"""
        ),
        "services_in_order": whole(
            "SELECT cid AS correlation_id, array_to_string(services, ' > ') AS services FROM traces"
        ),
        "max_level": whole("SELECT cid AS correlation_id, max_level FROM traces"),
        "levels_present": whole(
            """SELECT cid AS correlation_id, array_to_string(levels, '|') AS levels_present
            FROM traces"""
        ),
        "error_flags": whole(
            """SELECT cid AS correlation_id, coalesce(mr >= 3, false) AS has_errors,
            warned AS has_warnings FROM traces"""
        ),
        "log_count": whole("SELECT cid AS correlation_id, n AS log_count FROM traces"),
        "error_types": whole(
            """SELECT cid AS correlation_id, array_to_string(types, '|') AS error_types
            FROM traces WHERE len(types) > 0"""
        ),
        "detect_suspicious_keywords": whole(
            """SELECT cid AS correlation_id, array_to_string(kws, '|') AS suspicious_keywords
            FROM traces WHERE len(kws) > 0"""
        ),
        "fingerprint_message": whole("SELECT cid AS correlation_id, fp_msg AS message FROM traces"),
        "occurrence_counts": whole(
            """SELECT pid AS project_id, fp AS fingerprint, count(*) AS occurrence_count
            FROM verdicts WHERE action = 'PROMOTE' GROUP BY ALL"""
        ),
        "promotion_rate": whole("SELECT action, tier, count(*) AS n FROM verdicts GROUP BY ALL"),
        "enrich_trace": whole(FEATURES),
        # gate
        "gate_severity": whole(
            """SELECT cid AS correlation_id, own AS tier FROM cand WHERE own LIKE 'tier0%'"""
        ),
        "gate_content": whole(
            """SELECT cid AS correlation_id, own AS tier FROM cand WHERE own LIKE 'tier1%'"""
        ),
        "gate_cold_start": whole(
            """SELECT cid AS correlation_id, pid AS project_id, tier, operation FROM verdicts
            WHERE tier LIKE 'tier5%'"""
        ),
        "gate_deploy_window": _tier("tier2"),
        "gate_new_fingerprint": _tier("tier3"),
        "gate_default": _tier("default"),
        "gatekeeper": whole(
            "SELECT cid AS correlation_id, pid AS project_id, action, tier, operation FROM verdicts"
        ),
        "gatekeeper_without_store": whole(
            """SELECT cid AS correlation_id, coalesce(own, 'default') AS tier,
            CASE WHEN own IS NULL THEN 'DROP' ELSE 'PROMOTE' END AS action,
            CASE own
              WHEN 'tier0_severity' THEN 'severity_score=' || severity || ' >= 7'
              WHEN 'tier0_outcome' THEN 'outcome=' || outcome
              WHEN 'tier0_has_errors' THEN 'trace contains ERROR/FATAL logs'
              WHEN 'tier1_error_types'
                THEN 'error_types detected: [''' || array_to_string(types, ''', ''') || ''']'
              WHEN 'tier1_keywords'
                THEN 'suspicious keywords: [''' || array_to_string(kws, ''', ''') || ''']'
              ELSE 'healthy_traffic — no promotion criteria met' END AS reason FROM cand"""
        ),
        "gatekeeper_with_store": _tier(""),
        "verdict": split(
            """SELECT cid AS correlation_id, action, tier, reason, action = 'PROMOTE' AS is_promote
            FROM two_verdicts"""
        ),
        # scalar functions
        "normalize_message": whole(
            f"SELECT rs AS row_seq, {TEMPLATE.format('msg')} AS template FROM rows"
        ),
        "extract_error_type": whole(
            "SELECT rs AS row_seq, coalesce(et, '') AS error_type FROM rows"
        ),
        "has_suspicious_keywords": whole(
            "SELECT rs AS row_seq, len(kws) > 0 AS suspicious FROM rows"
        ),
        "classify_outcome": whole("SELECT cid AS correlation_id, outcome FROM valid"),
        "trace_severity": whole(
            "SELECT cid AS correlation_id, CAST(severity AS BIGINT) AS severity_score FROM valid"
        ),
        "normalize_request_path": whole(
            """SELECT coalesce(path, '') AS request_path, coalesce(pattern, '') AS pattern,
            count(*) AS n FROM traces GROUP BY ALL"""
        ),
        "trace_fingerprint": whole("SELECT cid AS correlation_id, fp AS fingerprint FROM valid"),
        "normalize_for_dedup": whole(
            f"SELECT rs AS row_seq, {DEDUP.format('msg')} AS norm FROM rows"
        ),
        "http_operation": whole(
            """SELECT cid AS correlation_id, coalesce(CASE
              WHEN method <> '' THEN trim(method || ' ' || coalesce(pattern, path, ''))
              WHEN dur IS NOT NULL THEN 'Trace executed' END, '') AS operation FROM valid"""
        ),
        "meta_context": whole(
            "SELECT cid AS correlation_id, entry AS line FROM entries"
        ),
        "service_flow": whole(
            """SELECT cid AS correlation_id, CASE WHEN len(services) > 1
              THEN 'Flow: ' || array_to_string(services, ' → ')
              ELSE 'Service: ' || services[1] END AS flow FROM valid"""
        ),
        "dedup_messages": whole("SELECT cid AS correlation_id, line FROM lines"),
        "outcome_line": whole(
            """SELECT cid AS correlation_id, 'Outcome: '
              || concat_ws(', ', replace(outcome, '_', ' '), status, dur || 'ms') AS line
            FROM valid"""
        ),
        "semantic_text": whole(
            "SELECT cid AS correlation_id, semantic_text FROM texts JOIN valid USING (cid)"
        ),
        "semantic_text_pieces": whole(
            """SELECT cid AS correlation_id, piece::BIGINT AS piece, substr(semantic_text, piece * 100 + 1, 100) AS text,
              least((piece + 1) * 100, length(semantic_text))::BIGINT AS chars
            FROM (SELECT cid, semantic_text, unnest(range((length(semantic_text) + 99) // 100)) AS piece
              FROM texts JOIN valid USING (cid))
            UNION ALL SELECT cid, -1, semantic_text, length(semantic_text)
            FROM texts JOIN valid USING (cid) WHERE length(semantic_text) <= 400"""
        ),
        "semantic_text_budget": statement(
            BUDGET, "SELECT cid AS correlation_id, semantic_text FROM texts"
        ),
        "vector_metadata": whole(
            """SELECT cid AS correlation_id, pid AS project_id, pid AS project_name,
            coalesce(method, '') AS request_method, coalesce(path, '') AS request_path,
            coalesce(pattern, '') AS request_path_pattern,
            CAST(coalesce(status, -1) AS BIGINT) AS request_status_code,
            array_to_string(services, ' > ') AS services, max_level, outcome,
            CAST(severity AS BIGINT) AS severity_score, fp AS fingerprint,
            mr >= 3 AS has_errors, warned AS has_warnings, n AS log_count,
            array_to_string(levels, '|') AS levels_present,
            array_to_string(types, '|') AS error_types, len(types) = 0 AS no_error_types,
            array_to_string(kws, '|') AS suspicious_keywords, len(kws) = 0 AS no_keywords, '' AS environment,
            dur AS duration_ms, CAST(floor(epoch(first_ts)) AS BIGINT) AS timestamp_unix,
            CAST(floor(epoch(first_ts)) AS BIGINT) AS last_seen, 1::BIGINT AS occurrence_count FROM valid"""
        ),
        "trace_documents": whole(new_documents.format("")),
        # streaming
        "stream_ingest": whole(_documents("")),
        "resume_point": split(
            """SELECT 0::BIGINT AS batch_id,
              (SELECT count(*) FROM one_verdicts WHERE operation = 'insert') AS promoted,
              (SELECT count(*) FROM one_verdicts WHERE operation <> 'insert') AS dropped,
              (SELECT count(*) FROM one_traces WHERE error <> '') AS failed
            UNION ALL SELECT 1,
              (SELECT count(*) FROM two_verdicts WHERE operation = 'insert'),
              (SELECT count(*) FROM two_verdicts WHERE operation <> 'insert'),
              (SELECT count(*) FROM two_traces WHERE error <> '')"""
        ),
        "bounded_drain": logs_sql(
            f"""SELECT correlationId AS correlation_id, count(*) AS n,
            (SELECT count(*) FROM logs WHERE {LATE}) AS waiting FROM logs
            WHERE {EARLY} GROUP BY 1"""
        ),
        "admission_limits": logs_sql(
            """SELECT batch_id, count(*) AS total, count(*) AS traces, sum(n)::BIGINT AS log_rows FROM (
              SELECT correlationId, count(*) AS n, CASE WHEN min(timestamp) < TIMESTAMP '2024-01-11' THEN 0
                WHEN min(timestamp) < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END::BIGINT AS batch_id
              FROM logs GROUP BY 1) GROUP BY 1"""
        ),
        "trace_state": logs_sql("SELECT correlationId AS correlation_id, count(*) AS n FROM logs GROUP BY 1"),
        "session_windows": logs_sql(
            f"""SELECT correlation_id, min(epoch_us(timestamp)) AS start_us,
              max(epoch_us(timestamp)) + 7200000000 AS end_us, count(*) AS log_count,
              count(*) FILTER (rnk >= 3) AS errors
            FROM (SELECT *, correlationId AS correlation_id, {RANK.format("lvl")} AS rnk, sum(begins) OVER (
                PARTITION BY correlationId ORDER BY timestamp, rowSeq ROWS UNBOUNDED PRECEDING) AS nth
              FROM (SELECT *, {LEVEL.format("level")} AS lvl, CASE WHEN timestamp - lag(timestamp) OVER (
                  PARTITION BY correlationId ORDER BY timestamp, rowSeq) <= INTERVAL 2 HOURS THEN 0 ELSE 1 END AS begins
                FROM logs WHERE NOT (timestamp < TIMESTAMP '2024-01-03' AND rowSeq % 2 = 1)))
            GROUP BY correlation_id, nth
            HAVING max(timestamp) + INTERVAL 2 HOURS <= (SELECT max(timestamp) - INTERVAL 12 HOURS FROM logs)"""
        ),
        "nested_stream": statement(
            STANDALONE,
            """SELECT cid AS correlation_id, '' AS error, n AS log_count FROM valid
            UNION ALL SELECT '{"correlationId": "cut off', 'invalid_json', 0""",
        ),
        "group_by_project": logs_sql(
            """SELECT projectId || '/' || strftime(timestamp, '%Y-%m-%d') AS correlation_id, projectId AS project_id,
              count(*) AS log_count, arg_min(message, (timestamp, rowSeq)) AS first_message FROM logs GROUP BY ALL"""
        ),
        "model_embeddings": whole(
            """SELECT cid AS correlation_id, array_to_string(list_transform(range(97, 123), lambda c:
              length(lower(semantic_text)) - length(replace(lower(semantic_text), chr(c::INTEGER), ''))), ',') AS counts
            FROM texts JOIN verdicts USING (cid) WHERE operation = 'insert'"""
        ),
        "halted_batch": whole(
            f"SELECT cid AS correlation_id, error, 0::BIGINT AS written FROM ({FAILED})"
        ),
        "merge_on_duplicate": split(_documents("two_")),
        "late_rows": statement(REVERSED, _documents("two_")),
        "idempotent_replay": split(_documents("two_")),
        # embeddings
        "embed_documents": whole(
            r"""SELECT cid AS correlation_id, 384::BIGINT AS dimensions,
            string_agg(bucket || ':' || c, ' ' ORDER BY bucket) AS content FROM (
              SELECT cid, CAST(('0x' || substr(md5(word), 1, 8))::UBIGINT % 384 AS BIGINT) AS bucket,
                count(*) AS c
              FROM (SELECT cid, unnest(string_split_regex(lower(semantic_text), '\s+')) AS word
                FROM texts JOIN verdicts USING (cid) WHERE operation = 'insert')
              WHERE word <> '' GROUP BY ALL) GROUP BY cid"""
        ),
    }
