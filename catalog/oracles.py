"""Checking SQL for every registered query, written from the rules of the data model."""

from __future__ import annotations

from catalog.sample_log import check_log_sql

# Unicode white space, as code points.
SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
WS = "||".join(f"chr({c})" for c in SPACE)

TYPED = f"""
log AS ({check_log_sql()}),
docs AS (SELECT *, TRY_CAST(payload AS JSON) AS j FROM log),
kinds AS (
  SELECT *, json_type(j) AS root,
    coalesce(json_type(j, '$.user_id'), 'NULL') AS user_kind,
    coalesce(json_type(j, '$.event_type'), 'NULL') AS type_kind,
    coalesce(json_type(j, '$.trace_id'), 'NULL') AS trace_kind,
    coalesce(json_type(j, '$.value'), 'NULL') AS value_kind,
    json_type(j, '$.timestamp') AS time_kind,
    arrived_us // 1000000 AS arrived
  FROM docs),
fields AS (
  SELECT *,
    coalesce(root = 'OBJECT' AND user_kind IN ('NULL', 'VARCHAR') AND type_kind IN ('NULL', 'VARCHAR')
      AND trace_kind IN ('NULL', 'VARCHAR')
      AND value_kind IN ('NULL', 'BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE'), false) AS well,
    coalesce(j->>'$.user_id', '') AS user_id,
    coalesce(j->>'$.event_type', '') AS event_type,
    coalesce(TRY_CAST(j->>'$.value' AS DOUBLE), 0) AS value,
    trim(coalesce(j->>'$.trace_id', ''), {WS}) AS trace,
    CASE WHEN time_kind = 'VARCHAR' THEN trim(j->>'$.timestamp', {WS})
         WHEN time_kind IN ('BIGINT', 'UBIGINT') THEN j->>'$.timestamp' END AS time_text
  FROM kinds),
times AS (
  SELECT *,
    CASE WHEN regexp_full_match(time_text, '[+-]?[0-9]+') THEN TRY_CAST(time_text AS BIGINT) END AS n,
    CASE WHEN regexp_full_match(time_text,
        '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]+)?(Z|[+-][0-9]{{2}}:[0-9]{{2}})')
      THEN floor(epoch(TRY_CAST(time_text AS TIMESTAMPTZ)))::BIGINT END AS moment
  FROM fields),
parsed AS (
  SELECT part AS "partition", off AS "offset", sender, payload, arrived_us, arrived,
    user_id, event_type, value,
    CASE WHEN n > 10000000000000000 THEN n // 1000000000 WHEN n > 100000000000000 THEN n // 1000000
         WHEN n > 100000000000 THEN n // 1000 WHEN n IS NOT NULL THEN n
         ELSE coalesce(moment, arrived) END AS "timestamp",
    CASE WHEN trace <> '' THEN trace
         ELSE substr(sha256(topic || ':' || part || ':' || off), 1, 32) END AS trace_id,
    CASE WHEN payload = '' THEN 'empty' WHEN NOT well THEN 'malformed'
         WHEN trim(user_id, {WS}) = '' THEN 'missing user_id'
         WHEN trim(event_type, {WS}) = '' THEN 'missing event_type'
         WHEN isnan(value) OR abs(value) > 99999999.99 THEN 'out of range' END AS reject_reason
  FROM times),
valid AS (SELECT * FROM parsed WHERE reject_reason IS NULL)
"""


def recursion(
    rows: str, name: str = "r", mult: float = 1.5, fallback: float = 1000, n: int = 10, idle=None
) -> str:
    """CTEs that score ``rows`` (id, u, val, ins, t, and rn counting from 1 per user) one by one."""
    window = "r.w" if idle is None else f"CASE WHEN o.t - r.t >= {idle} THEN []::DOUBLE[] ELSE r.w END"
    return f"""
{name}_o AS ({rows}),
{name} AS (
  SELECT DISTINCT u, 0::BIGINT AS rn, NULL::BIGINT AS id, NULL::BIGINT AS t, NULL::DOUBLE AS av,
    NULL::BOOLEAN AS an, []::DOUBLE[] AS w FROM {name}_o
  UNION ALL
  SELECT u, rn, id, t, av, an, CASE WHEN an OR NOT ins THEN w ELSE list_prepend(val, w)[1:{n}] END
  FROM (
    SELECT u, rn, id, t, val, ins, w, list_avg(w) AS av,
      CASE WHEN list_avg(w) > 0 THEN val > list_avg(w) * {mult} ELSE val > {fallback} END AS an
    FROM (SELECT o.u, o.rn, o.id, o.t, o.val, o.ins, {window} AS w
          FROM {name} r JOIN {name}_o o ON o.u = r.u AND o.rn = r.rn + 1) AS met) AS scored)
"""


def event_rows(user: str = "user_id", value: str = "value") -> str:
    return f"""SELECT event_id AS id, {user} AS u, {value} AS val, true AS ins, epoch_us(ts) AS t,
      row_number() OVER (PARTITION BY {user} ORDER BY ts, event_id) AS rn FROM events"""


def event_scores(user: str = "user_id", value: str = "value", **rules) -> str:
    return f"""WITH RECURSIVE {recursion(event_rows(user, value), **rules)}
SELECT id AS event_id, u AS user_id, av AS rolling_avg, an AS is_anomaly FROM r WHERE rn > 0"""


CROWD = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END"


def processed(condition: str = "true", idle=None, clock: str = "arrived_us") -> str:
    """CTEs up to ``scored`` (one row per valid event) and ``audit`` of the whole job."""
    rows = f"""SELECT "offset" AS id, user_id AS u, value AS val, inserted AS ins, {clock} AS t,
      row_number() OVER (PARTITION BY user_id ORDER BY "offset", "partition") AS rn FROM flagged"""
    return f"""{TYPED},
flagged AS (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY "offset", "partition") = 1 AS inserted
  FROM valid WHERE {condition}),
{recursion(rows, idle=idle)},
scored AS (SELECT f.*, r.av AS rolling_avg, r.an AS is_anomaly
  FROM flagged f JOIN r ON r.rn > 0 AND r.id = f."offset"),
audit AS (SELECT user_id, event_type, CAST(CAST(value AS VARCHAR) AS DECIMAL(10,2)) AS event_value,
    CAST(CAST(rolling_avg AS VARCHAR) AS DECIMAL(10,2)) AS rolling_avg, is_anomaly, trace_id,
    make_timestamp(CASE WHEN "timestamp" > 0 THEN "timestamp" ELSE arrived END * 1000000) AS event_timestamp,
    make_timestamp(arrived_us) AS ingested_at
  FROM scored WHERE inserted)
"""


_AUDIT = """SELECT user_id, event_type, event_value::DOUBLE AS event_value, rolling_avg::DOUBLE AS rolling_avg,
  is_anomaly, trace_id, event_timestamp FROM audit"""
AUDIT_ROWS = f"WITH RECURSIVE {processed()}\n{_AUDIT}"
AUDIT_ROWS_IDLE = f"WITH RECURSIVE {processed(idle=12 * 3600 * 1000000, clock='"offset" * 300000000')}\n{_AUDIT}"

ALERTS = """SELECT user_id, event_type, value AS event_value, is_anomaly, trace_id,
  CASE WHEN "timestamp" > 0 THEN "timestamp" ELSE arrived END AS "timestamp"
FROM scored WHERE inserted AND is_anomaly"""

LOSS = processed('"partition" <> 3')


def percentiles(source: str, column: str, probs: list[float]) -> str:
    parts = [
        f"SELECT {p}::DOUBLE AS p, round(quantile_cont({column}, {p}), 6) AS value FROM {source}"
        for p in probs
    ]
    return " UNION ALL ".join(parts)


def preceding(user: str) -> str:
    return f"""SELECT event_id, {user} AS user_id, round(avg(value) OVER (PARTITION BY {user}
  ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 6) AS preceding_avg FROM events"""


INGEST_SUMMARY = f"""WITH RECURSIVE {processed()}
SELECT count(*) AS events, min(ingested_at) AS first_at, max(ingested_at) AS last_at,
  round(count(*) / (epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) * 1e6, 9) AS per_second
FROM audit"""
NEW_ONLY = f"""WITH {TYPED}
SELECT "partition", "offset", trace_id FROM valid
WHERE trace_id NOT IN (SELECT trace_id FROM valid WHERE "partition" <> 3)"""
FIRST_HALF = '"offset" < (SELECT max("offset") // 2 FROM parsed)'


def sinks(condition: str = "true") -> str:
    """Rows of the reject, response and alert tables."""
    return f"""SELECT 'rejects' AS sink, "partition" || ':' || "offset" AS row_key, reject_reason AS detail
FROM parsed WHERE reject_reason IS NOT NULL AND {condition}
UNION ALL SELECT 'responses', trace_id, CASE WHEN is_anomaly THEN 'true' ELSE 'false' END FROM scored
UNION ALL SELECT 'alerts', trace_id, user_id || '/' || event_type FROM ({ALERTS}) AS raised"""


KEYED_ROWS = """SELECT event_id AS id, user_id AS u, value AS val, epoch_us(ts) AS t,
  trace_id = '' OR row_number() OVER (PARTITION BY trace_id ORDER BY ts, event_id) = 1 AS ins,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
FROM (SELECT *, CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 3 = 0 THEN 'copied'
        ELSE 'k' || (event_id % 1000) END AS trace_id FROM events) AS keyed"""

ORACLES = {
    "surge_scores": event_scores(),
    "surge_scores_low_fallback": event_scores(mult=3.0, fallback=100, n=5),
    "surge_scores_shifted": event_scores(value="value - 50", fallback=20),
    "surge_scores_hot_user": event_scores(user=CROWD),
    "surge_scores_hot_two_levels": event_scores(
        user=CROWD,
        value="CASE WHEN event_id % 20 = 0 OR ts < TIMESTAMP '2024-01-02' THEN 100.0 ELSE 160.0 END::DOUBLE",
    ),
    "surge_scores_resumed": event_scores(),
    "idle_reset_scores": event_scores(idle=12 * 3600 * 1000000),
    "idle_reset_resumed": event_scores(idle=12 * 3600 * 1000000),
    "preceding_avg": preceding("user_id"),
    "preceding_avg_hot_user": preceding(CROWD),
    "static_scores": """SELECT event_id, user_id, NULL::DOUBLE AS rolling_avg, value > 100 AS is_anomaly
FROM events""",
    "window_snapshot": f"""WITH RECURSIVE {recursion(event_rows())},
last AS (SELECT u, w FROM r QUALIFY row_number() OVER (PARTITION BY u ORDER BY rn DESC) = 1)
SELECT u AS user_id, len(w)::BIGINT AS kept, w[1] AS newest, w[-1] AS oldest,
  round(list_avg(w), 6) AS window_avg FROM last WHERE len(w) > 0""",
    "parsed_events": f"""WITH {TYPED}
SELECT "partition", "offset", user_id, event_type, value, "timestamp", trace_id FROM valid""",
    "rejects": f"""WITH {TYPED}
SELECT "partition", "offset", payload, reject_reason FROM parsed WHERE reject_reason IS NOT NULL""",
    "reject_summary": f"""WITH {TYPED}
SELECT reject_reason, "partition", count(*) AS rejects FROM parsed WHERE reject_reason IS NOT NULL
GROUP BY ALL""",
    "first_wins": f"""WITH {TYPED}
SELECT "partition", "offset", trace_id,
  row_number() OVER (PARTITION BY trace_id ORDER BY "offset", "partition") = 1 AS inserted FROM valid""",
    "first_wins_hot_key": """SELECT event_id, trace_id,
  trace_id = '' OR row_number() OVER (PARTITION BY trace_id ORDER BY ts, event_id) = 1 AS inserted
FROM (SELECT *, CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 3 = 0 THEN 'copied'
        ELSE 'k' || (event_id % 1000) END AS trace_id FROM events) AS keyed""",
    "new_only": NEW_ONLY,
    "process_responses": f"""WITH RECURSIVE {processed()}
SELECT "partition", "offset", trace_id, inserted, is_anomaly FROM scored""",
    "response_rows": f"""WITH RECURSIVE {processed()}
SELECT trace_id, true AS success, 'event processed successfully' AS message, arrived AS processed_at,
  is_anomaly FROM scored""",
    "fallback_key": "SELECT count(*) AS events, count(*) AS keys, count(*) AS well_formed FROM events",
    "repartition_by_key": f"""WITH log AS ({check_log_sql()})
SELECT sender AS key, 1::BIGINT AS places, count(*) AS messages FROM log GROUP BY sender""",
    "audit_rows": AUDIT_ROWS,
    "alerts": f"WITH RECURSIVE {processed()} {ALERTS}",
    "alert_records": f"""WITH RECURSIVE {processed()}
SELECT true AS alert, 'anomaly' AS alert_type, user_id, event_type, event_value AS value, trace_id,
  "timestamp" FROM ({ALERTS}) AS raised""",
    "text_list_avg": """SELECT event_id, round(list_avg(list_filter(
    [TRY_CAST(t AS DOUBLE) FOR t IN texts], lambda d: isfinite(d))), 6) AS text_avg
FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN []::VARCHAR[] ELSE [
    CASE WHEN event_id % 3 = 0 THEN 'NaN' ELSE CAST(value AS VARCHAR) END,
    CASE WHEN event_id % 5 = 0 THEN 'bad1' ELSE '-Inf' END,
    CASE WHEN event_id % 4 = 0 THEN 'Inf' ELSE '2.5e1' END] END AS texts FROM events) AS lists""",
    "ingest_summary": INGEST_SUMMARY,
    "latency_percentiles": f"""WITH {TYPED},
delays AS (SELECT (arrived_us - "timestamp" * 1000000) / 1e6 AS delay FROM valid)
{percentiles("delays", "delay", [0.5, 0.95, 0.99])}""",
    "value_percentiles": percentiles("events", "value", [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]),
    "event_counts": f"""WITH RECURSIVE {processed()}
SELECT user_id, event_type, count(*) AS events FROM audit GROUP BY ALL""",
    "recovery_time": f"""WITH RECURSIVE {processed()}
SELECT min(ingested_at) AS first_row_at,
  round((epoch_us(min(ingested_at)) - epoch_us(TIMESTAMP '2024-01-10')) / 1e6, 6) AS recovery_seconds
FROM audit WHERE ingested_at > TIMESTAMP '2024-01-10'""",
    "lookup_trace": f"""WITH RECURSIVE {processed()}
SELECT trace_id, user_id, event_type, is_anomaly FROM audit WHERE trace_id = 'shared-view'""",
    "lookup_user": f"""WITH RECURSIVE {processed()}
SELECT trace_id, user_id, event_type, is_anomaly FROM audit WHERE user_id = '7' AND event_type = 'click'""",
    "no_baseline": f"""WITH RECURSIVE {processed()}
SELECT trace_id, user_id, event_type, is_anomaly FROM audit WHERE rolling_avg IS NULL""",
    "affinity_violations": f"""WITH log AS ({check_log_sql()})
SELECT sender AS key, count(DISTINCT part) AS partitions FROM log GROUP BY sender
HAVING count(DISTINCT part) > 1""",
    "missing_events": f"""WITH RECURSIVE {LOSS}
SELECT "partition", "offset", trace_id FROM valid WHERE trace_id NOT IN (SELECT trace_id FROM audit)""",
    "completeness": f"""WITH RECURSIVE {LOSS}
SELECT event_type, count(*) AS published, count(a.trace_id) AS persisted,
  count(*) - count(a.trace_id) AS missing
FROM (SELECT DISTINCT event_type, trace_id FROM valid) v
LEFT JOIN (SELECT trace_id FROM audit) a ON a.trace_id = v.trace_id GROUP BY event_type""",
    "replay_report": f"""WITH {TYPED},
n AS (SELECT count(DISTINCT trace_id) AS n FROM valid)
SELECT n AS rows_before, n AS rows_after, 0::BIGINT AS added, 0::BIGINT AS lost FROM n""",
    "diff_scores": f"""WITH RECURSIVE {recursion(event_rows(), "a")}, {recursion(event_rows(), "b", mult=2.0)},
x AS (SELECT id, an FROM a WHERE rn > 0), y AS (SELECT id, an FROM b WHERE rn > 0)
SELECT id AS event_id, an AS is_anomaly, 1::BIGINT AS surplus FROM (FROM x EXCEPT ALL FROM y)
UNION ALL
SELECT id, an, -1::BIGINT FROM (FROM y EXCEPT ALL FROM x)""",
    "correlate": f"""WITH RECURSIVE {LOSS}
SELECT v."partition", v."offset", v.trace_id AS idempotency_key, a.trace_id IS NOT NULL AS persisted,
  a.is_anomaly FROM valid v LEFT JOIN audit a ON a.trace_id = v.trace_id""",
    "history_range": f"""WITH log AS ({check_log_sql()})
SELECT part AS "partition", off AS "offset", sender AS key, payload AS value FROM log
WHERE off >= 4 * part
  AND off < CASE part WHEN 0 THEN 400 WHEN 1 THEN 4000 WHEN 2 THEN 400000 ELSE off + 1 END""",
    "keyed_messages": """SELECT CAST(user_id AS VARCHAR) AS key, '{"user_id":"' || user_id ||
  '","event_type":"' || event_type || '","value":' || CAST(value AS VARCHAR) || '}' AS value
FROM events""",
    "stream_scores": event_scores(),
    "stream_scores_copies": event_scores(),
    "live_audit_rows": AUDIT_ROWS,
    "live_new_run": AUDIT_ROWS,
    "live_idle_reset": AUDIT_ROWS_IDLE,
    "live_sinks": f"WITH RECURSIVE {processed()}\n{sinks()}",
    "live_commit_record": f"""WITH RECURSIVE {processed(FIRST_HALF)}
{sinks(FIRST_HALF)}
UNION ALL SELECT 'audit', trace_id, CASE WHEN is_anomaly THEN 'true' ELSE 'false' END FROM audit""",
    "live_failed_batch": AUDIT_ROWS,
    "live_merged_audit": AUDIT_ROWS,
    "ingest_summary_recorded": INGEST_SUMMARY,
    "new_only_bucketed": NEW_ONLY,
    "stream_first_wins": f"""WITH RECURSIVE {recursion(KEYED_ROWS, idle=12 * 3600 * 1000000)}
SELECT r.id AS event_id, r.u AS user_id, r.av AS rolling_avg, r.an AS is_anomaly, o.ins AS inserted
FROM r JOIN r_o o ON o.id = r.id WHERE r.rn > 0""",
    "latency_percentiles_recorded": f"""WITH RECURSIVE {processed()}
SELECT p, count(*) AS events, true AS within_bound
FROM audit CROSS JOIN (SELECT unnest([0.5, 0.95, 0.99])::DOUBLE AS p) AS asked GROUP BY p""",
    "stream_idle_scores": event_scores(idle=12 * 3600 * 1000000),
}
