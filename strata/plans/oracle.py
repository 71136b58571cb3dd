"""DuckDB SQL for each registered query, written independently of the Spark
code from the driver tables (views ``events`` etc.). Used as the
correctness oracle; column names and types match the Spark results."""

from __future__ import annotations

from strata.functions.rules import load_rules
from strata.schemas import ID_FIELDS, METRIC_FIELDS

# Event rows from the driver table, same mapping as strata.sources.events
# (fixed values), and the Silver (filled) form.
_ROWS = """
ev AS (
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
),
flat AS (
    SELECT 'e' || CAST(event_id AS VARCHAR) AS event_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS "timestamp",
           event_type,
           'device_' || CAST(user_id AS VARCHAR) AS source,
           CASE WHEN event_type = 'error' THEN 'error'
                WHEN event_id % 3 = 0 THEN 'pending'
                ELSE 'completed' END AS status,
           CAST(k AS DOUBLE) * 110.0 AS distance,
           value - 50 AS temperature,
           CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS amount,
           k * 1000 AS duration,
           CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'Normal' END AS note,
           date_trunc('millisecond', ts) AS event_ts
    FROM ev
),
silver AS (
    SELECT event_id, "timestamp", event_type, source, status,
           coalesce(distance, 0.0) AS distance,
           coalesce(temperature, 0.0) AS temperature,
           coalesce(amount, 0.0) AS amount,
           coalesce(duration, 0) AS duration,
           coalesce(note, '') AS note,
           event_ts
    FROM flat
),
gold AS (
    SELECT CAST(date_trunc('hour', event_ts) AS DATE) AS date_hour,
           CAST(hour(event_ts) AS INTEGER) AS hour,
           date_trunc('hour', event_ts) AS window_start,
           event_type, source, status,
           count(event_id) AS event_count,
           avg(distance) AS avg_distance,
           avg(temperature) AS avg_temperature,
           avg(amount) AS avg_amount,
           avg(duration) AS avg_duration,
           min(distance) AS min_distance, max(distance) AS max_distance,
           min(temperature) AS min_temperature, max(temperature) AS max_temperature,
           min(amount) AS min_amount, max(amount) AS max_amount,
           min(duration) AS min_duration, max(duration) AS max_duration
    FROM silver
    WHERE event_ts IS NOT NULL
    GROUP BY date_trunc('hour', event_ts), hour(event_ts), event_type, source, status
)"""

_GOLD_COLS = """date_hour, hour, event_type, source, status, event_count,
       round(avg_distance, 6) AS avg_distance, round(avg_temperature, 6) AS avg_temperature,
       round(avg_amount, 6) AS avg_amount, round(avg_duration, 6) AS avg_duration,
       min_distance, max_distance, min_temperature, max_temperature,
       min_amount, max_amount, min_duration, max_duration"""

# The rows of records with faults, as strata.sources.events.faulty_records
# makes them: ``flat`` holds what a permissive parse leaves of each record.
_FAULTY_ROWS = _ROWS.replace("flat AS (", "clean AS (", 1).replace(
    "silver AS (",
    """flat AS (
    SELECT CASE WHEN cut THEN NULL ELSE event_id END AS event_id,
           CASE WHEN cut OR n % 23 = 3 AND n % 19 <> 2 THEN NULL WHEN n % 19 = 2 THEN 'not a time' ELSE "timestamp" END AS "timestamp",
           CASE WHEN cut THEN NULL ELSE event_type END AS event_type,
           CASE WHEN cut THEN NULL ELSE source END AS source,
           CASE WHEN cut THEN NULL ELSE status END AS status,
           CASE WHEN cut THEN NULL ELSE distance END AS distance,
           CASE WHEN cut THEN NULL ELSE temperature END AS temperature,
           CASE WHEN cut OR n % 29 = 4 THEN NULL WHEN n % 31 = 5 THEN -5.0 ELSE amount END AS amount,
           CASE WHEN cut THEN NULL ELSE duration END AS duration,
           CASE WHEN cut THEN NULL ELSE note END AS note,
           CASE WHEN cut OR n % 23 = 3 OR n % 19 = 2 THEN NULL ELSE event_ts END AS event_ts
    FROM (SELECT *, n % 17 = 1 AS cut FROM (SELECT *, CAST(substr(event_id, 2) AS BIGINT) AS n FROM clean)),
         (VALUES (1), (2)) AS delivery(number)
    WHERE number = 1 OR n % 13 = 0
),
silver AS (""",
    1,
)

# Metric lines derived from events (same mapping as
# strata.sources.metrics.metrics_lines_from_events); the extra unparsable
# lines are dropped by the reader, so they do not appear here.
_LINES = """
ev AS (
    SELECT event_id, ts, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events
),
lines AS (
    SELECT CASE WHEN event_id % 50 = 0 THEN CAST(0 AS BIGINT)
                ELSE CAST(epoch(date_trunc('minute', ts)) AS BIGINT) END AS ts,
           CASE event_id % 4 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' WHEN 2 THEN 'gold' END AS layer,
           event_id AS batch_id,
           CASE WHEN event_id % 11 = 0 THEN NULL ELSE k END AS row_count,
           CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'batch failed: ' || event_type
                WHEN event_id % 5 = 0 THEN '' END AS error
    FROM ev
)"""


# JSON text of each event as Spark's to_json writes it: fields in schema
# order, NULL fields left out, doubles in shortest round-trip form.
_JSON = r"""
WITH ev AS (
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
)
SELECT 'e' || CAST(event_id AS VARCHAR) AS key,
       '{"event_id":"e' || CAST(event_id AS VARCHAR) || '"'
       || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"'
       || ',"event_type":"' || event_type || '"'
       || ',"source":"device_' || CAST(user_id AS VARCHAR) || '"'
       || ',"status":"' || CASE WHEN event_type = 'error' THEN 'error'
                                WHEN event_id % 3 = 0 THEN 'pending'
                                ELSE 'completed' END || '"'
       || ',"metrics":{"distance":' || CAST(CAST(k AS DOUBLE) * 110.0 AS VARCHAR)
       || ',"temperature":' || CAST(value - 50 AS VARCHAR)
       || CASE WHEN event_id % 10 = 0 THEN '' ELSE ',"amount":' || CAST(value AS VARCHAR) END
       || ',"duration":' || CAST(k * 1000 AS VARCHAR) || '}'
       || ',"extra":{' || CASE WHEN event_id % 7 = 0 THEN '' ELSE '"note":"Normal"' END || '}}' AS value
FROM ev"""


def _rule_sql(rules) -> list[tuple[str, float | None, float | None, str]]:
    out = []
    for field, spec in (rules.get("numeric_ranges") or {}).items():
        lo, hi = (spec or {}).get("min"), (spec or {}).get("max")
        parts = []
        if lo is not None:
            parts.append(f"{field} < {lo}")
        if hi is not None:
            parts.append(f"{field} > {hi}")
        out.append((field, lo, hi, " OR ".join(parts) or "FALSE"))
    return out


def _num(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({v} AS DOUBLE)"


def build() -> dict[str, str]:
    rules = _rule_sql(load_rules())
    gold = f"WITH {_ROWS}\nSELECT {_GOLD_COLS}\nFROM gold"
    flat_cols = 'event_id, "timestamp", event_type, source, status, distance, temperature, amount, duration, note'
    kpi = """WITH {rows}
SELECT event_type, CAST(sum(event_count) AS BIGINT) AS total_events,
       {avgs}
FROM gold GROUP BY event_type ORDER BY total_events DESC, event_type"""
    three = [f"round(avg(avg_{m}), 2) AS avg_{m}" for m in ("distance", "temperature", "amount")]
    four = three + ["round(avg(avg_duration), 2) AS avg_duration"]
    weighted = [
        f"round(sum(avg_{m} * event_count) / sum(event_count), 2) AS avg_{m}"
        for m in ("distance", "temperature", "amount", "duration")
    ]
    report = "\nUNION ALL\n".join(
        f"SELECT '{f}' AS field, {_num(lo)} AS min, {_num(hi)} AS max, "
        f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS out_of_range FROM flat"
        for f, lo, hi, cond in rules
    )
    quarantine = "\nUNION ALL\n".join(
        f"SELECT {flat_cols}, '{f}' AS rule FROM silver WHERE {cond}" for f, _, _, cond in rules
    )
    per_layer = " + ".join(f"count(*) FILTER (WHERE {cond})" for _, _, _, cond in rules)
    sql = {
        "events_to_json": _JSON,
        "bronze_parse": f"WITH {_ROWS}\nSELECT {flat_cols} FROM flat",
        "silver_flatten": f"WITH {_ROWS}\nSELECT {flat_cols} FROM silver",
        "gold_hourly": gold,
        "total_events": f"WITH {_ROWS}\nSELECT CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total_events FROM gold",
        "kpis_by_event_type": kpi.format(rows=_ROWS, avgs=",\n       ".join(three)),
        "kpis_by_event_type_full": kpi.format(rows=_ROWS, avgs=",\n       ".join(four)),
        "kpis_by_event_type_weighted": kpi.format(rows=_ROWS, avgs=",\n       ".join(weighted)),
        "hourly_volume": f"WITH {_ROWS}\nSELECT hour, CAST(sum(event_count) AS BIGINT) AS events "
        "FROM gold GROUP BY hour ORDER BY hour",
        "quality_report": f"WITH {_ROWS}\n{report}",
        "quarantine_rows": f"WITH {_ROWS}\n{quarantine}",
        "duplicate_count": f"WITH {_ROWS}\nSELECT CAST(count(*) AS BIGINT) AS total, "
        "CAST(count(DISTINCT event_id) AS BIGINT) AS distinct_ids, "
        "CAST(count(*) - count(DISTINCT event_id) AS BIGINT) AS duplicates FROM silver",
        "metrics_summary": f"WITH {_LINES}\nSELECT coalesce(layer, 'unknown') AS layer, "
        "CAST(count(*) AS BIGINT) AS batches, CAST(sum(coalesce(row_count, 0)) AS BIGINT) AS rows, "
        "CAST(count(*) FILTER (WHERE coalesce(error, '') <> '') AS BIGINT) AS errors "
        "FROM lines GROUP BY coalesce(layer, 'unknown')",
        "metrics_timeline": f"WITH {_LINES}\nSELECT make_timestamp(ts * 1000000) AS \"timestamp\", "
        + ", ".join(
            f"CAST(coalesce(sum(row_count) FILTER (WHERE layer = '{x}'), 0) AS BIGINT) AS {x}"
            for x in ("bronze", "silver", "gold")
        )
        + ", CAST(coalesce(sum(row_count) FILTER (WHERE layer NOT IN ('bronze', 'silver', 'gold')), 0) AS BIGINT) AS other"
        + " FROM lines WHERE ts IS NOT NULL AND ts <> 0 AND layer IS NOT NULL GROUP BY ts ORDER BY ts",
        "recent_errors": f"WITH {_LINES}\nSELECT ts, layer, batch_id, error FROM lines "
        "WHERE coalesce(error, '') <> '' ORDER BY ts DESC NULLS LAST, batch_id DESC NULLS LAST, "
        "layer ASC NULLS LAST LIMIT 10",
        "quarantine_total": f"WITH {_ROWS},\nq AS (SELECT CAST({per_layer} AS BIGINT) AS n FROM flat)\n"
        "SELECT 'bronze' AS layer, n AS rows FROM q UNION ALL SELECT 'silver', n FROM q "
        "UNION ALL SELECT 'all', 2 * n FROM q",
    }
    for name in ("bronze_parse", "gold_hourly", "quality_report", "quarantine_rows", "duplicate_count"):
        sql[f"faulty_{name}"] = sql[name].replace(_ROWS, _FAULTY_ROWS)
    # The first 20 characters of the JSON text of the records that are cut there.
    cut = """SELECT n, substr('{"event_id":"' || event_id || '",' ||
       CASE WHEN n % 23 = 3 AND n % 19 <> 2 THEN '"event_type":"' ELSE '"timestamp":"' END, 1, 20) AS raw
    FROM (SELECT *, CAST(substr(event_id, 2) AS BIGINT) AS n FROM flat) WHERE n % 17 = 1"""
    sql["faulty_dead_letters"] = (
        f"WITH {_ROWS}\nSELECT raw FROM ({cut}), (VALUES (1), (2)) AS delivery(number) WHERE number = 1 OR n % 13 = 0"
    )
    fields = [*ID_FIELDS, "metrics", *[f"metrics.{m}" for m in METRIC_FIELDS], "extra", "extra.note"]
    n_wrong = """(SELECT count(*) FROM (SELECT CAST(substr(event_id, 2) AS BIGINT) AS n FROM flat), (VALUES (1), (2)) AS delivery(number)
    WHERE n % 29 = 4 AND n % 17 <> 1 AND (number = 1 OR n % 13 = 0))"""
    sql["faulty_kind_errors"] = f"WITH {_ROWS}\nSELECT field, CASE WHEN field = 'metrics.amount' THEN {n_wrong} ELSE 0 END::BIGINT AS wrong_kind FROM (VALUES " + ", ".join(
        f"('{f}')" for f in fields
    ) + ") AS t(field)"
    sql["faulty_dead_letters_stream"] = sql["faulty_dead_letters"]
    sql["gold_hourly_repaired"] = sql["faulty_gold_hourly"]
    # Unreadable records are no events: their rows are NULL in ``flat``.
    events = "(SELECT * FROM silver WHERE event_id IS NOT NULL)"
    sql["silver_date_range"] = (
        f"WITH {_FAULTY_ROWS}\nSELECT {flat_cols}, event_ts::DATE AS event_date FROM {events} "
        "WHERE event_ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'"
    )
    sql["distinct_ids_by_date"] = (
        f"WITH {_FAULTY_ROWS}\nSELECT event_ts::DATE AS date, count(*)::BIGINT AS rows, "
        "count(DISTINCT event_id)::BIGINT AS distinct_ids, TRUE AS near FROM silver GROUP BY event_ts::DATE"
    )
    sql["faulty_duplicates_stream"] = (
        f"WITH {_FAULTY_ROWS}\nSELECT layer || '_duplicates' AS layer, count(*)::BIGINT AS rows, "
        f"(count(*) - count(DISTINCT event_id))::BIGINT AS duplicates FROM {events}, (VALUES ('bronze'), ('silver')) AS t(layer) GROUP BY layer"
    )
    sql["faulty_layer_metrics"] = (
        f"WITH {_FAULTY_ROWS}\nSELECT count(*)::BIGINT AS rows, count(*) FILTER (WHERE event_id IS NULL)::BIGINT AS dead_letters, "
        "TRUE AS distinct_near FROM flat"
    )
    sql["bronze_stream"] = sql["bronze_parse"]
    sql["silver_stream"] = sql["silver_flatten"]
    sql["gold_hourly_live"] = gold
    sql["gold_backfill"] = gold
    for name in ("gold_hourly_final", "backfill_rerun_range", "backfill_after_stream"):
        sql[name] = gold
    sql["kpis_by_event_type_dates"] = sql["kpis_by_event_type"].replace(
        "FROM gold GROUP BY", "FROM gold WHERE date_hour BETWEEN DATE '2024-01-05' AND DATE '2024-01-11' GROUP BY"
    )
    sql["layer_metrics"] = (
        f"WITH {_ROWS}\nSELECT layer, (SELECT count(*) FROM flat)::BIGINT AS rows, 0::BIGINT AS errors "
        "FROM (VALUES ('bronze'), ('silver')) AS t(layer)"
    )
    return sql


ORACLE_SQL: dict[str, str] = build()
