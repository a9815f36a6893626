"""SQL for each query of the catalogue, over the same tables, to check results by.

Written apart from the Spark code: plain SQL built-ins throughout.
"""

from __future__ import annotations

_LOGS = """
WITH num AS (
    SELECT event_id AS n, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(floor(event_id / 250.0) AS BIGINT) AS batch_no
    FROM events
),
deliveries AS (
    SELECT *, batch_no + CASE WHEN n % 33 = 0 THEN 1 + n % 3 ELSE 0 END AS arrival_no, 0 AS again
    FROM num
    UNION ALL
    SELECT *, batch_no + 4 AS arrival_no, 1 AS again FROM num WHERE n % 50 = 7
),
numbered AS (
    SELECT
        'e_' || n AS event_id,
        ts AS event_time,
        '/api/v1/' || event_type AS endpoint,
        CASE n % 6 WHEN 3 THEN 'POST' WHEN 4 THEN 'PUT' WHEN 5 THEN 'DELETE' ELSE 'GET' END AS method,
        CAST(CASE WHEN event_type = 'error' AND n % 4 = 0 THEN 503
                  WHEN event_type = 'error' THEN 500
                  WHEN k < 4 THEN 404 WHEN k < 6 THEN 401 WHEN k < 8 THEN 400
                  WHEN k < 11 THEN 201 ELSE 200 END AS INTEGER) AS status_code,
        CAST(greatest(1, floor(value))
             + CASE WHEN event_type = 'error' THEN 200 + n * 37 % 1801 ELSE 0 END
             + again AS INTEGER) AS latency_ms,
        'u_' || user_id AS user_id,
        CASE user_id % 10 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'DE' WHEN 3 THEN 'IN'
             WHEN 4 THEN 'BR' WHEN 5 THEN 'JP' WHEN 6 THEN 'KE' WHEN 7 THEN 'NG'
             WHEN 8 THEN 'CA' ELSE 'AU' END AS country,
        'b_' || lpad(CAST(arrival_no AS VARCHAR), 5, '0') AS ingest_batch_id,
        CASE WHEN arrival_no >= 1 THEN 'ua_' || (n % 4) END AS user_agent,
        CASE WHEN arrival_no >= 2 THEN 's_' || user_id END AS session_id,
        CASE WHEN arrival_no >= 2 THEN k >= 30 END AS is_authenticated,
        'events_b_' || lpad(CAST(arrival_no AS VARCHAR), 5, '0') || '.jsonl' AS _source_file,
        TIMESTAMP '2024-02-01 00:00:00' + arrival_no * INTERVAL 15 MINUTE AS _ingested_at,
        CAST(ts AS DATE) AS ingest_date,
        n,
        arrival_no
    FROM deliveries
),
logs AS (SELECT * EXCLUDE (n, arrival_no) FROM numbered)
"""

_NEWEST = (
    "row_number() OVER (PARTITION BY event_id"
    " ORDER BY _ingested_at DESC, ingest_batch_id DESC, _source_file DESC)"
)

_SILVER = (
    _LOGS
    + f""",
silver AS (
    SELECT * EXCLUDE (version) FROM (SELECT *, {_NEWEST} AS version FROM logs) WHERE version = 1
)
"""
)

_HALVES = (
    _LOGS
    + f""",
target AS (
    SELECT * EXCLUDE (n, arrival_no, version) FROM (
        SELECT *, {_NEWEST} AS version FROM numbered
        WHERE arrival_no <= (SELECT max(arrival_no) / 2.0 FROM numbered))
    WHERE version = 1
),
source AS (
    SELECT * EXCLUDE (n, arrival_no, version) FROM (
        SELECT *, {_NEWEST} AS version FROM numbered
        WHERE arrival_no > (SELECT max(arrival_no) / 2.0 FROM numbered))
    WHERE version = 1
)
"""
)

# Faults by the number of the event, then typed; numbers that do not parse become null.
_DIRTY = (
    _LOGS
    + """,
cleaned AS (
    SELECT
        CASE WHEN n % 20 <> 3 THEN event_id END AS event_id,
        CASE WHEN n % 61 <> 0 THEN event_time END AS event_time,
        CASE WHEN n % 71 <> 0 THEN endpoint END AS endpoint,
        upper(trim(CASE WHEN n % 103 = 0 THEN 'FETCH' WHEN n % 5 = 0 THEN ' get ' ELSE method END))
            AS method,
        TRY_CAST(CASE WHEN n % 97 = 0 THEN 'abc' WHEN n % 101 = 0 THEN '9999'
                      ELSE CAST(status_code AS VARCHAR) END AS INTEGER) AS status_code,
        TRY_CAST(CASE WHEN n % 211 = 0 THEN '999999'
                      ELSE CAST(latency_ms AS VARCHAR) END AS INTEGER) AS latency_ms,
        CASE WHEN n % 89 <> 0 THEN user_id END AS user_id,
        country, ingest_batch_id, user_agent, session_id, is_authenticated, _source_file,
        _ingested_at,
        CASE WHEN n % 61 <> 0 THEN ingest_date END AS ingest_date
    FROM numbered
)
"""
)

_DIRTY_LATEST = (
    _DIRTY
    + f""",
batch AS (
    SELECT * EXCLUDE (version)
    FROM (SELECT *, {_NEWEST} AS version FROM cleaned WHERE event_id IS NOT NULL)
    WHERE version = 1
    UNION ALL
    SELECT * FROM cleaned WHERE event_id IS NULL
)
"""
)


def _staging(table: str) -> str:
    return f""",
stg AS (
    SELECT event_id, CAST(event_time AS TIMESTAMP) AS event_ts,
           CAST(date_trunc('day', event_time) AS TIMESTAMP) AS event_date,
           endpoint, method, status_code,
           coalesce(status_code >= 500, false) AS is_server_error,
           coalesce(status_code BETWEEN 400 AND 499, false) AS is_client_error,
           latency_ms, user_id, country, ingest_batch_id,
           user_agent, session_id, is_authenticated, _ingested_at
    FROM {table}
)"""


def _rounded(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


_RATE = _rounded("count(*) FILTER (is_server_error) / CAST(count(*) AS DOUBLE)", 4)

_MARTS = f""",
fct AS (
    SELECT event_date,
           count(*) AS request_count,
           count(DISTINCT user_id) AS unique_users,
           count(*) FILTER (is_server_error) AS server_error_count,
           count(*) FILTER (is_client_error) AS client_error_count,
           {_RATE} AS server_error_rate,
           {_rounded("avg(latency_ms)", 1)} AS avg_latency_ms,
           {_rounded("median(latency_ms)", 1)} AS p50_latency_ms,
           {_rounded("quantile_cont(latency_ms, 0.95)", 1)} AS p95_latency_ms,
           {_rounded("quantile_cont(latency_ms, 0.99)", 1)} AS p99_latency_ms
    FROM stg GROUP BY event_date
),
rollup_rows AS (
    SELECT endpoint, method,
           count(*) AS request_count,
           count(*) FILTER (is_server_error) AS server_error_count,
           {_RATE} AS server_error_rate,
           {_rounded("avg(latency_ms)", 1)} AS avg_latency_ms,
           {_rounded("quantile_cont(latency_ms, 0.95)", 1)} AS p95_latency_ms
    FROM stg GROUP BY endpoint, method
),
dim AS (
    SELECT *, CAST(rank() OVER (ORDER BY request_count DESC) AS BIGINT) AS traffic_rank
    FROM rollup_rows
)
"""

_MODELS = _SILVER + _staging("silver") + _MARTS
_DIRTY_MODELS = _DIRTY_LATEST + _staging("batch") + _MARTS

_METHODS = "'GET', 'POST', 'PUT', 'PATCH', 'DELETE', 'HEAD', 'OPTIONS'"
_STATUSES = "200, 201, 204, 301, 302, 400, 401, 403, 404, 429, 500, 502, 503"


def _stats(table: str) -> str:
    def bad(column: str, test: str, shown: str, order: str) -> str:
        return (
            f"(SELECT string_agg(shown, ', ' ORDER BY {order}) FROM ("
            f"SELECT DISTINCT {column} AS v, coalesce({shown}, 'NULL') AS shown"
            f" FROM {table} WHERE coalesce({test}, true)))"
        )

    status = bad("status_code", "status_code NOT BETWEEN 100 AND 599", "CAST(status_code AS VARCHAR)", "v NULLS LAST")
    method = bad("method", f"method NOT IN ({_METHODS})", "'''' || method || ''''", "v NULLS LAST")
    nulls = ", ".join(
        f"count(*) - count({c}) AS null_{c}"
        for c in ("event_id", "event_time", "endpoint", "status_code", "user_id")
    )
    return f""",
stats AS (
    SELECT count(*) AS row_count, {nulls},
           CAST(coalesce(max(latency_ms), 0) AS BIGINT) AS max_latency_ms,
           min(event_time) AS min_event_time, max(event_time) AS max_event_time,
           (SELECT count(*) FROM (SELECT event_id FROM {table} WHERE event_id IS NOT NULL
                                  GROUP BY event_id HAVING count(*) > 1)) AS duplicate_event_ids,
           {status} AS bad_status_codes,
           {method} AS bad_methods
    FROM {table}
)"""


def _report() -> str:
    lines = ["SELECT 1 AS position, 'non_empty_batch' AS name, row_count > 0 AS passed,"
             " 'row_count=' || row_count AS detail FROM stats"]
    columns = ("event_id", "event_time", "endpoint", "status_code", "user_id")
    for position, c in enumerate(columns, 2):
        rate = f"null_{c} / CAST(row_count AS DOUBLE)"
        shown = f"CAST(CAST(round(CAST({rate} AS DECIMAL(38,10)), 4) AS DECIMAL(10,4)) AS VARCHAR)"
        lines.append(
            f"SELECT {position}, 'null_rate::{c}', {rate} <= 0.01, null_{c} || '/' || row_count"
            f" || ' = ' || {shown} || ' (threshold 0.01)' FROM stats WHERE row_count > 0"
        )
    lines += [
        "SELECT 7, 'status_code_range', bad_status_codes IS NULL, coalesce('invalid codes found=['"
        " || bad_status_codes || ']', 'all codes in 100-599') FROM stats WHERE row_count > 0",
        "SELECT 8, 'method_whitelist', bad_methods IS NULL, coalesce('unknown methods=['"
        " || bad_methods || ']', 'all methods known') FROM stats WHERE row_count > 0",
        "SELECT 9, 'latency_sanity', max_latency_ms <= 30000, 'max_latency_ms=' || max_latency_ms"
        " || ' (limit 30000)' FROM stats WHERE row_count > 0",
        "SELECT 10, 'no_duplicate_event_ids', duplicate_event_ids = 0, 'duplicate_event_ids='"
        " || duplicate_event_ids FROM stats WHERE row_count > 0",
    ]
    return ",\nreport AS (\n" + "\nUNION ALL\n".join(lines) + "\n)\n"


def _suite(silver: str) -> str:
    tests = []

    def add(model: str, column: str, kind: str, severity: str, failures: str) -> None:
        tests.append(
            f"SELECT '{model}' AS model, '{column}' AS column_name, '{kind}' AS test,"
            f" '{severity}' AS severity, CAST(({failures}) AS BIGINT) AS failures"
        )

    tables = {"silver_events": silver, "stg_logs": "stg", "fct_requests_daily": "fct", "dim_endpoints": "dim"}
    not_null = {
        "silver_events": ("event_id", "event_time", "endpoint", "status_code"),
        "stg_logs": ("event_id", "status_code", "method", "event_ts"),
        "fct_requests_daily": ("event_date", "request_count", "server_error_rate"),
        "dim_endpoints": ("endpoint", "request_count", "traffic_rank"),
    }
    for model, columns in not_null.items():
        for c in columns:
            add(model, c, "not_null", "error", f"SELECT count(*) FROM {tables[model]} WHERE {c} IS NULL")
    for model, c in (("silver_events", "event_id"), ("stg_logs", "event_id"), ("fct_requests_daily", "event_date")):
        add(model, c, "unique", "error",
            f"SELECT count(*) FROM (SELECT {c} FROM {tables[model]} WHERE {c} IS NOT NULL"
            f" GROUP BY {c} HAVING count(*) > 1)")
    for c, severity, values in (("status_code", "warn", _STATUSES), ("method", "error", _METHODS)):
        add("stg_logs", c, "accepted_values", severity,
            f"SELECT count(DISTINCT {c}) FROM stg WHERE {c} NOT IN ({values})")
    add("fct_requests_daily", "server_error_rate", "accepted_range", "error",
        "SELECT count(*) FROM fct WHERE server_error_rate NOT BETWEEN 0 AND 1")
    add("stg_logs", "event_ts", "freshness", "error",
        "SELECT count(*) FROM (SELECT max(event_ts) AS m FROM stg)"
        " WHERE TIMESTAMP '2024-01-31 12:00:00' - m > INTERVAL 2 HOURS")
    return ",\nsuite AS (SELECT *, CASE WHEN failures > 0 THEN severity ELSE 'pass' END AS status FROM (\n" + (
        "\nUNION ALL\n".join(tests)
    ) + "))\n"


_FIELD_TYPES = {
    "event_id": "string",
    "event_time": "string",
    "endpoint": "string",
    "method": "string",
    "status_code": "bigint",
    "latency_ms": "bigint",
    "user_id": "string",
    "country": "string",
    "ingest_batch_id": "string",
    "user_agent": "string",
    "session_id": "string",
    "is_authenticated": "boolean",
}

_FIELDS = (
    _LOGS
    + ",\nfields AS (\n"
    + "\nUNION ALL\n".join(
        f"SELECT _source_file, '{c}' AS field, '{t}' AS type, count({c}) AS row_count"
        f" FROM logs GROUP BY _source_file HAVING count({c}) > 0"
        for c, t in _FIELD_TYPES.items()
    )
    + "\n)"
)

_FIELDS_WITH_BAD_LINES = (
    _FIELDS
    + """,
all_fields AS (
    SELECT * FROM fields
    UNION ALL
    SELECT _source_file, '_corrupt_record', 'string', 1 FROM (SELECT DISTINCT _source_file FROM logs)
)
"""
)

_FIRST_DIFF = (
    _FIELDS
    + """,
old_fields AS (
    SELECT field, type FROM fields WHERE _source_file = (SELECT min(_source_file) FROM fields)
),
new_fields AS (SELECT DISTINCT field, type FROM fields),
diff AS (
    SELECT field, o.type AS old_type, w.type AS new_type,
           CASE WHEN o.type IS NULL THEN 'added' WHEN w.type IS NULL THEN 'removed'
                ELSE 'type_changed' END AS change,
           CASE WHEN o.type IS NULL THEN 'additive' ELSE 'breaking' END AS severity
    FROM old_fields o FULL JOIN new_fields w USING (field)
    WHERE o.type IS DISTINCT FROM w.type
)
"""
)

_DIRTY_DIFF = (
    _FIELDS
    + """,
old_fields AS (SELECT DISTINCT field, type FROM fields),
new_fields AS (
    SELECT field, CASE WHEN field IN ('status_code', 'latency_ms') THEN 'string' ELSE type END AS type
    FROM old_fields WHERE field <> 'country'
),
diff AS (
    SELECT field, o.type AS old_type, w.type AS new_type,
           CASE WHEN o.type IS NULL THEN 'added' WHEN w.type IS NULL THEN 'removed'
                ELSE 'type_changed' END AS change,
           CASE WHEN o.type IS NULL THEN 'additive' ELSE 'breaking' END AS severity
    FROM old_fields o FULL JOIN new_fields w USING (field)
    WHERE o.type IS DISTINCT FROM w.type
)
"""
)

_WORST = """
SELECT CASE WHEN count(*) = 0 THEN 'none' WHEN bool_or(severity = 'breaking') THEN 'breaking'
            ELSE 'additive' END"""

# Delays run to millions of seconds, where a double is exact to some nine digits after
# the point, not ten.
_LATE = (
    _LOGS
    + f""",
newest AS (SELECT ingest_batch_id, max(event_time) AS newest FROM logs GROUP BY ingest_batch_id),
seen AS (
    SELECT ingest_batch_id,
           max(newest) OVER (ORDER BY ingest_batch_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
    FROM newest
),
delays AS (
    SELECT ingest_batch_id, coalesce(event_time < seen, false) AS late,
           CAST(epoch(date_trunc('second', _ingested_at)) AS BIGINT)
           - CAST(epoch(date_trunc('second', event_time)) AS BIGINT) AS delay_seconds
    FROM logs JOIN seen USING (ingest_batch_id)
)
SELECT ingest_batch_id, count(*) AS row_count, count(*) FILTER (late) AS late_rows,
       {_rounded("count(*) FILTER (late) / CAST(count(*) AS DOUBLE)", 4)} AS late_share,
       CAST(round(CAST(quantile_cont(delay_seconds, 0.95) AS DECIMAL(38,6)), 1) AS DOUBLE)
           AS p95_delay_seconds
FROM delays GROUP BY ingest_batch_id
"""
)

# Rows of the two-run lake: arrival is set by the run, so a later run wins, then the later batch.
_TWO_RUNS = (
    _LOGS
    + """,
runs AS (
    SELECT * REPLACE (TIMESTAMP '2024-02-01 00:00:00'
                      + CASE WHEN arrival_no <= (SELECT max(arrival_no) / 2.0 FROM numbered)
                             THEN INTERVAL 0 MINUTE ELSE INTERVAL 15 MINUTE END AS _ingested_at)
    FROM numbered
),
lake AS (
    SELECT * EXCLUDE (n, arrival_no, version) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id
                                     ORDER BY _ingested_at DESC, ingest_batch_id DESC) AS version
        FROM runs)
    WHERE version = 1
)
"""
)
_TWO_RUN_MODELS = _TWO_RUNS + _staging("lake") + _MARTS

ORACLE_SQL: dict[str, str] = {
    "raw_provenance": _LOGS
    + """SELECT event_id, CAST(latency_ms AS BIGINT) AS latency_ms,
       TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at, ingest_date, ingest_batch_id AS file_batch
FROM logs""",
    "json_ingest_roundtrip": _LOGS
    + "SELECT * EXCLUDE (_source_file) REPLACE (TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at) FROM logs",
    "clean_and_typed": _DIRTY + "SELECT * FROM cleaned",
    "dedupe_keep_latest": _SILVER + "SELECT * FROM silver",
    "dedupe_with_missing_ids": _DIRTY_LATEST + "SELECT * FROM batch",
    "file_level_anti_join": _LOGS
    + """SELECT * EXCLUDE (n, arrival_no) FROM numbered
WHERE _source_file NOT IN (
    SELECT _source_file FROM numbered WHERE arrival_no <= (SELECT max(arrival_no) / 2.0 FROM numbered))""",
    "distinct_source_files": _LOGS + "SELECT DISTINCT _source_file FROM logs",
    "silver_watermark": _SILVER + "SELECT max(_ingested_at) AS watermark FROM silver",
    "incremental_rows": _HALVES
    + "SELECT * FROM logs WHERE _ingested_at > (SELECT max(_ingested_at) FROM target)",
    "backfill_rows": _LOGS
    + f"""SELECT * EXCLUDE (version) FROM (
    SELECT *, {_NEWEST} AS version FROM logs
    WHERE _ingested_at >= TIMESTAMP '2024-02-01 01:00:00'
      AND _ingested_at < TIMESTAMP '2024-02-01 03:00:00')
WHERE version = 1""",
    "silver_upsert": _HALVES
    + """SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM source)
UNION ALL SELECT * FROM source""",
    "upsert_effects": _HALVES
    + """SELECT CASE WHEN event_id IN (SELECT event_id FROM target) THEN 'updated' ELSE 'inserted' END
           AS action, count(*) AS row_count
FROM source GROUP BY 1""",
    "row_counts": _HALVES
    + """SELECT 'read' AS step, count(*) AS row_count FROM numbered
UNION ALL SELECT 'new', count(*) FROM numbered
    WHERE arrival_no > (SELECT max(arrival_no) / 2.0 FROM numbered)
UNION ALL SELECT 'candidate', count(*) FROM logs
    WHERE _ingested_at > (SELECT max(_ingested_at) FROM target)
UNION ALL SELECT 'merged', count(*) FROM source""",
    "staging_logs": _MODELS + "SELECT * FROM stg",
    "error_flags": _DIRTY
    + """SELECT status_code,
       CASE WHEN status_code >= 500 THEN true ELSE false END AS is_server_error,
       CASE WHEN status_code >= 400 AND status_code < 500 THEN true ELSE false END AS is_client_error,
       count(*) AS row_count
FROM cleaned GROUP BY 1, 2, 3""",
    "daily_request_count": _MODELS + "SELECT event_date, request_count FROM fct",
    "daily_unique_users": _MODELS + "SELECT event_date, unique_users FROM fct",
    "user_sketches": _MODELS
    + """SELECT CAST(event_date AS VARCHAR) AS span, unique_users, true AS sketch_is_near FROM fct
UNION ALL SELECT 'all days', count(DISTINCT user_id), true FROM stg""",
    "daily_error_rates": _MODELS
    + "SELECT event_date, server_error_count, client_error_count, server_error_rate FROM fct",
    "daily_latency": _MODELS
    + "SELECT event_date, avg_latency_ms, p50_latency_ms, p95_latency_ms, p99_latency_ms FROM fct",
    "fct_requests_daily": _MODELS + "SELECT * FROM fct ORDER BY event_date",
    "fct_with_missing_values": _DIRTY_MODELS + "SELECT * FROM fct",
    "endpoint_rollup": _MODELS + "SELECT * FROM rollup_rows",
    "dim_endpoints": _MODELS + "SELECT * FROM dim",
    "user_traffic_rank": _MODELS
    + """SELECT *, CAST(rank() OVER (ORDER BY request_count DESC) AS BIGINT) AS traffic_rank
FROM (SELECT user_id, country, count(*) AS request_count FROM stg GROUP BY user_id, country)""",
    "latest_day_kpis": _MODELS
    + """SELECT event_date, request_count, server_error_rate * 100 AS server_error_percent,
       p95_latency_ms, unique_users
FROM fct ORDER BY event_date DESC LIMIT 1""",
    "panel_traffic": _MODELS + "SELECT event_date, request_count FROM fct ORDER BY event_date",
    "panel_error_rate": _MODELS + "SELECT event_date, server_error_rate FROM fct ORDER BY event_date",
    "panel_latency": _MODELS
    + "SELECT event_date, p50_latency_ms, p95_latency_ms, p99_latency_ms FROM fct ORDER BY event_date",
    "top_endpoints": _MODELS
    + """SELECT endpoint, method, request_count, server_error_rate, avg_latency_ms, p95_latency_ms,
       traffic_rank
FROM dim ORDER BY request_count DESC, endpoint, method LIMIT 15""",
    "top_endpoint_bars": _MODELS
    + """SELECT endpoint, request_count
FROM (SELECT * FROM dim ORDER BY request_count DESC, endpoint, method LIMIT 15)""",
    "requests_per_endpoint": _MODELS
    + "SELECT endpoint, count(*) AS request_count FROM stg GROUP BY endpoint",
    "quality_stats": _DIRTY_LATEST + _stats("batch") + "SELECT * FROM stats",
    "quality_report_clean": _SILVER + _stats("silver") + _report() + "SELECT * FROM report",
    "quality_report_dirty": _DIRTY_LATEST + _stats("batch") + _report() + "SELECT * FROM report",
    "quality_report_before_dedupe": _LOGS + _stats("logs") + _report() + "SELECT * FROM report",
    "quality_report_empty": _SILVER
    + ", fresh AS (SELECT * FROM silver WHERE _ingested_at > (SELECT max(_ingested_at) FROM silver))"
    + _stats("fresh")
    + _report()
    + "SELECT * FROM report",
    "quality_report_many_bad_values": _SILVER
    + """,
faulty AS (
    SELECT * REPLACE (
        CASE WHEN k % 3 = 0 THEN CAST(k % 700 + 600 AS INTEGER) ELSE status_code END AS status_code,
        CASE WHEN k % 5 = 0 THEN 'M' || (k % 900) ELSE method END AS method)
    FROM (SELECT *, CAST(substr(event_id, 3) AS BIGINT) AS k FROM silver)
)"""
    + _stats("faulty")
    + _report()
    + "SELECT * FROM report",
    "quality_summary": _DIRTY_LATEST
    + _stats("batch")
    + _report()
    + """SELECT bool_and(passed) AS passed,
       coalesce(string_agg(name, ',' ORDER BY position) FILTER (NOT passed), '') AS failures,
       string_agg('[' || CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END || '] ' || name || ': ' || detail,
                  chr(10) ORDER BY position) AS summary
FROM report""",
    "bad_values": _DIRTY
    + f"""SELECT 'status_code_range' AS rule, coalesce(CAST(status_code AS VARCHAR), 'NULL') AS value,
       count(*) AS row_count
FROM cleaned WHERE coalesce(status_code NOT BETWEEN 100 AND 599, true) GROUP BY status_code
UNION ALL
SELECT 'method_whitelist', coalesce('''' || method || '''', 'NULL'), count(*)
FROM cleaned WHERE coalesce(method NOT IN ({_METHODS}), true) GROUP BY method""",
    "rows_by_broken_rule": _DIRTY_LATEST
    + f"""SELECT * FROM (
    SELECT 'null_rate::event_id' AS rule, count(*) AS row_count FROM batch WHERE event_id IS NULL
    UNION ALL SELECT 'null_rate::event_time', count(*) FROM batch WHERE event_time IS NULL
    UNION ALL SELECT 'null_rate::endpoint', count(*) FROM batch WHERE endpoint IS NULL
    UNION ALL SELECT 'null_rate::status_code', count(*) FROM batch WHERE status_code IS NULL
    UNION ALL SELECT 'null_rate::user_id', count(*) FROM batch WHERE user_id IS NULL
    UNION ALL SELECT 'status_code_range', count(*) FROM batch
        WHERE coalesce(status_code NOT BETWEEN 100 AND 599, true)
    UNION ALL SELECT 'method_whitelist', count(*) FROM batch
        WHERE coalesce(method NOT IN ({_METHODS}), true)
    UNION ALL SELECT 'latency_sanity', count(*) FROM batch WHERE latency_ms > 30000)
WHERE row_count > 0""",
    "test_unique": _LOGS
    + "SELECT event_id AS value, count(*) AS row_count FROM logs GROUP BY event_id HAVING count(*) > 1",
    "test_not_null": _DIRTY
    + "SELECT event_id, method, latency_ms, _source_file FROM cleaned WHERE status_code IS NULL",
    "test_accepted_values": _DIRTY
    + f"""SELECT method AS value, count(*) AS row_count FROM cleaned
WHERE method NOT IN ({_METHODS}) GROUP BY method""",
    "test_accepted_range": _MODELS
    + """SELECT event_date, server_error_rate FROM fct
WHERE server_error_rate < 0 OR server_error_rate > 0.2""",
    "test_freshness": _MODELS
    + """SELECT max(event_ts) AS most_recent_event,
       epoch(TIMESTAMP '2024-01-31 12:00:00' - max(event_ts)) AS staleness
FROM stg
HAVING TIMESTAMP '2024-01-31 12:00:00' - max(event_ts) > INTERVAL 2 HOURS""",
    "data_test_suite": _MODELS + _suite("silver") + "SELECT * FROM suite",
    "data_test_suite_dirty": _DIRTY_MODELS + _suite("batch") + "SELECT * FROM suite",
    "data_test_status": _MODELS
    + _suite("silver")
    + """SELECT count(*) AS tests, count(*) FILTER (failures > 0) AS failed,
       CASE WHEN bool_or(status = 'error') THEN 'error' WHEN bool_or(status = 'warn') THEN 'warn'
            ELSE 'pass' END AS status
FROM suite""",
    "schema_drift_by_file": _FIELDS_WITH_BAD_LINES + "SELECT * FROM all_fields",
    "field_history": _FIELDS_WITH_BAD_LINES
    + """SELECT field, type, min(_source_file) AS first_file, count(*) AS files,
       CAST(sum(row_count) AS BIGINT) AS row_count
FROM all_fields GROUP BY field, type""",
    "schema_diff": _FIRST_DIFF + "SELECT * FROM diff",
    "schema_diff_breaking": _DIRTY_DIFF + "SELECT * FROM diff",
    "schema_classes": "SELECT 'later files' AS change, classification FROM ("
    + _FIRST_DIFF
    + _WORST
    + " AS classification FROM diff) UNION ALL SELECT 'text fields', classification FROM ("
    + _DIRTY_DIFF
    + _WORST
    + " AS classification FROM diff)",
    "evolving_append": _LOGS + "SELECT * FROM logs",
    "widening_append": _HALVES
    + """SELECT event_id, CAST(latency_ms AS DOUBLE) AS latency_ms, _ingested_at FROM target
UNION ALL SELECT event_id, latency_ms + 0.5::DOUBLE, _ingested_at FROM source""",
    "schema_changes_of_appends": """SELECT CAST(version AS BIGINT) AS version, field, old_type, new_type, change, severity
FROM (VALUES (1, 'user_agent', NULL, 'string', 'added', 'additive'),
             (2, 'session_id', NULL, 'string', 'added', 'additive'),
             (2, 'is_authenticated', NULL, 'boolean', 'added', 'additive'),
             (3, 'latency_ms', 'int', 'double', 'type_changed', 'widening'),
             (4, 'country', 'string', NULL, 'removed', 'breaking'),
             (4, 'status_code', 'int', 'string', 'type_changed', 'breaking'))
    AS changes(version, field, old_type, new_type, change, severity)
WHERE (SELECT count(*) FROM events) > 0""",
    "ingest_after_half_commit": _LOGS
    + "SELECT * EXCLUDE (_source_file) REPLACE (TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at) FROM logs",
    "ledger_of_files": _LOGS
    + "SELECT ingest_batch_id AS file_batch, count(*) AS row_count FROM logs GROUP BY ingest_batch_id",
    "late_arrivals": _LATE,
    "quarantine_append": _DIRTY_LATEST + "SELECT * FROM batch",
    "lake_silver": _TWO_RUNS + "SELECT * EXCLUDE (_source_file) FROM lake",
    "backfill_then_increment": _TWO_RUNS + "SELECT * EXCLUDE (_source_file) FROM lake",
    "backfill_older_window": _TWO_RUNS + "SELECT * EXCLUDE (_source_file) FROM lake",
    "lake_daily_facts": _TWO_RUN_MODELS + "SELECT * FROM fct",
    "lake_endpoints": _TWO_RUN_MODELS + "SELECT * FROM dim",
    "lake_run_log": _TWO_RUNS
    + """SELECT run, TIMESTAMP '2024-01-31 00:00:00' AS finished_at, silver_rows
FROM (
    SELECT 'first run' AS run, count(DISTINCT event_id) AS silver_rows, max(event_time) AS newest
    FROM numbered WHERE arrival_no <= (SELECT max(arrival_no) / 2.0 FROM numbered)
    UNION ALL
    SELECT 'second run', count(*), max(event_time) FROM lake
)
WHERE TIMESTAMP '2024-01-31 00:00:00' - newest <= INTERVAL 2 HOURS""",
    "stream_ingest": _LOGS
    + "SELECT * EXCLUDE (_source_file) REPLACE (TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at) FROM logs",
    "stream_silver": _SILVER + "SELECT * EXCLUDE (_source_file, _ingested_at) FROM silver",
}
