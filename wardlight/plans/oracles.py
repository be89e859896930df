"""SQL over the driver's tables that each named query must equal.

The statements are written from the operators' definitions, not from the Spark code: joins instead of the rollup, rule
by rule on the derived columns instead of parsing JSON, a recursive walk for the cooldown.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-31 12:00:00'"
EARLIER_CHECK, LATER_CHECK = "TIMESTAMP '2024-01-30 23:30:00'", "TIMESTAMP '2024-01-31 08:21:00'"
POLLS = [f"TIMESTAMP '2024-01-31 {time}:00'" for time in ("11:20", "11:24", "11:25", "12:00")]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
ROUTABLE = "('symptom_report', 'clinic_visit', 'hospital_admission', 'vaccination_record')"


def _age(as_of: str, moment: str) -> str:
    return f"((epoch_us({as_of}) - epoch_us({moment})) / 1000000.0::DOUBLE / 3600.0::DOUBLE)"


def _utc(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S+00:00')"


def _missing(fields: list[str]) -> str:
    tests = [f"CASE WHEN coalesce(CAST({name} AS VARCHAR), '') = '' THEN '{name}' END" for name in fields]
    return f"concat_ws(',', {', '.join(tests)})"


def _state_checks(table: str, time: str, columns: list[str], as_of: str) -> str:
    """The five state checks of one table as one SELECT per check."""
    age = _age(as_of, "latest")
    nulls = " OR ".join(f"{name} IS NULL" for name in columns)
    stats = f"(SELECT count(*) AS n, max({time}) AS latest, count(*) FILTER ({nulls}) AS nulls FROM {table})"
    head = f"SELECT {as_of} AS checked_at, '%s' AS check_name, '{table}' AS table_name, "
    tail = f" AS message FROM {stats}"
    has_rows = " WHERE n > 0"
    values = ", n AS row_count, latest AS latest_timestamp, "
    hours = f"format('{{:.1f}}', {age})"
    return " UNION ALL ".join(
        [
            head % "table_exists" + "'PASS' AS status" + values + "'Table exists'" + tail,
            head % "row_count_nonzero"
            + "CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END AS status"
            + values
            + "CASE WHEN n = 0 THEN 'Table has no rows' ELSE 'Table has data' END"
            + tail,
            head % "freshness"
            + f"CASE WHEN {age} > 8 THEN 'FAIL' ELSE 'PASS' END AS status"
            + values
            + f"'Latest data is ' || {hours} || CASE WHEN {age} > 8 THEN 'h old; threshold is 8h' ELSE 'h old' END"
            + tail
            + has_rows,
            head % "required_columns" + "'PASS' AS status" + values + "'Required columns present'" + tail + has_rows,
            head % "null_key_values"
            + "CASE WHEN nulls > 0 THEN 'WARN' ELSE 'PASS' END AS status"
            + values
            + "CASE WHEN nulls > 0 THEN nulls || ' rows have null values in key columns' ELSE 'No null key values' END"
            + tail
            + has_rows,
        ]
    )


def _domain_check(table: str, name: str, condition: str, text: str, as_of: str) -> str:
    return (
        f"SELECT {as_of} AS checked_at, '{name}' AS check_name, '{table}' AS table_name, "
        f"CASE WHEN bad > 0 THEN 'FAIL' ELSE 'PASS' END AS status, bad AS row_count, "
        f"CAST(NULL AS TIMESTAMP) AS latest_timestamp, bad || ' {text}' AS message "
        f"FROM (SELECT count(*) FILTER ({condition}) AS bad FROM {table})"
    )


def _prediction_check(status: str, message: str, as_of: str) -> str:
    return (
        f"SELECT {as_of} AS checked_at, 'outbreak_prediction_table' AS check_name, "
        f"'outbreak_predictions' AS table_name, '{status}' AS status, CAST(NULL AS BIGINT) AS row_count, "
        f"CAST(NULL AS TIMESTAMP) AS latest_timestamp, '{message}' AS message"
    )


RATE_COLUMNS = ["hour", "event_type", "region", "event_count"]
SEVERITY_COLUMNS = ["window_start", "window_end", "region", "event_type", "avg_severity", "sample_count"]
BED_COLUMNS = ["hour", "region", "avg_available_beds", "min_available_beds", "sample_count"]
VACCINATION_COLUMNS = ["hour", "region", "vaccine_type", "dose_number", "vaccination_count"]


def _all_state_checks(as_of: str) -> str:
    return " UNION ALL ".join(
        [
            _state_checks("hourly_event_rate", "hour", RATE_COLUMNS, as_of),
            _state_checks("severity_trend", "window_start", SEVERITY_COLUMNS, as_of),
            _state_checks("bed_availability", "hour", BED_COLUMNS, as_of),
            _state_checks("vaccination_trend", "hour", VACCINATION_COLUMNS, as_of),
        ]
    )


def _all_domain_checks(as_of: str) -> str:
    return " UNION ALL ".join(
        [
            _domain_check(
                "bed_availability",
                "bed_availability_nonnegative",
                "min_available_beds < 0 OR avg_available_beds < 0",
                "rows have negative bed counts",
                as_of,
            ),
            _domain_check(
                "severity_trend",
                "severity_range",
                "avg_severity < 0 OR avg_severity > 4",
                "rows have avg_severity outside 0..4",
                as_of,
            ),
            _domain_check(
                "vaccination_trend",
                "vaccination_values",
                "dose_number < 1 OR vaccination_count < 0",
                "rows have invalid dose_number or vaccination_count",
                as_of,
            ),
        ]
    )


def _report(as_of: str) -> str:
    exists = _prediction_check("PASS", "Outbreak table exists", as_of)
    return f"{_all_state_checks(as_of)} UNION ALL {_all_domain_checks(as_of)} UNION ALL {exists}"


# Common table expressions, in dependency order. A statement gets those it mentions, directly or through another one.
CTES = {
    "ev": """
        SELECT event_id AS "offset",
               CASE event_type WHEN 'click' THEN 'symptom_report' WHEN 'view' THEN 'clinic_visit'
                    WHEN 'purchase' THEN 'hospital_admission' WHEN 'signup' THEN 'vaccination_record'
                    ELSE CASE k % 3 WHEN 0 THEN 'general_health_report' WHEN 1 THEN 'vaccination'
                              ELSE 'emergency_incident' END END AS event_type,
               ts AS "timestamp", r_name AS region, 'P' || user_id AS patient_id,
               CASE WHEN event_type NOT IN ('click', 'purchase') OR k % 10 = 0 THEN NULL
                    WHEN value < 15 THEN 'low' WHEN value < 35 THEN 'moderate' WHEN value < 70 THEN 'high'
                    WHEN value < 140 THEN 'severe' WHEN value < 300 THEN 'critical' ELSE 'unknown' END AS severity,
               CASE WHEN event_type = 'purchase' AND k % 7 <> 0 THEN 3 * k END AS available_beds,
               CASE WHEN event_type = 'signup' THEN CASE WHEN k % 13 = 0 THEN 1 ELSE 2 END END AS schema_version,
               CASE WHEN event_type = 'signup' THEN k % 4 END AS dose_number,
               CASE WHEN event_type = 'signup' AND k % 11 <> 0 THEN
                    CASE user_id % 3 WHEN 0 THEN 'influenza' WHEN 1 THEN 'covid19' ELSE 'measles' END
               END AS vaccine_type,
               CASE WHEN event_type = 'signup' THEN 'VR' || event_id END AS record_id,
               CASE WHEN event_type = 'signup'
                    THEN strftime(ts - INTERVAL 2 MINUTE, '%Y-%m-%dT%H:%M:%S.%fZ') END AS administered_at
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
        JOIN region ON user_id % 5 = r_regionkey""",
    "raw_all": """
        SELECT * REPLACE (
                 CASE WHEN "offset" % 97 = 0 THEN NULL WHEN "offset" % 97 = 1 THEN '' ELSE region END AS region),
               "offset" % 83 = 0 AS bad_json,
               CASE WHEN "offset" % 89 = 0 THEN 'not-a-time'
                    ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') END AS time_text
        FROM ev""",
    "raw": """SELECT * FROM raw_all WHERE NOT bad_json""",
    "judged": f"""
        SELECT *, CASE WHEN event_type = 'vaccination_record' THEN
                    {_missing(["event_type", "schema_version", "time_text", "record_id", "patient_id", "region",
                               "vaccine_type", "dose_number", "administered_at"]).replace("'time_text'", "'timestamp'")}
                  ELSE {_missing(["event_type", "time_text", "region"]).replace("'time_text'", "'timestamp'")}
                  END AS missing
        FROM raw""",
    "verdicts": """
        SELECT *, CASE WHEN missing <> '' THEN 'missing_fields'
                       WHEN time_text = 'not-a-time' THEN 'bad_timestamp'
                       WHEN event_type = 'vaccination_record' AND schema_version <> 2 THEN 'bad_schema_version'
                       WHEN event_type = 'vaccination_record' AND dose_number < 1 THEN 'bad_dose_number'
                       ELSE 'valid' END AS reason
        FROM judged""",
    "valid": """SELECT * FROM verdicts WHERE reason = 'valid'""",
    "hourly_event_rate": f"""
        SELECT date_trunc('hour', "timestamp") AS hour, event_type, region, count(*) AS event_count
        FROM ev WHERE event_type IN {ROUTABLE} GROUP BY ALL""",
    "scored": """
        SELECT * FROM (
            SELECT *, CAST(CASE severity WHEN 'low' THEN 1 WHEN 'moderate' THEN 2 WHEN 'high' THEN 3
                                WHEN 'severe' THEN 3 WHEN 'critical' THEN 4 END AS DOUBLE) AS score
            FROM ev WHERE event_type IN ('symptom_report', 'hospital_admission'))
        WHERE score IS NOT NULL""",
    "severity_trend": """
        SELECT date_trunc('hour', "timestamp") AS window_start,
               date_trunc('hour', "timestamp") + INTERVAL 1 HOUR AS window_end,
               region, event_type, avg(score) AS avg_severity, count(*) AS sample_count
        FROM scored GROUP BY ALL""",
    "bed_availability": """
        SELECT date_trunc('hour', "timestamp") AS hour, region, avg(available_beds) AS avg_available_beds,
               min(available_beds) AS min_available_beds, count(*) AS sample_count
        FROM ev WHERE event_type = 'hospital_admission' AND available_beds IS NOT NULL GROUP BY 1, 2""",
    "vaccination_trend": """
        SELECT date_trunc('hour', "timestamp") AS hour, region, vaccine_type, dose_number,
               count(*) AS vaccination_count
        FROM ev WHERE event_type = 'vaccination_record' AND vaccine_type IS NOT NULL AND dose_number >= 1
        GROUP BY ALL""",
    "event_features": """
        SELECT hour, region, CAST(sum(event_count) AS BIGINT) AS total_events FROM hourly_event_rate GROUP BY ALL""",
    "severity_features": """
        SELECT window_start AS hour, region, avg(avg_severity) AS avg_severity
        FROM severity_trend GROUP BY window_start, region""",
    "bed_features": """
        SELECT hour, region, min(min_available_beds) AS min_available_beds FROM bed_availability GROUP BY ALL""",
    "vaccination_features": """
        SELECT hour, region, CAST(sum(vaccination_count) AS BIGINT) AS vaccination_count
        FROM vaccination_trend GROUP BY ALL""",
    "features": """
        SELECT hour, region, total_events, coalesce(avg_severity, 0) AS avg_severity,
               coalesce(min_available_beds, 999) AS min_available_beds,
               coalesce(vaccination_count, 0) AS vaccination_count
        FROM event_features LEFT JOIN severity_features USING (hour, region)
        LEFT JOIN bed_features USING (hour, region) LEFT JOIN vaccination_features USING (hour, region)""",
    # scores of counts are exact decimals and become doubles only where they meet the severity score
    "exact_scores": """
        SELECT *, CAST(least(total_events, 10) AS DECIMAL(10, 4)) * 0.1 AS event_exact,
               least(avg_severity / 4.0::DOUBLE, 1.0::DOUBLE) AS severity_score,
               CASE WHEN min_available_beds <= 50 THEN 1.0 WHEN min_available_beds <= 100 THEN 0.7
                    WHEN min_available_beds <= 200 THEN 0.4 ELSE 0.1 END AS bed_exact,
               1.00 - CAST(least(vaccination_count, 20) AS DECIMAL(10, 4)) * 0.05 AS vaccination_exact
        FROM features""",
    "scores": """
        SELECT hour, region, total_events, avg_severity, min_available_beds, vaccination_count,
               CAST(event_exact AS DOUBLE) AS event_score, severity_score,
               CAST(bed_exact AS DOUBLE) AS bed_pressure_score, CAST(vaccination_exact AS DOUBLE) AS vaccination_score
        FROM exact_scores""",
    "risk": """
        SELECT s.*, outbreak_risk_score,
               CASE WHEN outbreak_risk_score >= 0.75 THEN 'critical' WHEN outbreak_risk_score >= 0.50 THEN 'high'
                    WHEN outbreak_risk_score >= 0.30 THEN 'medium' ELSE 'low' END AS outbreak_risk_level
        FROM scores s JOIN (
            SELECT hour, region, CAST(0.35 * event_exact AS DOUBLE) + 0.35::DOUBLE * severity_score
                   + CAST(0.20 * bed_exact AS DOUBLE) + CAST(0.10 * vaccination_exact AS DOUBLE) AS outbreak_risk_score
            FROM exact_scores) USING (hour, region)""",
    "outbreak_predictions": f"""SELECT {AS_OF} AS predicted_at, * FROM risk""",
    "data_quality_checks": f"""{_report(EARLIER_CHECK)} UNION ALL {_report(LATER_CHECK)}""",
    "top_rate": """
        SELECT * FROM hourly_event_rate ORDER BY hour DESC, event_count DESC, region, event_type LIMIT 20""",
    "top_sev": """
        SELECT * FROM severity_trend ORDER BY window_start DESC, avg_severity DESC, region, event_type LIMIT 20""",
    "top_bed": """
        SELECT * FROM bed_availability ORDER BY hour DESC, min_available_beds, region LIMIT 20""",
    "latest_doses": """
        SELECT hour, region, vaccine_type, CAST(sum(vaccination_count) AS BIGINT) AS doses
        FROM vaccination_trend WHERE hour = (SELECT max(hour) FROM vaccination_trend) GROUP BY ALL""",
    "rate_alerts": f"""
        SELECT 1 AS check_order, hour AS event_time, CAST(-event_count AS DOUBLE) AS sort_value,
               CASE WHEN event_count >= 3 THEN 'critical' ELSE 'warning' END AS level, 'event_rate' AS metric, region,
               event_type || ' had ' || event_count || ' events at ' || {_utc("hour")} AS message
        FROM top_rate WHERE event_count >= 2""",
    "severity_alerts": f"""
        SELECT 2 AS check_order, window_start AS event_time, -avg_severity AS sort_value,
               CASE WHEN avg_severity >= 3.0 THEN 'critical' ELSE 'warning' END AS level, 'severity' AS metric, region,
               event_type || ' avg_severity=' || format('{{:.2f}}', avg_severity) || ' from ' || sample_count
                   || ' samples at ' || {_utc("window_start")} AS message
        FROM top_sev WHERE avg_severity >= 2.0""",
    "bed_alerts": f"""
        SELECT 3 AS check_order, hour AS event_time, CAST(min_available_beds AS DOUBLE) AS sort_value,
               CASE WHEN min_available_beds <= 50 THEN 'critical' ELSE 'warning' END AS level,
               'bed_availability' AS metric, region,
               'min_available_beds=' || min_available_beds || ', avg_available_beds='
                   || format('{{:.2f}}', avg_available_beds) || ' at ' || {_utc("hour")} AS message
        FROM top_bed WHERE min_available_beds <= 100""",
    "vaccination_alerts": f"""
        SELECT 4 AS check_order, hour AS event_time, CAST(doses AS DOUBLE) AS sort_value,
               CASE WHEN doses <= 1 THEN 'warning' ELSE 'info' END AS level,
               CASE WHEN doses <= 1 THEN 'vaccination_low' ELSE 'vaccination_surge' END AS metric, region,
               CASE WHEN doses <= 1 THEN 'Only ' ELSE '' END || doses || ' ' || vaccine_type
                   || ' vaccination records at ' || {_utc("hour")} AS message
        FROM (SELECT * FROM latest_doses ORDER BY doses, region, vaccine_type LIMIT 20)
        WHERE doses <= 1 OR doses >= 2""",
    "quality_alerts": f"""
        SELECT 5 AS check_order, checked_at AS event_time, CAST(0 AS DOUBLE) AS sort_value,
               CASE WHEN status = 'FAIL' THEN 'critical' ELSE 'warning' END AS level, 'data_quality' AS metric,
               CASE WHEN coalesce(table_name, '') = '' THEN 'pipeline' ELSE table_name END AS region,
               check_name || '=' || status || ' at ' || {_utc("checked_at")} || ': ' || message AS message
        FROM (SELECT * FROM data_quality_checks
              WHERE checked_at >= {AS_OF} - INTERVAL 12 HOUR AND status IN ('WARN', 'FAIL')
              ORDER BY checked_at DESC, check_name, table_name LIMIT 20)""",
    "bed_events": """
        SELECT CASE WHEN available_beds <= 50 THEN 'critical' ELSE 'warning' END AS level,
               'bed_availability' AS metric, region, "timestamp" AS polled_at, "offset" AS position
        FROM ev WHERE event_type = 'hospital_admission' AND available_beds <= 100""",
    "bed_moments": """
        SELECT level, region, polled_at, min(position) AS position FROM bed_events GROUP BY ALL""",
    "following": """
        SELECT *, min(polled_at) OVER (PARTITION BY level, region ORDER BY polled_at
                                       RANGE BETWEEN INTERVAL 6 HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS next_at
        FROM bed_moments""",
    "emitted": """
        SELECT level, region, min(polled_at) AS polled_at FROM bed_moments GROUP BY level, region
        UNION ALL
        SELECT f.level, f.region, f.next_at FROM emitted e JOIN following f USING (level, region, polled_at)
        WHERE f.next_at IS NOT NULL""",
    # alerts that arrive in three batches by number: each key is walked batch by batch, in the order of time within one
    "batched": """
        SELECT *, row_number() OVER (PARTITION BY level, region ORDER BY position % 3, polled_at, position) AS place
        FROM bed_events""",
    "batched_next": """
        SELECT a.level, a.region, a.place, min(b.place) AS next_place
        FROM batched a JOIN batched b ON a.level = b.level AND a.region = b.region AND b.place > a.place
            AND b.polled_at >= a.polled_at + INTERVAL 6 HOUR
        GROUP BY a.level, a.region, a.place""",
    "batched_emitted": """
        SELECT level, region, place FROM batched WHERE place = 1
        UNION ALL
        SELECT n.level, n.region, n.next_place FROM batched_emitted e JOIN batched_next n USING (level, region, place)""",
    "region_labels": """
        SELECT region, CASE WHEN observed <= 60 THEN 'CRITICAL' WHEN observed <= 150 THEN 'WARNING' ELSE 'OK' END
                   AS severity, 'min_available_beds' AS metric, observed,
               CAST(CASE WHEN observed <= 60 THEN 60 WHEN observed <= 150 THEN 150 END AS BIGINT) AS threshold, hour,
               'avg=' || format('{:.1f}', avg_available_beds) || ', min=' || observed || ', samples=' || sample_count
                   AS detail
        FROM (SELECT DISTINCT ON (region) *, CAST(min_available_beds AS BIGINT) AS observed
              FROM bed_availability ORDER BY region, hour DESC)
        UNION ALL
        SELECT region, CASE WHEN event_count >= 3 THEN 'CRITICAL' WHEN event_count >= 2 THEN 'WARNING' ELSE 'OK' END,
               'hospital_admission_count', event_count,
               CASE WHEN event_count >= 3 THEN 3 WHEN event_count >= 2 THEN 2 END, hour,
               'event_type=hospital_admission, count=' || event_count
        FROM (SELECT DISTINCT ON (region) * FROM hourly_event_rate WHERE event_type = 'hospital_admission'
              ORDER BY region, hour DESC)""",
    "states": """
        SELECT 'hourly_event_rate' AS table_name, count(*) AS row_count, max(hour) AS latest_time
        FROM hourly_event_rate
        UNION ALL SELECT 'severity_trend', count(*), max(window_start) FROM severity_trend
        UNION ALL SELECT 'bed_availability', count(*), max(hour) FROM bed_availability
        UNION ALL SELECT 'vaccination_trend', count(*), max(hour) FROM vaccination_trend""",
    "health": f"""
        SELECT table_name, CASE WHEN row_count = 0 THEN 'EMPTY' WHEN age > 8 THEN 'STALE' ELSE 'HEALTHY' END AS status,
               age AS age_hours, row_count,
               CASE WHEN row_count = 0 THEN 'Table has no rows — Spark job may never have run or table was truncated'
                    ELSE 'Latest row is ' || format('{{:.1f}}', age)
                        || CASE WHEN age > 8 THEN 'h old (threshold: 8h) — Spark CronJob may have failed'
                                ELSE 'h old — within threshold' END END AS message
        FROM (SELECT *, {_age("TIMESTAMP '2024-01-31 07:00:00'", "latest_time")} AS age FROM states
              WHERE table_name <> 'vaccination_trend')""",
    "vaccination_totals": """
        SELECT region, vaccine_type, dose_number, CAST(sum(vaccination_count) AS BIGINT) AS vaccination_count,
               region || ' / ' || vaccine_type || ' dose ' || dose_number AS label
        FROM vaccination_trend GROUP BY region, vaccine_type, dose_number""",
}


def _used(body: str, ctes: dict[str, str]) -> list[str]:
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in ctes:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                pending.append(ctes[name])
    return [name for name in ctes if name in needed]


def _sql(body: str, ctes: dict[str, str] = CTES) -> str:
    used = _used(body, ctes)
    if not used:
        return body
    recursive = "RECURSIVE " if any(name.endswith("emitted") for name in used) else ""
    return f"WITH {recursive}" + ",\n".join(f"{name} AS ({ctes[name]})" for name in used) + f"\n{body}"


def _from_raw() -> dict[str, str]:
    """The expressions over the events that a run from raw messages stores: the valid ones that have a target."""
    judging = ["ev", "raw_all", "raw", "judged", "verdicts", "valid"]
    changed = {name: CTES[name] for name in judging}
    changed["stored"] = f"SELECT * FROM valid WHERE event_type IN {ROUTABLE}"
    for name, text in CTES.items():
        if name not in judging:
            changed[name] = re.sub(r"\bFROM ev\b", "FROM stored", text)
    return changed


def _polled() -> dict[str, str]:
    """Bed alerts at the first full minute at or after their own time."""
    minute = "make_timestamp((epoch_us(polled_at) + 59999999) // 60000000 * 60000000)"
    return {**CTES, "bed_events": f"SELECT * REPLACE ({minute} AS polled_at) FROM ({CTES['bed_events']})"}


def _cycle() -> dict[str, str]:
    """The feed of every poll, and the polls at which each key is emitted."""
    feeds = []
    for poll in POLLS:
        checks = CTES["quality_alerts"].replace(AS_OF, poll)
        feed = _STATEMENTS["alert_feed"].replace(AS_OF, poll).replace("FROM quality_alerts", f"FROM ({checks})")
        feeds.append(f"SELECT {poll} AS polled_at, * FROM ({feed})")
    return {
        **CTES,
        "cycle_feed": """
            SELECT *, row_number() OVER (PARTITION BY polled_at, level, metric, region
                                         ORDER BY check_order, position) AS place
            FROM (%s)""" % " UNION ALL ".join(feeds),
        "cycle_following": """
            SELECT *, min(polled_at) OVER (PARTITION BY level, metric, region ORDER BY polled_at
                                           RANGE BETWEEN INTERVAL 300 SECOND FOLLOWING AND UNBOUNDED FOLLOWING)
                       AS next_at
            FROM cycle_feed WHERE place = 1""",
        "cycle_emitted": """
            SELECT level, metric, region, min(polled_at) AS polled_at FROM cycle_feed GROUP BY ALL
            UNION ALL
            SELECT f.level, f.metric, f.region, f.next_at
            FROM cycle_emitted e JOIN cycle_following f USING (level, metric, region, polled_at)
            WHERE f.next_at IS NOT NULL""",
    }


def _pivot(
    aggregate: str, by: str, values: list[str], key: str, table: str, fill: str | None, cast: str | None = None
) -> str:
    cells = []
    for value in values:
        cell = f"{aggregate} FILTER ({by} = '{value}')"
        cell = f"coalesce({cell}, {fill})" if fill else cell
        cells.append(f'{f"CAST({cell} AS {cast})" if cast else cell} AS "{value}"')
    return f"SELECT {key}, {', '.join(cells)} FROM {table} GROUP BY {key}"


def _open_hours(table: str, hour: str, columns: str = "*") -> str:
    """The whole table; an hour is open until the newest event is two hours past its end."""
    newest = f'(SELECT max("timestamp") FROM ev WHERE event_type IN {ROUTABLE})'
    return f"SELECT {columns}, NOT {hour} + INTERVAL 1 HOUR <= {newest} - INTERVAL 2 HOUR AS is_open FROM {table}"


EVENT_COLUMNS = (
    '"offset", event_type, region, patient_id, severity, available_beds, schema_version, dose_number, vaccine_type, '
    "record_id, administered_at"
)
TYPES = ["symptom_report", "clinic_visit", "hospital_admission", "vaccination_record"]
VACCINATION_ROWS = "event_type = 'vaccination_record'"
# Events come in three slices; the watermark of a slice is two hours before the newest event of earlier ones.
SLICE_WATERMARKS = f"""
    SELECT part, lag(newest) OVER (ORDER BY part) - INTERVAL 2 HOUR AS watermark
    FROM (SELECT "offset" % 3 AS part, max(max("timestamp")) OVER (ORDER BY "offset" % 3) AS newest
          FROM ev WHERE event_type IN {ROUTABLE} GROUP BY "offset" % 3)"""
RATE_TABLE = "SELECT hour, event_type, region, event_count FROM hourly_event_rate"


def _bad_as_null(columns: str) -> str:
    names = [name.strip() for name in columns.split(",")]
    return ", ".join(n if n == '"offset"' else f"CASE WHEN NOT bad_json THEN {n} END AS {n}" for n in names)


_STATEMENTS = {
    # sources
    "scan_events": f"""
        SELECT {EVENT_COLUMNS}, "timestamp" FROM raw WHERE time_text <> 'not-a-time' AND region IS NOT NULL""",
    "parse_json_events": f"""
        SELECT {_bad_as_null(EVENT_COLUMNS)}, CASE WHEN NOT bad_json THEN time_text END AS "timestamp" FROM raw_all""",
    "clean_events": """
        SELECT "offset", "timestamp", event_type, region FROM raw
        WHERE time_text <> 'not-a-time' AND region IS NOT NULL""",
    "optional_source_present": f"""
        SELECT date_trunc('hour', "timestamp") AS hour, event_type, region, count(*) AS event_count
        FROM (SELECT "timestamp", event_type, region FROM ev
              WHERE event_type IN {ROUTABLE} AND event_type <> 'vaccination_record'
              UNION ALL
              SELECT "timestamp", event_type, region FROM raw
              WHERE {VACCINATION_ROWS} AND time_text <> 'not-a-time' AND region IS NOT NULL)
        GROUP BY ALL""",
    "optional_source_empty": "SELECT * FROM hourly_event_rate WHERE event_type <> 'vaccination_record'",
    "union_events": f"""SELECT "timestamp", event_type, region FROM ev WHERE event_type IN {ROUTABLE}""",
    "sample_events": f"""SELECT "offset" FROM ev WHERE {VACCINATION_ROWS} ORDER BY "offset" LIMIT 5""",
    "scan_result_tables": """
        SELECT 'hourly_event_rate' AS table_name, hour AS row_time, region FROM hourly_event_rate
        UNION ALL SELECT 'severity_trend', window_start, region FROM severity_trend
        UNION ALL SELECT 'bed_availability', hour, region FROM bed_availability
        UNION ALL SELECT 'vaccination_trend', hour, region FROM vaccination_trend
        UNION ALL SELECT 'outbreak_predictions', predicted_at, region FROM outbreak_predictions
        UNION ALL SELECT 'data_quality_checks', checked_at, NULL FROM data_quality_checks""",
    # validation and routing
    "validate_bad_json": """SELECT "offset", bad_json FROM raw_all""",
    "validate_base_required": f"""SELECT "offset", event_type, missing FROM judged WHERE NOT {VACCINATION_ROWS}""",
    "validate_vax_required": f"""SELECT "offset", missing FROM judged WHERE {VACCINATION_ROWS}""",
    "validate_timestamp": """SELECT "offset", time_text <> 'not-a-time' AS ok FROM raw""",
    "validate_schema_version": f"""SELECT "offset", schema_version = 2 AS ok FROM raw WHERE {VACCINATION_ROWS}""",
    "validate_dose_number": f"""SELECT "offset", dose_number >= 1 AS ok FROM raw WHERE {VACCINATION_ROWS}""",
    "validate_administered_at": f"""
        SELECT "offset", administered_at IS NOT NULL AS ok FROM raw WHERE {VACCINATION_ROWS}""",
    "validate_events": """
        SELECT "offset", event_type, reason, missing FROM verdicts
        UNION ALL SELECT "offset", NULL, 'bad_json', '' FROM raw_all WHERE bad_json""",
    "validation_summary": """
        SELECT (SELECT count(*) FROM raw_all) AS total_seen, (SELECT count(*) FROM valid) AS valid,
               (SELECT count(*) FROM raw_all) - (SELECT count(*) FROM valid) AS invalid""",
    "enrich_events": """
        SELECT "offset", 'team-a' AS team_id, '2024-01-31T12:00:00.000000Z' AS processing_timestamp,
               'event-generator' AS event_source, 'team-a' AS json_team_id,
               '2024-01-31T12:00:00.000000Z' AS json_processing_timestamp, 'event-generator' AS json_event_source,
               patient_id AS json_patient_id
        FROM valid""",
    "route_events": f"""
        SELECT "offset", event_type,
               CASE event_type WHEN 'symptom_report' THEN 'symptom_reports' WHEN 'clinic_visit' THEN 'clinic_visits'
                    WHEN 'hospital_admission' THEN 'hospital_admissions' ELSE 'vaccination_records' END AS topic
        FROM valid WHERE event_type IN {ROUTABLE}""",
    "unroutable_events": f"""SELECT "offset", event_type FROM valid WHERE event_type NOT IN {ROUTABLE}""",
    "routing_summary": f"""
        SELECT count(*) AS processed, count(*) FILTER (event_type IN {ROUTABLE}) AS routed,
               count(*) FILTER (event_type NOT IN {ROUTABLE}) AS dropped FROM valid""",
    # hourly aggregates
    "hourly_event_rate": f"{RATE_TABLE} ORDER BY hour, region, event_type",
    "severity_score": """
        SELECT "offset", severity,
               CAST(CASE WHEN severity = 'low' THEN 1 WHEN severity = 'moderate' THEN 2
                         WHEN severity IN ('high', 'severe') THEN 3 WHEN severity = 'critical' THEN 4 END AS DOUBLE)
                   AS score
        FROM ev WHERE severity IS NOT NULL""",
    "severity_trend": "SELECT * FROM severity_trend ORDER BY window_start, region, event_type",
    "bed_availability": "SELECT * FROM bed_availability ORDER BY hour, region",
    "vaccination_trend": "SELECT * FROM vaccination_trend ORDER BY hour, region, vaccine_type, dose_number",
    "topic_counts": f"SELECT event_type, count(*) AS row_count FROM ev WHERE event_type IN {ROUTABLE} GROUP BY 1",
    # outbreak risk
    "risk_event_features": "SELECT * FROM event_features",
    "risk_severity_features": "SELECT * FROM severity_features",
    "risk_bed_features": "SELECT * FROM bed_features",
    "risk_vaccination_features": "SELECT * FROM vaccination_features",
    "risk_joined_features": "SELECT * FROM features",
    "risk_component_scores": "SELECT * FROM scores",
    "outbreak_risk": "SELECT * FROM risk",
    "outbreak_risk_joined": "SELECT * FROM risk",
    "top_risk": """
        SELECT hour, region, total_events,
               CAST(round(CAST(avg_severity AS DECIMAL(18, 14)), 2) AS DOUBLE) AS avg_severity,
               min_available_beds, vaccination_count,
               CAST(round(CAST(outbreak_risk_score AS DECIMAL(18, 14)), 2) AS DOUBLE) AS outbreak_risk_score,
               outbreak_risk_level
        FROM (SELECT * FROM risk ORDER BY outbreak_risk_score DESC, hour, region LIMIT 10)""",
    # top-k, latest rows, retention
    "latest_beds": "SELECT DISTINCT ON (region) * FROM bed_availability ORDER BY region, hour DESC",
    "latest_admission_rate": f"""
        SELECT DISTINCT ON (region) * FROM ({RATE_TABLE}) WHERE event_type = 'hospital_admission'
        ORDER BY region, hour DESC""",
    "top_event_rate": "SELECT * FROM top_rate",
    "top_severity": "SELECT * FROM top_sev",
    "top_bed_pressure": "SELECT * FROM top_bed",
    "vaccination_latest_hour": "SELECT * FROM latest_doses",
    "recent_rows": f"{RATE_TABLE} ORDER BY hour DESC, region, event_type LIMIT 10",
    "recent_vaccinations": """
        SELECT * FROM vaccination_trend ORDER BY hour DESC, region, vaccine_type, dose_number LIMIT 20""",
    "recent_checks": "SELECT * FROM data_quality_checks ORDER BY checked_at DESC, table_name, check_name LIMIT 20",
    "retention_filter": f"SELECT * FROM hourly_event_rate WHERE NOT hour < {AS_OF} - INTERVAL 7 DAY",
    # data quality
    "dq_null_keys": """
        SELECT 'decoded_events' AS table_name, count(*) AS row_count,
               count(*) FILTER (bad_json OR region IS NULL) AS null_rows FROM raw_all
        UNION ALL SELECT table_name, row_count, 0 FROM states""",
    "dq_freshness": f"""
        SELECT table_name, row_count, latest_time AS latest_timestamp, {_age(AS_OF, "latest_time")} AS age_hours
        FROM states""",
    "dq_table_state": f"""
        {_all_state_checks(AS_OF)}
        UNION ALL SELECT {AS_OF}, 'table_exists', 'outbreak_predictions', 'FAIL', NULL, NULL,
                         'Expected table outbreak_predictions does not exist'""",
    "dq_domain": f"""
        {_all_domain_checks(AS_OF)}
        UNION ALL {_prediction_check("WARN", "ML has not created outbreak_predictions yet", AS_OF)}""",
    "dq_report": _report(AS_OF),
    "dq_summary": """
        SELECT count(*) AS total_checks, count(*) FILTER (status = 'PASS') AS passed,
               count(*) FILTER (status = 'WARN') AS warned, count(*) FILTER (status = 'FAIL') AS failed
        FROM data_quality_checks""",
    # alerts
    "classify_levels": """
        SELECT 'event_rate' AS metric, hour AS row_time, region, CAST(event_count AS DOUBLE) AS observed,
               CASE WHEN event_count >= 3 THEN 'critical' WHEN event_count >= 2 THEN 'warning' END AS level
        FROM hourly_event_rate
        UNION ALL
        SELECT 'severity', window_start, region, avg_severity,
               CASE WHEN avg_severity >= 3 THEN 'critical' WHEN avg_severity >= 2 THEN 'warning' END
        FROM severity_trend
        UNION ALL
        SELECT 'bed_availability', hour, region, CAST(min_available_beds AS DOUBLE),
               CASE WHEN min_available_beds <= 50 THEN 'critical' WHEN min_available_beds <= 100 THEN 'warning' END
        FROM bed_availability""",
    "alert_event_rate": "SELECT * FROM rate_alerts",
    "alert_severity": "SELECT * FROM severity_alerts",
    "alert_bed_availability": "SELECT * FROM bed_alerts",
    "alert_vaccination": "SELECT * FROM vaccination_alerts",
    "alert_data_quality": "SELECT * FROM quality_alerts",
    "alert_pipeline_freshness": f"""
        SELECT 6 AS check_order, latest AS event_time, CAST(0 AS DOUBLE) AS sort_value, 'critical' AS level,
               'pipeline_freshness' AS metric, 'all' AS region,
               'hourly_event_rate latest row is ' || format('{{:.1f}}', age) || 'h old; threshold is 8h' AS message
        FROM (SELECT latest, {_age("TIMESTAMP '2024-01-31 12:21:00'", "latest")} AS age
              FROM (SELECT max(hour) AS latest FROM hourly_event_rate))
        WHERE age > 8""",
    "alert_feed": f"""
        SELECT *, row_number() OVER (PARTITION BY check_order ORDER BY event_time DESC, sort_value, region, message)
                   AS position
        FROM (SELECT * FROM rate_alerts UNION ALL SELECT * FROM severity_alerts UNION ALL SELECT * FROM bed_alerts
              UNION ALL SELECT * FROM vaccination_alerts UNION ALL SELECT * FROM quality_alerts
              UNION ALL
              SELECT 6, latest, 0, 'critical', 'pipeline_freshness', 'all',
                     'hourly_event_rate latest row is ' || format('{{:.1f}}', {_age(AS_OF, "latest")})
                         || 'h old; threshold is 8h'
              FROM (SELECT max(hour) AS latest FROM hourly_event_rate) WHERE {_age(AS_OF, "latest")} > 8)""",
    "alert_cooldown": """
        SELECT b.*, CASE WHEN m.position IS NOT NULL THEN 'EMITTED' ELSE 'SUPPRESSED' END AS status
        FROM bed_events b LEFT JOIN (
            SELECT * FROM bed_moments JOIN emitted USING (level, region, polled_at)
        ) m USING (level, region, polled_at, position)""",
    # reports
    "bed_warning_report": "SELECT * FROM region_labels WHERE severity <> 'OK'",
    "bed_warning_summary": """
        SELECT count(*) FILTER (metric = 'min_available_beds') AS regions_checked_beds,
               count(*) FILTER (metric = 'hospital_admission_count') AS regions_checked_admissions,
               count(*) FILTER (severity <> 'OK') AS warnings_raised,
               count(*) FILTER (severity = 'CRITICAL') AS criticals_raised FROM region_labels""",
    "table_state": "SELECT * FROM states",
    "pipeline_health": "SELECT * FROM health",
    "pipeline_health_summary": """
        SELECT count(*) FILTER (status = 'HEALTHY') AS tables_healthy,
               count(*) FILTER (status <> 'HEALTHY') AS tables_unhealthy, count(*) AS tables_checked,
               CASE WHEN bool_and(status = 'HEALTHY') THEN 'HEALTHY' ELSE 'UNHEALTHY' END AS overall FROM health""",
    "table_row_counts": """
        SELECT table_name, row_count FROM states
        UNION ALL SELECT 'outbreak_predictions', count(*) FROM outbreak_predictions
        UNION ALL SELECT 'data_quality_checks', count(*) FROM data_quality_checks""",
    # chart tables
    "chart_event_rate": _pivot("sum(event_count)", "event_type", TYPES, "hour", "hourly_event_rate", "0", "BIGINT"),
    "chart_region_totals": """
        SELECT region, event_type, CAST(sum(event_count) AS BIGINT) AS event_count FROM hourly_event_rate
        GROUP BY region, event_type ORDER BY region, event_type LIMIT 12""",
    "chart_severity": _pivot("avg(avg_severity)", "region", REGIONS, "window_start", "severity_trend", "0"),
    "chart_beds": _pivot("min(min_available_beds)", "region", REGIONS, "hour", "bed_availability", None),
    "chart_risk": _pivot("avg(outbreak_risk_score)", "region", REGIONS, "hour", "outbreak_predictions", None),
    "chart_vaccination": "SELECT * FROM vaccination_totals",
    "chart_dq_status": """
        SELECT status, (SELECT count(*) FROM data_quality_checks c WHERE c.status = s.status) AS checks
        FROM (VALUES ('PASS'), ('WARN'), ('FAIL')) s(status)""",
    "chart_top_severity": """
        SELECT * FROM severity_trend ORDER BY avg_severity DESC, window_start, region, event_type LIMIT 10""",
    "chart_top_beds": "SELECT * FROM bed_availability ORDER BY min_available_beds, hour, region LIMIT 10",
    "chart_top_risk": "SELECT * FROM outbreak_predictions ORDER BY outbreak_risk_score DESC, hour, region LIMIT 10",
    "chart_top_vaccination": """
        SELECT * FROM vaccination_totals
        ORDER BY vaccination_count DESC, region, vaccine_type, dose_number LIMIT 10""",
    "chart_recent_checks": """
        SELECT * FROM data_quality_checks ORDER BY checked_at DESC, table_name, check_name LIMIT 12""",
    # stored tables
    "sink_full_refresh": "SELECT * FROM states",
    "stored_hourly_event_rate": f"{RATE_TABLE} ORDER BY hour, region, event_type",
    "stored_severity_trend": "SELECT * FROM severity_trend ORDER BY window_start, region, event_type",
    "stored_bed_availability": "SELECT * FROM bed_availability ORDER BY hour, region",
    "stored_vaccination_trend": "SELECT * FROM vaccination_trend ORDER BY hour, region, vaccine_type, dose_number",
    "stored_outbreak_predictions": "SELECT * FROM outbreak_predictions ORDER BY predicted_at, hour, region",
    "stored_data_quality_checks": "SELECT * FROM data_quality_checks ORDER BY checked_at, table_name, check_name",
    "retention_clean_up": f"""
        SELECT * FROM hourly_event_rate WHERE NOT hour < date_trunc('day', {AS_OF} - INTERVAL 7 DAY)""",
    "pipeline_refresh": RATE_TABLE,
    "pipeline_refresh_state": "SELECT * FROM states",
    "predictions_refresh": "SELECT * FROM outbreak_predictions",
    "dq_history_append": "SELECT * FROM data_quality_checks",
    "incremental_hourly_event_rate": RATE_TABLE,
    "incremental_severity_trend": "SELECT * FROM severity_trend",
    "incremental_bed_availability": "SELECT * FROM bed_availability",
    "incremental_vaccination_trend": "SELECT * FROM vaccination_trend",
    # streams
    "ingest_stream": """
        SELECT "offset", CASE WHEN reason = 'valid' THEN 'valid' ELSE 'invalid' END AS verdict, reason FROM verdicts
        UNION ALL SELECT "offset", 'invalid', 'bad_json' FROM raw_all WHERE bad_json""",
    "publish_valid": "SELECT event_type, region, patient_id FROM valid",
    "publish_routed": f"""
        SELECT CASE event_type WHEN 'symptom_report' THEN 'symptom_reports' WHEN 'clinic_visit' THEN 'clinic_visits'
                    WHEN 'hospital_admission' THEN 'hospital_admissions' ELSE 'vaccination_records' END AS topic,
               count(*) AS messages
        FROM valid WHERE event_type IN {ROUTABLE} GROUP BY 1""",
    "ingest_stream_summary": """
        SELECT (SELECT count(*) FROM raw_all) AS total_seen, (SELECT count(*) FROM valid) AS valid,
               (SELECT count(*) FROM raw_all) - (SELECT count(*) FROM valid) AS invalid""",
    "route_stream_summary": f"""
        SELECT count(*) AS processed, count(*) FILTER (event_type IN {ROUTABLE}) AS routed,
               count(*) FILTER (event_type NOT IN {ROUTABLE}) AS dropped FROM valid""",
    "stream_hourly_rate": _open_hours("hourly_event_rate", "hour", "hour, event_type, region, event_count"),
    "stream_severity_trend": _open_hours("severity_trend", "window_start"),
    "stream_bed_availability": _open_hours("bed_availability", "hour"),
    "stream_vaccination_trend": _open_hours("vaccination_trend", "hour"),
    "stream_late_events": f"""
        SELECT "timestamp", event_type, region, watermark
        FROM (SELECT * FROM ev WHERE event_type IN {ROUTABLE}) JOIN ({SLICE_WATERMARKS}) ON part = "offset" % 3
        WHERE date_trunc('hour', "timestamp") + INTERVAL 1 HOUR <= watermark""",
    "stream_progress": f"""
        SELECT part AS batch_number, max("timestamp") AS newest_time, count(*) AS row_count,
               count(*) FILTER (date_trunc('hour', "timestamp") + INTERVAL 1 HOUR <= watermark) AS late_count, watermark
        FROM (SELECT * FROM ev WHERE event_type IN {ROUTABLE}) JOIN ({SLICE_WATERMARKS}) ON part = "offset" % 3
        GROUP BY part, watermark""",
    "alert_cooldown_stream_status": """
        SELECT level, 'bed_availability' AS metric, region, polled_at, position,
               CASE WHEN e.place IS NULL THEN 'SUPPRESSED' ELSE 'EMITTED' END AS status
        FROM batched b LEFT JOIN batched_emitted e USING (level, region, place)""",
    "alert_cooldown_stream": """
        SELECT level, 'bed_availability' AS metric, region, polled_at AS emitted_at FROM emitted""",
}

ORACLES = {name: _sql(body) for name, body in _STATEMENTS.items()} | {
    "pipeline_from_raw": _sql("SELECT * FROM outbreak_predictions", _from_raw()),
    "alert_cooldown_polled": _sql(_STATEMENTS["alert_cooldown"], _polled()),
    "alert_cycle": _sql(
        """
        SELECT f.* EXCLUDE (place),
               CASE WHEN place = 1 AND e.polled_at IS NOT NULL THEN 'EMITTED' ELSE 'SUPPRESSED' END AS status
        FROM cycle_feed f LEFT JOIN cycle_emitted e
            ON (f.level, f.metric, f.region, f.polled_at) = (e.level, e.metric, e.region, e.polled_at)""",
        _cycle(),
    ),
}
