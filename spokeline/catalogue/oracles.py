"""The same results as SQL over the given tables."""

NOW = "TIMESTAMP '2024-01-31 00:00:00'"

STATIONS = """
stations AS (
    SELECT CAST(c_custkey AS VARCHAR) AS station_code, c_name AS name,
           CAST(c_custkey % 50 AS INTEGER) AS capacity,
           CASE WHEN c_acctbal >= 0 THEN CAST(48 AS DOUBLE) + c_acctbal / 100000 END AS lat,
           CASE WHEN c_acctbal >= 0 THEN CAST(2 AS DOUBLE) + c_acctbal / 100000 END AS lon,
           CASE WHEN c_nationkey BETWEEN 1 AND 99 THEN c_nationkey END AS arrondissement
    FROM customer)"""

STATUS = """
base AS (
    SELECT *, CAST(floor(value) AS INTEGER) AS bikes,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS docks
    FROM events),
status AS (
    SELECT CAST(user_id AS VARCHAR) AS station_code, bikes AS num_bikes_available,
           docks AS num_docks_available, bikes % 10 AS num_ebikes,
           bikes - bikes % 10 AS num_mechanical, event_type <> 'error' AS is_renting,
           ts AS last_reported, date_trunc('hour', ts) AS ingested_at, event_id
    FROM base)"""

LATEST = """
latest AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY station_code
            ORDER BY ingested_at DESC NULLS FIRST, event_id DESC) AS rn FROM status)
    WHERE rn = 1)"""

CURRENT = """
current_rows AS (
    SELECT s.station_code, s.name, s.arrondissement, s.capacity, s.lat, s.lon,
           st.num_bikes_available, st.num_docks_available, st.num_ebikes, st.num_mechanical,
           st.is_renting, st.last_reported,
           round(CAST(100 AS DOUBLE) * st.num_bikes_available / nullif(s.capacity, 0), 1)
               AS fill_rate_pct
    FROM stations s JOIN status st ON s.station_code = st.station_code
    WHERE st.ingested_at = (SELECT max(ingested_at) FROM status s2
                            WHERE s2.station_code = st.station_code))"""


def _mean_rate(bikes: str, capacity: str) -> str:
    """Mean fill rate with 16 decimals per rate, in whole numbers."""
    rate = f"(CAST({bikes} AS HUGEINT) * 2000000000000000000 + {capacity}) // (2 * {capacity})"
    rates = f"CASE WHEN {capacity} <> 0 THEN {rate} END"
    unit = "CAST(1000000000000000 AS HUGEINT)"
    return f"""CAST((2 * sum({rates}) + count({rates}) * {unit})
               // (2 * count({rates}) * {unit}) AS DOUBLE) / 10"""


def _totals(source: str, time: str, group: str) -> str:
    return f"""
    SELECT s.arrondissement, {time} AS snapshot_time,
           CAST(count(DISTINCT s.station_code) AS INTEGER) AS total_stations,
           CAST(sum(st.num_bikes_available) AS INTEGER) AS total_bikes,
           CAST(sum(st.num_docks_available) AS INTEGER) AS total_docks,
           CAST(sum(st.num_ebikes) AS INTEGER) AS total_ebikes,
           {_mean_rate('st.num_bikes_available', 's.capacity')} AS avg_fill_rate,
           CAST(count(*) FILTER (WHERE st.num_bikes_available = 0) AS INTEGER) AS empty_stations,
           CAST(count(*) FILTER (WHERE st.num_docks_available = 0) AS INTEGER) AS full_stations
    FROM stations s JOIN {source} st ON s.station_code = st.station_code
    WHERE s.arrondissement IS NOT NULL GROUP BY {group}"""


def _trend(now: str) -> str:
    return f"""
    SELECT station_code, date_trunc('hour', ingested_at) AS hour_bucket,
           round(avg(num_bikes_available), 2) AS avg_bikes,
           round(avg(num_docks_available), 2) AS avg_docks,
           min(num_bikes_available) AS min_bikes, max(num_bikes_available) AS max_bikes,
           CAST(count(*) AS INTEGER) AS snapshots_count
    FROM status WHERE ingested_at > {now} - INTERVAL 24 HOURS
    GROUP BY station_code, date_trunc('hour', ingested_at)"""


BOTH = f"WITH {STATIONS}, {STATUS}"
ROLLUP = f"rollup_rows AS ({_totals('latest', NOW, 's.arrondissement')})"
WITH_ROLLUP = f"{BOTH}, {LATEST}, {ROLLUP}"
HISTORY = f"""{BOTH}, hourly_latest AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY station_code, ingested_at
            ORDER BY event_id DESC) AS rn FROM status)
    WHERE rn = 1),
history AS ({_totals('hourly_latest', 'st.ingested_at', 's.arrondissement, st.ingested_at')})"""
WITH_CURRENT = f"{BOTH}, {CURRENT}"

CRITICAL = """SELECT * FROM current_rows WHERE num_bikes_available < 3 AND is_renting
    ORDER BY num_bikes_available NULLS LAST, station_code, last_reported"""


def _kpis(renting: str) -> str:
    return f"""
    SELECT CAST(sum(num_bikes_available) AS BIGINT) AS total_bikes,
           CAST(sum(num_docks_available) AS BIGINT) AS total_docks,
           count(*) AS total_stations, CAST(sum(num_ebikes) AS BIGINT) AS total_ebikes,
           count(*) FILTER (WHERE num_bikes_available = 0) AS empty_stations,
           {_mean_rate('num_bikes_available', 'capacity')} AS avg_fill_pct
    FROM current_rows WHERE {renting}"""


EVENT_TYPE = """CASE WHEN bikes = 0 THEN 'empty_station' WHEN bikes < 3 THEN 'low_bikes'
    WHEN docks = 0 THEN 'full_station' ELSE 'snapshot' END"""
# The alert styles of the event types.
COLOUR = """CASE event_type
    WHEN 'empty_station' THEN 'background-color: #d62728; color: white'
    WHEN 'low_bikes' THEN 'background-color: #ff7f0e; color: white'
    WHEN 'full_station' THEN 'background-color: #1f77b4; color: white' ELSE '' END"""
CLASSIFIED = f"""{STATUS}, classified AS (
    SELECT event_id, ts, CAST(user_id AS VARCHAR) AS station_code, {EVENT_TYPE} AS event_type,
           bikes, docks FROM base)"""

# What each form of a record comes to: view is typed, click is text, purchase is sparse, signup
# has no code, and error is malformed or too large.
RECORDS = f"""{STATUS}, parsed AS (
    SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS source, event_type,
        CAST(CASE WHEN event_type = 'purchase' THEN user_id ELSE user_id * 1000 + 7 END AS VARCHAR)
            AS station_code,
        CASE WHEN event_type = 'view' THEN 'S' || user_id ELSE '' END AS name,
        CAST(CASE WHEN event_type = 'purchase' THEN 0 ELSE user_id % 50 END AS INTEGER) AS capacity,
        CASE event_type WHEN 'view' THEN CAST(48 AS DOUBLE) + CAST(docks AS DOUBLE) / 1000
            WHEN 'click' THEN CAST(48.25 AS DOUBLE) END AS lat,
        CASE event_type WHEN 'view' THEN CAST(2 AS DOUBLE) + CAST(docks AS DOUBLE) / 1000 END
            AS lon,
        CASE WHEN event_type = 'purchase' THEN 0 ELSE bikes END AS num_bikes_available,
        docks AS num_docks_available,
        CASE event_type WHEN 'view' THEN bikes % 10 WHEN 'click' THEN 1 ELSE 0 END AS num_ebikes,
        CASE event_type WHEN 'view' THEN CAST(trunc(value) AS INTEGER) WHEN 'click' THEN 1000
            ELSE 0 END AS num_mechanical,
        event_type <> 'purchase' AS is_installed, event_type = 'view' AS is_renting,
        event_type <> 'click' AS is_returning,
        CASE event_type WHEN 'view' THEN ts - INTERVAL 2 HOURS WHEN 'click' THEN ts ELSE {NOW} END
            AS last_reported
    FROM base WHERE event_type IN ('view', 'click', 'purchase')),
rows AS (
    SELECT *, CASE WHEN length(station_code) > 3
        AND CAST(left(station_code, length(station_code) - 3) AS BIGINT) BETWEEN 1 AND 99
        THEN CAST(left(station_code, length(station_code) - 3) AS INTEGER) END AS arrondissement
    FROM parsed)"""

MESSAGE_ROWS = f"""{STATUS}, published AS (
    SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS source,
        CASE event_type WHEN 'view' THEN CAST(user_id * 1000 + 7 AS VARCHAR)
            WHEN 'click' THEN chr(10) || ' ' || (user_id * 1000 + 7) || ' '
            WHEN 'signup' THEN '' ELSE CAST(user_id AS VARCHAR) END AS station_code,
        CASE event_type WHEN 'view' THEN ' S' || user_id || chr(9) WHEN 'signup' THEN 'x'
            WHEN 'purchase' THEN ''
            WHEN 'error' THEN CASE WHEN bikes >= 60 THEN '' WHEN bikes < 30 THEN 'x' END
            END AS name,
        CASE WHEN event_type IN ('view', 'click', 'signup') THEN bikes
            WHEN event_type = 'purchase' THEN 0 END AS num_bikes_available,
        CASE WHEN event_type IN ('view', 'click', 'purchase') THEN docks ELSE 0 END
            AS num_docks_available,
        CASE event_type WHEN 'view' THEN bikes % 10 WHEN 'click' THEN 1 ELSE 0 END AS num_ebikes,
        CASE event_type WHEN 'view' THEN CAST(trunc(value) AS INTEGER) WHEN 'click' THEN 1000
            ELSE 0 END AS num_mechanical,
        CASE WHEN event_type IN ('view', 'click') THEN CAST(user_id % 50 AS INTEGER)
            WHEN event_type = 'error' AND bikes >= 60 THEN docks ELSE 0 END AS capacity,
        event_type NOT IN ('click', 'purchase') AS is_renting,
        CASE event_type WHEN 'view' THEN CAST(48 AS DOUBLE) + CAST(docks AS DOUBLE) / 1000
            WHEN 'click' THEN CAST(0 AS DOUBLE) END AS lat,
        CASE event_type WHEN 'view' THEN CAST(2 AS DOUBLE) + CAST(docks AS DOUBLE) / 1000 END
            AS lon,
        CASE WHEN event_type <> 'error' THEN NULL
            WHEN bikes < 60 THEN 'num_bikes_available is not an integer'
            ELSE 'num_bikes_available is out of range' END AS reason
    FROM base),
messages AS (
    SELECT station_code AS key, *, CASE WHEN num_bikes_available = 0 THEN 'empty_station'
        WHEN num_bikes_available < 3 THEN 'low_bikes'
        WHEN num_docks_available = 0 THEN 'full_station' ELSE 'snapshot' END AS event_type
    FROM published)"""

TOPIC = f"""{STATUS}, consumed AS (
    SELECT event_id AS "offset", event_type AS form, bikes,
        CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS station_code,
        CASE event_type WHEN 'view' THEN 'view' WHEN 'purchase' THEN NULL
            WHEN 'error' THEN CASE WHEN bikes < 60 THEN 'error' ELSE 'snapshot' END
            ELSE 'snapshot' END AS event_type,
        CASE event_type WHEN 'view' THEN bikes WHEN 'signup' THEN bikes
            WHEN 'purchase' THEN NULL ELSE 0 END AS num_bikes_available,
        CASE event_type WHEN 'view' THEN docks ELSE 0 END AS num_docks_available,
        CASE WHEN event_type = 'view' THEN bikes % 10
            WHEN event_type = 'error' AND bikes < 60 THEN docks ELSE 0 END AS num_ebikes,
        CASE event_type WHEN 'click' THEN docks END AS extra,
        CASE WHEN event_type <> 'error' THEN NULL
            WHEN bikes < 60 THEN 'station code is missing' ELSE 'message is not JSON' END AS reason
    FROM base)"""

# All records, and all of them five minutes later with values larger by 7.
LATER = RECORDS.replace("SELECT *, CAST(floor(value)", "SELECT * REPLACE (value + 7 AS value), CAST(floor(value + 7)")
LOADS = f"""WITH {RECORDS}, first_load AS (SELECT * FROM rows),
second_load AS (WITH {LATER} SELECT * FROM rows),
loads AS (
    SELECT r.* EXCLUDE (last_reported), {NOW} AS ingested_at, last_reported FROM first_load r
    UNION ALL
    SELECT r.* EXCLUDE (last_reported), {NOW} + INTERVAL 5 MINUTES AS ingested_at,
           CASE WHEN event_type = 'purchase' THEN {NOW} + INTERVAL 5 MINUTES ELSE last_reported END
    FROM second_load r)"""

ORACLES = {
    "district_rollup": f"{WITH_ROLLUP} SELECT * FROM rollup_rows",
    "hourly_trend": f"WITH {STATUS} {_trend(NOW)}",
    "hourly_trend_station": f"""WITH {STATUS}, trend AS ({_trend(NOW)})
        SELECT hour_bucket, avg_bikes, avg_docks, snapshots_count FROM trend
        WHERE station_code = '7' AND hour_bucket > {NOW} - INTERVAL 24 HOURS
        ORDER BY hour_bucket""",
    "current_status": f"{WITH_CURRENT} SELECT * FROM current_rows",
    "latest_status_one": f"WITH {STATUS}, {LATEST} SELECT * FROM latest",
    "critical_stations": f"{WITH_CURRENT} {CRITICAL}",
    "critical_stations_view": f"{WITH_CURRENT} {CRITICAL}",
    "top_active_stations": f"""WITH {STATUS}
        SELECT station_code, count(*) AS snapshot_count, avg(num_bikes_available) AS avg_bikes,
               min(num_bikes_available) AS min_bikes, max(num_bikes_available) AS max_bikes
        FROM status WHERE ingested_at > {NOW} - INTERVAL 24 HOURS
        GROUP BY station_code ORDER BY snapshot_count DESC, station_code LIMIT 10""",
    "kpi_summary": f"{WITH_CURRENT} {_kpis('is_renting')}",
    "kpi_empty": f"{WITH_CURRENT} {_kpis('capacity < 0')}",
    "kpi_cards": f"""{WITH_CURRENT}, kpi AS ({_kpis('is_renting')})
        SELECT coalesce(total_bikes, 0) AS total_bikes, coalesce(total_docks, 0) AS total_docks,
               total_stations, coalesce(total_ebikes, 0) AS total_ebikes, empty_stations,
               printf('%.1f%%', coalesce(avg_fill_pct, 0)) AS avg_fill_label FROM kpi""",
    "station_map": f"""{WITH_CURRENT}
        SELECT name, lat, lon, arrondissement, num_bikes_available, num_docks_available,
               capacity, fill_rate_pct, is_renting,
               CASE WHEN fill_rate_pct IS NOT NULL
                   THEN greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE), fill_rate_pct)) END
                   AS colour_value
        FROM current_rows WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    "district_history": f"{HISTORY} SELECT * FROM history",
    "district_latest_snapshot": f"""{HISTORY}
        SELECT arrondissement, snapshot_time, total_bikes, total_docks, total_stations,
               avg_fill_rate, empty_stations, full_stations
        FROM history WHERE snapshot_time = (SELECT max(snapshot_time) FROM history)
        ORDER BY arrondissement""",
    "district_long": f"""{WITH_ROLLUP}
        SELECT arrondissement, 'total_bikes' AS variable, total_bikes AS value FROM rollup_rows
        UNION ALL
        SELECT arrondissement, 'empty_stations', empty_stations FROM rollup_rows""",
    "fill_labels": f"""{WITH_ROLLUP}
        SELECT CAST(arrondissement AS VARCHAR) AS district, avg_fill_rate,
               CASE WHEN avg_fill_rate IS NOT NULL
                   THEN greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE), avg_fill_rate)) END
                   AS colour_value,
               CASE WHEN avg_fill_rate IS NOT NULL THEN printf('%.1f%%', avg_fill_rate) END
                   AS fill_label
        FROM rollup_rows""",
    "recent_events": f"""WITH {CLASSIFIED}
        SELECT ts AS consumed_at, station_code, event_type, bikes AS num_bikes_available,
               docks AS num_docks_available, {COLOUR} AS alert_colour
        FROM classified ORDER BY ts DESC, event_id DESC LIMIT 50""",
    "classify_events": f"""WITH {CLASSIFIED}
        SELECT event_id, event_type, {COLOUR} AS alert_colour FROM classified""",
    "fill_rate_rows": f"""WITH {STATUS}, rates AS (
            SELECT event_id, round(CAST(100 AS DOUBLE) * bikes / nullif(docks, 0), 1) AS rate
            FROM base)
        SELECT event_id, rate AS fill_rate_pct, CASE WHEN rate IS NOT NULL
            THEN greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE), rate)) END AS colour_value
        FROM rates""",
    "district_parse": """WITH codes AS (
            SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS code FROM orders),
        numbers AS (
            SELECT o_orderkey, CASE WHEN length(code) > 3
                THEN CAST(left(code, length(code) - 3) AS INTEGER) END AS n FROM codes)
        SELECT o_orderkey, CASE WHEN n BETWEEN 1 AND 99 THEN n END AS arrondissement
        FROM numbers""",
    "payload_fields": f"""WITH {TOPIC}
        SELECT "offset", station_code, event_type, num_bikes_available, num_docks_available,
               CASE WHEN form = 'error' AND bikes >= 60 THEN 0 ELSE num_ebikes END AS num_ebikes,
               extra, reason FROM consumed""",
    "export_parse": f"""WITH {RECORDS}
        SELECT station_code, name, capacity, lat, lon, arrondissement, {NOW} AS ingested_at,
               source, num_bikes_available, num_docks_available, num_ebikes, num_mechanical,
               is_installed, is_renting, is_returning, last_reported FROM rows""",
    "export_rejects": f"""WITH {STATUS}
        SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS source, 0 AS pos,
               CASE WHEN bikes < 60 THEN 'num_bikes_available is not an integer'
                   ELSE 'num_bikes_available is out of range' END AS reason
        FROM base WHERE event_type = 'error'""",
    "message_json": f"""WITH {MESSAGE_ROWS}
        SELECT key, station_code, name, num_bikes_available, num_docks_available, num_ebikes,
               num_mechanical, capacity, is_renting, lat, lon,
               '2024-01-31T00:00:00' AS produced_at, event_type
        FROM messages WHERE reason IS NULL""",
    "status_upsert": """WITH numbered AS (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate,
                       l_partkey, l_suppkey, l_quantity, l_extendedprice) AS first_rank,
                   row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
                       l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                       l_extendedprice DESC) AS last_rank
            FROM lineitem)
        SELECT n.l_orderkey, n.l_partkey, n.l_suppkey, n.l_linenumber, n.l_quantity,
               n.l_extendedprice, n.l_discount, n.l_tax, f.l_returnflag, f.l_linestatus, n.l_shipdate
        FROM numbered n JOIN numbered f
            ON n.l_orderkey = f.l_orderkey AND n.l_linenumber = f.l_linenumber
        WHERE n.last_rank = 1 AND f.first_rank = 1""",
    "stations_upsert": f"""WITH {STATIONS}, newest AS (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY o_custkey
                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
            WHERE rn = 1),
        changed AS (
            SELECT CAST(o_custkey * 2 AS VARCHAR) AS station_code, o_orderpriority AS name,
                   CAST(floor(o_totalprice) AS INTEGER) AS capacity, CAST(NULL AS DOUBLE) AS lat,
                   o_totalprice AS lon, 1 AS arrondissement FROM newest)
        SELECT * FROM changed
        UNION ALL
        SELECT * FROM stations WHERE station_code NOT IN (SELECT station_code FROM changed)""",
    "rollup_upsert_rerun": f"{WITH_ROLLUP} SELECT * FROM rollup_rows",
    "trend_upsert": f"""WITH {STATUS},
        first_run AS ({_trend(NOW + " - INTERVAL 12 HOURS")}),
        second_run AS ({_trend(NOW)})
        SELECT * FROM second_run
        UNION ALL
        SELECT f.* FROM first_run f LEFT JOIN second_run s
            ON f.station_code = s.station_code AND f.hour_bucket = s.hour_bucket
        WHERE s.station_code IS NULL""",
    "dq_counts": f"""{BOTH}, counts AS (
            SELECT 'raw_stations' AS label, count(*) AS row_count FROM stations
            UNION ALL
            SELECT 'raw_station_status (last hour)', count(*) FROM status
                WHERE ingested_at > {NOW} - INTERVAL 1 HOUR
            UNION ALL
            SELECT 'stream_events (last hour)', count(*) FROM events
                WHERE ts > {NOW} - INTERVAL 1 HOUR)
        SELECT label, row_count, row_count = 0 AND label = 'raw_stations' AS fatal,
               NOT (row_count = 0 AND label = 'raw_stations') AS passed FROM counts""",
    "stream_feed": f"""WITH {MESSAGE_ROWS}
        SELECT key, station_code, name, num_bikes_available, num_docks_available, num_ebikes,
               num_mechanical, capacity, is_renting, lat, lon, event_type
        FROM messages WHERE reason IS NULL""",
    "stream_ingest": f"""WITH {TOPIC}
        SELECT "offset", station_code, event_type, num_bikes_available, num_docks_available,
               num_ebikes FROM consumed WHERE reason IS NULL""",
    "stream_order": f"""WITH {TOPIC}
        SELECT station_code, count(*) AS n_events, true AS in_order
        FROM consumed WHERE reason IS NULL GROUP BY station_code""",
    "payload_stored": f"""WITH {TOPIC}
        SELECT "offset", c.station_code, extra,
               CASE WHEN form IN ('view', 'signup') THEN bikes END AS bikes,
               CAST(e.ts AS DATE) AS consumed_date
        FROM consumed c JOIN events e ON e.event_id = c."offset" WHERE reason IS NULL""",
    "batch_run": f"""WITH {RECORDS}, newest AS (
            SELECT * EXCLUDE (rn) FROM (
                SELECT *, row_number() OVER (PARTITION BY station_code
                    ORDER BY last_reported DESC, source DESC) AS rn FROM rows)
            WHERE rn = 1),
        stations AS (
            SELECT * EXCLUDE (rn) FROM (
                SELECT station_code, arrondissement, capacity, row_number() OVER (
                    PARTITION BY station_code ORDER BY source DESC) AS rn FROM rows)
            WHERE rn = 1)
        {_totals('newest', NOW, 's.arrondissement')}""",
    "export_files": f"""WITH {RECORDS}, numbered AS (
            SELECT event_id, event_id // 1000 AS file,
                   row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1 AS pos
            FROM events)
        SELECT file, pos, station_code, num_bikes_available, num_docks_available, is_renting
        FROM rows JOIN numbered ON CAST(source AS BIGINT) = event_id""",
    "batch_rerun": f"""{LOADS}
        SELECT station_code, name, capacity, lat, lon, arrondissement, ingested_at FROM (
            SELECT *, row_number() OVER (PARTITION BY station_code
                ORDER BY ingested_at DESC, source DESC) AS rn FROM loads)
        WHERE rn = 1""",
    "batch_status": f"""{LOADS}, ranked AS (
            SELECT *, row_number() OVER (newest) AS last_rank,
                   first_value(is_installed) OVER (oldest) AS first_installed,
                   first_value(is_returning) OVER (oldest) AS first_returning
            FROM loads
            WINDOW newest AS (PARTITION BY station_code, last_reported
                       ORDER BY ingested_at DESC, source DESC),
                   oldest AS (PARTITION BY station_code, last_reported ORDER BY ingested_at, source))
        SELECT station_code, num_bikes_available, num_docks_available, num_ebikes, num_mechanical,
               first_installed AS is_installed, is_renting, first_returning AS is_returning,
               last_reported, ingested_at
        FROM ranked WHERE last_rank = 1""",
    "status_table_upsert": f"""WITH {STATUS}, first_load AS (
            SELECT *, num_ebikes > 2 AS is_installed, num_ebikes > 4 AS is_returning FROM status),
        changes AS (
            SELECT * REPLACE (num_docks_available AS num_bikes_available,
                num_bikes_available AS num_docks_available, NOT is_installed AS is_installed,
                NOT is_returning AS is_returning, NOT is_renting AS is_renting,
                last_reported + INTERVAL 1 DAY * (CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) AS last_reported,
                ingested_at + INTERVAL 1 HOUR AS ingested_at)
            FROM first_load),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY station_code, last_reported ORDER BY n, event_id) AS first_rank,
                   row_number() OVER (PARTITION BY station_code, last_reported ORDER BY n DESC, event_id DESC) AS last_rank
            FROM (SELECT 0 AS n, * FROM first_load UNION ALL SELECT 1, * FROM changes))
        SELECT l.* EXCLUDE (n, event_id, first_rank, last_rank)
               REPLACE (f.is_installed AS is_installed, f.is_returning AS is_returning)
        FROM ranked l JOIN ranked f ON l.station_code = f.station_code AND l.last_reported = f.last_reported
        WHERE l.last_rank = 1 AND f.first_rank = 1""",
    "key_checks": f"""{BOTH}, trend AS ({_trend(NOW)}),
        counts AS (
            SELECT 'stations' AS label, (SELECT count(*) - count(DISTINCT station_code) FROM stations) AS twice,
                   (SELECT count(*) FROM stations WHERE station_code IS NULL) AS unknown,
                   (SELECT count(*) FROM stations WHERE length(station_code) > 20) AS too_long
            UNION ALL
            SELECT 'trend', (SELECT count(*) FROM (SELECT 1 FROM trend
                       GROUP BY station_code, hour_bucket HAVING count(*) > 1)),
                   (SELECT count(*) FROM trend WHERE station_code IS NULL OR hour_bucket IS NULL),
                   (SELECT count(*) FROM trend WHERE length(station_code) > 20)
            UNION ALL
            SELECT 'lineitem', (SELECT count(*) FROM (SELECT 1 FROM lineitem
                       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)),
                   (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL), NULL),
        rules AS (
            SELECT label, 'key is not unique' AS rule, twice AS violations FROM counts
            UNION ALL SELECT label, 'key is null', unknown FROM counts
            UNION ALL SELECT label, 'station_code is too long', too_long FROM counts WHERE too_long IS NOT NULL)
        SELECT label, rule, violations, violations = 0 AS passed FROM rules""",
    "batch_rejects": f"""WITH {STATUS}
        SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS source, 0 AS pos,
               CASE WHEN floor(value + 7 * n) < 60 THEN 'num_bikes_available is not an integer'
                   ELSE 'num_bikes_available is out of range' END AS reason,
               {NOW} + INTERVAL 5 MINUTES * n AS rejected_at
        FROM base, (SELECT unnest([0, 1]) AS n) WHERE event_type = 'error'""",
}

# The same upsert, of a stored table.
ORACLES["stations_table_upsert"] = ORACLES["stations_upsert"]
# The same results, from stored tables or read in another way.
ORACLES["district_stored_snapshot"] = ORACLES["district_latest_snapshot"]
ORACLES["recent_stored_events"] = ORACLES["recent_events"]
ORACLES["export_elements"] = ORACLES["export_files"]
