"""DuckDB SQL that computes every registered query a second time, from the same Parquet tables.

The SQL is written as named blocks; ``sql(name)`` puts the blocks a query needs in front of its SELECT.
Boxes, limits and code tables are printed from ``refdata`` as literals.
"""

from __future__ import annotations

from wakeline import refdata as ref
from wakeline.quality.expectations import Rule
from wakeline.quality.suites import SUITES
from wakeline.sources import events_adapter as adapter


def _num(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def _text(x: str) -> str:
    return "'" + x + "'"


def _list(items) -> str:
    return "[" + ", ".join(items) + "]"


def _case(pairs, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in pairs) + f" ELSE {otherwise} END"


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    chord = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"2 * {_num(ref.EARTH_RADIUS_KM)} * asin(least(1.0::DOUBLE, sqrt({chord})))"


def _mid_case(mmsi: str) -> str:
    return _case([(f"left({mmsi}, 3) = '{k}'", _text(v)) for k, v in ref.FLAG_BY_MID.items()], "NULL")


def _mmsi(user: str) -> str:
    return f"{_list(map(_text, adapter.MID_OF_USER))}[{user} % 10 + 1] || lpad({user}::VARCHAR, 6, '0')"


def _port(field: int) -> str:
    return _list((_num(p[field]) if field < 2 else _text(p[field])) for p in ref.PORT_BOXES)


OCEAN = _case(
    [
        (f"lat BETWEEN {_num(a)} AND {_num(b)} AND lon BETWEEN {_num(c)} AND {_num(d)}", _text(name))
        for a, b, c, d, name in ref.OCEAN_BOXES
    ],
    _text(ref.OCEAN_FALLBACK),
)
PORT_NO = _case(
    [
        (f"abs(lat - {_num(a)}) <= {_num(r)} AND abs(lon - {_num(b)}) <= {_num(r)}", str(i))
        for i, (a, b, r, _, _) in reversed(list(enumerate(ref.PORT_BOXES, start=1)))
    ],
    "NULL",
)
NAV = "CASE WHEN nav IS NOT NULL THEN coalesce(" + _case(
    [(f"nav = {k}", _text(v)) for k, v in ref.NAV_STATUS.items()], "NULL"
) + ", 'unknown_' || nav::VARCHAR) END"
SHIP_TYPE = "CASE WHEN kind IS NULL THEN NULL ELSE " + _case(
    [(f"kind BETWEEN {a} AND {b}", _text(v)) for a, b, v in ref.SHIP_TYPE_RANGES], _text(ref.SHIP_TYPE_FALLBACK)
) + " END"
LIMIT = _case(
    [(f"vessel_type_normalized = '{k}'", _num(v)) for k, v in ref.SPEED_LIMIT_KNOTS.items()],
    _num(ref.DEFAULT_SPEED_LIMIT_KNOTS),
)
ORIGIN = f"epoch_us(TIMESTAMP '{adapter.ORIGIN}')"
AS_OF = f"TIMESTAMP '{adapter.AS_OF}'"
TRACK = "OVER (PARTITION BY mmsi ORDER BY event_timestamp)"
DAY_TRACK = "OVER (PARTITION BY mmsi, date_day ORDER BY event_timestamp)"


def _half_up(column: str, digits: int) -> str:
    """Rounding on the printed decimal digits, halves away from zero (20 digits hold every printed double here)."""
    return f"(round({column}::VARCHAR::DECIMAL(38, 20), {digits})::DOUBLE + 0.0::DOUBLE)"


# name -> (blocks it reads, SQL)
BLOCKS: dict[str, tuple[list[str], str]] = {
    "shrunk": ([], f"""
        SELECT event_id, user_id, event_type, value, regexp_extract(props, '[0-9]+')::INT AS k,
               make_timestamp({ORIGIN} + (epoch_us(ts) - {ORIGIN}) // {adapter.TIME_SHRINK}) AS t
        FROM events"""),
    "bronze": (["shrunk"], f"""
        SELECT event_id AS rid, {_mmsi('user_id')} AS mmsi, user_id,
               {_port(0)}[(user_id + day(t)) % 15 + 1] + CASE WHEN event_type IN ('click', 'view') THEN (k - 50) / 1e3
                    WHEN event_type = 'purchase' THEN 1e0 + k / 2e3 ELSE k / 4e1 END AS lat,
               {_port(1)}[(user_id + day(t)) % 15 + 1] + CASE WHEN event_type IN ('click', 'view') THEN (k - 50) / 1e3
                    WHEN event_type = 'purchase' THEN 1e0 ELSE -k / 5e1 END AS lon,
               CASE WHEN k = 99 THEN 102.3::DOUBLE ELSE value * 0.19371::DOUBLE END AS sog,
               CASE WHEN k = 97 THEN 360::DOUBLE ELSE (event_id * 53 % 3600) / 1e1 END AS cog,
               CASE WHEN k = 98 THEN 511 ELSE (event_id * 37 + k * 11) % 360 END AS hd,
               (event_id % 16)::INT AS nav, 'VESSEL ' || user_id || ' ' AS ship, t,
               t + INTERVAL 5 SECOND AS ingested, (event_id % 50)::VARCHAR AS batch
        FROM shrunk"""),
    "renamed": (["bronze"], f"""
        SELECT rid, mmsi, trim(ship) AS vessel_name, {_mid_case('mmsi')} AS flag_country, lat AS latitude,
               lon AS longitude, {OCEAN} AS ocean_region, {PORT_NO} AS port_no,
               CASE WHEN sog < 102.3::DOUBLE THEN sog END AS speed_over_ground,
               CASE WHEN cog < 360 THEN cog END AS course_over_ground, CASE WHEN hd <> 511 THEN hd END AS heading,
               {NAV} AS navigational_status, t AS event_timestamp, batch, ingested
        FROM bronze"""),
    "single": (["renamed"], """
        SELECT * FROM renamed
        QUALIFY row_number() OVER (PARTITION BY mmsi, event_timestamp ORDER BY ingested DESC, rid DESC) = 1"""),
    "silver": (["single"], f"""
        SELECT mmsi, vessel_name, flag_country, latitude, longitude, ocean_region, {_port(3)}[port_no] AS port_name,
               {_port(4)}[port_no] AS port_country, port_no IS NOT NULL AS is_in_port_zone,
               sqrt(pow((latitude - {_port(0)}[port_no]) * 111, 2) + pow((longitude - {_port(1)}[port_no]) * 111, 2))
                   AS distance_to_port_km,
               speed_over_ground, course_over_ground, heading, navigational_status,
               abs(speed_over_ground - lag(speed_over_ground) {TRACK}) AS speed_change_rate,
               abs(heading - lag(heading) {TRACK})::DOUBLE AS heading_change_degrees,
               event_timestamp, batch AS _bronze_batch_id
        FROM single"""),
    "static": ([], f"""
        SELECT {_mmsi('o_custkey')} AS mmsi, trim(' SHIP ' || o_custkey) AS vessel_name, o_custkey * 7 % 100 AS kind,
               (o_custkey + 9000000)::VARCHAR AS imo_number, 'C' || o_custkey AS callsign,
               upper(trim(CASE WHEN o_orderkey % 7 = 0 THEN 'tba ' ELSE lower(o_orderpriority) END)) AS destination,
               ((o_orderkey % 150) / 1e1)::FLOAT::DOUBLE AS draught, o_orderdate AS processed_at, o_orderkey AS rid
        FROM orders"""),
    "metadata": (["static"], f"""
        SELECT mmsi, vessel_name, {SHIP_TYPE} AS vessel_type_normalized, imo_number, callsign,
               CASE WHEN destination NOT IN ({', '.join(map(_text, ref.EMPTY_DESTINATIONS))}) THEN destination END
                   AS destination_clean,
               draught, {_mid_case('mmsi')} AS flag_country, '{ref.SOURCE_SYSTEM}' AS source_system, processed_at, rid
        FROM static"""),
    "newest": (["metadata"], """
        SELECT * FROM metadata
        QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY processed_at DESC, rid DESC) = 1"""),
    "stg": (["silver", "newest"], """
        SELECT s.*, coalesce(n.vessel_type_normalized, 'unknown') AS vessel_type_normalized, n.destination_clean,
               n.imo_number, n.callsign, n.draught, event_timestamp::DATE AS date_day,
               hour(event_timestamp)::INT AS hour_of_day
        FROM silver s LEFT JOIN newest n ON s.mmsi = n.mmsi
        WHERE s.mmsi IS NOT NULL AND s.mmsi NOT LIKE '0%' AND event_timestamp IS NOT NULL
          AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"""),
    "seg": (["stg"], f"""
        SELECT *, date_sub('minute', lag(event_timestamp) {DAY_TRACK}, event_timestamp) AS silence,
               coalesce(sqrt(pow((latitude - lag(latitude) {DAY_TRACK}) * 111, 2)
                             + pow((longitude - lag(longitude) {DAY_TRACK}) * 111, 2)), 0) AS km
        FROM stg"""),
    "activity": (["seg"], f"""
        SELECT mmsi, date_day, max(vessel_name) AS vessel_name, max(flag_country) AS flag_country,
               max(vessel_type_normalized) AS vessel_type, max(ocean_region) AS primary_ocean_region,
               count(*) AS position_count, count(DISTINCT port_name) AS distinct_ports_visited,
               count(*) FILTER (is_in_port_zone) AS positions_in_port,
               count(*) FILTER (NOT coalesce(is_in_port_zone, false)) AS positions_at_sea,
               min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen,
               date_sub('minute', min(event_timestamp), max(event_timestamp)) AS active_minutes,
               round(avg(speed_over_ground), 2) AS avg_speed_knots, round(max(speed_over_ground), 2) AS max_speed_knots,
               round(avg(speed_over_ground) FILTER (speed_over_ground > 0.5), 2) AS avg_underway_speed_knots,
               count(*) FILTER (speed_over_ground < 0.5) AS positions_stationary,
               round(sum(km), 2) AS estimated_distance_km,
               round(avg(speed_change_rate), 3) AS avg_speed_change_rate,
               round(max(speed_change_rate), 3) AS max_speed_change_rate,
               round(avg(heading_change_degrees), 3) AS avg_heading_change,
               round(max(heading_change_degrees), 3) AS max_heading_change,
               count(*) FILTER (speed_change_rate > 5) AS sudden_speed_changes,
               count(*) FILTER (heading_change_degrees > 45) AS sharp_turns,
               count(*) FILTER (silence > 30) AS ais_gaps_30min, count(*) FILTER (silence > 120) AS ais_gaps_2hr,
               max(silence) AS max_ais_gap_minutes, max(port_name) AS last_known_port,
               max(destination_clean) AS declared_destination, '{ref.SOURCE_SYSTEM}' AS source_system,
               '{ref.PIPELINE_VERSION}' AS pipeline_version
        FROM seg GROUP BY mmsi, date_day"""),
    "in_port": (["stg"], f"""
        SELECT *, lag(is_in_port_zone) {TRACK} AS was_in FROM stg WHERE port_name IS NOT NULL"""),
    "first_entries": (["in_port"], """
        SELECT port_name, port_country, date_day, mmsi FROM in_port
        WHERE is_in_port_zone AND coalesce(NOT was_in, true)"""),
    "changes": (["stg"], f"""
        SELECT DISTINCT port_name, port_country, date_day, mmsi
        FROM (SELECT *, lag(port_name) {TRACK} AS was_at FROM stg)
        WHERE port_name IS NOT NULL AND port_name IS DISTINCT FROM was_at"""),
    "erratic": (["activity", "stg"], """
        SELECT md5(a.mmsi || '-' || a.date_day::VARCHAR) AS alert_id, a.mmsi, a.date_day, a.vessel_name, a.flag_country,
               a.vessel_type, a.primary_ocean_region AS ocean_region, a.last_known_port,
               CASE WHEN sharp_turns > 20 THEN 'high' WHEN sharp_turns > 10 THEN 'medium' ELSE 'low' END AS severity,
               sharp_turns, avg_heading_change,
               sharp_turns || ' sharp turns (>45°) detected — avg heading change: '
                   || round(avg_heading_change, 1) || '°' AS description,
               avg_speed_knots, p.latitude, p.longitude, p.event_timestamp AS last_position_timestamp
        FROM activity a LEFT JOIN stg p ON a.mmsi = p.mmsi AND a.date_day = p.date_day
        WHERE sharp_turns > 10 AND avg_speed_knots > 1
        QUALIFY row_number() OVER (PARTITION BY a.mmsi, a.date_day ORDER BY p.event_timestamp DESC) = 1"""),
    "neighbours": (["stg"], f"""
        SELECT *, lag(event_timestamp) {TRACK} AS before_ts, lag(latitude) {TRACK} AS before_lat,
               lag(longitude) {TRACK} AS before_lon, lag(port_name) {TRACK} AS before_port
        FROM stg"""),
    "gaps": (["neighbours"], f"""
        SELECT *, date_sub('minute', before_ts, event_timestamp) AS gap_minutes,
               {_km('before_lat', 'before_lon', 'latitude', 'longitude')} AS displacement_km
        FROM neighbours WHERE date_sub('minute', before_ts, event_timestamp) > 120"""),
    "dark": (["gaps"], f"""
        SELECT md5(mmsi || {_ts('event_timestamp')}) AS dark_event_id, mmsi, vessel_name, flag_country,
               vessel_type_normalized, before_ts AS signal_lost_at, event_timestamp AS signal_recovered_at, gap_minutes,
               before_lat AS last_known_lat, before_lon AS last_known_lon, latitude AS reappearance_lat,
               longitude AS reappearance_lon, ocean_region, port_country, before_port AS last_known_port,
               port_name AS reappearance_port, displacement_km, event_timestamp::DATE AS event_date,
               CASE WHEN gap_minutes > 720 AND displacement_km > 100 THEN 'CRITICAL'
                    WHEN gap_minutes > 360 AND displacement_km > 50 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
               coalesce(port_country IS NOT NULL AND port_name <> before_port, false) AS reappeared_in_other_port
        FROM gaps"""),
    "timed": (["neighbours"], f"""
        SELECT *, {LIMIT} AS type_max_speed,
               {_km('before_lat', 'before_lon', 'latitude', 'longitude')} / {_num(ref.KM_PER_NAUTICAL_MILE)}
                   / (date_sub('second', before_ts, event_timestamp) / 3600e0) AS knots
        FROM neighbours WHERE date_sub('second', before_ts, event_timestamp) > 0"""),
    "speed": (["timed"], f"""
        SELECT md5(mmsi || {_ts('event_timestamp')}) AS anomaly_id, mmsi, vessel_name, vessel_type_normalized,
               flag_country, ocean_region, port_country, event_timestamp, date_day AS event_date,
               speed_over_ground AS reported_sog, knots AS calculated_speed_knots, speed_change_rate, type_max_speed,
               round(knots - type_max_speed, 2) AS speed_delta_knots,
               greatest(knots - type_max_speed, 0) AS speed_excess_knots, latitude, longitude,
               CASE WHEN knots > type_max_speed AND speed_change_rate > 5 THEN 'GPS_SPOOFING'
                    WHEN knots > type_max_speed THEN 'IMPOSSIBLE_SPEED' ELSE 'SUDDEN_ACCELERATION' END AS anomaly_type
        FROM timed WHERE knots > type_max_speed OR speed_change_rate > 10"""),
    "slow": (["stg"], f"""
        SELECT *, {_half_up('latitude', 1)} AS lat_cell, {_half_up('longitude', 1)} AS lon_cell
        FROM stg
        WHERE speed_over_ground BETWEEN 0.1::DOUBLE AND 4.0::DOUBLE AND NOT is_in_port_zone
          AND (navigational_status IS NULL OR navigational_status NOT IN ('at_anchor', 'moored'))"""),
    "stays": (["slow"], """
        SELECT mmsi, vessel_name, vessel_type_normalized, flag_country, ocean_region, lat_cell, lon_cell,
               lat_cell || '_' || lon_cell AS loiter_zone, min(event_timestamp) AS window_start,
               max(event_timestamp) AS window_end, count(*) AS position_count,
               date_sub('minute', min(event_timestamp), max(event_timestamp)) AS duration_minutes,
               avg(speed_over_ground) AS avg_speed_knots, avg(heading_change_degrees) AS avg_heading_change,
               min(date_day) AS event_date
        FROM slow GROUP BY ALL
        HAVING date_sub('minute', min(event_timestamp), max(event_timestamp)) > 180"""),
    "loiter": (["stays"], f"""
        SELECT md5(mmsi || {_ts('window_start')}) AS loiter_event_id, *,
               CASE WHEN duration_minutes > 720 AND avg_heading_change > 20 THEN 'HIGH'
                    WHEN duration_minutes > 360 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
        FROM stays"""),
    "roster": (["stg"], """
        SELECT mmsi, arg_max(vessel_name, event_timestamp) AS vessel_name,
               arg_max(vessel_type_normalized, event_timestamp) AS vessel_type_normalized,
               any_value(flag_country) AS flag_country,
               arg_max(port_name, event_timestamp) FILTER (port_name IS NOT NULL) AS last_known_port
        FROM stg GROUP BY mmsi"""),
    "risk": (["roster", "dark", "speed", "loiter"], f"""
        WITH d AS (SELECT mmsi, count(*) AS n,
                          sum(CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 ELSE 1 END)::BIGINT AS points,
                          count(*) FILTER (reappeared_in_other_port) AS moved
                   FROM dark WHERE event_date >= ({AS_OF} - INTERVAL 30 DAY)::DATE GROUP BY 1),
             s AS (SELECT mmsi, count(*) AS n, count(*) FILTER (anomaly_type = 'GPS_SPOOFING') AS spoofed
                   FROM speed WHERE event_date >= ({AS_OF} - INTERVAL 30 DAY)::DATE GROUP BY 1),
             l AS (SELECT mmsi, count(*) AS n
                   FROM loiter WHERE event_date >= ({AS_OF} - INTERVAL 30 DAY)::DATE GROUP BY 1)
        SELECT md5(mmsi || '{adapter.AS_OF[:10]}') AS score_id, mmsi, vessel_name, vessel_type_normalized, flag_country,
               last_known_port, coalesce(d.n, 0) AS dark_events_30d, coalesce(d.moved, 0) AS port_change_gaps_30d,
               coalesce(s.n, 0) AS speed_anomalies_30d, coalesce(s.spoofed, 0) AS spoofing_signals_30d,
               coalesce(l.n, 0) AS loiter_events_30d,
               coalesce(d.points, 0) * 10 + coalesce(d.moved, 0) * 8 + coalesce(s.spoofed, 0) * 15
                   + coalesce(s.n, 0) * 5 + coalesce(l.n, 0) * 3 AS risk_score,
               {AS_OF}::DATE AS score_date
        FROM roster LEFT JOIN d USING (mmsi) LEFT JOIN s USING (mmsi) LEFT JOIN l USING (mmsi)
        WHERE coalesce(d.points, 0) + coalesce(s.n, 0) + coalesce(l.n, 0) > 0"""),
    "pings": (["bronze"], """
        SELECT mmsi, lat, lon, CASE WHEN sog < 102.3::DOUBLE THEN sog END AS sog, t,
               lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, lag(t) OVER w AS t0,
               lag(CASE WHEN sog < 102.3::DOUBLE THEN sog END) OVER w AS sog0
        FROM bronze WINDOW w AS (PARTITION BY mmsi ORDER BY t)"""),
    "rated": (["pings"], f"""
        SELECT *, {_km('lat0', 'lon0', 'lat', 'lon')} / {_num(ref.KM_PER_NAUTICAL_MILE)}
                   / ((epoch_us(t) - epoch_us(t0)) / 1e6 / 3600) AS knots, coalesce(abs(sog - sog0), 0) AS change
        FROM pings WHERE t > t0"""),
    "alerts": (["rated"], f"""
        SELECT mmsi, CASE WHEN knots > 35 AND change > 5 THEN 'GPS_SPOOFING' WHEN knots > 35 THEN 'IMPOSSIBLE_SPEED'
                          ELSE 'SUDDEN_ACCELERATION' END AS alert_type,
               CASE WHEN knots > 35 THEN 'high' ELSE 'medium' END AS severity,
               'calculated_speed=' || printf('%.1f', knots) || 'kn reported_sog=' || coalesce(sog::VARCHAR, 'None')
                   || 'kn speed_change=' || printf('%.1f', change) || 'kn' AS description,
               lat AS latitude, lon AS longitude, {_ts('t')} AS detected_at
        FROM rated WHERE knots > 35 OR change > 10"""),
    "twice": (["renamed"], """
        SELECT rid, mmsi, event_timestamp, vessel_name, batch, ingested FROM renamed
        UNION ALL
        SELECT rid + 1000000000000, mmsi, event_timestamp, 'LATE ' || vessel_name, 'r' || batch,
               ingested + INTERVAL 60 SECOND FROM renamed WHERE rid % 20 = 0"""),
}
# The mixed raw feed and the blocks built on it. Messages: 1 of 11 static, 1 of 11 of an unhandled type, 1 of 19 not
# JSON, 1 of 13 without identity, 1 of 17 at latitude 91, 1 of 17 without own latitude (half of these have one in the
# envelope).
BLOCKS |= {
    "feed": (["bronze"], f"""
        SELECT rid, CASE WHEN rid % 11 = 1 THEN 'ShipStaticData' WHEN rid % 11 = 2 THEN 'BaseStationReport'
                         ELSE 'PositionReport' END AS kind,
               rid % 19 = 7 AS broken, CASE WHEN rid % 13 <> 4 THEN mmsi::BIGINT::VARCHAR END AS id,
               CASE WHEN rid % 13 <> 4 THEN user_id END AS user_id,
               CASE WHEN rid % 17 = 3 THEN 91::DOUBLE WHEN rid % 17 <> 5 THEN lat END AS own_lat,
               CASE WHEN rid % 17 <> 5 OR rid % 2 = 0 THEN lat END AS meta_lat, lon, sog, cog, hd, nav, ship, t
        FROM bronze"""),
    "judged": (["feed"], """
        SELECT *, CASE WHEN broken THEN 'invalid_json' WHEN kind = 'BaseStationReport' THEN 'unhandled_type'
                       WHEN id IS NULL AND user_id IS NULL THEN 'missing_mmsi'
                       WHEN kind = 'PositionReport' AND NOT coalesce(abs(coalesce(nullif(own_lat, 0), meta_lat)) <= 90
                            AND abs(lon) <= 180, false) THEN 'invalid_position' END AS reject_reason
        FROM feed"""),
    "reports": (["feed"], "SELECT * FROM feed WHERE NOT broken AND kind = 'PositionReport'"),
    "zoned": (["renamed"], f"""
        SELECT *, {_port(3)}[port_no] AS port_name, {_port(4)}[port_no] AS port_country,
               port_no IS NOT NULL AS is_in_port_zone,
               sqrt(pow((latitude - {_port(0)}[port_no]) * 111, 2) + pow((longitude - {_port(1)}[port_no]) * 111, 2))
                   AS distance_to_port_km
        FROM renamed"""),
}

HALF = "TIMESTAMP '2024-01-02 12:00:00'"


def _cutoff(table: str, column: str, hours: int) -> str:
    return f"(SELECT max({column}) - INTERVAL {hours} HOUR FROM {table} WHERE {column} < {HALF})"


BLOCKS |= {
    "late_neighbours": (["stg", "dark"], f"""
        SELECT *, lag(event_timestamp) {TRACK} AS before_ts, lag(latitude) {TRACK} AS before_lat,
               lag(longitude) {TRACK} AS before_lon, lag(port_name) {TRACK} AS before_port
        FROM stg WHERE event_timestamp >= {_cutoff('dark', 'signal_recovered_at', 6)}"""),
    "late_gaps": (["late_neighbours"], BLOCKS["gaps"][1].replace("FROM neighbours", "FROM late_neighbours")),
    "late_dark": (["late_gaps"], BLOCKS["dark"][1].replace("FROM gaps", "FROM late_gaps")),
    "late_slow": (["slow", "loiter"], f"""
        SELECT * FROM slow WHERE event_timestamp >= {_cutoff('loiter', 'window_start', 4)}"""),
    "late_stays": (["late_slow"], BLOCKS["stays"][1].replace("FROM slow", "FROM late_slow")),
    "late_loiter": (["late_stays"], BLOCKS["loiter"][1].replace("FROM stays", "FROM late_stays")),
    "zoned_label": (["silver"], """
        SELECT strftime(time_bucket(INTERVAL 5 MINUTE, event_timestamp), '%H:%M') AS t, count(*) AS n
        FROM silver GROUP BY 1"""),
    "minute_label": (["silver"], "SELECT strftime(event_timestamp, '%H:%M') AS t, count(*) AS n FROM silver GROUP BY 1"),
    "last_alerts": (["alerts"], "SELECT * FROM alerts ORDER BY detected_at DESC, mmsi, alert_type LIMIT 50"),
}


def _hole(table: str, step: int) -> str:
    minute = "left(t, 2)::INT * 60 + right(t, 2)::INT"
    return f"""
        SELECT after, t AS until, gap_minutes::INT AS gap_minutes FROM (
            SELECT t, lag(t) OVER (ORDER BY t) AS after,
                   {minute} - lag({minute}) OVER (ORDER BY t) - {step} AS gap_minutes FROM {table})
        WHERE gap_minutes >= {step}"""


SILVER_OUT = f"""mmsi, vessel_name, flag_country, latitude, longitude, ocean_region, port_name, port_country,
    is_in_port_zone, round(distance_to_port_km, 3) AS distance_to_port_km, speed_over_ground, course_over_ground,
    heading::DOUBLE AS heading, navigational_status, speed_change_rate, heading_change_degrees,
    {_ts('event_timestamp')} AS event_timestamp, '{ref.SOURCE_SYSTEM}' AS _source_system,
    NULL::VARCHAR AS _source_file, _bronze_batch_id, '{ref.PIPELINE_VERSION}' AS _pipeline_version"""


def _port_traffic(entries: str) -> str:
    named = ", ".join(
        f"count(DISTINCT CASE WHEN vessel_type_normalized = '{c}' THEN p.mmsi END) AS {c}_vessels"
        for c in ref.NAMED_PORT_CATEGORIES
    )
    others = ", ".join(map(_text, ref.NAMED_PORT_CATEGORIES))
    return f"""
        SELECT p.port_name, p.port_country, p.date_day::VARCHAR AS date_day, count(DISTINCT p.mmsi) AS unique_vessels,
               count(*) AS total_position_reports, {named},
               count(DISTINCT CASE WHEN vessel_type_normalized NOT IN ({others}) THEN p.mmsi END) AS other_vessels,
               count(DISTINCT flag_country) AS distinct_flag_countries,
               round(avg(speed_over_ground), 2) AS avg_speed_in_port, round(max(speed_over_ground), 2) AS max_speed_in_port,
               count(*) FILTER (speed_change_rate > 3) AS sudden_manoeuvres,
               round(avg(speed_change_rate), 3) AS avg_speed_change_rate, count(DISTINCT e.mmsi) AS vessel_entries,
               {_ts('min(event_timestamp)')} AS first_activity, {_ts('max(event_timestamp)')} AS last_activity
        FROM in_port p LEFT JOIN {entries} e
          ON p.port_name = e.port_name AND p.date_day = e.date_day AND p.mmsi = e.mmsi
        GROUP BY p.port_name, p.port_country, p.date_day"""


# name -> (blocks it reads, final SELECT)
FINAL: dict[str, tuple[list[str], str]] = {
    "silver_positions": (["silver"], f"SELECT {SILVER_OUT} FROM silver"),
    "silver_metadata": (["metadata"], f"SELECT * REPLACE ({_ts('processed_at')} AS processed_at) RENAME (rid AS _row_id) FROM metadata"),
    "latest_metadata": (["newest"], f"SELECT * REPLACE ({_ts('processed_at')} AS processed_at) RENAME (rid AS _row_id) FROM newest"),
    "stg_vessel_positions": (["stg"], f"""
        SELECT {SILVER_OUT}, vessel_type_normalized, destination_clean, imo_number, callsign, draught,
               date_day::VARCHAR AS date_day, hour_of_day FROM stg"""),
    "vessel_activity_summary": (["activity"], f"""
        SELECT * REPLACE (date_day::VARCHAR AS date_day, {_ts('first_seen')} AS first_seen, {_ts('last_seen')} AS last_seen,
                          max_ais_gap_minutes::DOUBLE AS max_ais_gap_minutes) FROM activity"""),
    "port_traffic": (["in_port", "first_entries"], _port_traffic("first_entries")),
    "port_traffic_transition": (["in_port", "changes"], _port_traffic("changes")),
    "port_entries": (["first_entries"], "SELECT port_name, port_country, date_day::VARCHAR AS date_day, mmsi FROM first_entries"),
    "vessel_erratic_course": (["erratic"], f"""
        SELECT * REPLACE (date_day::VARCHAR AS date_day, {_ts('last_position_timestamp')} AS last_position_timestamp)
        FROM erratic"""),
    "vessel_dark_events": (["dark"], f"""
        SELECT * REPLACE ({_ts('signal_lost_at')} AS signal_lost_at, {_ts('signal_recovered_at')} AS signal_recovered_at,
                          event_date::VARCHAR AS event_date, round(displacement_km, 3) AS displacement_km) FROM dark"""),
    "vessel_speed_anomalies": (["speed"], f"""
        SELECT * REPLACE ({_ts('event_timestamp')} AS event_timestamp, event_date::VARCHAR AS event_date,
                          round(calculated_speed_knots, 3) AS calculated_speed_knots,
                          round(speed_excess_knots, 3) AS speed_excess_knots) FROM speed"""),
    "vessel_loitering": (["loiter"], f"""
        SELECT * REPLACE ({_ts('window_start')} AS window_start, {_ts('window_end')} AS window_end,
                          event_date::VARCHAR AS event_date, round(avg_speed_knots, 3) AS avg_speed_knots,
                          round(avg_heading_change, 3) AS avg_heading_change) FROM loiter"""),
    "vessel_risk_score": (["risk"], "SELECT * REPLACE (score_date::VARCHAR AS score_date) FROM risk"),
    "vessel_roster": (["roster"], "SELECT * FROM roster"),
    "vessel_alerts_batch": (["alerts"], "SELECT * FROM alerts"),
    "silent_vessels": (["bronze"], f"""
        SELECT mmsi, 'AIS_GAP' AS alert_type, 'medium' AS severity,
               'No messages for >120 min — last seen at ' || {_ts('max(t)')} AS description,
               arg_max(lat, t) AS latitude, arg_max(lon, t) AS longitude, {_ts('max(t)')} AS last_seen_at
        FROM bronze GROUP BY mmsi HAVING max(t) < {AS_OF} - INTERVAL 120 MINUTE"""),
    "dedup_latest": (["twice"], f"""
        SELECT mmsi, {_ts('event_timestamp')} AS event_timestamp, vessel_name, batch AS _bronze_batch_id, rid AS _row_id
        FROM twice QUALIFY row_number() OVER (PARTITION BY mmsi, event_timestamp ORDER BY ingested DESC, rid DESC) = 1"""),
}

ALERT_COLUMNS = "mmsi, alert_type, severity, description, latitude, longitude"
KEPT = "dark_event_id, mmsi, gap_minutes, severity, event_date::VARCHAR AS event_date"
FINAL |= {
    "bronze_flatten": (["reports"], f"""
        SELECT cog AS Cog, own_lat AS Latitude, lon AS Longitude, nav::DOUBLE AS NavigationalStatus, sog AS Sog,
               hd::DOUBLE AS TrueHeading, user_id::DOUBLE AS UserID, true AS Valid, id AS MMSI, id AS MMSI_String,
               ship AS ShipName, {_ts('t')} || '123 +0000 UTC' AS time_utc, '{ref.SOURCE_SYSTEM}' AS _source_system,
               (rid * 31 % 262143)::INT AS CommunicationState, (1 + rid % 3)::INT AS MessageID,
               rid % 2 = 0 AS PositionAccuracy, rid % 5 = 0 AS Raim, (rid % 255 - 127)::INT AS RateOfTurn,
               (rid % 4)::INT AS RepeatIndicator, 0 AS Spare, (rid % 3)::INT AS SpecialManoeuvreIndicator,
               (rid % 60)::INT AS Timestamp
        FROM reports"""),
    "bronze_validate": (["judged"], f"""
        SELECT id AS MMSI, own_lat AS Latitude, lon AS Longitude, sog AS Sog, {_ts('t')} AS time_utc,
               t::DATE::VARCHAR AS partition_date, hour(t)::INT AS partition_hour
        FROM judged
        WHERE reject_reason IS NULL AND kind = 'PositionReport' AND id IS NOT NULL AND own_lat BETWEEN -90 AND 90
          AND lon BETWEEN -180 AND 180"""),
    "bronze_rejected": (["reports"], f"""
        SELECT id AS MMSI, own_lat AS Latitude, lon AS Longitude, ship AS ShipName,
               {_ts('t')} || '123 +0000 UTC' AS time_utc
        FROM reports WHERE id IS NULL OR own_lat IS NULL OR own_lat > 90"""),
    "bronze_metadata": (["feed"], f"""
        SELECT id AS MMSI, ship AS ShipName, (rid % 100)::INT AS Type, (rid + 9000000)::INT AS ImoNumber,
               'C' || rid AS Callsign, ship AS Name, 'ROTTERDAM' AS Destination, 7.5::DOUBLE AS MaximumStaticDraught,
               '{ref.SOURCE_SYSTEM}' AS _source_system, 'b' AS _batch_id, '{ref.PIPELINE_VERSION}' AS _pipeline_version
        FROM feed WHERE NOT broken AND kind = 'ShipStaticData' AND id IS NOT NULL"""),
    "route_messages": (["judged"], """
        SELECT rid AS event_id, CASE WHEN reject_reason IS NULL THEN
                   CASE kind WHEN 'PositionReport' THEN 'positions' ELSE 'metadata' END END AS route, reject_reason,
               CASE WHEN NOT broken THEN strftime(t, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS time_utc
        FROM judged"""),
    "normalize_time": (["feed"], f"""
        SELECT rid AS event_id, CASE WHEN NOT broken THEN {_ts('t')} END AS time_utc FROM feed"""),
    "stg_dedup": (["twice", "newest"], f"""
        SELECT t.mmsi, {_ts('event_timestamp')} AS event_timestamp, t.vessel_name, batch AS _bronze_batch_id,
               coalesce(vessel_type_normalized, 'unknown') AS vessel_type_normalized
        FROM (SELECT * FROM twice WHERE mmsi NOT LIKE '0%' QUALIFY row_number() OVER
                  (PARTITION BY mmsi, event_timestamp ORDER BY ingested DESC, batch DESC) = 1) t
        LEFT JOIN newest n ON t.mmsi = n.mmsi"""),
    "ocean_region_lookup": (["renamed"], """
        SELECT ocean_region, count(*) AS n, min(latitude) AS south, max(latitude) AS north FROM renamed GROUP BY 1"""),
    "port_zone_lookup": (["zoned"], """
        SELECT port_name, port_country, is_in_port_zone, count(*) AS n, count(DISTINCT mmsi) AS vessels
        FROM zoned GROUP BY ALL"""),
    "port_distance": (["zoned"], """
        SELECT mmsi, port_name, rid AS event_id, round(distance_to_port_km, 3) AS distance_to_port_km
        FROM zoned WHERE is_in_port_zone"""),
    "flag_lookup": (["bronze"], f"""
        SELECT {_mid_case('mmsi')} AS flag_country, count(*) AS n, count(DISTINCT mmsi) AS vessels FROM bronze GROUP BY 1"""),
    "nav_status_lookup": (["bronze"], f"""
        SELECT nav::BIGINT AS code, {NAV} AS navigational_status, count(*) AS n FROM bronze GROUP BY ALL"""),
    "ship_type_lookup": (["static"], f"""
        SELECT kind::BIGINT AS code, {SHIP_TYPE} AS category, count(*) AS n FROM static GROUP BY ALL"""),
    "speed_limit_lookup": (["stg"], f"""
        SELECT vessel_type_normalized, {LIMIT} AS type_max_speed, count(*) AS n FROM stg GROUP BY ALL"""),
    "masked_vessels": (["bronze"], "SELECT left(mmsi, 6) || '***' AS mmsi, count(*) AS n FROM bronze GROUP BY 1"),
    "movement_deltas": (["silver"], f"""
        SELECT mmsi, {_ts('event_timestamp')} AS event_timestamp, speed_change_rate, heading_change_degrees FROM silver"""),
    "day_segments": (["seg"], f"""
        SELECT mmsi, {_ts('event_timestamp')} AS event_timestamp, silence::DOUBLE AS minutes_since_prev,
               round(km, 3) AS segment_distance_km FROM seg"""),
    "loiter_candidates": (["slow"], f"""
        SELECT mmsi, {_ts('event_timestamp')} AS event_timestamp, speed_over_ground, lat_cell, lon_cell FROM slow"""),
    "incremental_cutoff": (["late_dark"], FINAL["vessel_dark_events"][1].replace("FROM dark", "FROM late_dark")),
    "dark_events_incremental": (["dark"], FINAL["vessel_dark_events"][1]
        + f" WHERE dark.signal_recovered_at >= {_cutoff('dark', 'signal_recovered_at', 6)}"),
    "speed_anomalies_incremental": (["speed"], FINAL["vessel_speed_anomalies"][1]
        + f" WHERE speed.event_timestamp >= {_cutoff('speed', 'event_timestamp', 2)}"),
    "loitering_incremental": (["late_loiter"], FINAL["vessel_loitering"][1].replace("FROM loiter", "FROM late_loiter")),
    "merge_upsert": (["dark"], f"""
        SELECT {KEPT} FROM dark WHERE event_date < DATE '2024-01-02'
        UNION ALL SELECT {KEPT.replace('severity', 'lower(severity)')} FROM dark WHERE event_date >= DATE '2024-01-02'"""),
    "merge_sync_schema": (["dark"], """
        SELECT dark_event_id, mmsi, CASE WHEN event_date >= DATE '2024-01-02' THEN lower(severity) ELSE severity END AS severity,
               event_date::VARCHAR AS event_date, CASE WHEN event_date >= DATE '2024-01-02' THEN true END AS reviewed
        FROM dark"""),
    "risk_signals_30d": (["dark", "speed", "loiter"], """
        WITH d AS (SELECT mmsi, count(*) AS dark_events,
                          sum(CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'HIGH' THEN 2 ELSE 1 END) AS dark_score,
                          count(*) FILTER (reappeared_in_other_port) AS port_change_gaps FROM dark GROUP BY 1),
             s AS (SELECT mmsi, count(*) AS speed_anomalies,
                          count(*) FILTER (anomaly_type = 'GPS_SPOOFING') AS spoofing_signals,
                          sum(speed_excess_knots) AS total_excess_knots FROM speed GROUP BY 1),
             l AS (SELECT mmsi, count(*) AS loiter_events, sum(duration_minutes) AS total_loiter_minutes
                   FROM loiter GROUP BY 1)
        SELECT mmsi, coalesce(dark_events, 0) AS dark_events, coalesce(dark_score, 0)::BIGINT AS dark_score,
               coalesce(port_change_gaps, 0) AS port_change_gaps, coalesce(speed_anomalies, 0) AS speed_anomalies,
               coalesce(spoofing_signals, 0) AS spoofing_signals,
               round(coalesce(total_excess_knots, 0), 3) AS total_excess_knots,
               coalesce(loiter_events, 0) AS loiter_events, coalesce(total_loiter_minutes, 0)::BIGINT AS total_loiter_minutes
        FROM d FULL JOIN s USING (mmsi) FULL JOIN l USING (mmsi)"""),
    "null_profile": (["bronze"], """
        SELECT "column", (SELECT count(*) FROM bronze) AS total, nulls,
               round(nulls * 100e0 / (SELECT count(*) FROM bronze), 1) AS percent
        FROM (SELECT 'MMSI' AS "column", count(*) - count(mmsi) AS nulls FROM bronze
              UNION ALL SELECT 'Latitude', count(*) - count(lat) FROM bronze
              UNION ALL SELECT 'Longitude', count(*) - count(lon) FROM bronze
              UNION ALL SELECT 'Sog', count(*) - count(sog) FROM bronze
              UNION ALL SELECT 'RateOfTurn', count(*) FROM bronze
              UNION ALL SELECT '_source_file', count(*) FROM bronze
              UNION ALL SELECT 'time_utc', count(*) - count(t) FROM bronze)"""),
    "duplicate_audit": (["twice"], """
        SELECT count(*) AS total_rows, count(DISTINCT (mmsi, event_timestamp)) AS distinct_keys,
               count(*) - count(DISTINCT (mmsi, event_timestamp)) AS duplicate_rows,
               (SELECT count(*) FROM (SELECT 1 FROM twice GROUP BY mmsi, event_timestamp HAVING count(*) > 1))
                   AS duplicated_keys
        FROM twice"""),
    "duplicate_batches": (["twice"], f"""
        SELECT batch AS _bronze_batch_id, count(*) AS rows_in_duplicated_groups, {_ts('min(ingested)')} AS processed_at
        FROM twice SEMI JOIN (SELECT mmsi, event_timestamp FROM twice GROUP BY 1, 2 HAVING count(*) > 1)
            USING (mmsi, event_timestamp) GROUP BY 1"""),
    "report_overview": (["silver"], f"""
        SELECT count(*) AS positions, count(DISTINCT mmsi) AS vessels, count(DISTINCT flag_country) AS flags,
               count(*) FILTER (is_in_port_zone) AS in_port, {_ts('min(event_timestamp)')} AS first_ts,
               {_ts('max(event_timestamp)')} AS last_ts FROM silver"""),
    "report_gold_totals": (["activity"], """
        SELECT count(*) AS vessel_days, round(sum(estimated_distance_km)) AS km, sum(sharp_turns)::BIGINT AS sharp_turns,
               sum(sudden_speed_changes)::BIGINT AS sudden_changes FROM activity"""),
    "report_table_counts": (["activity", "stg", "erratic", "dark", "speed", "loiter", "risk"], """
        SELECT 'vessel_activity_summary' AS t, count(*) AS n FROM activity
        UNION ALL SELECT 'port_traffic', count(DISTINCT (port_name, date_day)) FROM stg WHERE port_name IS NOT NULL
        UNION ALL SELECT 'vessel_erratic_course', count(*) FROM erratic
        UNION ALL SELECT 'vessel_dark_events', count(*) FROM dark
        UNION ALL SELECT 'vessel_speed_anomalies', count(*) FROM speed
        UNION ALL SELECT 'vessel_loitering', count(*) FROM loiter
        UNION ALL SELECT 'vessel_risk_score', count(*) FROM risk"""),
    "report_top_flags": (["silver"], """
        SELECT flag_country AS k, count(DISTINCT mmsi) AS n FROM silver WHERE flag_country IS NOT NULL
        GROUP BY 1 ORDER BY n DESC, k LIMIT 10"""),
    "report_regions": (["silver"], "SELECT ocean_region AS k, count(*) AS n FROM silver GROUP BY 1"),
    "report_types": (["activity"], """
        SELECT vessel_type AS k, count(*) AS n FROM activity GROUP BY 1 ORDER BY n DESC, k LIMIT 8"""),
    "report_timeline": (["zoned_label"], "SELECT * FROM zoned_label"),
    "report_timeline_gaps": (["zoned_label"], _hole("zoned_label", 5)),
    "report_timeline_gaps_minute": (["minute_label"], _hole("minute_label", 1)),
    "report_grid": (["silver"], f"""
        SELECT ({_half_up('(latitude / 2)', 0)} * 2)::BIGINT AS la, ({_half_up('(longitude / 2)', 0)} * 2)::BIGINT AS lo,
               count(*) AS n FROM silver GROUP BY 1, 2"""),
    "report_top_ports": (["in_port", "first_entries"], f"""
        SELECT port_name, port_country, unique_vessels, total_position_reports, cargo_vessels, tanker_vessels,
               passenger_vessels, round(avg_speed_in_port, 1) AS avg_speed
        FROM ({_port_traffic("first_entries")}) ORDER BY total_position_reports DESC, port_name, date_day LIMIT 8"""),
    "report_top_risk": (["risk"], """
        SELECT left(mmsi, 6) || '***' AS mmsi, flag_country, vessel_type_normalized AS t, dark_events_30d AS dark,
               speed_anomalies_30d AS speed, spoofing_signals_30d AS spoof, loiter_events_30d AS loiter, risk_score
        FROM risk ORDER BY risk_score DESC, risk.mmsi LIMIT 8"""),
    "report_risk_histogram": (["risk"], "SELECT risk_score AS k, count(*) AS n FROM risk GROUP BY 1"),
    "report_anomaly_buckets": (["speed"], """
        SELECT CASE WHEN calculated_speed_knots < 35 THEN '14-35 kn' WHEN calculated_speed_knots < 100 THEN '35-100 kn'
                    WHEN calculated_speed_knots < 1000 THEN '100-1,000 kn' ELSE 'over 1,000 kn' END AS k,
               count(*) AS n, round(min(calculated_speed_knots), 3) AS lo FROM speed GROUP BY 1"""),
    "report_case_file": (["speed", "silver"], f"""
        WITH worst AS (SELECT mmsi, event_timestamp AS seen, calculated_speed_knots AS knots FROM speed
                       ORDER BY knots DESC, mmsi, seen LIMIT 1)
        SELECT left(p.mmsi, 6) || '***' AS mmsi, round(knots) AS speed_knots, {_ts('p.event_timestamp')} AS ts,
               round(latitude, 3) AS lat, round(longitude, 3) AS lon, speed_over_ground AS sog, navigational_status AS status
        FROM silver p JOIN worst ON p.mmsi = worst.mmsi AND p.event_timestamp BETWEEN seen - INTERVAL 60 SECOND AND seen
        ORDER BY p.event_timestamp DESC LIMIT 2"""),
    "alerts_by_type": (["last_alerts"], "SELECT alert_type, count(*) AS n FROM last_alerts GROUP BY 1"),
    "latest_alerts": (["last_alerts"], f"SELECT detected_at, {ALERT_COLUMNS} FROM last_alerts ORDER BY detected_at DESC, mmsi, alert_type LIMIT 8"),
    "vessel_alerts_stream": (["alerts"], f"SELECT {ALERT_COLUMNS} FROM alerts"),
    "silver_stream": (["silver"], f"SELECT {SILVER_OUT} FROM silver"),
}

FINAL |= {
    "movement_deltas_sliced": FINAL["movement_deltas"],
    "stg_salted": FINAL["stg_vessel_positions"],
    "dark_events_sliced": FINAL["vessel_dark_events"],
    "dark_events_seeded": FINAL["vessel_dark_events"],
    "erratic_by_day_ends": FINAL["vessel_erratic_course"],
    "activity_sliced": FINAL["vessel_activity_summary"],
    "dead_letters": (["judged"], f"""
        SELECT reject_reason AS error, '{ref.SOURCE_SYSTEM}' AS source, count(*) AS n FROM judged
        WHERE reject_reason IS NOT NULL GROUP BY 1"""),
}


# Chained streams, boxes, visits and holes.

GOOD = "id IS NOT NULL AND own_lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"
ISO = ("CASE WHEN epoch_us({t}) % 1000000 = 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S+00:00')"
       " ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END")
SILENT = "epoch_us(t) - epoch_us(t0) > 120 * 60000000::BIGINT"
BLOCKS |= {
    "counted": (["feed"], f"""
        SELECT count(*) AS rows_read, count(*) FILTER (broken) AS invalid_json,
               count(*) FILTER (NOT broken AND kind <> 'PositionReport') AS rows_other,
               count(*) FILTER (NOT broken AND kind = 'PositionReport' AND id IS NULL) AS missing_mmsi,
               count(*) FILTER (NOT broken AND kind = 'PositionReport' AND id IS NOT NULL
                                AND NOT coalesce({GOOD}, false)) AS invalid_position,
               count(*) FILTER (NOT broken AND kind = 'PositionReport' AND {GOOD}) AS rows_written
        FROM feed"""),
    "visited": (["slow"], f"""
        SELECT *, CASE WHEN lag(event_timestamp) {TRACK} IS NULL OR lat_cell IS DISTINCT FROM lag(lat_cell) {TRACK}
                            OR lon_cell IS DISTINCT FROM lag(lon_cell) {TRACK}
                            OR date_sub('minute', lag(event_timestamp) {TRACK}, event_timestamp) > 720
                       THEN event_timestamp END AS begins
        FROM slow"""),
    "visits": (["visited"], f"""
        SELECT mmsi, vessel_name, vessel_type_normalized, flag_country, ocean_region, lat_cell, lon_cell, visit,
               lat_cell || '_' || lon_cell AS loiter_zone, min(event_timestamp) AS window_start,
               max(event_timestamp) AS window_end, count(*) AS position_count,
               date_sub('minute', min(event_timestamp), max(event_timestamp)) AS duration_minutes,
               avg(speed_over_ground) AS avg_speed_knots, avg(heading_change_degrees) AS avg_heading_change,
               min(date_day) AS event_date
        FROM (SELECT *, max(begins) {TRACK} AS visit FROM visited) GROUP BY ALL
        HAVING date_sub('minute', min(event_timestamp), max(event_timestamp)) > 180"""),
    "sessions": (["visits"], BLOCKS["loiter"][1].replace("FROM stays", "FROM visits").replace(", *,", ", * EXCLUDE (visit),")),
    "hole_label": (["silver"], """
        SELECT strftime(time_bucket(INTERVAL 5 MINUTE, event_timestamp), '%H:%M') AS t, count(*) AS n
        FROM silver WHERE hour(event_timestamp) NOT IN (9, 10) GROUP BY 1"""),
}
FINAL |= {
    "keyed_json": (["reports", "renamed"], f"""
        SELECT id AS mmsi, vessel_name, {_mid_case('id')} AS flag_country, latitude, longitude, ocean_region,
               {_port(3)}[port_no] AS port_name, speed_over_ground, navigational_status, {_ts("date_trunc('milliseconds', event_timestamp)")} AS event_timestamp,
               '{ref.SOURCE_SYSTEM}' AS _source_system
        FROM renamed JOIN reports USING (rid) WHERE {GOOD}
        QUALIFY row_number() OVER (PARTITION BY id, date_trunc('milliseconds', event_timestamp) ORDER BY rid) = 1"""),
    "batch_audit": (["counted"], """
        SELECT 'bronze_positions' AS layer, rows_read, rows_written, rows_read - rows_written - rows_other AS rows_rejected,
               rows_other, 0::BIGINT AS rows_copies, invalid_json, missing_mmsi, invalid_position, 0::BIGINT AS invalid_time
        FROM counted"""),
    "layer_gap": (["counted"], """
        SELECT rows_read - rows_other AS rows_read, rows_written,
               round(1 - rows_written / (rows_read - rows_other)::DOUBLE, 6) AS gap FROM counted"""),
    "silence_stream": (["pings", "rated"], f"""
        SELECT mmsi, CASE WHEN knots > 35 AND change > 5 THEN 'GPS_SPOOFING' WHEN knots > 35 THEN 'IMPOSSIBLE_SPEED'
                          ELSE 'SUDDEN_ACCELERATION' END AS alert_type,
               CASE WHEN knots > 35 THEN 'high' ELSE 'medium' END AS severity,
               'calculated_speed=' || printf('%.1f', knots) || 'kn reported_sog=' || coalesce(sog::VARCHAR, 'None')
                   || 'kn speed_change=' || printf('%.1f', change) || 'kn' AS description,
               lat AS latitude, lon AS longitude
        FROM rated WHERE (knots > 35 OR change > 10) AND NOT ({SILENT})
        UNION ALL
        SELECT mmsi, 'AIS_GAP', 'medium', 'No messages for >120 min — last seen at ' || ({ISO.format(t='t0')}), lat0, lon0
        FROM rated WHERE {SILENT}
        UNION ALL
        SELECT mmsi, 'AIS_GAP', 'medium', 'No messages for >120 min — last seen at ' || ({ISO.format(t='max(t)')}),
               arg_max(lat, t), arg_max(lon, t)
        FROM pings GROUP BY mmsi
        HAVING epoch_ms(max(t)) + 7200000 <= (SELECT epoch_ms(max(t)) - 600000 FROM pings)"""),
    "stream_once_each": (["bronze"], f"SELECT DISTINCT mmsi AS MMSI, {_ts('t')} AS time_utc, 1::BIGINT AS copies FROM bronze"),
    "box_index_lookup": (["bronze"], """
        SELECT rid AS event_id, min(b.zone_id) AS zone_id, 'zone ' || min(b.zone_id) AS zone
        FROM bronze LEFT JOIN (
            SELECT c_custkey AS zone_id, (c_custkey * 37 % 1600) / 1e1 - 8e1 AS y, (c_custkey * 91 % 3500) / 1e1 - 175e0 AS x,
                   0.05::DOUBLE + (c_custkey % 50) / 2e1 AS half FROM customer) b
        ON lat BETWEEN y - half AND y + half AND lon BETWEEN x - half AND x + half
        GROUP BY rid"""),
    "loitering_sessions": (["sessions"], FINAL["vessel_loitering"][1].replace("FROM loiter", "FROM sessions")),
    "report_timeline_hole": (["hole_label"], _hole("hole_label", 5)),
}
FINAL["loitering_sessions_sliced"] = FINAL["loitering_sessions"]


# Expectations: every rule as one SELECT over the model's block.

MODEL_BLOCK = {
    "silver_positions": ["silver"], "silver_metadata": ["metadata"], "vessel_activity_summary": ["activity"],
    "port_traffic": ["in_port", "first_entries"], "vessel_erratic_course": ["erratic"], "vessel_dark_events": ["dark"],
    "vessel_speed_anomalies": ["speed"], "vessel_loitering": ["loiter"], "vessel_risk_score": ["risk"],
}


def _rule_sql(rule: Rule) -> str:
    column = rule.columns[0] if rule.columns else ""
    keys = ", ".join(rule.columns)
    if rule.kind == "not_null":
        count = f"SELECT count(*) FROM model WHERE {column} IS NULL"
    elif rule.kind == "accepted_values":
        count = f"SELECT count(*) FROM model WHERE {column} NOT IN ({', '.join(map(_text, rule.values))})"
    elif rule.kind == "not_constant":
        count = f"SELECT CASE WHEN count(DISTINCT {column}) > 1 THEN 0 ELSE 1 END FROM model"
    elif rule.kind == "is_true":
        expression = rule.expression.replace("timestampdiff(MINUTE, ", "date_sub('minute', ")
        expression = expression.replace("current_timestamp()", "now()").replace("current_date()", "current_date")
        count = f"SELECT count(*) FROM model WHERE NOT ({expression})"
    else:
        present = f"WHERE {column} IS NOT NULL" if rule.kind == "unique" else ""
        count = f"SELECT count(*) FROM (SELECT 1 FROM model {present} GROUP BY {keys} HAVING count(*) > 1)"
    return (
        f"SELECT '{rule.name}' AS name, '{rule.kind}' AS kind, '{rule.severity}' AS severity, "
        f"({count})::BIGINT AS failures, ({count}) = 0 AS passed"
    )


def _expectations(name: str) -> str:
    source = MODEL_BLOCK[name][0] if name != "port_traffic" else f"({_port_traffic('first_entries')})"
    clock = {"silver_metadata": ", processed_at AS processing_timestamp"}.get(name, ", now() AS gold_processed_at")
    model = f"WITH model AS (SELECT *{clock} FROM {source})"
    if name == "port_traffic":
        model = f"WITH model AS (SELECT * REPLACE (date_day::DATE AS date_day){clock} FROM {source})"
    return model + "\n" + "\nUNION ALL ".join(_rule_sql(r) for r in SUITES[name])


FINAL |= {f"expectations_{name}": (blocks, _expectations(name)) for name, blocks in MODEL_BLOCK.items()}


def _needed(names: list[str], seen: dict[str, None]) -> None:
    for name in names:
        if name not in seen:
            _needed(BLOCKS[name][0], seen)
            seen[name] = None


def sql(name: str) -> str:
    reads, select = FINAL[name]
    order: dict[str, None] = {}
    _needed(reads, order)
    blocks = ",\n".join(f"{b} AS ({BLOCKS[b][1]})" for b in order)
    return f"WITH {blocks}\nSELECT * FROM ({select})"


TABLES_READ_BACK = {
    "merge_into_table": """
        SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS day
        FROM events WHERE event_type = 'purchase' OR ts < TIMESTAMP '2024-01-16'""",
    "compact_table": "SELECT event_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events",
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(name) for name in FINAL} | TABLES_READ_BACK
