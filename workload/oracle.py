"""DuckDB SQL for the registered queries."""

from __future__ import annotations

WS = "' ' || chr(9) || chr(10) || chr(160) || chr(12288)"

BASIC = """basic AS (
  SELECT o_orderkey AS report_id, o_orderdate AS date_time, CAST(o_custkey % 100 AS INTEGER) AS police_beat,
         o_orderpriority AS address_road_primary, nullif(CAST(o_custkey % 7 AS INTEGER), 0) AS injured,
         nullif(CAST(o_orderkey % 3 AS INTEGER), 1) AS killed, nullif(o_orderstatus, 'O') AS hit_run_lvl
  FROM orders),
recent AS (SELECT * FROM basic WHERE date_time >= (SELECT max(date_time) - INTERVAL 90 DAY FROM basic))"""

CHILDREN = BASIC + """,
details AS (
  SELECT l_orderkey AS report_id, l_linenumber AS line, nullif(l_returnflag, 'N') AS person_role,
         nullif(l_linestatus, 'F') AS person_injury_lvl,
         nullif(CAST(trunc(l_quantity) AS INTEGER) % 5, 0) AS injured,
         nullif(CAST(l_partkey % 9 AS INTEGER), 4) AS killed,
         CASE WHEN l_tax > 0 THEN l_returnflag END AS veh_type,
         CAST(l_suppkey % 100 AS INTEGER) AS police_beat, nullif(l_returnflag, 'R') AS hit_run_lvl
  FROM lineitem),
children AS (SELECT * FROM details WHERE report_id IN (SELECT report_id FROM recent)),
sizes AS (SELECT report_id, count(*) AS n_rows FROM children GROUP BY report_id)"""


def null_rates(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round_even(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 2) AS null_pct FROM {source}"
        for c in columns
    )


RAW = f"""raw AS (
  SELECT event_id + 2 AS row_num,
    CASE WHEN event_id % 29 = 0 THEN '  ' WHEN event_id % 3 = 0 THEN chr(9) || CAST(event_id AS VARCHAR) || chr(160)
         ELSE CAST(event_id AS VARCHAR) END AS report_id,
    CASE WHEN event_id % 23 = 0 THEN '01/05/2024' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date_time,
    CASE WHEN event_id % 5 = 0 THEN ' ' ELSE '' END || CAST(user_id AS VARCHAR) AS police_beat,
    CASE WHEN event_id % 11 = 0 THEN 'x' WHEN event_id % 7 = 0 THEN '   ' WHEN event_id % 13 = 0 THEN '1.0'
         ELSE CAST(event_id % 4 AS VARCHAR) END AS injured,
    CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 10 = 0 THEN ' ' || event_type || chr(12288) ELSE event_type END AS note
  FROM events),
cells AS (
  SELECT row_num, nullif(trim(report_id, {WS}), '') AS report_id, nullif(trim(date_time, {WS}), '') AS date_time,
         nullif(trim(police_beat, {WS}), '') AS police_beat, nullif(trim(injured, {WS}), '') AS injured,
         nullif(trim(note, {WS}), '') AS note FROM raw),
typed AS (
  SELECT row_num, report_id,
         CASE WHEN regexp_full_match(date_time, '[0-9]{{4}}-.*') THEN TRY_CAST(date_time AS TIMESTAMP) END AS date_time,
         CASE WHEN regexp_full_match(police_beat, '[+-]?[0-9]+') THEN TRY_CAST(police_beat AS INTEGER) END AS police_beat,
         CASE WHEN regexp_full_match(injured, '[+-]?[0-9]+') THEN TRY_CAST(injured AS INTEGER) END AS injured,
         note FROM cells),
found AS (
  SELECT row_num, 0 AS col_ord, 'report_id' AS column_name, 'required' AS rule, report_id AS value FROM cells WHERE report_id IS NULL
  UNION ALL SELECT row_num, 1, 'date_time', 'required', date_time FROM cells WHERE date_time IS NULL
  UNION ALL SELECT row_num, 2, 'police_beat', 'required', police_beat FROM cells WHERE police_beat IS NULL
  UNION ALL SELECT c.row_num, 1, 'date_time', 'timestamp', c.date_time FROM cells c JOIN typed t USING (row_num)
            WHERE c.date_time IS NOT NULL AND t.date_time IS NULL
  UNION ALL SELECT c.row_num, 2, 'police_beat', 'integer', c.police_beat FROM cells c JOIN typed t USING (row_num)
            WHERE c.police_beat IS NOT NULL AND t.police_beat IS NULL
  UNION ALL SELECT c.row_num, 3, 'injured', 'integer', c.injured FROM cells c JOIN typed t USING (row_num)
            WHERE c.injured IS NOT NULL AND t.injured IS NULL)"""

MAPPED = """mapped AS (
  SELECT c_custkey AS objectid, c_custkey % 500 AS beat,
         CASE WHEN c_custkey % 41 <> 0 THEN 32.0 + (c_custkey % 64) / 64.0 END AS representative_lat,
         -117.0 - (c_custkey % 64) / 64.0 AS representative_lon,
         CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 37 <> 0 THEN 'K' || (c_custkey % 60) END AS station_id
  FROM customer)"""

SPLIT = r"""replies AS (
  SELECT event_id, date_trunc('hour', ts) AS captured_at, 'K' || (user_id % 60) AS station_id, user_id % 60 AS station_no,
         CAST(CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS INTEGER) AS http_status,
         CASE WHEN event_id % 13 = 0 THEN regexp_replace(props, '\}$', '') ELSE props END AS body
  FROM events),
asked AS (SELECT DISTINCT captured_at, station_id FROM replies),
last_try AS (
  SELECT captured_at, station_id, http_status, body FROM replies WHERE station_no < 50
  QUALIFY row_number() OVER (PARTITION BY captured_at, station_id ORDER BY event_id DESC) = 1),
split AS (
  SELECT a.captured_at, a.station_id, l.http_status, l.body,
         (l.http_status IS NULL OR l.http_status >= 400 OR l.body IS NULL OR NOT json_valid(l.body)) AS is_failed
  FROM asked a LEFT JOIN last_try l USING (captured_at, station_id))"""

ISO = "strftime(captured_at, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
SOURCE = "'https://api.weather.gov' AS source, CAST(1 AS INTEGER) AS schema_version"

DOCUMENTS = SPLIT + f""",
documents_ AS (
  SELECT captured_at, {ISO} AS captured_at_utc, list(station_id ORDER BY station_id) AS stations_requested,
         coalesce(list(station_id ORDER BY station_id) FILTER (WHERE is_failed), []) AS stations_failed,
         coalesce(list(CASE WHEN NOT is_failed THEN json(body) END ORDER BY station_id) FILTER (WHERE NOT is_failed), []) AS observations
  FROM split GROUP BY captured_at)"""

OBSERVED = """observed AS (
  SELECT CASE WHEN event_id % 31 <> 0 THEN 'obs/' || event_id END AS observation_id, event_id, user_id % 50 AS station_no,
         'K' || (user_id % 50) AS station_id, ts, event_type, value
  FROM events)"""

# Rectangles on an integer grid: one or two parts per supplier, some with a unit hole.
RECTANGLES = """base AS (
  SELECT s_suppkey AS k, CAST(s_nationkey AS BIGINT) AS beat, (s_suppkey * 7) % 13 AS x, (s_suppkey * 5) % 11 AS y,
         s_suppkey % 3 + 1 AS w, s_suppkey % 4 + 1 AS h, (s_suppkey % 3 = 2 AND s_suppkey % 4 >= 2) AS hole
  FROM supplier),
rects AS (
  SELECT k, 0 AS part_no, beat, x, y, w, h, hole FROM base
  UNION ALL SELECT k, 1, beat, x + 20, y + 3, 1, 1, FALSE FROM base WHERE k % 4 = 0)"""

COMPONENTS = RECTANGLES + """,
columns_ AS (SELECT *, unnest(range(w)) AS i FROM rects),
squares AS (SELECT *, unnest(range(h)) AS j FROM columns_),
grid AS (SELECT DISTINCT beat, x + i AS cx, y + j AS cy FROM squares WHERE NOT (hole AND i = 1 AND j = 1)),
reach(beat, cx, cy, rx, ry) AS (
  SELECT beat, cx, cy, cx, cy FROM grid
  UNION
  SELECT g.beat, g.cx, g.cy, r.rx, r.ry FROM reach r JOIN grid g
    ON g.beat = r.beat AND abs(g.cx - r.cx) + abs(g.cy - r.cy) = 1),
members AS (SELECT beat, cx, cy, min(rx * 1000 + ry) AS comp FROM reach GROUP BY beat, cx, cy)"""

POINTS = COMPONENTS + """,
ranked AS (
  SELECT beat, comp, min(cy) AS y0, max(cy) + 1 AS y1,
         row_number() OVER (PARTITION BY beat ORDER BY count(*) DESC, min(cx), min(cy)) AS r
  FROM members GROUP BY beat, comp),
biggest AS (SELECT beat, comp, y0, y1 FROM ranked WHERE r = 1),
own AS (SELECT m.beat, m.cx, m.cy, b.y0, b.y1 FROM members m JOIN biggest b USING (beat, comp)),
touching AS (
  SELECT beat, cx + dx AS px, cy + dy AS py, count(*) AS n, min((dx + dy) % 2) <> max((dx + dy) % 2) AS straight
  FROM own, (VALUES (0), (1)) a(dx), (VALUES (0), (1)) b(dy) GROUP BY beat, px, py),
corners AS (
  SELECT DISTINCT beat, x + dx * w AS px, y + dy * h AS py FROM rects, (VALUES (0), (1)) a(dx), (VALUES (0), (1)) b(dy)
  UNION
  SELECT DISTINCT beat, x + 1 + dx, y + 1 + dy FROM rects, (VALUES (0), (1)) a(dx), (VALUES (0), (1)) b(dy) WHERE hole),
vertices AS (
  SELECT t.beat, t.py FROM touching t LEFT JOIN corners c USING (beat, px, py)
  WHERE t.n < 4 AND (t.n <> 2 OR NOT t.straight OR c.px IS NOT NULL)),
scan AS (
  SELECT v.beat, max(CASE WHEN 2 * v.py <= b.y0 + b.y1 THEN v.py END) + min(CASE WHEN 2 * v.py > b.y0 + b.y1 THEN v.py END) AS twice_y
  FROM vertices v JOIN biggest b USING (beat) GROUP BY v.beat),
scanned AS (
  SELECT o.beat, o.cx, s.twice_y, o.cx - row_number() OVER (PARTITION BY o.beat ORDER BY o.cx) AS run
  FROM own o JOIN scan s ON s.beat = o.beat AND o.cy = CAST(floor(s.twice_y / 2.0) AS BIGINT)),
runs AS (SELECT beat, twice_y, min(cx) AS a, max(cx) + 1 AS b FROM scanned GROUP BY beat, twice_y, run),
widest AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY beat ORDER BY b - a DESC, a) = 1)"""

NAMED = """named AS (
  SELECT s_suppkey AS feature_index, s_suppkey * 10 + 7 AS objectid, CAST(s_nationkey AS BIGINT) AS beat,
         CASE WHEN s_suppkey % 19 <> 0 THEN s_nationkey % 5 + CASE WHEN s_suppkey % 17 = 0 THEN 1 ELSE 0 END END AS div,
         s_nationkey % 3 + CASE WHEN s_suppkey % 23 = 0 THEN 8 ELSE 0 END AS serv,
         CASE WHEN s_suppkey % 3 <> 0 THEN 'area ' || s_nationkey || CASE WHEN s_suppkey % 29 = 0 THEN 'b' ELSE '' END END AS name,
         CASE WHEN s_suppkey % 4 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type
  FROM supplier),
one AS (
  SELECT beat, min(objectid) AS objectid, count(*) AS source_feature_count, count(*) - count(name) AS source_null_name_count,
         CAST(min(CAST(div AS VARCHAR)) AS BIGINT) AS div, CAST(min(CAST(serv AS VARCHAR)) AS BIGINT) AS serv, min(name) AS name,
         count(DISTINCT div) + CASE WHEN count(div) < count(*) THEN 1 ELSE 0 END > 1 AS div_conflict,
         count(DISTINCT serv) + CASE WHEN count(serv) < count(*) THEN 1 ELSE 0 END > 1 AS serv_conflict,
         count(DISTINCT name) > 1 AS name_conflict,
         string_agg(CAST(objectid AS VARCHAR), ',' ORDER BY objectid) AS source_objectids
  FROM named GROUP BY beat),
clashes AS (
  SELECT beat, 'div' AS field, CAST(div AS VARCHAR) AS chosen FROM one WHERE div_conflict
  UNION ALL SELECT beat, 'serv', CAST(serv AS VARCHAR) FROM one WHERE serv_conflict
  UNION ALL SELECT beat, 'name', name FROM one WHERE name_conflict)"""


def distances(pairs: str, rounds: int = 10) -> str:
    """CTE chain: Vincenty's inverse formula over ``pairs`` (lat1, lon1, lat2, lon2), giving ``measured.km``."""
    f, a = 1 / 298.257223563, 6378137.0
    b = a * (1 - f)
    ctes = [
        f"""start_ AS (SELECT *, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, dl AS lam FROM (
  SELECT *, atan({1 - f!r} * tan(radians(lat1))) AS u1, atan({1 - f!r} * tan(radians(lat2))) AS u2,
         radians(CASE WHEN lon2 - lon1 > 180 THEN lon2 - lon1 - 360 WHEN lon2 - lon1 < -180 THEN lon2 - lon1 + 360 ELSE lon2 - lon1 END) AS dl
  FROM {pairs}))"""
    ]
    previous = "start_"
    for i in range(rounds):
        ctes.append(
            f"""it{i}a AS (SELECT *, sqrt(power(c2 * sin(lam), 2) + power(c1 * s2 - s1 * c2 * cos(lam), 2)) AS ss,
       s1 * s2 + c1 * c2 * cos(lam) AS cs FROM {previous}),
it{i}b AS (SELECT *, atan2(ss, cs) AS sigma, CASE WHEN ss = 0 THEN 0 ELSE c1 * c2 * sin(lam) / ss END AS sina FROM it{i}a),
it{i}c AS (SELECT *, CASE WHEN 1 - sina * sina = 0 THEN 0 ELSE cs - 2 * s1 * s2 / (1 - sina * sina) END AS c2m,
       {f!r} / 16 * (1 - sina * sina) * (4 + {f!r} * (4 - 3 * (1 - sina * sina))) AS cc FROM it{i}b)"""
        )
        if i < rounds - 1:
            ctes.append(
                f"""it{i} AS (SELECT * EXCLUDE (lam, ss, cs, sigma, sina, c2m, cc),
       dl + (1 - cc) * {f!r} * sina * (sigma + cc * ss * (c2m + cc * cs * (2 * c2m * c2m - 1))) AS lam FROM it{i}c)"""
            )
        previous = f"it{i}"
    last = f"it{rounds - 1}c"
    ctes.append(
        f"""u2_ AS (SELECT *, (1 - sina * sina) * {(a * a - b * b) / (b * b)!r} AS uu FROM {last}),
ab_ AS (SELECT *, 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu))) AS big_a,
       uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu))) AS big_b FROM u2_),
measured AS (SELECT *, {b!r} * big_a * (sigma - big_b * ss * (c2m + big_b / 4 * (cs * (2 * c2m * c2m - 1)
       - big_b / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))) / 1000 AS km FROM ab_)"""
    )
    return ",\n".join(ctes)


NEAR_POINTS = """points AS (
  SELECT c_custkey AS beat, 31.5 + (c_custkey * 53 % 251) / 100.0 AS lat1, -118.5 + (c_custkey * 89 % 241) / 100.0 AS lon1 FROM customer)"""
WIDE_POINTS = """points AS (
  SELECT c_custkey AS beat, CAST(-60.0 AS DOUBLE) + CAST(c_custkey * 53 % 1199 AS DOUBLE) / 10 + CAST(0.037 AS DOUBLE) AS lat1,
         CAST(-180.0 AS DOUBLE) + CAST(c_custkey * 89 % 3593 AS DOUBLE) / 10 + CAST(0.041 AS DOUBLE) AS lon1 FROM customer)"""

# The station list in its own order.
LISTED = """listed(ordinal, station_id, station_name, lat2, lon2, station_location) AS (VALUES
  (0, 'KSAN', 'San Diego International Airport', 32.7338, -117.1933, 'Coastal/Downtown'),
  (1, 'KNZY', 'North Island Naval Air Station', 32.6992, -117.2153, 'Harbor/Coronado'),
  (2, 'KSDM', 'Brown Field Municipal', 32.5723, -116.9801, 'South San Diego'),
  (3, 'KMYF', 'Montgomery-Gibbs Executive', 32.8158, -117.1394, 'Kearny Mesa/Inland'),
  (4, 'KRNM', 'Ramona Airport', 33.04111, -116.91556, 'North Inland/East County'),
  (5, 'KSEE', 'Gillespie Field', 32.82472, -116.97222, 'East County/El Cajon'),
  (6, 'KNKX', 'MCAS Miramar', 32.86833, -117.14167, 'North Inland/Miramar'))"""

NEAREST = "nearest AS (SELECT * FROM measured QUALIFY row_number() OVER (PARTITION BY beat ORDER BY km, ordinal) = 1)"

MAPPING = f"""pairs_ AS (
  SELECT s_suppkey AS k, s_suppkey // 2 AS beat, (s_suppkey // 2 * 7) % 29 AS x, (s_suppkey // 2 * 5) % 23 AS y,
         s_suppkey // 2 % 3 + 1 AS h, s_suppkey // 2 % 2 + 1 AS w1, s_suppkey // 2 % 4 + 1 AS w2,
         s_suppkey // 2 % 5 = 0 AS apart, s_name FROM supplier),
both_ AS (
  SELECT beat, min(k) * 10 + 7 AS objectid, string_agg(CAST(k * 10 + 7 AS VARCHAR), ',' ORDER BY k) AS source_objectids,
         list(k * 10 + 7 ORDER BY k) AS ids,
         count(*) AS source_feature_count, count(*) - count(CASE WHEN k % 2 = 0 THEN 1 END) AS source_null_name_count,
         beat % 5 AS div, beat % 3 AS serv, min(CASE WHEN k % 2 = 0 THEN s_name END) AS name,
         min(x) AS x, min(y) AS y, min(h) AS h, min(w1) AS w1, min(w2) AS w2, bool_or(apart) AND count(*) = 2 AS apart, count(*) AS n
  FROM pairs_ GROUP BY beat),
spans AS (
  SELECT *, CASE WHEN apart AND w2 > w1 THEN x + w1 + 2 ELSE x END AS a,
         CASE WHEN n = 1 THEN x + w1 WHEN NOT apart THEN x + w1 + w2 WHEN w2 > w1 THEN x + w1 + 2 + w2 ELSE x + w1 END AS b
  FROM both_),
{LISTED},
located AS (
  SELECT s.*, l.*, 32 + (y + h / 2.0) / 8.0 AS lat1, -118 + (a + b) / 16.0 AS lon1 FROM spans s, listed l),
{distances('located')},
{NEAREST},
mapping AS (
  SELECT objectid, ids, source_objectids, source_feature_count, source_null_name_count, beat, div, serv, name,
         CASE WHEN apart THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type, round(CAST(lat1 AS DOUBLE), 6) AS representative_lat,
         round(CAST(lon1 AS DOUBLE), 6) AS representative_lon, station_id, station_name, station_location,
         round(km, 2) AS distance_to_station_km
  FROM nearest)"""

MAPPING_FIELDS = """objectid, source_objectids, source_feature_count, source_null_name_count, beat, div, serv, name, geometry_type,
  representative_lat, representative_lon, station_id, station_name, station_location, distance_to_station_km"""

ORACLE: dict[str, str] = {
    "rows_per_report_90d": f"""WITH {CHILDREN}
SELECT n_rows AS rows_per_key, count(*) AS n_keys FROM sizes GROUP BY n_rows ORDER BY n_keys DESC, rows_per_key LIMIT 10""",
    "recent_window": f"WITH {BASIC} SELECT report_id, date_time, police_beat, address_road_primary FROM recent",
    "recent_children": f"WITH {CHILDREN} SELECT report_id, line, police_beat FROM children",
    "latest_and_cutoff": f"WITH {BASIC} SELECT max(date_time) AS latest, max(date_time) - INTERVAL 90 DAY AS cutoff FROM basic",
    "parent_shape": f"WITH {BASIC} SELECT count(*) AS n_rows, CAST(7 AS INTEGER) AS n_columns FROM recent",
    "child_shape": f"WITH {CHILDREN} SELECT count(*) AS n_rows, CAST(9 AS INTEGER) AS n_columns FROM children",
    "grain_check": f"""WITH {BASIC} SELECT count(DISTINCT report_id) = count(*) AS is_unique,
  count(DISTINCT report_id) AS n_distinct, count(*) AS n_rows FROM recent""",
    "grain_check_children": f"""WITH {CHILDREN} SELECT count(DISTINCT report_id) = count(*) AS is_unique,
  count(DISTINCT report_id) AS n_distinct, count(*) AS n_rows FROM details""",
    "null_profile": f"WITH {BASIC} "
    + null_rates(
        "recent",
        ["report_id", "date_time", "police_beat", "address_road_primary", "injured", "killed", "hit_run_lvl"],
    ),
    "null_profile_subset": f"WITH {CHILDREN} "
    + null_rates(
        "children",
        ["person_role", "person_injury_lvl", "injured", "killed", "veh_type", "police_beat", "hit_run_lvl"],
    ),
    "top_roads": f"""WITH {BASIC} SELECT address_road_primary AS road, count(*) AS n_rows FROM recent
  WHERE address_road_primary IS NOT NULL GROUP BY road ORDER BY n_rows DESC, road LIMIT 15""",
    "top_beats": f"""WITH {BASIC} SELECT police_beat AS beat, count(*) AS n_rows FROM recent
  GROUP BY beat ORDER BY n_rows DESC, beat LIMIT 15""",
    "hour_histogram": """SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_rows FROM events
  WHERE ts >= (SELECT max(ts) - INTERVAL 90 DAY FROM events) GROUP BY 1""",
    "rows_per_report": f"WITH {CHILDREN} SELECT report_id, n_rows FROM sizes",
    "rows_per_report_describe": f"""WITH {CHILDREN} SELECT count(*) AS n, round(avg(n_rows), 6) AS mean,
  round(stddev_samp(n_rows), 6) AS std, min(n_rows) AS "min", quantile_cont(n_rows, 0.25) AS p25, quantile_cont(n_rows, 0.5) AS p50,
  quantile_cont(n_rows, 0.75) AS p75, max(n_rows) AS "max" FROM sizes""",
    "normalize_rows": f"WITH {RAW} SELECT row_num, report_id, date_time, police_beat, injured, note FROM typed",
    "required_violations": f"WITH {RAW} SELECT row_num, column_name, value FROM found WHERE rule = 'required'",
    "integer_violations": f"WITH {RAW} SELECT row_num, column_name, value FROM found WHERE rule = 'integer'",
    "timestamp_violations": f"WITH {RAW} SELECT row_num, column_name, value FROM found WHERE rule = 'timestamp'",
    "first_violation": f"WITH {RAW} SELECT row_num, column_name, rule, value FROM found ORDER BY row_num, col_ord LIMIT 1",
    "staging_counts": f"""WITH {RAW}, broken AS (SELECT DISTINCT row_num FROM found)
SELECT (SELECT count(*) FROM raw) AS rows_read, (SELECT count(*) FROM raw) - (SELECT count(*) FROM broken) AS rows_accepted,
  (SELECT count(*) FROM broken) AS rows_broken""",
    "lineage_columns": """SELECT event_id + 2 AS row_num, DATE '2024-02-01' AS snapshot_dt, 'event_rows.csv' AS source_file,
  TIMESTAMP '2024-02-01 06:00:00' AS load_ts FROM events""",
    "staged_table": f"""WITH {RAW} SELECT report_id, date_time, police_beat, injured, note FROM typed
  WHERE row_num NOT IN (SELECT row_num FROM found)""",
    "load_job": """WITH counts AS (SELECT (SELECT count(*) FROM orders) AS n_basic, (SELECT count(*) FROM lineitem) AS n_details)
SELECT n_basic AS rows_inserted, CAST(o_orderkey AS VARCHAR) AS report_id, CAST(o_orderdate AS TIMESTAMP) AS date_time,
  CAST(o_custkey % 100 AS INTEGER) AS police_beat, nullif(CAST(o_custkey % 7 AS INTEGER), 0) AS injured,
  DATE '2024-02-01' AS snapshot_dt, 'pd_collisions_datasd.csv' AS source_file, TIMESTAMP '2024-02-01 06:00:00' AS load_ts FROM orders, counts
UNION ALL
SELECT n_details, CAST(l_orderkey AS VARCHAR), CAST(o_orderdate AS TIMESTAMP), CAST(l_suppkey % 100 AS INTEGER),
  nullif(CAST(l_quantity AS INTEGER) % 5, 0), DATE '2024-02-01', 'pd_collisions_details_datasd.csv', TIMESTAMP '2024-02-01 06:00:00'
FROM lineitem JOIN orders ON o_orderkey = l_orderkey, counts""",
    "csv_scan": f"WITH {RAW} SELECT report_id, date_time, police_beat, injured, note FROM typed",
    "load_job_refusals": """WITH n AS (SELECT count(*) AS n FROM orders)
SELECT 'good' AS load, '' AS message, n AS rows_in_table FROM n
UNION ALL SELECT 'header', 'dataset staging_collisions_basic: missing columns [''killed'']', n FROM n
UNION ALL SELECT 'row', 'dataset staging_collisions_basic, row ' ||
  (SELECT count(*) + 1 FROM orders WHERE o_orderkey <= (SELECT min(o_orderkey) FROM orders WHERE o_orderkey % 50 = 33)) ||
  ', column police_beat: not a valid integer: ' || chr(39) || 'x' || chr(39), n FROM n
UNION ALL SELECT 'file', 'source files not found: staging_collisions_basic: /landing/2024-02-04/pd_collisions_datasd.csv', n FROM n""",
    "row_numbers": """SELECT event_id, length('"' || event_type || '", ' || CASE WHEN event_id % 3 = 0 THEN chr(10) || chr(10) || ',' ELSE '' END || props) AS note_length,
  row_number() OVER (PARTITION BY event_id // 2000 ORDER BY event_id) + 1 AS row_num FROM events""",
    "header_check": """SELECT event_id,
  CASE event_id % 6 WHEN 1 THEN 'missing' WHEN 2 THEN 'duplicates' WHEN 3 THEN 'unexpected' WHEN 4 THEN 'empty' WHEN 5 THEN 'missing' END AS problem,
  CASE WHEN event_id % 6 = 2 THEN 'report_id' ELSE '' END AS duplicates,
  CASE event_id % 6 WHEN 1 THEN 'note' WHEN 4 THEN 'date_time,injured,note,police_beat,report_id' WHEN 5 THEN 'report_id' ELSE '' END AS missing,
  CASE event_id % 6 WHEN 3 THEN event_type WHEN 5 THEN 'Report_ID' ELSE '' END AS unexpected FROM events""",
    "dated_sources": """SELECT 'landing/raw/' || strftime(ts, '%Y-%m-%d') || '/rows_' || day(ts) || '.csv' AS path,
  'rows_' || day(ts) || '.csv' AS source_file, count(*) AS n_rows FROM events GROUP BY 1, 2""",
    "run_dates": "SELECT event_id, CASE WHEN event_id % 3 = 1 THEN CAST(ts AS DATE) END AS run_date FROM events",
    "mapping_violations": f"""WITH {MAPPED} SELECT objectid, 'representative_lat' AS missing_field FROM mapped WHERE representative_lat IS NULL
  UNION ALL SELECT objectid, 'station_id' FROM mapped WHERE station_id IS NULL""",
    "requested_stations": f"WITH {MAPPED} SELECT DISTINCT station_id FROM mapped WHERE station_id <> ''",
    "response_split": f"WITH {SPLIT} SELECT captured_at, station_id, http_status, body, is_failed FROM split",
    "capture_metrics": f"""WITH {SPLIT} SELECT captured_at, count(*) AS total_stations,
  count(*) FILTER (WHERE NOT is_failed) AS succeeded, count(*) FILTER (WHERE is_failed) AS failed FROM split GROUP BY captured_at""",
    "batch_envelope": f"""WITH {DOCUMENTS}
SELECT 'nws_observations/' || strftime(captured_at, '%Y-%m-%d') || '/' || strftime(captured_at, '%Y-%m-%dT%H-%M-%SZ') || '.json' AS batch_key,
  CAST(to_json({{'captured_at_utc': captured_at_utc, 'stations_requested': stations_requested, 'stations_failed': stations_failed,
    'source': 'https://api.weather.gov', 'schema_version': 1, 'observations': observations}}) AS VARCHAR) AS document FROM documents_""",
    "batch_keys": """SELECT event_id, 'nws_observations/' || strftime(ts, '%Y-%m-%d') || '/' || strftime(ts, '%Y-%m-%dT%H-%M-%SZ') || '.json' AS batch_key
  FROM events""",
    "observation_log": f"""WITH {SPLIT} SELECT {ISO} AS captured_at_utc, CAST(captured_at AS DATE) AS capture_date, station_id, is_failed,
  {SOURCE}, CASE WHEN NOT is_failed THEN body END AS body FROM split""",
    "observation_rows": f"WITH {SPLIT} SELECT {ISO} AS captured_at_utc, {SOURCE}, CAST(json(body) AS VARCHAR) AS body FROM split WHERE NOT is_failed",
    "stream_observation_batches": f"WITH {SPLIT} SELECT {ISO} AS captured_at_utc, {SOURCE}, CAST(json(body) AS VARCHAR) AS body FROM split WHERE NOT is_failed",
    "observation_flatten": f"""WITH {OBSERVED} SELECT observation_id, 'Feature' AS feature_type, station_id, 'Station ' || station_no AS station_name,
  ts AS observed_at, CAST(-117.0 - station_no / 64.0 AS DOUBLE) AS lon, CAST(32.0 + station_no / 64.0 AS DOUBLE) AS lat,
  event_type AS text_description, value AS temperature, 'wmoUnit:degC' AS temperature_unit, 'V' AS temperature_qc,
  CASE WHEN event_id % 4 <> 0 THEN value * 2 END AS wind_gust, CAST(0 AS BIGINT) AS n_present_weather,
  observation_id IS NOT NULL AS is_valid FROM observed""",
    "observation_cloud_layers": f"""WITH {OBSERVED},
layered AS (SELECT *, unnest(CASE WHEN event_id % 3 = 0 THEN [NULL] ELSE range(event_id % 3) END) AS layer FROM observed)
SELECT observation_id, station_id, CAST(layer AS BIGINT) AS layer, CASE layer WHEN 0 THEN 'FEW' WHEN 1 THEN 'BKN' END AS amount,
  CAST(layer * 100 + station_no AS DOUBLE) AS base, CASE WHEN layer IS NOT NULL THEN 'wmoUnit:m' END AS base_unit FROM layered""",
    "response_scan": f"WITH {SPLIT} SELECT station_id, http_status, body FROM replies",
    "capture_job_document": f"""WITH {SPLIT}, {MAPPED},
wanted AS (SELECT DISTINCT station_id FROM mapped WHERE station_id <> '' AND representative_lat IS NOT NULL),
latest AS (SELECT station_id, http_status, body FROM replies WHERE station_no < 50
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY event_id DESC) = 1),
outcome AS (SELECT w.station_id, (l.http_status IS NULL OR l.http_status >= 400 OR l.body IS NULL OR NOT json_valid(l.body)) AS is_failed
  FROM wanted w LEFT JOIN latest l USING (station_id))
SELECT '2024-02-01T06:30:00+00:00' AS captured_at_utc, string_agg(station_id, ',' ORDER BY station_id) AS stations_requested,
  coalesce(string_agg(station_id, ',' ORDER BY station_id) FILTER (WHERE is_failed), '') AS stations_failed,
  count(*) FILTER (WHERE NOT is_failed) AS n_observations, count(*) AS total_stations,
  count(*) FILTER (WHERE NOT is_failed) AS succeeded, count(*) FILTER (WHERE is_failed) AS failed FROM outcome""",
    "report_detail_join": f"""SELECT l_orderkey AS report_id, l_linenumber AS line, nullif(l_returnflag, 'N') AS person_role,
  o_orderdate AS report_date_time, CAST(o_custkey % 100 AS INTEGER) AS report_police_beat FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "beat_weather_join": f"""WITH {SPLIT}, {MAPPED} SELECT DISTINCT beat, station_id, captured_at, http_status
  FROM mapped JOIN split USING (station_id) WHERE NOT is_failed""",
    "container_rules": """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 1 THEN 'not_a_feature_collection' ELSE 'features_not_a_list' END AS rule
  FROM supplier WHERE s_suppkey % 3 <> 0""",
    "feature_rules": """SELECT s_suppkey AS feature_index, CASE s_suppkey % 10 WHEN 1 THEN 'missing_required_properties'
    WHEN 2 THEN 'unsupported_geometry_type' WHEN 3 THEN 'missing_coordinates' WHEN 4 THEN 'missing_properties_or_geometry'
    ELSE 'not_an_integer' END AS rule,
  CASE s_suppkey % 10 WHEN 1 THEN 'div' WHEN 4 THEN 'objectid,beat,div,serv' ELSE '' END AS missing_keys
  FROM supplier WHERE s_suppkey % 10 BETWEEN 1 AND 5""",
    "typed_features": f"""WITH {NAMED} SELECT feature_index, objectid, beat, CAST(div AS BIGINT) AS div, CAST(serv AS BIGINT) AS serv, name,
  geometry_type, CAST(CASE geometry_type WHEN 'Polygon' THEN 1 ELSE 2 END AS BIGINT) AS n_parts FROM named""",
    "feature_lines_scan": f"""WITH {NAMED} SELECT objectid, beat, CAST(div AS BIGINT) AS div, CAST(serv AS BIGINT) AS serv, name, geometry_type
  FROM named""",
    "beat_consolidation": f"""WITH {NAMED} SELECT beat, objectid, source_feature_count, source_null_name_count, div, serv, name,
  div_conflict, serv_conflict, name_conflict, source_objectids FROM one""",
    "beat_source_ids": f"WITH {NAMED} SELECT beat, objectid FROM named",
    "beat_conflicts": f"WITH {NAMED} SELECT beat, field, chosen FROM clashes",
    "mapping_job_refusal": f"""WITH {NAMED} SELECT replace('conflicting values: {{~beat~: ' || beat || ', ~field~: ~' || field || '~, ~chosen~: ~' ||
  chosen || '~}}', '~', chr(39)) AS message FROM clashes ORDER BY beat, field LIMIT 1""",
    "beat_conflict_values": f"""WITH {NAMED},
spread AS (
  SELECT beat, 'div' AS field, CAST(div AS VARCHAR) AS value FROM named
  UNION SELECT beat, 'serv', CAST(serv AS VARCHAR) FROM named
  UNION SELECT beat, 'name', name FROM named WHERE name IS NOT NULL)
SELECT s.beat, s.field, s.value FROM spread s JOIN clashes c ON c.beat = s.beat AND c.field = s.field""",
    "station_rules": """WITH stations AS (
  SELECT CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN 'D' || (c_custkey % 100) ELSE 'C' || c_custkey END AS station_id
  FROM customer)
SELECT 'invalid_station_id' AS rule, station_id FROM stations WHERE station_id = ''
UNION ALL SELECT 'duplicate_station_id', station_id FROM stations WHERE station_id <> '' GROUP BY station_id HAVING count(*) > 1""",
    "polygon_area": f"""WITH {RECTANGLES} SELECT k AS feature_index, CAST(part_no AS BIGINT) AS part_no,
  round(CAST(w * h - CASE WHEN hole THEN 1 ELSE 0 END AS DOUBLE) / 64, 9) AS area FROM rects""",
    "representative_point": f"""WITH {RECTANGLES}, single AS (SELECT k, min(x) AS x, min(y) AS y, min(w) AS w, min(h) AS h, bool_or(hole) AS hole
  FROM rects WHERE part_no = 0 GROUP BY k)
SELECT k AS beat, CASE WHEN k % 4 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type,
  -- with a hole in a shape 4 high, the line half-way between ordinates 2 and 4 passes above the hole
  round(-118 + CASE WHEN hole AND h = 3 THEN x + 0.5 ELSE x + w / 2.0 END / 8.0, 9) AS lon,
  round(32 + CASE WHEN hole AND h = 4 THEN y + 3 ELSE y + h / 2.0 END / 8.0, 9) AS lat FROM single""",
    "beat_union": f"""WITH RECURSIVE {COMPONENTS}
SELECT beat, CASE WHEN count(DISTINCT comp) = 1 THEN 'Polygon' ELSE 'MultiPolygon' END AS geometry_type,
  count(DISTINCT comp) AS n_parts, round(CAST(count(*) AS DOUBLE) / 64, 9) AS area FROM members GROUP BY beat""",
    "beat_union_slanted": """SELECT s_suppkey % 10 AS beat, 'Polygon' AS geometry_type, CAST(1 AS BIGINT) AS n_parts,
  round(count(*) * CAST(0.125 AS DOUBLE), 6) AS area, CAST(0 AS BIGINT) AS n_open FROM supplier GROUP BY 1""",
    "beat_point": f"""WITH RECURSIVE {POINTS}
SELECT beat, round(-118 + (a + b) / 16.0, 9) AS lon, round(32 + twice_y / 16.0, 9) AS lat FROM widest""",
    "union_closes": "SELECT CAST(0 AS BIGINT) AS beat, CAST(0 AS BIGINT) AS imbalance FROM supplier WHERE FALSE",
    "geodesic_distance": f"""WITH {NEAR_POINTS}, pairs_ AS (SELECT *, 32.7338 AS lat2, -117.1933 AS lon2 FROM points),
{distances('pairs_')} SELECT beat, round(km, 5) AS km FROM measured""",
    "nearest_of_listed": f"""WITH {NEAR_POINTS},
pairs_ AS (SELECT p.*, n_nationkey AS ordinal, 'N' || n_nationkey AS station_id, n_name AS station_name,
  31.5 + (n_nationkey * 7 % 25) / 10.0 AS lat2, -118.5 + (n_nationkey * 11 % 25) / 10.0 AS lon2 FROM points p, nation),
{distances('pairs_')}, {NEAREST} SELECT beat, station_id, station_name, round(km, 5) AS distance_km FROM nearest""",
    "nearest_of_many": f"""WITH {WIDE_POINTS},
sites AS (SELECT s_suppkey AS ordinal, 'S' || s_suppkey AS station_id, CAST(-60.0 AS DOUBLE) + CAST(s_suppkey * 37 % 1201 AS DOUBLE) / 10 AS lat2,
  CAST(-180.0 AS DOUBLE) + CAST(s_suppkey * 101 % 3601 AS DOUBLE) / 10 AS lon2 FROM supplier),
pairs_ AS (SELECT p.*, s.* FROM points p, sites s
  -- leave out pairs far apart on the globe, where the series does not settle
  WHERE sin(radians(lat1)) * sin(radians(lat2)) + cos(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon1 - lon2)) > -0.5),
{distances('pairs_', 12)}, {NEAREST} SELECT beat, station_id, round(km, 5) AS distance_km FROM nearest""",
    "area_mapping": f"WITH {MAPPING} SELECT {MAPPING_FIELDS} FROM mapping",
    "mapping_scan": f"""WITH {MAPPING} SELECT objectid, beat, name, representative_lat, representative_lon, station_id FROM mapping""",
    "mapping_job": f"""WITH {MAPPING} SELECT objectid, beat, name, representative_lat, representative_lon, station_id FROM mapping""",
    "document_features": """SELECT s_suppkey - (SELECT min(s_suppkey) FROM supplier) AS feature_index, s_suppkey * 10 + 7 AS objectid,
  s_suppkey // 2 AS beat, 'Polygon' AS geometry_type, 'FeatureCollection' AS container_type FROM supplier""",
    "area_mapping_rules": f"""WITH {MAPPING} SELECT count(*) AS n_rows, count(beat) - count(DISTINCT beat) AS n_duplicates,
  CAST(CASE WHEN count(*) = 0 THEN 'empty_mapping' END AS VARCHAR) AS rule FROM mapping""",
    "area_mapping_summary": f"""WITH {MAPPING} SELECT count(*) AS total_beats, count(beat) - count(DISTINCT beat) AS duplicate_beats,
  CAST(sum(greatest(source_feature_count - 1, 0)) AS BIGINT) AS collapsed_features, CAST(sum(source_null_name_count) AS BIGINT) AS null_name_features,
  max(distance_to_station_km) AS max_distance_km, round(avg(distance_to_station_km), 6) AS avg_distance_km,
  count(*) FILTER (WHERE geometry_type = 'MultiPolygon') AS multipolygon_beats FROM mapping""",
    "area_beats_per_station": f"WITH {MAPPING} SELECT station_id, count(*) AS n_beats FROM mapping GROUP BY station_id",
    "area_mapping_document": f"""WITH {MAPPING}
SELECT CAST(0 AS INTEGER) AS section, CAST(NULL AS BIGINT) AS beat, '[' AS value UNION ALL SELECT 2, NULL, ']'
UNION ALL SELECT 1, beat, CASE WHEN beat = (SELECT min(beat) FROM mapping) THEN '  ' ELSE ', ' END || CAST(to_json({{
  'objectid': objectid, 'source_objectids': ids, 'source_feature_count': source_feature_count, 'source_null_name_count': source_null_name_count,
  'beat': beat, 'div': div, 'serv': serv, 'name': name, 'geometry_type': geometry_type, 'representative_lat': representative_lat,
  'representative_lon': representative_lon, 'station_id': station_id, 'station_name': station_name, 'station_location': station_location,
  'distance_to_station_km': distance_to_station_km}}) AS VARCHAR) FROM mapping""",
}
