"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

_TELEMETRY = """
telemetry AS (
  SELECT
    CAST(floor(epoch(ts)) AS BIGINT) AS last_updated,
    'motivate_BOS_' || (CAST(json_extract(props, '$.k') AS BIGINT) % 25) AS station_id,
    CAST(floor(value) AS BIGINT) % 101 AS battery_charge_percentage,
    CAST(event_id AS VARCHAR) AS displayed_number,
    CAST(json_extract(props, '$.k') AS BIGINT) AS docking_capability,
    event_type = 'view' AS is_lbs_internal_rideable,
    event_type AS make_and_model,
    CAST(user_id AS VARCHAR) AS rideable_id,
    value % 17 AS conservative_range_miles,
    value % 31 AS estimated_range_miles,
    ts
  FROM events)"""

_SILVER = f"""{_TELEMETRY},
silver AS (
  SELECT md5(rideable_id || last_updated) AS ebike_time_id, rideable_id, station_id, displayed_number,
    make_and_model, battery_charge_percentage, conservative_range_miles, estimated_range_miles,
    date_trunc('second', ts) AS timestamp_utc,
    date_trunc('second', ts) - INTERVAL 4 HOUR AS timestamp_local, last_updated
  FROM telemetry),
readings AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY rideable_id, last_updated ORDER BY displayed_number) AS rn FROM silver)
  WHERE rn = 1)"""

# Each reading looks up its successor by the time of the next one.
_TRIPS = f"""{_SILVER},
following AS (
  SELECT rideable_id, last_updated AS t0,
    lead(last_updated) OVER (PARTITION BY rideable_id ORDER BY last_updated) AS t1
  FROM readings),
trips AS (
  SELECT md5(a.ebike_time_id || b.ebike_time_id) AS trip_id, a.ebike_time_id AS trip_start_id,
    b.ebike_time_id AS trip_end_id, a.rideable_id,
    a.timestamp_local AS trip_start_time_local, b.timestamp_local AS trip_end_time_local,
    t1 - t0 AS trip_duration_seconds, a.station_id AS pickup_station_id, b.station_id AS dropoff_station_id,
    CASE WHEN t1 - t0 >= 3600 THEN '60+ minutes' WHEN t1 - t0 >= 1800 THEN '30-60 minutes'
         WHEN t1 - t0 >= 600 THEN '10-30 minutes' ELSE '0-10 minutes' END AS trip_duration_bucket,
    a.battery_charge_percentage AS pickup_battery_charge_percentage,
    b.battery_charge_percentage AS dropoff_battery_charge_percentage,
    a.estimated_range_miles AS pickup_estimated_range_miles,
    b.estimated_range_miles AS dropoff_estimated_range_miles,
    a.station_id = b.station_id AS "Single_station_trip",
    a.station_id <> b.station_id AND (
      (b.battery_charge_percentage >= a.battery_charge_percentage
        AND b.battery_charge_percentage <= a.battery_charge_percentage + CAST(9.9 AS DOUBLE))
      OR (b.estimated_range_miles >= a.estimated_range_miles
        AND b.estimated_range_miles <= a.estimated_range_miles + CAST(3.49 AS DOUBLE))) AS "Rebalancing_trip",
    b.battery_charge_percentage - a.battery_charge_percentage >= 10
      OR b.estimated_range_miles >= a.estimated_range_miles + CAST(3.5 AS DOUBLE) AS maintenance_trip
  FROM following f
  JOIN readings a ON a.rideable_id = f.rideable_id AND a.last_updated = f.t0
  JOIN readings b ON b.rideable_id = f.rideable_id AND b.last_updated = f.t1
  WHERE t1 - t0 > 60 AND (a.station_id <> b.station_id OR b.estimated_range_miles < a.estimated_range_miles)),
stations AS (
  SELECT 'motivate_BOS_' || n_nationkey AS station_id, n_name AS name,
    CAST(42.3 AS DOUBLE) + CAST(0.004 AS DOUBLE) * n_nationkey AS lat,
    CAST(-71.1 AS DOUBLE) + CAST(0.01 AS DOUBLE) * n_regionkey AS lon
  FROM nation)"""

_PAIRS = f"""{_TRIPS},
travelled AS (
  SELECT DISTINCT pickup_station_id AS p, dropoff_station_id AS d FROM trips
  WHERE pickup_station_id <> dropoff_station_id),
new_pairs AS (
  SELECT p AS source_station_id, s1.lat AS source_station_lat, s1.lon AS source_station_lon,
    d AS destination_station_id, s2.lat AS destination_station_lat, s2.lon AS destination_station_lon
  FROM travelled JOIN stations s1 ON s1.station_id = p JOIN stations s2 ON s2.station_id = d
  WHERE (CAST(replace(p, 'motivate_BOS_', '') AS INT) + CAST(replace(d, 'motivate_BOS_', '') AS INT)) % 3 <> 0)"""

_HISTORY = """
history AS (
  SELECT l_orderkey || '-' || l_linenumber AS ride_id,
    CASE WHEN l_returnflag = 'R' THEN 'classic_bike' ELSE 'electric_bike' END AS rideable_type,
    o_orderdate + to_seconds(l_partkey * 37 % 86400) AS started_at,
    o_orderdate + to_seconds(l_partkey * 37 % 86400 + l_suppkey * l_linenumber * 13 % 5000) AS ended_at,
    nc.n_name AS start_station_name,
    CASE WHEN l_linenumber <> 7 THEN ns.n_name END AS end_station_name,
    CASE WHEN o_orderstatus = 'F' THEN 'member' ELSE 'casual' END AS member_casual
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation nc ON c_nationkey = nc.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ns ON s_nationkey = ns.n_nationkey)"""

_NESTED = """
SELECT CAST(floor(epoch(l_shipdate)) AS BIGINT) AS last_updated, 'S' || l_suppkey AS station_id,
  CAST(l_quantity AS BIGINT) AS battery_charge_percentage, l_returnflag AS displayed_number,
  CAST(l_linenumber AS BIGINT) AS docking_capability, l_returnflag = 'R' AS is_lbs_internal_rideable,
  l_linestatus AS make_and_model, 'P' || l_partkey AS rideable_id,
  l_discount AS conservative_range_miles, l_tax AS estimated_range_miles
FROM lineitem
UNION ALL
SELECT CAST(floor(epoch(l_shipdate)) AS BIGINT), 'S' || l_suppkey, CAST(l_linenumber AS BIGINT), l_linestatus,
  CAST(l_linenumber AS BIGINT), l_returnflag = 'R', l_linestatus, 'O' || l_orderkey, NULL, NULL
FROM lineitem"""

_LATEST = """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1"""

_RANGES = """
marked AS (
  SELECT *, CASE WHEN lag(o_orderstatus) OVER w IS NOT DISTINCT FROM o_orderstatus
      AND lag(o_orderkey) OVER w IS NOT NULL THEN 0 ELSE 1 END AS opens
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS run FROM marked),
runs AS (
  SELECT o_custkey, max(o_orderkey) AS o_orderkey, min(o_orderstatus) AS o_orderstatus,
    arg_max(o_totalprice, o_orderkey) AS o_totalprice, min(o_orderkey) AS start_at
  FROM numbered GROUP BY o_custkey, run),
ranges AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, start_at AS "__START_AT",
    lead(start_at) OVER (PARTITION BY o_custkey ORDER BY start_at) AS "__END_AT"
  FROM runs)"""

_NAMED = f"""
WITH {_TRIPS}
SELECT t.*, s1.name AS pickup_station_name, s2.name AS dropoff_station_name
FROM trips t LEFT JOIN stations s1 ON t.pickup_station_id = s1.station_id
LEFT JOIN stations s2 ON t.dropoff_station_id = s2.station_id"""

_FIRST_LETTER = "SELECT conv_id, turn, substr(text, 1, 1) AS letter FROM conversations"

_KM = """2 * 6371.0 * asin(least(1.0, sqrt(
    pow(sin(radians(destination_station_lat - source_station_lat) / 2), 2)
    + cos(radians(source_station_lat)) * cos(radians(destination_station_lat))
      * pow(sin(radians(destination_station_lon - source_station_lon) / 2), 2))))"""

_ROUTED = f"""
        WITH {_PAIRS}, legs AS (
          SELECT *, source_station_lon = destination_station_lon AS blocked,
            abs(destination_station_lat - source_station_lat) * 100000 AS north,
            abs(destination_station_lon - source_station_lon) * 80000 AS east
          FROM new_pairs)
        SELECT source_station_id, destination_station_id,
          CASE WHEN NOT blocked THEN round((north + east) / 1000, 1) END AS distance,
          CASE WHEN NOT blocked THEN round(north / 4 + east / 4, 0) END AS driving_travel_time,
          CASE WHEN blocked THEN 'Error: no road' END AS error
        FROM legs"""


def _index(column: str) -> str:
    return f"""
        SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i FROM history
        WHERE {column} IS NOT NULL GROUP BY {column}"""


SQL: dict[str, str] = {
    "trips": f"WITH {_TRIPS} SELECT * FROM trips",
    "trips_streaming": f"WITH {_TRIPS} SELECT * FROM trips",
    "trips_streaming_late": f"WITH {_TRIPS} SELECT * FROM trips",
    "trips_stream_static_join": f"WITH {_TRIPS} SELECT * FROM trips",
    "next_event": """
        SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events""",
    "trip_end_readings": f"""
        WITH {_SILVER},
        tt AS (SELECT rideable_id, last_updated,
                 lead(last_updated) OVER (PARTITION BY rideable_id ORDER BY last_updated) AS next_updated FROM readings)
        SELECT tt.*, r.station_id AS next_station_id
        FROM tt JOIN readings r ON tt.rideable_id = r.rideable_id AND tt.next_updated = r.last_updated""",
    "trips_with_station_names": _NAMED,
    "trips_with_names_from_history": _NAMED,
    "medallion_run": _NAMED,
    "trips_with_coordinates": f"""
        WITH {_TRIPS}
        SELECT trip_id, pickup_station_id, dropoff_station_id, s1.lat AS pickup_station_lat, s1.lon AS pickup_station_lon,
          s2.lat AS dropoff_station_lat, s2.lon AS dropoff_station_lon
        FROM trips JOIN stations s1 ON pickup_station_id = s1.station_id JOIN stations s2 ON dropoff_station_id = s2.station_id""",
    "top_routes_trips": f"""
        WITH {_TRIPS}
        SELECT s1.name AS pickup_station_name, s2.name AS dropoff_station_name, count(trip_id) AS trip_count
        FROM trips LEFT JOIN stations s1 ON pickup_station_id = s1.station_id
        LEFT JOIN stations s2 ON dropoff_station_id = s2.station_id
        WHERE NOT "Rebalancing_trip" AND NOT maintenance_trip
        GROUP BY 1, 2 ORDER BY trip_count DESC, 1 NULLS LAST, 2 NULLS LAST LIMIT 5""",
    "distinct_pairs": f"WITH {_PAIRS} SELECT p AS pickup_station_id, d AS dropoff_station_id FROM travelled",
    "new_station_pairs": f"""
        WITH {_PAIRS} SELECT * FROM new_pairs""",
    "distance_matrix": f"""
        WITH {_PAIRS}, measured AS (
          SELECT source_station_id, destination_station_id, {_KM} AS km FROM new_pairs)
        SELECT source_station_id, destination_station_id, round(km, 1) AS distance, round(km * 240, 0) AS driving_travel_time
        FROM measured""",
    "route_enrichment_udf": _ROUTED,
    "route_enrichment_sql": _ROUTED,
    "medallion_distance_matrix": f"""
        WITH {_PAIRS}, measured AS (
          SELECT p AS source_station_id, d AS destination_station_id, {_KM} AS km FROM (
            SELECT p, d, s1.lat AS source_station_lat, s1.lon AS source_station_lon, s2.lat AS destination_station_lat,
              s2.lon AS destination_station_lon
            FROM travelled JOIN stations s1 ON s1.station_id = p JOIN stations s2 ON s2.station_id = d))
        SELECT source_station_id, destination_station_id, round(km, 1) AS distance, round(km * 240, 0) AS driving_travel_time
        FROM measured""",
    "trip_duration_buckets": f"""
        WITH {_HISTORY}, timed AS (
          SELECT *, CAST(epoch(ended_at) - epoch(started_at) AS BIGINT) AS trip_duration_seconds FROM history
          WHERE CAST(started_at AS DATE) BETWEEN DATE '1995-02-01' AND DATE '2001-07-31')
        SELECT *, CASE WHEN trip_duration_seconds >= 3600 THEN '60+ minutes'
          WHEN trip_duration_seconds >= 1800 THEN '30-60 minutes' WHEN trip_duration_seconds >= 600 THEN '10-30 minutes'
          ELSE '0-10 minutes' END AS trip_duration_bucket FROM timed""",
    "route_counts": f"""
        WITH {_HISTORY} SELECT start_station_name, end_station_name, count(*) AS trip_count FROM history GROUP BY 1, 2""",
    "top_routes_history": f"""
        WITH {_HISTORY} SELECT start_station_name, end_station_name, count(*) AS trip_count FROM history GROUP BY 1, 2
        ORDER BY trip_count DESC, 1 NULLS LAST, 2 NULLS LAST LIMIT 5""",
    "row_count": f"WITH {_HISTORY} SELECT count(*) AS row_count FROM history",
    "history_filter_load": f"WITH {_HISTORY} SELECT * FROM history WHERE rideable_type = 'electric_bike'",
    "json_flatten_native": _NESTED,
    "json_flatten_text": _NESTED,
    "json_flatten_sql": _NESTED,
    "json_inferred_once": """
        SELECT CAST(CAST(floor(epoch(l_shipdate)) AS BIGINT) AS VARCHAR) AS last_updated, 'S' || l_suppkey AS station_id,
          CAST(2 AS INT) AS n_ebikes FROM lineitem
        UNION ALL
        SELECT CAST(CAST(floor(epoch(l_shipdate)) AS BIGINT) AS VARCHAR), 'empty', CAST(0 AS INT) FROM lineitem""",
    "json_schema_infer": """
        SELECT 'OBJECT<' || string_agg(k || ': BIGINT', ', ' ORDER BY k) || '>' AS json_schema
        FROM (SELECT DISTINCT unnest(json_keys(props)) AS k FROM events)""",
    "json_props_parse": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "station_info_flatten": """
        SELECT CAST(1704067200 + c_custkey AS VARCHAR) AS last_updated, c_custkey || suffix AS station_id, c_name AS name,
          CAST(42.3 AS DOUBLE) + CAST(0.004 AS DOUBLE) * c_nationkey AS lat, c_acctbal AS lon,
          CAST(CASE WHEN suffix = 'a' THEN c_nationkey ELSE 15 END AS BIGINT) AS capacity
        FROM customer, (VALUES ('a'), ('b')) AS two(suffix)""",
    "station_status_flatten": """
        SELECT CAST(CAST(floor(epoch(o_orderdate)) AS BIGINT) + o_orderkey % 60 AS VARCHAR) AS last_updated,
          CAST(o_custkey AS VARCHAR) AS station_id, o_orderkey % 20 AS num_bikes_available,
          o_orderkey % 7 AS num_docks_available, o_orderkey % 5 AS num_ebikes_available,
          CAST(o_orderstatus = 'O' AS BIGINT) AS is_renting, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS last_reported
        FROM orders""",
    "route_steps_sum": """
        SELECT o_orderkey, round((o_totalprice + o_totalprice / 2 + o_totalprice / 4) / 1000, 1) AS distance_km,
          round(CAST(o_custkey AS DOUBLE) + o_custkey / 2 + o_custkey / 4, 0) AS duration_s
        FROM orders""",
    "route_text_split": """
        WITH routes AS (
          SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'Error: no road'
            ELSE round(l_extendedprice / 1000, 1) || ';' || l_quantity END AS route FROM lineitem)
        SELECT l_orderkey, l_linenumber,
          CASE WHEN strpos(route, ';') > 0 THEN substr(route, 1, strpos(route, ';') - 1) ELSE '' END AS distance,
          substr(route, strpos(route, ';') + 1) AS driving_travel_time FROM routes""",
    "snapshot_enrich": f"WITH {_SILVER} SELECT * FROM silver",
    "scalar_functions": """
        WITH base AS (
          SELECT o_orderkey, o_orderpriority, CAST(floor(epoch(o_orderdate)) AS BIGINT) + o_custkey AS s, o_custkey FROM orders),
        timed AS (SELECT *, to_timestamp(s) AT TIME ZONE 'UTC' AS t FROM base)
        SELECT o_orderkey, md5(o_orderkey || o_orderpriority) AS key_md5, s AS text_to_long, t AS long_to_timestamp,
          t AS epoch_to_timestamp, strftime(t, '%Y-%m-%d %H:%M:%S') AS epoch_text, t - INTERVAL 4 HOUR AS local_from_text,
          t - INTERVAL 4 HOUR AS local_by_offset,
          (t AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local_by_zone,
          CAST(90 AS BIGINT) AS seconds, CAST(t AS DATE) AS day, strftime(t, '%Y%m%d%H%M%S') AS stamp,
          CAST(strpos(o_orderpriority, '-') AS INT) AS dash_at, substr(o_orderpriority, 3, 4) AS part,
          'clerk_' || o_custkey || '_bike_example' AS schema_name, substr(o_orderpriority, 1, 1) AS letter,
          'motivate_BOS_' || o_orderkey AS prefixed
        FROM timed""",
    "predicates": """
        WITH base AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS done FROM orders)
        SELECT o_orderkey, CASE WHEN o_custkey < 600 THEN '0-10 minutes' WHEN o_custkey < 1800 THEN '10-30 minutes'
            WHEN o_custkey < 3600 THEN '30-60 minutes' ELSE '60+ minutes' END AS bucket,
          coalesce(done, false) AS done_flag, CAST(o_orderstatus = 'F' AS INT) AS label
        FROM base WHERE (o_orderpriority = '1-URGENT' OR done IS NULL OR done IS FALSE) AND o_orderkey <> o_custkey
          AND (o_totalprice > 1000 OR o_totalprice BETWEEN o_custkey AND o_custkey + 9.9)""",
    "star_projection": "SELECT * EXCLUDE (o_orderpriority), o_custkey AS custkey_again FROM orders",
    "scd1_latest": _LATEST,
    "scd1_streaming": _LATEST,
    "scd1_repeated_snapshot": f"WITH {_SILVER} SELECT * FROM readings",
    "scd2_history": f"WITH {_RANGES} SELECT * FROM ranges",
    "scd2_streaming": f"WITH {_RANGES} SELECT * FROM ranges",
    "scd2_current": f"""
        WITH {_RANGES} SELECT 'motivate_BOS_' || o_custkey AS station_id, o_orderkey, o_orderstatus, o_totalprice
        FROM ranges WHERE "__END_AT" IS NULL""",
    "file_stream_ingest": f"""
        WITH {_TELEMETRY} SELECT * EXCLUDE (ts) REPLACE (CAST(last_updated AS VARCHAR) AS last_updated) FROM telemetry""",
    "table_stream_append": "SELECT event_id, user_id, event_type, value FROM events",
    "udf_first_letter_scalar": _FIRST_LETTER,
    "udf_first_letter_decorated": _FIRST_LETTER,
    "udf_first_letter_pandas": _FIRST_LETTER,
    "udf_first_letter_pandas_call": _FIRST_LETTER,
    "udf_first_letter_iterator": _FIRST_LETTER,
    "udf_first_letter_sql": _FIRST_LETTER,
    "first_letter_native": _FIRST_LETTER,
    "csv_header_scan": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
          CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
    "csv_infer_scan": "SELECT * FROM orders",
    "preview_rows": f"""
        WITH {_TELEMETRY} SELECT * EXCLUDE (ts) REPLACE (CAST(last_updated AS VARCHAR) AS last_updated) FROM telemetry
        ORDER BY CAST(displayed_number AS BIGINT) LIMIT 100""",
    "text_dir_scan": "SELECT props AS value FROM events",
    "filename_metadata": """
        SELECT event_id, user_id, date_trunc('day', ts) AS capture_time, CAST(dayofyear(ts) AS VARCHAR) AS run_id FROM events""",
    "zip_csv_scan": "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
    "ctas_roundtrip": "SELECT * FROM part",
    "medallion_rejects": """
        SELECT count(*) FILTER (event_id % 5 = 0) AS broken, count(*) FILTER (event_id % 7 = 0) AS keyless, count(*) AS kept
        FROM events""",
    "cluster_write": "SELECT * FROM lineitem",
    "cluster_layout": "SELECT CAST(0 AS BIGINT) AS files_within_others FROM (SELECT count(*) FROM lineitem)",
    "file_listing": "SELECT DISTINCT event_type, true AS filled FROM events",
    "rider_features": f"""
        WITH {_HISTORY}, k AS ({_index("rideable_type")}), s AS ({_index("start_station_name")}), e AS ({_index("end_station_name")})
        SELECT ride_id, CASE WHEN member_casual = 'member' THEN 1 ELSE 0 END AS label, k.i AS rideable_type_index,
          s.i AS start_station_index, coalesce(e.i, (SELECT count(*) FROM e)) AS end_station_index
        FROM history h JOIN k USING (rideable_type) JOIN s USING (start_station_name)
        LEFT JOIN e ON e.end_station_name = h.end_station_name""",
    "rider_classifier": f"WITH {_HISTORY} SELECT ride_id, member_casual, right(md5(ride_id), 1) IN ('0', '1', '2') AS held_out, true AS decoded FROM history",
    "materialized_view_refresh": f"""
        WITH {_TRIPS} SELECT pickup_station_id, count(*) AS trips FROM trips GROUP BY 1""",
    "previous_and_next_order": """
        SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER w AS prev_key, lead(o_orderkey) OVER w AS next_key
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""",
}
