"""The same results in SQL, over the same tables."""

from __future__ import annotations

from checks.fixtures import DIM_ZONE_SQL, FULL_RAW_SQL, LINEITEM_TRIPS_SQL, MOVED_SQL, RAW_TRIPS_SQL, TRIPS_SQL


def _round(x: str, digits: int) -> str:
    """Half up on the shortest decimal text of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def _exact(x: str) -> str:
    """The sum of doubles as decimals of ten digits."""
    return f"sum(CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,10)))"


def _total(x: str, digits: int = 2) -> str:
    return f"CAST(round({_exact(x)}, {digits}) AS DOUBLE)"


def _mean(x: str) -> str:
    """The exact sum over the count, half up at six digits, by whole numbers."""
    whole = f"CAST({_exact(x)} * 10000000000 AS HUGEINT)"
    return f"CASE WHEN count({x}) > 0 THEN sign({whole}) * CAST((2 * abs({whole}) + 10000 * count({x})) // (20000 * count({x})) AS DOUBLE) / 1000000 END"


_FIELDS = "ride_id, event_time, ingest_time, dropoff_time, pickup_zone, dropoff_zone, distance_km, fare_usd, payment_type"
_CLEAN_COLUMNS = f"""
    {_round('distance_km', 2)} AS distance_km,
    abs(fare_usd) AS fare_usd,
    CASE WHEN lower(payment_type) = 'unknown' THEN NULL ELSE payment_type END AS payment_type"""
_CLEANED = f"""{TRIPS_SQL},
cleaned AS (
  SELECT ride_id, event_time, ingest_time, dropoff_time, pickup_zone, dropoff_zone, {_CLEAN_COLUMNS}, treated
  FROM trips
)"""
_METRIC_COLUMNS = f"""
    CASE WHEN distance_km > 0 THEN {_round('fare_usd / distance_km', 3)} END AS fare_per_km,
    CASE WHEN duration > 0 THEN {_round('fare_usd / duration', 3)} END AS fare_per_min,
    CASE WHEN duration > 0 THEN {_round('distance_km / duration * 60', 2)} END AS avg_speed_kmh"""
_DURATION = "(epoch_us(dropoff_time) // 1000000 - epoch_us(event_time) // 1000000) / 60 AS duration"
_ENRICHED = f"""{_CLEANED},
timed AS (SELECT *, {_DURATION} FROM cleaned),
enriched AS (SELECT *, {_METRIC_COLUMNS} FROM timed)"""
_LINEITEM_CLEANED = f"""{LINEITEM_TRIPS_SQL},
cleaned AS (SELECT ride_id, event_time, dropoff_time, {_CLEAN_COLUMNS} FROM trips),
timed AS (SELECT *, {_DURATION} FROM cleaned)"""
_BOUNDS = """
bounds AS (
  SELECT min(event_time) AS t0, min(event_time) + INTERVAL 1 DAY AS t1 FROM trips WHERE treated = 'No'
)"""
_WINDOW_COLUMNS = f"""
    count(*) AS trips, {_total('fare_usd')} AS revenue_usd, {_total('distance_km')} AS distance_km,
    {_mean('fare_usd')} AS avg_fare_usd"""
_DAYS = f"""SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', event_time) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, {_WINDOW_COLUMNS}
FROM cleaned GROUP BY 1, 2"""
_DAILY = f"WITH {_CLEANED} {_DAYS}"

# Delays in whole microseconds of event time: the least delay is 0.05 s * 1440.
_SCHEDULE = """
gaps AS (
  SELECT *, row_number() OVER o AS seq,
         coalesce(epoch_us(event_time) - lag(epoch_us(event_time)) OVER o, 0) AS gap_us
  FROM trips WINDOW o AS (ORDER BY event_time, ride_id)
),
schedule AS (
  SELECT ride_id, event_time, seq, gap_us / 1000000 AS gap_s,
         greatest(gap_us / 1000000 / 1440.0::DOUBLE, 0.05::DOUBLE) AS delay_s,
         CAST(sum(greatest(gap_us, 72000000)) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) AS DOUBLE) / 1440000000.0::DOUBLE AS emit_offset_s
  FROM gaps
)"""


def _iso(ts: str) -> str:
    return f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END"


_MESSAGES = f"""WITH {TRIPS_SQL}
SELECT ride_id AS key,
       '{{"ride_id":"' || ride_id || '","event_time":"' || {_iso('event_time')} || '","ingest_time":"' || {_iso('ingest_time')}
       || '","dropoff_time":"' || {_iso('dropoff_time')} || '","pickup_zone":"' || pickup_zone || '","dropoff_zone":"' || dropoff_zone
       || '","distance_km":' || CAST(distance_km AS VARCHAR) || ',"fare_usd":' || CAST(fare_usd AS VARCHAR)
       || ',"payment_type":"' || payment_type || '"}}' AS value
FROM trips"""
_ALL_TRIPS = f"WITH {TRIPS_SQL} SELECT * FROM trips"
_ALL_CLEANED = f"WITH {_CLEANED} SELECT * EXCLUDE (treated) FROM cleaned"
_RAW_KEPT = f"WITH {RAW_TRIPS_SQL} SELECT * FROM raw_trips WHERE tpep_pickup_datetime IS NOT NULL"
_WITH_UPDATED = f"""WITH {TRIPS_SQL},
both_versions AS (
  SELECT *, 0 AS src FROM trips
  UNION ALL
  SELECT * REPLACE (ingest_time + to_minutes(CAST(dropoff_zone AS BIGINT) - 50) AS ingest_time, fare_usd + 1 AS fare_usd), 1 AS src FROM trips
),
updated AS (
  SELECT * EXCLUDE (src) FROM both_versions
  QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY ingest_time DESC, src DESC) = 1
)"""
_UPDATED = f"{_WITH_UPDATED} SELECT * FROM updated"
_FACTS = f"""{_ENRICHED}, {DIM_ZONE_SQL},
facts AS (
  SELECT e.* EXCLUDE (treated), strftime(event_time, '%Y-%m-%d') AS event_date,
         coalesce(p.zone_name, 'Unknown') AS pickup_zone_name, coalesce(p.borough, 'Unknown') AS pickup_borough,
         coalesce(d.zone_name, 'Unknown') AS dropoff_zone_name, coalesce(d.borough, 'Unknown') AS dropoff_borough
  FROM enriched e
  LEFT JOIN dim_zone p ON e.pickup_zone = p.zone_id
  LEFT JOIN dim_zone d ON e.dropoff_zone = d.zone_id
)"""
# What a spoilt message turns into, by the last digit of its key.
_OUTCOME = """
spoilt AS (
  SELECT *, CASE CAST(ride_id AS BIGINT) % 10
    WHEN 0 THEN 'malformed' WHEN 1 THEN 'malformed' WHEN 4 THEN 'malformed'
    WHEN 2 THEN 'missing: ride_id,event_time,ingest_time,dropoff_time'
    WHEN 3 THEN 'empty' WHEN 5 THEN 'missing: ingest_time' ELSE 'accepted' END AS outcome
  FROM trips
)"""


def _failures(table: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {bad}) AS failures FROM {table}" for c, bad in checks.items())


ORACLES: dict[str, str] = {
    "scan_trips_glob": f"WITH {RAW_TRIPS_SQL} SELECT * FROM raw_trips",
    "scan_trips_schema": f"WITH {FULL_RAW_SQL} SELECT * FROM full_raw",
    "parquet_overwrite_roundtrip": _ALL_TRIPS,
    "csv_source_roundtrip": _ALL_TRIPS,
    "jdbc_read_ranges": f"""WITH {TRIPS_SQL}, {_BOUNDS}
        SELECT CAST(least((epoch_us(event_time) - epoch_us(t0)) // 3600000000, 23) AS INTEGER) AS range_no, count(*) AS trips
        FROM trips, bounds WHERE event_time BETWEEN t0 AND t1 GROUP BY 1""",
    "payload_map": f"""WITH {RAW_TRIPS_SQL}
        SELECT CAST(event_id AS VARCHAR) AS ride_id, tpep_pickup_datetime AS event_time, TIMESTAMP '2024-02-01' AS ingest_time,
               tpep_dropoff_datetime AS dropoff_time, CAST(PULocationID AS VARCHAR) AS pickup_zone,
               CAST(DOLocationID AS VARCHAR) AS dropoff_zone, trip_distance * 1.60934::DOUBLE AS distance_km,
               fare_amount AS fare_usd, payment_type
        FROM raw_trips WHERE tpep_pickup_datetime IS NOT NULL""",
    "replay_resumed": f"""WITH {RAW_TRIPS_SQL}
        SELECT CAST(event_id AS VARCHAR) AS ride_id, tpep_pickup_datetime AS event_time, tpep_dropoff_datetime AS dropoff_time,
               CAST(PULocationID AS VARCHAR) AS pickup_zone, CAST(DOLocationID AS VARCHAR) AS dropoff_zone,
               trip_distance * 1.60934::DOUBLE AS distance_km, fare_amount AS fare_usd, payment_type
        FROM raw_trips WHERE tpep_pickup_datetime IS NOT NULL""",
    "key_fallback": f"""WITH {RAW_TRIPS_SQL}
        SELECT md5(concat_ws(chr(31), '=' || DOLocationID, '=' || PULocationID, '=' || event_id, '=' || CAST(fare_amount AS VARCHAR),
                   '=' || payment_type, '=' || epoch_us(tpep_dropoff_datetime), '=' || epoch_us(tpep_pickup_datetime),
                   '=' || CAST(trip_distance AS VARCHAR))) AS ride_id,
               tpep_pickup_datetime AS event_time
        FROM raw_trips WHERE tpep_pickup_datetime IS NOT NULL""",
    "drop_null_event_time": _RAW_KEPT,
    "encode_wire": _MESSAGES,
    "stream_source": _MESSAGES,
    "decode_wire": f"WITH {TRIPS_SQL} SELECT {_FIELDS} FROM trips",
    "parse_quarantine": f"WITH {TRIPS_SQL}, {_OUTCOME} SELECT outcome, count(*) AS messages FROM spoilt GROUP BY outcome",
    "stream_quarantine": f"WITH {TRIPS_SQL}, {_OUTCOME} SELECT outcome, count(*) AS messages FROM spoilt GROUP BY outcome",
    "accepted_messages": f"WITH {TRIPS_SQL}, {_OUTCOME} SELECT {_FIELDS} FROM spoilt WHERE outcome = 'accepted'",
    "clean_trips": f"WITH {_CLEANED} SELECT * FROM cleaned",
    "trip_duration": f"WITH {_ENRICHED} SELECT ride_id, duration FROM enriched",
    "fare_metrics": f"WITH {_ENRICHED} SELECT ride_id, duration, fare_per_km, fare_per_min FROM enriched",
    "avg_speed": f"WITH {_ENRICHED} SELECT ride_id, duration, avg_speed_kmh FROM enriched",
    "time_features": f"""WITH {TRIPS_SQL}
        SELECT ride_id, CAST(hour(event_time) AS INTEGER) AS event_hour, CAST(dayofweek(event_time) + 1 AS INTEGER) AS event_weekday,
               dayofweek(event_time) IN (0, 6) AS is_weekend, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS event_day_start
        FROM trips""",
    "enrich_trips": f"WITH {_ENRICHED} SELECT * FROM enriched",
    "enrich_lineitem": f"WITH {_LINEITEM_CLEANED} SELECT *, {_METRIC_COLUMNS} FROM timed",
    "custom_transform": f"WITH {_ENRICHED} SELECT ride_id, fare_per_min, avg_speed_kmh, CAST(floor(fare_usd / 10) AS BIGINT) AS fare_band FROM enriched",
    "untreated_min": f"WITH {TRIPS_SQL} SELECT min(event_time) AS t0 FROM trips WHERE treated = 'No'",
    "untreated_day": f"WITH {TRIPS_SQL}, {_BOUNDS} SELECT trips.* FROM trips, bounds WHERE event_time BETWEEN t0 AND t1",
    "mark_treated": f"""WITH {TRIPS_SQL}, {_BOUNDS}
        SELECT ride_id, event_time, CASE WHEN event_time BETWEEN t0 AND t1 THEN 'Yes' ELSE treated END AS treated FROM trips, bounds""",
    "backfill_range": f"""WITH {TRIPS_SQL} SELECT * FROM trips
        WHERE event_time >= TIMESTAMP '2024-01-05' AND event_time < TIMESTAMP '2024-01-08'""",
    "daily_batch_all": f"WITH {_ENRICHED} SELECT * EXCLUDE (treated), strftime(event_time, '%Y-%m-%d') AS event_date FROM enriched",
    "daily_batch_with_late_batch": f"""WITH {_ENRICHED},
        parts AS (SELECT *, treated = 'No' AND CAST(ride_id AS BIGINT) % 5 = 0 AS late FROM enriched),
        first_run AS (SELECT min(event_time) AS t0, min(event_time) + INTERVAL 1 DAY AS t1 FROM parts WHERE treated = 'No' AND NOT late),
        second_run AS (
          SELECT min(event_time) AS t0, min(event_time) + INTERVAL 1 DAY AS t1 FROM parts, first_run f
          WHERE treated = 'No' AND (late OR NOT event_time BETWEEN f.t0 AND f.t1)
        )
        SELECT p.* EXCLUDE (treated, late), strftime(event_time, '%Y-%m-%d') AS event_date FROM parts p, first_run f, second_run s
        WHERE NOT late AND event_time BETWEEN f.t0 AND f.t1 OR event_time BETWEEN s.t0 AND s.t1""",
    "scan_trips_mixed": f"""WITH {RAW_TRIPS_SQL}
        SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN payment_type END AS payment_type,
                          CASE WHEN event_id % 2 = 1 THEN trip_distance END AS trip_distance) FROM raw_trips""",
    "scan_trips_widened": f"""WITH {RAW_TRIPS_SQL}
        SELECT * REPLACE (CAST(PULocationID AS DOUBLE) AS PULocationID,
                          CASE WHEN event_id % 3 <> 1 THEN DOLocationID END AS DOLocationID,
                          CASE WHEN event_id % 3 = 2 THEN CAST(CAST(floor(trip_distance) AS INTEGER) AS DOUBLE) ELSE trip_distance END AS trip_distance)
        FROM raw_trips""",
    "payload_map_times": f"""WITH {RAW_TRIPS_SQL}
        SELECT CAST(event_id AS VARCHAR) AS ride_id, tpep_pickup_datetime AS event_time, tpep_dropoff_datetime AS dropoff_time
        FROM raw_trips WHERE tpep_pickup_datetime IS NOT NULL""",
    "payload_defaults": f"""WITH {RAW_TRIPS_SQL},
        keyed AS (
          SELECT *, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'k' || event_id END AS key FROM raw_trips
        )
        SELECT CASE WHEN event_id % 4 > 1 THEN key ELSE
                 md5(concat_ws(chr(31), '=' || event_id, coalesce('=' || key, '~'),
                     '=' || epoch_us(tpep_dropoff_datetime), '=' || epoch_us(tpep_pickup_datetime))) END AS ride_id,
               tpep_pickup_datetime AS event_time, TIMESTAMP '2024-02-01' AS ingest_time, tpep_dropoff_datetime AS dropoff_time,
               '' AS pickup_zone, '' AS dropoff_zone, 0.0::DOUBLE AS distance_km, 0.0::DOUBLE AS fare_usd, 'unknown' AS payment_type
        FROM keyed WHERE tpep_pickup_datetime IS NOT NULL""",
    "sort_order": f"WITH {TRIPS_SQL} SELECT count(*) AS rows, 0::BIGINT AS out_of_order FROM trips",
    "sample_to_target": f"""WITH {TRIPS_SQL}
        SELECT count(*) AS table_rows, 0::BIGINT AS outside, 0::BIGINT AS twice, true AS near_target FROM trips""",
    "quarantined_text": f"""{_MESSAGES.replace('SELECT ride_id AS key', 'SELECT ride_id AS key, event_time, ingest_time', 1).replace('WITH ', 'WITH m AS (WITH ', 1)}),
        kinds AS (
          SELECT CAST(key AS BIGINT) % 10 AS kind, value, '"event_time":"' || {_iso('event_time')} || '"' AS event,
                 '"ingest_time":"' || {_iso('ingest_time')} || '"' AS ingest
          FROM m
        )
        SELECT CASE kind WHEN 0 THEN 'no json at all' WHEN 1 THEN substr(value, 1, 40) WHEN 2 THEN '{{}}'
                 WHEN 4 THEN replace(value, event, '"event_time":"NaT"') WHEN 5 THEN replace(value, ingest, '"ingest_time":null') END AS raw,
               CASE kind WHEN 2 THEN 'missing: ride_id,event_time,ingest_time,dropoff_time' WHEN 3 THEN 'empty'
                 WHEN 5 THEN 'missing: ingest_time' ELSE 'malformed' END AS reject_reason
        FROM kinds WHERE kind < 6""",
    "stream_two_topics": f"""WITH {_CLEANED}
        SELECT * EXCLUDE (treated), 'No' AS treated, strftime(event_time, '%Y-%m-%d') AS event_date FROM cleaned""",
    "stream_closed_windows": f"""WITH {_CLEANED},
        days AS ({_DAYS})
        SELECT * FROM days WHERE window_end <= (SELECT max(event_time) - INTERVAL 1 HOUR FROM cleaned)""",
    "stream_late_trips": f"""WITH {_CLEANED},
        days AS ({_DAYS})
        SELECT * FROM days WHERE window_end <= (SELECT max(event_time) - INTERVAL 1 HOUR FROM cleaned)""",
    "stream_clean_interval": _ALL_CLEANED,
    "daily_batch_warehouse": f"""WITH {_ENRICHED}, {_BOUNDS},
        next_bounds AS (
          SELECT min(event_time) AS t0, min(event_time) + INTERVAL 1 DAY AS t1 FROM trips, bounds
          WHERE treated = 'No' AND NOT event_time BETWEEN t0 AND t1
        )
        SELECT e.* EXCLUDE (treated), strftime(event_time, '%Y-%m-%d') AS event_date FROM enriched e, bounds b, next_bounds n
        WHERE event_time BETWEEN b.t0 AND b.t1 OR event_time BETWEEN n.t0 AND n.t1""",
    "daily_batch_staging": f"""WITH {TRIPS_SQL}, {_BOUNDS}
        SELECT ride_id, event_time, CASE WHEN event_time BETWEEN t0 AND t1 THEN 'Yes' ELSE treated END AS treated FROM trips, bounds""",
    "backfill_corrected": f"""WITH {_ENRICHED}
        SELECT * EXCLUDE (treated), strftime(event_time, '%Y-%m-%d') AS event_date FROM enriched
        WHERE CAST(ride_id AS BIGINT) % 2 = 0 OR event_time < TIMESTAMP '2024-01-05 12:00:00' OR event_time >= TIMESTAMP '2024-01-15'""",
    "row_count": f"WITH {TRIPS_SQL} SELECT count(*) AS row_count FROM trips",
    "sort_by_event_time": f"WITH {TRIPS_SQL} SELECT * FROM trips ORDER BY event_time, ride_id",
    "first_n_trips": f"WITH {TRIPS_SQL} SELECT * FROM trips ORDER BY event_time, ride_id LIMIT 1000",
    "first_half_trips": f"""WITH {LINEITEM_TRIPS_SQL}
        SELECT ride_id, event_time, fare_usd FROM trips
        QUALIFY row_number() OVER (ORDER BY event_time, ride_id) <= (SELECT count(*) // 2 FROM trips)""",
    "sample_hash": f"""WITH {TRIPS_SQL} SELECT * FROM trips
        WHERE CAST(CAST('0x' || substr(md5(ride_id), 1, 15) AS BIGINT) AS HUGEINT) * (SELECT count(*) FROM trips)
              < 1000::HUGEINT * 1152921504606846976""",
    "union_trip_parts": _ALL_TRIPS,
    "inter_arrival_gap": f"WITH {TRIPS_SQL}, {_SCHEDULE} SELECT ride_id, event_time, gap_s FROM schedule",
    "replay_delay": f"WITH {TRIPS_SQL}, {_SCHEDULE} SELECT ride_id, event_time, delay_s FROM schedule",
    "replay_schedule": f"WITH {TRIPS_SQL}, {_SCHEDULE} SELECT * FROM schedule",
    "replay_schedule_lineitem": f"WITH {LINEITEM_TRIPS_SQL}, {_SCHEDULE} SELECT * FROM schedule",
    "emit_offsets": f"""WITH {TRIPS_SQL}
        SELECT ride_id, event_time,
               CAST(epoch_us(event_time) - min(epoch_us(event_time)) OVER () AS DOUBLE) / 1440000000.0::DOUBLE AS emit_offset_s
        FROM trips""",
    "stream_clean": _ALL_CLEANED,
    "stream_to_staging": f"WITH {_CLEANED} SELECT * EXCLUDE (treated), 'No' AS treated, strftime(event_time, '%Y-%m-%d') AS event_date FROM cleaned",
    "stream_retry_after_mark": f"""WITH {TRIPS_SQL},
        first_day AS (SELECT min(event_time) AS t0, min(event_time) + INTERVAL 1 DAY AS t1 FROM trips)
        SELECT ride_id, event_time, CASE WHEN event_time BETWEEN t0 AND t1 THEN 'Yes' ELSE 'No' END AS treated FROM trips, first_day""",
    "stream_daily_window": _DAILY,
    "replay_as_stream": _ALL_TRIPS,
    "stream_dedup": _ALL_TRIPS,
    "daily_window": _DAILY,
    "daily_window_odd_values": f"""WITH {TRIPS_SQL},
        cleaned AS (
          SELECT event_time, kind, CASE WHEN kind > 3 THEN fare_usd END AS fare_usd, CASE WHEN kind NOT BETWEEN 3 AND 5 THEN distance_km END AS distance_km
          FROM (SELECT *, CAST(dropoff_zone AS BIGINT) % 10 AS kind FROM trips)
        ),
        odd AS (
          SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS window_start,
                 count(*) FILTER (kind IN (0, 1, 3)) AS odd_fares, count(*) FILTER (kind BETWEEN 3 AND 5) AS odd_distances
          FROM cleaned GROUP BY 1
        )
        SELECT * FROM ({_DAYS}) JOIN odd USING (window_start)""",
    "hourly_zone_kpi": f"""WITH {_CLEANED}
        SELECT CAST(date_trunc('hour', event_time) AS TIMESTAMP) AS event_hour, pickup_zone, {_WINDOW_COLUMNS} FROM cleaned GROUP BY 1, 2""",
    "ingest_lag": f"""WITH {TRIPS_SQL},
        lags AS (SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS window_start,
                        (epoch_us(ingest_time) - epoch_us(event_time)) / 1000000 AS lag_s FROM trips)
        SELECT window_start, count(*) AS trips, min(lag_s) AS min_lag_s, max(lag_s) AS max_lag_s, {_mean('lag_s')} AS avg_lag_s
        FROM lags GROUP BY 1""",
    "ingest_lag_quantiles": f"""WITH {TRIPS_SQL},
        lags AS (SELECT CAST(date_trunc('day', event_time) AS TIMESTAMP) AS window_start, epoch_us(ingest_time) - epoch_us(event_time) AS us FROM trips),
        shifts AS (SELECT window_start, us, abs(us) AS size, greatest(length(bin(abs(us))) - 8, 0) AS spare FROM lags),
        tops AS (
          SELECT window_start, CASE WHEN us < 0 THEN -((size >> spare) << spare) ELSE ((size >> spare) << spare) + (1::BIGINT << spare) - 1 END AS top FROM shifts
        ),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY top) AS rank, count(*) OVER (PARTITION BY window_start) AS n FROM tops
        )
        SELECT window_start, count(*) AS trips, CAST(min(top) FILTER (rank >= ceil(n * 0.5::DOUBLE)) AS DOUBLE) / 1000000 AS lag_p50_s,
               CAST(min(top) FILTER (rank >= ceil(n * 0.9::DOUBLE)) AS DOUBLE) / 1000000 AS lag_p90_s,
               CAST(min(top) FILTER (rank >= ceil(n * 0.999::DOUBLE)) AS DOUBLE) / 1000000 AS lag_p99_9_s
        FROM ranked GROUP BY 1""",
    "freshness": f"""WITH {TRIPS_SQL}
        SELECT max(event_time) AS latest_event,
               (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(event_time))) / 1000000 AS age_s,
               (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(event_time))) / 1000000 <= 172800 AS is_fresh
        FROM trips""",
    "upsert_latest": _UPDATED,
    "upsert_table": _UPDATED,
    "upsert_moved_keys": f"""WITH {TRIPS_SQL}, {MOVED_SQL},
        versions AS (
          SELECT *, 0 AS src FROM trips
          UNION ALL SELECT *, 1 AS src FROM updates WHERE CAST(ride_id AS BIGINT) % 3 = 0
          UNION ALL SELECT *, 2 AS src FROM moved
        )
        SELECT * EXCLUDE (src) FROM versions QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY ingest_time DESC, src DESC) = 1""",
    "upsert_new_column": f"""WITH {TRIPS_SQL},
        both_versions AS (
          SELECT *, NULL::BIGINT AS fare_band, 0 AS src FROM trips
          UNION ALL
          SELECT * REPLACE (ingest_time + to_minutes(CAST(dropoff_zone AS BIGINT) - 50) AS ingest_time, fare_usd + 1 AS fare_usd),
                 CAST(floor((fare_usd + 1) / 10) AS BIGINT) AS fare_band, 1 AS src
          FROM trips WHERE CAST(ride_id AS BIGINT) % 2 = 0
        )
        SELECT * EXCLUDE (src) FROM both_versions
        QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY ingest_time DESC, src DESC) = 1""",
    "stream_upsert": f"{_WITH_UPDATED} SELECT * EXCLUDE (treated) FROM updated",
    "dq_not_null": f"WITH {_CLEANED} " + _failures("cleaned", {c: f"{c} IS NULL" for c in ("ride_id", "event_time", "fare_usd", "payment_type")}),
    "dq_unique": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dq_range": f"WITH {TRIPS_SQL} " + _failures("trips", {"distance_km": "distance_km < 0 OR distance_km > 50", "fare_usd": "fare_usd < 0"}),
    "dq_business_rules": f"""WITH {_ENRICHED}
        SELECT ride_id, event_time, 'dropoff_before_pickup' AS rule FROM enriched WHERE dropoff_time < event_time
        UNION ALL
        SELECT ride_id, event_time, 'over_speed' AS rule FROM enriched WHERE avg_speed_kmh > 130""",
    "dim_zone": f"WITH {DIM_ZONE_SQL} SELECT * FROM dim_zone",
    "fact_trips": f"WITH {_FACTS} SELECT * FROM facts",
    "kpi_daily": f"""WITH {_FACTS}
        SELECT event_date, pickup_borough, count(*) AS trips, count(*) FILTER (WHERE fare_usd IS NULL) AS trips_without_fare,
               {_total('fare_usd')} AS revenue_usd, {_mean('distance_km')} AS avg_distance_km,
               {_mean('fare_per_km')} AS avg_fare_per_km, {_mean('avg_speed_kmh')} AS avg_speed_kmh
        FROM facts GROUP BY 1, 2""",
}
