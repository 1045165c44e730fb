"""Every query of the engine over the test tables, and the same results in plain SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators.days import one_day, two_digit_hour
from curbline.operators.refine import DERIVED_COLUMNS, FLAG_COLUMNS, refine
from curbline.operators.totals import HOUR, ZONE, total_up
from curbline.operators.zones import zone_dimension
from curbline.plans import bronze, gold, replay, reports
from curbline.plans.lake import Lake
from curbline.schema import DROPOFF, PICKUP, conform, struct_of
from curbline.session import apply_settings, fresh_path, keep
from curbline.sources import samples
from curbline.sources.files import file_stream, read_trips, read_zone_lookup, table_stream
from curbline.streaming.tables import checkpoint_of, drain_to_table
from curbline.streaming.windows import (
    close_windows,
    late_rows,
    open_windows,
    trip_windows,
    windowed,
    with_closing,
)

DAY = date(2024, 1, 1)
STAMP = "_gold_updated_at"

# ---------------------------------------------------------------------------
# Inputs
# ---------------------------------------------------------------------------


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.trips(apply_settings(spark), sf_dir)


def _edge_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of three days, some without times."""
    return samples.trips(apply_settings(spark), sf_dir, samples.EDGE_FIELDS)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine(_trips(spark, sf_dir))


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_dimension(samples.zone_lookup(spark, sf_dir))


def _landing(spark: SparkSession, sf_dir: str) -> str:
    landing = fresh_path(spark, "landing")
    replay.write_hour_batches(_trips(spark, sf_dir), DAY, landing)
    return landing


def _bronze_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A new database whose bronze table was streamed from hourly batches."""
    lake = Lake(spark, f"curbline_{uuid.uuid4().hex}", _landing(spark, sf_dir))
    lake.create(fresh_path(spark, "lake"))
    lake.fill_bronze()
    return lake


def _silver_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = _bronze_lake(spark, sf_dir)
    lake.fill_silver()
    return lake


def _comparable(rows: DataFrame) -> DataFrame:
    """Times as epoch seconds, dates and nullable flags as text, load stamps left out."""
    shown = []
    for field in rows.schema:
        column = F.col(field.name)
        if field.name.startswith("_") and field.name != "_batch_hour":
            continue
        if field.dataType.typeName() == "timestamp":
            column = F.unix_seconds(column)
        elif field.dataType.typeName() in ("date", "boolean"):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return rows.select(*shown)


# Raw columns that the trip sample fills.
RAW = [
    "VendorID",
    PICKUP,
    DROPOFF,
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
]
MEASURES = ["trip_duration_mins", "speed_mph", "tip_pct", "fare_per_mile"]
LABELS = ["payment_type_desc", "pickup_hour", "pickup_date", "time_of_day"]
FLAGS = [*FLAG_COLUMNS, "is_anomaly"]

# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------


def trips_day_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = one_day(_edge_trips(spark, sf_dir), PICKUP, DAY)
    return _comparable(day.select(*RAW, F.hour(PICKUP).alias("pickup_hour")))


def events_day_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    events = spark.read.schema(struct_of(samples.EVENT_COLUMNS)).parquet(f"{sf_dir}/events.parquet")
    day = one_day(events, "ts", date(2024, 1, 15))
    return day.select(
        "event_id",
        F.unix_micros("ts").alias("ts_micros"),
        two_digit_hour("ts").alias("hour"),
        "event_type",
        "value",
    )


def replay_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fresh_path(spark, "landing")
    replay.write_hour_batches(_edge_trips(spark, sf_dir), DAY, landing)
    return replay.hour_batch_counts(spark, landing)


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.gate_report(_edge_trips(spark, sf_dir))


def trip_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = ["trip_distance", "fare_amount", "tip_amount"]
    return _comparable(_silver(spark, sf_dir).select(PICKUP, DROPOFF, *inputs, *MEASURES))


def trip_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_silver(spark, sf_dir).select(PICKUP, "payment_type", *LABELS))


def trip_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = ["fare_amount", "tip_amount", "total_amount", "passenger_count"]
    return _comparable(_silver(spark, sf_dir).select(PICKUP, *inputs, *FLAGS))


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_silver(spark, sf_dir).select(*RAW, *DERIVED_COLUMNS, *FLAGS))


def anomaly_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.anomaly_breakdown(total_up(_silver(spark, sf_dir), []))


def time_of_day_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.time_of_day_kpis(total_up(_silver(spark, sf_dir), ["time_of_day"]))


def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "zones")
    samples.zone_lookup(spark, sf_dir).write.option("header", True).csv(path)
    # The lookup was written as a folder, which the reader finds under the file's name.
    return zone_dimension(read_zone_lookup(spark, f"{path}.csv"))


def zone_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = total_up(_silver(spark, sf_dir), [ZONE])
    return gold.zone_kpis(totals, _zones(spark, sf_dir)).drop(STAMP)


def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = total_up(_silver(spark, sf_dir), [ZONE])
    return gold.top_zones(gold.zone_kpis(totals, _zones(spark, sf_dir)))


def hourly_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly_kpis(total_up(_silver(spark, sf_dir), HOUR)).drop(STAMP)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_report(_trips(spark, sf_dir), _silver(spark, sf_dir))


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = gold.trip_totals(_silver(spark, sf_dir))
    return reports.run_report(
        _trips(spark, sf_dir),
        None,
        gold.zone_kpis(totals, _zones(spark, sf_dir)),
        gold.hourly_kpis(totals),
        totals,
    )


def bronze_stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _bronze_lake(spark, sf_dir)
    return _comparable(spark.table(lake.bronze).select(*RAW, "_batch_hour"))


def bronze_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _bronze_lake(spark, sf_dir)
    return bronze.batch_hour_counts(spark.table(lake.bronze))


def silver_stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _silver_lake(spark, sf_dir)
    return _comparable(spark.table(lake.silver).select(*RAW, *DERIVED_COLUMNS, *FLAGS))


def gold_tables_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _silver_lake(spark, sf_dir)
    lake.fill_gold(_zones(spark, sf_dir))
    stored = [
        spark.table(table).select(
            F.lit(name).alias("table_name"), "total_trips", "total_revenue_usd", "anomaly_count"
        )
        for name, table in (("zones", lake.gold_zones), ("hours", lake.gold_hours))
    ]
    return (
        stored[0]
        .unionByName(stored[1])
        .groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("total_trips").alias("trips"),
            F.round(F.sum("total_revenue_usd"), 2).alias("revenue_usd"),
            F.sum("anomaly_count").alias("anomalies"),
        )
    )


def conform_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    wanted = samples.EVENT_COLUMNS | {"user_id": "double"}
    typed = conform(samples.events(spark, sf_dir), wanted)
    return typed.select(
        "event_id",
        F.unix_micros("ts").alias("ts_micros"),
        F.typeof("ts").alias("ts_type"),
        "user_id",
        F.typeof("user_id").alias("user_id_type"),
        "event_type",
        "value",
        "props",
    )


EVENT_TOTALS = ["events", "total_value"]


def _event_windows(stream: DataFrame) -> DataFrame:
    totals = (F.count(F.lit(1)), F.sum("value"))
    return windowed(stream, "ts", ["event_type"], dict(zip(EVENT_TOTALS, totals, strict=True)))


def stream_hourly_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows from the table that the stream fills, open ones from its state."""
    apply_settings(spark)
    lake = Lake(spark, f"curbline_{uuid.uuid4().hex}", f"{sf_dir}/events.parquet")
    lake.create(fresh_path(spark, "lake"))
    events = file_stream(spark, lake.landing, samples.EVENT_COLUMNS)
    table = f"{lake.database}.event_windows"
    drain_to_table(_event_windows(events), table)
    still_open = open_windows(spark, checkpoint_of(spark, table), ["event_type"], EVENT_TOTALS)
    return (
        spark.table(table)
        .unionByName(still_open)
        .select(
            F.unix_seconds("window_start").alias("window_start"),
            "event_type",
            "events",
            F.round("total_value", 2).alias("total_value"),
        )
    )


def stream_trip_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _silver_lake(spark, sf_dir)
    lake.fill_windows()
    found = lake.windows().drop("is_open")
    return found.withColumn("window_start", F.unix_seconds("window_start"))


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows from the table alone, after a marker has closed them."""
    lake = _silver_lake(spark, sf_dir)
    table, markers = f"{lake.database}.closed_windows", fresh_path(spark, "markers")
    silver = table_stream(spark, lake.silver)
    windows = trip_windows(with_closing(silver, markers))
    last = spark.table(lake.silver).agg(F.max(PICKUP)).first()[0]
    drain_to_table(windows, table)
    close_windows(silver, markers, PICKUP, last + timedelta(days=1))
    drain_to_table(windows, table)
    return spark.table(table).withColumn("window_start", F.unix_seconds("window_start"))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come in six files, in no order and one at a time: those in closed windows, in
    open ones, and too late, are all events."""
    apply_settings(spark)
    landing, arrival = fresh_path(spark, "landing"), [4, 5, 0, 2, 1, 3]
    part = F.least(F.lit(5), F.floor((F.dayofmonth("ts") - 1) / 5))
    events = keep(samples.events(spark, sf_dir).withColumn("part", part), "events")
    for number in arrival:
        own = events.where(F.col("part") == number).drop("part")
        own.coalesce(1).write.mode("append").parquet(landing)
    lake = Lake(spark, f"curbline_{uuid.uuid4().hex}", landing)
    lake.create(fresh_path(spark, "lake"))
    stream = file_stream(spark, landing, samples.EVENT_COLUMNS, maxFilesPerTrigger="1")
    table = f"{lake.database}.event_windows"
    drain_to_table(_event_windows(stream), table)
    checkpoint = checkpoint_of(spark, table)
    still_open = open_windows(spark, checkpoint, ["event_type"], EVENT_TOTALS)
    rows = spark.read.schema(struct_of(samples.EVENT_COLUMNS)).parquet(landing)
    late = late_rows(rows, checkpoint, "ts").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    counted = [spark.table(table), still_open, late]
    every = reduce(DataFrame.unionByName, (c.select("event_type", "events") for c in counted))
    return every.groupBy("event_type").agg(F.sum("events").alias("events"))


def gold_second_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly KPIs after two loads, the second stamped earlier than the first."""
    trips, landing = _edge_trips(spark, sf_dir), fresh_path(spark, "landing")
    lake = Lake(spark, f"curbline_{uuid.uuid4().hex}", landing)
    lake.create(fresh_path(spark, "lake"))
    for days, year in (((0,), 2030), ((-1, 1), 2020)):
        for offset in days:
            replay.write_hour_batches(trips, DAY + timedelta(days=offset), landing)
        lake.fill_bronze()
        stamp = F.lit(date(year, 1, 1)).cast("timestamp")
        rows = refine(table_stream(spark, lake.bronze)).withColumn("_silver_timestamp", stamp)
        drain_to_table(rows, lake.silver)
        lake.fill_gold(_zones(spark, sf_dir))
    return spark.table(lake.gold_hours).drop(STAMP)


def bronze_second_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days that land and drain one after the other, then a drain with nothing new."""
    trips, landing = _edge_trips(spark, sf_dir), fresh_path(spark, "landing")
    lake = Lake(spark, f"curbline_{uuid.uuid4().hex}", landing)
    lake.create(fresh_path(spark, "lake"))
    for day in (DAY, DAY - timedelta(days=1)):
        replay.write_hour_batches(trips, day, landing)
        lake.fill_bronze()
    lake.fill_bronze()
    return _comparable(spark.table(lake.bronze).select(*RAW, "_batch_hour"))


def bronze_refill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct places in files and files of a bronze table that was reset and filled anew,
    and the rows of a sample."""
    lake = _bronze_lake(spark, sf_dir)
    lake.reset()
    lake.fill_bronze()
    table = spark.table(lake.bronze)
    counted = table.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("_source_file", "_kafka_offset_sim").alias("places"),
        F.count_if(F.col("_ingest_timestamp").isNull()).alias("without_time"),
    )
    return counted.withColumn("sample_rows", bronze.sample(table).agg(F.count(F.lit(1))).scalar())


def mixed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written in two layouts that differ in types, in columns and in the times' zone."""
    trips, path = _trips(spark, sf_dir), fresh_path(spark, "months")
    first = F.col("VendorID") == 1
    trips.where(first).write.parquet(f"{path}/month=1")
    other = {"passenger_count": "bigint", PICKUP: "timestamp_ntz", DROPOFF: "timestamp_ntz"}
    older = trips.where(~first).withColumns({c: F.col(c).cast(t) for c, t in other.items()})
    older.drop("airport_fee", "Airport_fee").write.parquet(f"{path}/month=2")
    return _comparable(read_trips(spark, path).select(*RAW))


def entry(spark: SparkSession) -> DataFrame:
    """The hourly KPIs at the smallest scale."""
    return hourly_kpis(spark, "/root/testdata/sf0.001")


def _corpus_modules() -> list:
    """The modules with the corpus queries and the pipeline, or none where they aren't installed."""
    try:
        return [import_module("curbline.llm.queries"), import_module("corpus_pipeline")]
    except ModuleNotFoundError as error:
        if error.name not in ("curbline.llm", "curbline.llm.queries", "corpus_pipeline"):
            raise
        return []


def _corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _corpus_modules() for name, query in module.QUERIES.items()}


def _corpus_sql() -> dict[str, str]:
    return {name: sql for module in _corpus_modules() for name, sql in module.SQL.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        trips_day_window,
        events_day_window,
        replay_hour_counts,
        quality_gate,
        trip_measures,
        trip_labels,
        trip_flags,
        silver_rows,
        anomaly_breakdown,
        time_of_day_kpis,
        zone_dim,
        zone_kpis,
        top_zones,
        hourly_kpis,
        quality_report,
        run_report,
        bronze_stream_rows,
        bronze_hour_counts,
        silver_stream_rows,
        gold_tables_roundtrip,
        conform_events,
        stream_hourly_windows,
        stream_trip_windows,
        stream_closed_windows,
        stream_late_rows,
        gold_second_refresh,
        bronze_second_drain,
        bronze_refill,
        mixed_months,
    ]
    return {query.__name__: query for query in named} | _corpus_queries()


# ---------------------------------------------------------------------------
# The same results in SQL
# ---------------------------------------------------------------------------


def _round(expression: str, digits: int) -> str:
    """Half-up rounding of the decimal text of a double.

    DuckDB rounds the binary value, which takes 16.435 to 16.43; Spark gives 16.44.
    """
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


_FIELDS = ", ".join(f"{expression} AS {name}" for name, expression in samples.TRIP_FIELDS.items())

_TRIPS = f"""
trips AS (SELECT {_FIELDS} FROM lineitem)"""

_EDGE_TRIPS = f"""
trips AS (SELECT {", ".join(f"{e} AS {name}" for name, e in samples.EDGE_FIELDS.items())} FROM lineitem)"""

_SILVER = (
    _TRIPS
    + f""",
gated AS (
  SELECT *, CAST(do_sec - pu_sec AS DOUBLE) AS secs FROM trips
  WHERE do_sec > pu_sec AND do_sec - pu_sec < 86400 AND total_amount < 1000),
measured AS (
  SELECT *,
    {_round("secs / 60", 2)} AS trip_duration_mins,
    CASE WHEN fare_amount > 0 THEN {_round("tip_amount / fare_amount * 100", 1)} ELSE 0.0 END AS tip_pct,
    CASE payment_type WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash' WHEN 3 THEN 'no_charge'
      WHEN 4 THEN 'dispute' ELSE 'unknown' END AS payment_type_desc,
    CAST(extract(hour FROM make_timestamp(pu_sec * 1000000)) AS INTEGER) AS pickup_hour,
    CAST(CAST(make_timestamp(pu_sec * 1000000) AS DATE) AS VARCHAR) AS pickup_date,
    CASE WHEN trip_distance > 0 THEN {_round("fare_amount / trip_distance", 2)} END AS fare_per_mile
  FROM gated),
labelled AS (
  SELECT *,
    CASE WHEN trip_duration_mins > 0 AND trip_distance > 0
      THEN {_round("trip_distance / (trip_duration_mins / 60)", 2)} END AS speed_mph,
    CASE WHEN pickup_hour < 6 THEN 'night' WHEN pickup_hour < 12 THEN 'morning'
      WHEN pickup_hour < 17 THEN 'afternoon' WHEN pickup_hour < 21 THEN 'evening'
      ELSE 'night' END AS time_of_day
  FROM measured),
flagged AS (
  SELECT *,
    fare_amount = 0 AND trip_distance > 0 AS anomaly_zero_fare,
    speed_mph > 120 AS anomaly_speed,
    trip_duration_mins > 300 AS anomaly_long_trip,
    fare_amount < 0 OR tip_amount < 0 OR total_amount < 0 AS anomaly_negative_amount,
    passenger_count IS NULL OR passenger_count = 0 AS anomaly_no_passengers
  FROM labelled),
silver AS (
  SELECT *,
    anomaly_zero_fare OR anomaly_speed OR anomaly_long_trip OR anomaly_negative_amount
      OR anomaly_no_passengers AS is_anomaly
  FROM flagged)"""
)

_SHARED_KPIS = f"""
    count(*) AS total_trips,
    {_round("sum(CASE WHEN is_anomaly = FALSE THEN total_amount ELSE 0.0 END)", 2)} AS total_revenue_usd,
    {_round("avg(fare_amount)", 2)} AS avg_fare_usd,
    {_round("avg(trip_distance)", 2)} AS avg_distance_miles,
    {_round("avg(trip_duration_mins)", 1)} AS avg_duration_mins,
    {_round("avg(tip_pct)", 1)} AS avg_tip_pct,
    {_round("avg(speed_mph)", 1)} AS avg_speed_mph,
    CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_count"""

_ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone_name,
    r_name AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

_ZONE_KPIS = (
    _SILVER
    + ","
    + _ZONES
    + f""",
per_zone AS (
  SELECT PULocationID AS location_id, {_SHARED_KPIS},
    {_round("count(*) FILTER (WHERE payment_type_desc = 'credit_card') * CAST(100 AS DOUBLE) / count(*)", 1)}
      AS credit_card_pct
  FROM silver WHERE PULocationID IS NOT NULL GROUP BY PULocationID),
zone_kpis AS (
  SELECT per_zone.*, borough, zone_name, service_zone,
    CAST(rank() OVER (ORDER BY total_revenue_usd DESC) AS INTEGER) AS revenue_rank_overall
  FROM per_zone LEFT JOIN zones USING (location_id))"""
)

_CARD_CASH = """
    CAST(sum(CASE WHEN payment_type_desc = 'credit_card' THEN 1 ELSE 0 END) AS BIGINT)
      AS credit_card_trips,
    CAST(sum(CASE WHEN payment_type_desc = 'cash' THEN 1 ELSE 0 END) AS BIGINT) AS cash_trips"""

_HOURLY_KPIS = f"""
per_hour AS (
  SELECT pickup_hour, time_of_day, {_SHARED_KPIS}, {_CARD_CASH}
  FROM silver WHERE pickup_hour IS NOT NULL GROUP BY pickup_hour, time_of_day),
hourly_kpis AS (
  SELECT *, CAST(rank() OVER (ORDER BY total_revenue_usd DESC) AS INTEGER) AS revenue_rank,
    rank() OVER (ORDER BY total_revenue_usd DESC) <= 3 AS peak_hour
  FROM per_hour)"""

_RAW = """VendorID, pu_sec AS tpep_pickup_datetime, do_sec AS tpep_dropoff_datetime, passenger_count,
  trip_distance, PULocationID, payment_type, fare_amount, tip_amount, total_amount"""

_BATCH_HOUR = "CAST(extract(hour FROM make_timestamp(pu_sec * 1000000)) AS INTEGER)"

_FLAG_TEXT = ", ".join(f"CAST({flag} AS VARCHAR) AS {flag}" for flag in FLAGS)

_SILVER_ROWS = f"""WITH {_SILVER}
SELECT {_RAW}, {", ".join(DERIVED_COLUMNS)}, {_FLAG_TEXT} FROM silver"""


_TRIP_WINDOWS = f"""WITH {_SILVER},
hours AS (
  SELECT pu_sec - pu_sec % 3600 AS window_start, {_SHARED_KPIS}, {_CARD_CASH}
  FROM silver GROUP BY 1)
SELECT * FROM hours"""


def oracle_sql() -> dict[str, str]:
    return {
        "trips_day_window": f"""WITH {_EDGE_TRIPS}
SELECT {_RAW}, {_BATCH_HOUR} AS pickup_hour FROM trips
WHERE make_timestamp(pu_sec * 1000000) >= TIMESTAMP '2024-01-01 00:00:00'
  AND make_timestamp(pu_sec * 1000000) < TIMESTAMP '2024-01-02 00:00:00'""",
        "events_day_window": """
SELECT event_id, epoch_us(ts) AS ts_micros, strftime(ts, '%H') AS hour, event_type, value
FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'""",
        "replay_hour_counts": f"""WITH {_EDGE_TRIPS},
per_hour AS (
  SELECT {_BATCH_HOUR} AS hour, count(*) AS found FROM trips
  WHERE make_timestamp(pu_sec * 1000000) >= TIMESTAMP '2024-01-01 00:00:00'
    AND make_timestamp(pu_sec * 1000000) < TIMESTAMP '2024-01-02 00:00:00'
  GROUP BY 1),
hours AS (SELECT CAST(range AS INTEGER) AS hour FROM range(24))
SELECT hour, CAST(coalesce(sum(found), 0) AS BIGINT) AS trips
FROM hours LEFT JOIN per_hour USING (hour) GROUP BY ROLLUP (hour)""",
        "quality_gate": f"""WITH {_EDGE_TRIPS},
checked AS (
  SELECT pu_sec IS NOT NULL AS a, do_sec IS NOT NULL AS b,
    coalesce(do_sec > pu_sec, FALSE) AS c, coalesce(do_sec - pu_sec < 86400, FALSE) AS d,
    coalesce(total_amount < 1000, FALSE) AS e
  FROM trips)
SELECT count(*) AS rows_in,
  count(*) FILTER (WHERE a AND b AND c AND d AND e) AS rows_kept,
  count(*) FILTER (WHERE NOT (a AND b AND c AND d AND e)) AS rows_dropped,
  count(*) FILTER (WHERE NOT a) AS fails_pickup_known,
  count(*) FILTER (WHERE NOT b) AS fails_dropoff_known,
  count(*) FILTER (WHERE NOT c) AS fails_ends_after_start,
  count(*) FILTER (WHERE NOT d) AS fails_within_a_day,
  count(*) FILTER (WHERE NOT e) AS fails_total_in_range
FROM checked""",
        "trip_measures": f"""WITH {_SILVER}
SELECT pu_sec AS tpep_pickup_datetime, do_sec AS tpep_dropoff_datetime, trip_distance,
  fare_amount, tip_amount, trip_duration_mins, speed_mph, tip_pct, fare_per_mile FROM silver""",
        "trip_labels": f"""WITH {_SILVER}
SELECT pu_sec AS tpep_pickup_datetime, payment_type, payment_type_desc, pickup_hour, pickup_date,
  time_of_day FROM silver""",
        "trip_flags": f"""WITH {_SILVER}
SELECT pu_sec AS tpep_pickup_datetime, fare_amount, tip_amount, total_amount, passenger_count,
  {_FLAG_TEXT} FROM silver""",
        "silver_rows": _SILVER_ROWS,
        "anomaly_breakdown": f"""WITH {_SILVER}
SELECT CAST(sum(CAST(anomaly_zero_fare AS INTEGER)) AS BIGINT) AS zero_fare,
  CAST(sum(CAST(anomaly_speed AS INTEGER)) AS BIGINT) AS impossible_speed,
  CAST(sum(CAST(anomaly_long_trip AS INTEGER)) AS BIGINT) AS long_trip_5h,
  CAST(sum(CAST(anomaly_negative_amount AS INTEGER)) AS BIGINT) AS negative_amount,
  CAST(sum(CAST(anomaly_no_passengers AS INTEGER)) AS BIGINT) AS no_passengers,
  CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS total_anomalies
FROM silver""",
        "time_of_day_kpis": f"""WITH {_SILVER}
SELECT time_of_day, count(*) AS trip_count, {_round("avg(fare_amount)", 2)} AS avg_fare,
  {_round("avg(tip_pct)", 1)} AS avg_tip_pct
FROM silver GROUP BY time_of_day""",
        "zone_dim": f"WITH {_ZONES} SELECT * FROM zones",
        "zone_kpis": f"WITH {_ZONE_KPIS} SELECT * FROM zone_kpis",
        "top_zones": f"""WITH {_ZONE_KPIS}
SELECT revenue_rank_overall, zone_name, borough, total_trips, total_revenue_usd, avg_fare_usd,
  avg_tip_pct
FROM zone_kpis ORDER BY revenue_rank_overall, location_id LIMIT 15""",
        "hourly_kpis": f"WITH {_SILVER}, {_HOURLY_KPIS} SELECT * FROM hourly_kpis",
        "quality_report": f"""WITH {_SILVER}, {_TALLIES}
SELECT bronze_rows, silver_rows, bronze_rows - silver_rows AS dropped_rows, anomalies,
  {_round("anomalies * CAST(100 AS DOUBLE) / nullif(silver_rows, 0)", 1)} AS anomaly_rate_pct
FROM tallies""",
        "run_report": f"""WITH {_ZONE_KPIS}, {_HOURLY_KPIS}, {_TALLIES},
peak AS (SELECT * FROM hourly_kpis ORDER BY revenue_rank, pickup_hour LIMIT 1),
top AS (SELECT * FROM zone_kpis ORDER BY revenue_rank_overall, location_id LIMIT 1)
SELECT bronze_rows, silver_rows, bronze_rows - silver_rows AS dropped_rows, anomalies,
  {_round("anomalies * CAST(100 AS DOUBLE) / nullif(silver_rows, 0)", 1)} AS anomaly_rate_pct,
  (SELECT count(*) FROM zone_kpis) AS zone_rows,
  (SELECT count(*) FROM hourly_kpis) AS hourly_rows,
  (SELECT {_round("sum(total_revenue_usd)", 2)} FROM zone_kpis) AS total_revenue_usd,
  (SELECT pickup_hour FROM peak) AS peak_hour,
  (SELECT total_revenue_usd FROM peak) AS peak_hour_revenue_usd,
  (SELECT location_id FROM top) AS top_location_id,
  (SELECT zone_name FROM top) AS top_zone_name,
  (SELECT borough FROM top) AS top_borough
FROM tallies""",
        "bronze_stream_rows": f"""WITH {_TRIPS}
SELECT {_RAW}, {_BATCH_HOUR} AS _batch_hour FROM trips""",
        "bronze_hour_counts": f"""WITH {_TRIPS}
SELECT {_BATCH_HOUR} AS _batch_hour, count(*) AS count FROM trips GROUP BY 1""",
        "silver_stream_rows": _SILVER_ROWS,
        "gold_tables_roundtrip": f"""WITH {_ZONE_KPIS}, {_HOURLY_KPIS},
stored AS (
  SELECT 'zones' AS table_name, total_trips, total_revenue_usd, anomaly_count FROM zone_kpis
  UNION ALL
  SELECT 'hours', total_trips, total_revenue_usd, anomaly_count FROM hourly_kpis)
SELECT table_name, count(*) AS row_count, CAST(sum(total_trips) AS BIGINT) AS trips,
  {_round("sum(total_revenue_usd)", 2)} AS revenue_usd,
  CAST(sum(anomaly_count) AS BIGINT) AS anomalies
FROM stored GROUP BY table_name""",
        "conform_events": """
SELECT event_id, epoch_us(ts) AS ts_micros, 'timestamp' AS ts_type,
  CAST(user_id AS DOUBLE) AS user_id, 'double' AS user_id_type, event_type, value, props
FROM events""",
        "stream_hourly_windows": f"""
WITH hours AS (
  SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events,
    {_round("sum(value)", 2)} AS total_value
  FROM events GROUP BY 1, 2)
SELECT CAST(epoch(start) AS BIGINT) AS window_start, event_type, events, total_value
FROM hours""",
        "stream_trip_windows": _TRIP_WINDOWS,
        "stream_closed_windows": _TRIP_WINDOWS,
        "stream_late_rows": "SELECT event_type, count(*) AS events FROM events GROUP BY 1",
        "gold_second_refresh": f"""WITH {_SILVER.replace(_TRIPS, _EDGE_TRIPS)}, {_HOURLY_KPIS}
SELECT * FROM hourly_kpis""",
        "bronze_second_drain": f"""WITH {_EDGE_TRIPS}
SELECT {_RAW}, {_BATCH_HOUR} AS _batch_hour FROM trips
WHERE make_timestamp(pu_sec * 1000000) >= TIMESTAMP '2023-12-31 00:00:00'
  AND make_timestamp(pu_sec * 1000000) < TIMESTAMP '2024-01-02 00:00:00'""",
        "bronze_refill": """
SELECT count(*) AS row_count, count(*) AS places, CAST(0 AS BIGINT) AS without_time,
  least(count(*), 10) AS sample_rows
FROM lineitem""",
        "mixed_months": f"WITH {_TRIPS} SELECT {_RAW} FROM trips",
    } | _corpus_sql()


_TALLIES = """
tallies AS (
  SELECT (SELECT count(*) FROM trips) AS bronze_rows, count(*) AS silver_rows,
    count(*) FILTER (WHERE is_anomaly) AS anomalies
  FROM silver)"""
