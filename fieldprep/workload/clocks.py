"""Dates, times, zones and shift repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldprep.functions import clock, numeric, text
from fieldprep.operators import filters, shifts
from fieldprep.operators.aggregates import inside_outside_counts as count_inside
from fieldprep.workload.registry import query, table

STAMP = "yyyy-MM-dd HH:mm:ss"


def stamp(col):
    return F.date_format(col, STAMP)


@query(
    """
    SELECT o_orderkey,
           strftime(CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 5 HOUR
                         WHEN o_orderkey % 7 = 0 THEN NULL
                         ELSE timestamp '1899-12-30' + to_days(CAST(42000 + o_orderkey % 2000 AS INTEGER))
                              + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) END, '%Y-%m-%d %H:%M:%S') AS at
    FROM orders
    """
)
def serial_to_timestamp(spark, d):
    key = F.col("o_orderkey")
    serial = (F.lit(42000) + key % 2000) + (key % 86400) / F.lit(86400.0)
    raw = (
        F.when(key % 5 == 0, F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 5 HOUR"), STAMP))
        .when(key % 7 == 0, "not a time")
        .otherwise(serial.cast("string"))
    )
    return (
        table(spark, d, "orders")
        .select("o_orderkey", raw.alias("raw"))
        .select("o_orderkey", stamp(clock.serial_or_text(F.col("raw"), clock.parse_wall_clock)).alias("at"))
    )


@query(
    """
    SELECT o_orderkey, strftime(date '1899-12-30' + CAST(42000 + o_orderkey % 3000 AS INTEGER), '%Y-%m-%d') AS day FROM orders
    """
)
def serial_to_date(spark, d):
    raw = (F.lit(42000) + F.col("o_orderkey") % 3000).cast("string")
    return table(spark, d, "orders").select(
        "o_orderkey", F.date_format(clock.serial_to_date(raw), "yyyy-MM-dd").alias("day")
    )


@query(
    """
    SELECT event_id,
           strftime(CASE WHEN event_id % 6 = 4 THEN NULL WHEN event_id % 6 = 5 THEN NULL
                         WHEN event_id % 6 IN (0, 1) THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END,
                    '%Y-%m-%d %H:%M:%S') AS parsed,
           strftime(CASE WHEN event_id % 8 = 0 THEN date_trunc('day', ts) + INTERVAL 6 HOUR
                         ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS year_checked
    FROM events
    """
)
def lenient_parse(spark, d):
    ts, k = F.col("ts"), F.col("event_id") % 6
    raw = (
        F.when(k == 0, F.date_format(ts, "yyyy-MM-dd H:mm"))
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd HH:mm"))
        .when(k == 2, F.date_format(ts, "yyyy-MM-dd-HH:mm:ss"))
        .when(k == 3, F.date_format(ts, "yyyy/M/d H.mm.ss"))
        .when(k == 4, F.concat(F.date_format(ts, "yyyy-"), F.lit("13-01 00:00:00")))
    )
    # A stamp of a wrong year gives way to the start of the shift.
    wrong = F.col("event_id") % 8 == 0
    given = F.when(wrong, F.concat(F.lit("2099"), F.date_format(ts, "-MM-dd HH:mm:ss"))).otherwise(stamp(ts))
    shift = F.date_format(ts, "yyyy-MM-dd 06:00:00")
    checked = F.when(text.extract(given, "^[0-9]{4}") != "2024", shift).otherwise(given)
    return table(spark, d, "events").select(
        "event_id",
        stamp(clock.parse_wall_clock(text.pad_clock(raw))).alias("parsed"),
        stamp(clock.parse_wall_clock(checked)).alias("year_checked"),
    )


@query(
    """
    WITH e AS (SELECT event_id, ts, event_type,
                      CASE WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                           WHEN event_id % 4 = 1 THEN NULL ELSE strftime(ts + INTERVAL 1 HOUR, '%H:%M') END AS given
               FROM events)
    SELECT event_id, coalesce(regexp_matches(given, '^[0-9-]{10}'), false) AS new_tranche,
           CASE WHEN event_id % 4 <> 0 THEN coalesce(given, strftime(ts, '%H:%M')) END AS hour_min,
           strftime(date_trunc('second', ts) AT TIME ZONE 'America/Los_Angeles' AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS taken_utc,
           strftime(ts, '%Y-%m-%d') AS day
    FROM e
    """
)
def tranche_split_clock(spark, d):
    from fieldprep.plans.combining import extract_clock, zoned_inspection_time

    ts, k = F.col("ts"), F.col("event_id") % 4
    given = F.when(k == 0, stamp(ts)).when(k != 1, F.date_format(ts + F.expr("INTERVAL 1 HOUR"), "HH:mm"))
    raw = table(spark, d, "events").select(
        "event_id", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("raw_timestamp"), given.alias("Inspection Time")
    )
    done = zoned_inspection_time(extract_clock(raw))
    return done.select(
        "event_id",
        F.col("new_tranche"),
        F.col("Hour_Min_of_Insp").alias("hour_min"),
        stamp(clock.utc_clock(F.col("TimeOfInspection"))).alias("taken_utc"),
        F.col("Inspection Date").alias("day"),
    )


@query(
    """
    SELECT event_id,
           strftime(date_trunc('second', ts) + CASE WHEN hour(ts) = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END,
                    '%Y-%m-%d %H:%M:%S') AS at
    FROM events
    """
)
def date_plus_time(spark, d):
    ts = F.col("ts")
    clock_text = F.date_format(ts, "HH:mm:ss")
    return table(spark, d, "events").select(
        "event_id", stamp(clock.date_plus_clock(ts, clock.seconds_of_clock_text(clock_text))).alias("at")
    )


@query(
    """
    WITH m AS (
      SELECT event_id, ts, date_trunc('day', ts) + INTERVAL 8 HOUR AS s, date_trunc('day', ts) + INTERVAL 16 HOUR AS e FROM events)
    SELECT event_id,
           strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d %H:%M:%S') AS pacific,
           strftime(CASE WHEN ts BETWEEN s - INTERVAL 30 MINUTE AND e + INTERVAL 30 MINUTE THEN ts
                         ELSE ts - INTERVAL 8 HOUR END, '%Y-%m-%d %H:%M:%S') AS moved
    FROM m
    """
)
def zone_convert(spark, d):
    ts = F.col("ts")
    day = F.date_trunc("DAY", ts).cast("timestamp_ntz")
    rows = table(spark, d, "events").select(
        "event_id", "ts", (day + F.expr("INTERVAL 8 HOUR")).alias("s"), (day + F.expr("INTERVAL 16 HOUR")).alias("e")
    )
    rows = rows.withColumn("pacific", stamp(clock.in_zone(ts, clock.PACIFIC)))
    return shifts.move_back_outside_shift(rows, "ts", "s", "e").select("event_id", "pacific", stamp(ts).alias("moved"))


# Local wall clocks around the year, half-hourly through the night, so that they hit the
# skipped and the doubled hour of each year.
@query(
    """
    WITH l AS (SELECT o_orderkey, o_orderdate + to_minutes(CAST(o_orderkey % 8 * 30 AS BIGINT)) AS local FROM orders),
    c AS (SELECT o_orderkey, local,
                 CASE WHEN ((local + INTERVAL 7 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' = local
                      THEN local + INTERVAL 7 HOUR
                      WHEN ((local + INTERVAL 8 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' = local
                      THEN local + INTERVAL 8 HOUR END AS utc FROM l)
    SELECT o_orderkey, strftime(utc, '%Y-%m-%d %H:%M:%S') AS utc FROM c
    """
)
def force_zone(spark, d):
    local = F.timestamp_add("MINUTE", (F.col("o_orderkey") % 8 * 30).cast("int"), F.col("o_orderdate"))
    return table(spark, d, "orders").select(
        "o_orderkey", stamp(clock.force_zone(local, clock.PACIFIC)).alias("utc")
    )


@query(
    """
    SELECT event_id, round(abs(epoch(date_trunc('second', ts)) - epoch(date_trunc('day', ts) + INTERVAL 12 HOUR)) / 3600, 6) AS hours
    FROM events
    """
)
def shift_hours(spark, d):
    noon = F.date_trunc("DAY", F.col("ts")).cast("timestamp_ntz") + F.expr("INTERVAL 12 HOUR")
    whole = F.date_trunc("SECOND", F.col("ts")).cast("timestamp_ntz")
    return table(spark, d, "events").select("event_id", F.round(clock.shift_hours(whole, noon), 6).alias("hours"))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN t = 0 THEN 1 ELSE t END AS boats, floor(l_extendedprice / 7) AS floored, ceil(l_extendedprice / 7) AS ceiled,
           least(l_quantity, 1) AS capped
    FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL
                         ELSE (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) + (CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0 END)
                    END AS t FROM lineitem)
    """
)
def total_with_floor_one(spark, d):
    line = F.col("l_linenumber")
    counters = {
        "a": F.when(F.col("l_returnflag") == "R", "1").otherwise("0"),
        "b": F.when(line != 3, F.when(F.col("l_linestatus") == "F", "1.0").otherwise("0")).otherwise("?"),
    }
    rows = table(spark, d, "lineitem").withColumns(counters)
    price = F.col("l_extendedprice") / 7
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        numeric.total_at_least_one(F.col("a"), F.col("b")).alias("boats"),
        F.floor(price).cast("double").alias("floored"),
        F.ceil(price).cast("double").alias("ceiled"),
        F.least(F.col("l_quantity"), F.lit(1.0)).alias("capped"),
    )


@query(
    """
    SELECT o_orderkey, CAST(year(d) AS BIGINT) AS y, CAST(hour(d) AS BIGINT) AS h, strftime(d, '%Y-%m-%d') AS day, strftime(d, '%H') AS hh,
           strftime(d, '%Y-%m-%d %H:%M:%S') AS back
    FROM (SELECT o_orderkey, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS d FROM orders)
    """
)
def date_parts_padded(spark, d):
    at = F.timestamp_add("MINUTE", (F.col("o_orderkey") % 1440).cast("int"), F.col("o_orderdate"))
    raw = F.date_format(at, "yyyy-MM-dd H:mm")
    rows = table(spark, d, "orders").select("o_orderkey", raw.alias("raw"))
    rows = rows.withColumn("at", clock.parse_wall_clock(text.pad_clock(F.col("raw"))))
    at = F.col("at")
    return rows.select(
        "o_orderkey",
        F.year(at).cast("bigint").alias("y"),
        F.hour(at).cast("bigint").alias("h"),
        F.date_format(at, "yyyy-MM-dd").alias("day"),
        F.date_format(at, "HH").alias("hh"),
        stamp(at).alias("back"),
    )


_SHIFTED = """
    WITH base AS (
      SELECT event_id, user_id, date_trunc('second', ts) AS t, CAST(year(ts) AS BIGINT) AS y, event_type AS station,
             CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'w' || (user_id % 12) || '-' || CAST(day(ts) AS BIGINT) END AS wf,
             CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN '0600-24' ELSE '0600-18' END AS comment
      FROM events),
    raw AS (
      SELECT *, date_trunc('day', t) + INTERVAL 6 HOUR AS s,
             CASE WHEN event_id % 23 = 0 THEN NULL
                  WHEN event_id % 5 = 0 THEN date_trunc('day', t) + INTERVAL 2 HOUR
                  ELSE date_trunc('day', t) + INTERVAL 18 HOUR END AS e
      FROM base)
"""


def _shift_rows(spark, d):
    """Events as inspections of shifts with literal hours, some reversed, some open."""
    k, t = F.col("event_id"), F.col("raw_timestamp")
    rows = table(spark, d, "events").select(
        "event_id",
        F.date_trunc("SECOND", "ts").cast("timestamp_ntz").alias("raw_timestamp"),
        F.year("ts").cast("bigint").alias("Year"),
        F.col("event_type").alias("Station"),
        F.when(
            k % 10 != 0,
            F.concat(F.lit("w"), (F.col("user_id") % 12).cast("string"), F.lit("-"), F.dayofmonth("ts").cast("string")),
        ).alias("Workflow_ID"),
        F.when(k % 9 == 1, "0600-24").when(k % 9 != 0, "0600-18").alias("Shift_Start_Comment"),
    )
    day = F.date_trunc("DAY", t).cast("timestamp_ntz")
    at = lambda h: day + F.expr(f"INTERVAL {h} HOUR")
    return rows.withColumns(
        {"Start_Time": at(6), "End_Time": F.when(k % 23 == 0, None).when(k % 5 == 0, at(2)).otherwise(at(18))}
    )


@query(
    _SHIFTED
    + """
    SELECT event_id, strftime(s + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS start_at,
           strftime(CASE WHEN e < s THEN e + INTERVAL 1 DAY ELSE e END + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS end_at
    FROM raw
    """
)
def shift_repair_simple(spark, d):
    done = shifts.repair_shift_simple(_shift_rows(spark, d))
    return done.select("event_id", stamp("Start_Time").alias("start_at"), stamp("End_Time").alias("end_at"))


@query(
    _SHIFTED
    + """
    , k AS (SELECT *, CASE WHEN e IS NULL THEN wf ELSE coalesce(wf, strftime(t, '%Y-%m-%d')) END AS shift FROM raw),
    g AS (SELECT y, station, shift,
                 count(*) FILTER (WHERE NOT (t >= s AND t <= e)) AS outside,
                 min(t) FILTER (WHERE s > e) AS first_t, max(t) FILTER (WHERE s > e) AS last_t
          FROM k WHERE e IS NOT NULL GROUP BY ALL),
    j AS (SELECT k.*, outside, first_t, last_t, ceil((epoch(t) - epoch(s)) / 3600) AS gap
          FROM k LEFT JOIN g ON k.y = g.y AND k.station = g.station AND k.shift IS NOT DISTINCT FROM g.shift AND e IS NOT NULL),
    r AS (SELECT event_id, shift,
                 CASE WHEN e IS NULL OR outside = 0 THEN s WHEN s <= e THEN s + to_hours(CAST(gap - 1 AS BIGINT))
                      ELSE date_trunc('hour', first_t) END AS s2,
                 CASE WHEN e IS NULL THEN CASE comment WHEN '0600-18' THEN date_trunc('day', s) + INTERVAL 18 HOUR
                                                       WHEN '0600-24' THEN date_trunc('day', s) + INTERVAL 24 HOUR END
                      WHEN outside = 0 THEN e WHEN s <= e THEN e + to_hours(CAST(gap AS BIGINT))
                      WHEN date_trunc('hour', last_t) = last_t THEN last_t
                      ELSE date_trunc('hour', last_t) + INTERVAL 1 HOUR END AS e2
          FROM j)
    SELECT event_id, shift, strftime(s2, '%Y-%m-%d %H:%M:%S') AS start_at, strftime(e2, '%Y-%m-%d %H:%M:%S') AS end_at FROM r
    """
)
def shift_repair_full(spark, d):
    done = shifts.repair_shift_full(_shift_rows(spark, d))
    return done.select(
        "event_id",
        F.col("Workflow_ID").alias("shift"),
        stamp("Start_Time").alias("start_at"),
        stamp("End_Time").alias("end_at"),
    )


@query(
    _SHIFTED
    + """
    SELECT y, station, wf, count(*) FILTER (WHERE t >= s AND t <= e) AS inside,
           count(*) FILTER (WHERE NOT (t >= s AND t <= e)) AS outside,
           count(*) FILTER (WHERE (t >= s AND t <= e) IS NOT NULL) AS total
    FROM raw GROUP BY ALL
    """
)
def inside_outside_counts(spark, d):
    rows = _shift_rows(spark, d)
    inside = filters.within(F.col("raw_timestamp"), F.col("Start_Time"), F.col("End_Time"))
    counted = count_inside(rows, ["Year", "Station", "Workflow_ID"], inside)
    return counted.withColumnsRenamed({"Year": "y", "Station": "station", "Workflow_ID": "wf"})
