"""Scalar time / label function queries (F-01..F-07, F-12, F-13, F-15..F-17, F-24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.functions import labels as lb
from pelagic.functions import timeops as tm
from pelagic.plans import bindings as b
from pelagic.plans.catalog import register, rounded

# Fixed values of the binding: station number -> time zone.
STATION_ZONES = {
    "0": "Australia/Sydney", "1": "Australia/Perth", "2": "Australia/Darwin", "3": "Australia/Brisbane",
    "4": "Australia/Adelaide", "5": "Australia/Hobart", "6": "Australia/Melbourne", "7": "Australia/Sydney",
    "8": "Australia/Perth", "9": "Australia/Hobart",
}
_ZONE_SQL = ("CASE o_custkey % 10 WHEN 0 THEN 'Australia/Sydney' WHEN 1 THEN 'Australia/Perth' "
             "WHEN 2 THEN 'Australia/Darwin' WHEN 3 THEN 'Australia/Brisbane' WHEN 4 THEN 'Australia/Adelaide' "
             "WHEN 5 THEN 'Australia/Hobart' WHEN 6 THEN 'Australia/Melbourne' WHEN 7 THEN 'Australia/Sydney' "
             "WHEN 8 THEN 'Australia/Perth' ELSE 'Australia/Hobart' END")


def _local(o):
    """Local wall-clock time: order date plus an hour offset taken from the key (exercises DST gaps)."""
    return F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))


# ----------------------------------------------------------------- F-01, F-02, F-05, F-06, F-07, F-03
@register("trip_fields", sql=f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS local_ts,
                  {_ZONE_SQL} AS tz FROM orders)
SELECT o_orderkey,
       CAST(year(local_ts) AS INTEGER) AS "Year", CAST(month(local_ts) AS INTEGER) AS "Month",
       CAST(day(local_ts) AS INTEGER) AS "Day", strftime(local_ts, '%H:%M:%S') AS Time_24hr,
       CAST(dayofyear(local_ts) AS INTEGER) AS doy,
       'S' || CAST(o_custkey % 10 AS VARCHAR) || strftime(local_ts, '%Y%m%d') ||
         CASE WHEN o_custkey % 10 = 2 THEN strftime(local_ts, '_%H:%M') ELSE '' END AS trip_code,
       tz,
       timezone('UTC', timezone(tz, local_ts)) AS utc_ts
FROM t
""")
def trip_fields(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", (F.col("o_custkey") % 10).cast("string").alias("st"), _local(o).alias("local_ts"))
    tz = lb.code_map("st", STATION_ZONES)
    parts = tm.ymd_parts("local_ts")
    return t.select(
        "o_orderkey", parts["Year"].alias("Year"), parts["Month"].alias("Month"), parts["Day"].alias("Day"),
        parts["Time_24hr"].alias("Time_24hr"), F.dayofyear("local_ts").alias("doy"),
        tm.trip_code(F.concat(F.lit("S"), F.col("st")), "local_ts", with_time=F.col("st") == "2").alias("trip_code"),
        tz.alias("tz"), tm.local_to_utc("local_ts", tz).alias("utc_ts"))


# ----------------------------------------------------------------- F-04, F-16, F-17
@register("time_numbers", sql="""
SELECT event_id,
       round((epoch_us(ts) - epoch_us(TIMESTAMP '1950-01-01')) / 86400000000.0, 6) + 0.0 AS days_1950,
       round(year(ts) + (epoch_us(ts) - epoch_us(make_timestamp(year(ts), 1, 1, 0, 0, 0)))
             / (epoch_us(make_timestamp(year(ts) + 1, 1, 1, 0, 0, 0)) - epoch_us(make_timestamp(year(ts), 1, 1, 0, 0, 0))), 6) + 0.0
         AS decimal_year,
       timezone('Australia/Perth', timezone('UTC', ts)) AS perth_ts
FROM events
""")
def time_numbers(spark, sf_dir):
    e = b.table(spark, sf_dir, "events")
    return rounded(e.select(
        "event_id", tm.days_since("ts", "1950-01-01").alias("days_1950"),
        tm.decimal_year("ts").alias("decimal_year"), tm.utc_to_local("ts", "Australia/Perth").alias("perth_ts")))


# ----------------------------------------------------------------- F-16 inverse
@register("from_days", sql="""
SELECT event_id, TIMESTAMP '1950-01-01' + to_microseconds(CAST(round(
         (value * 1000.0 + CAST(event_id AS DOUBLE)) * 86400000000.0) AS BIGINT)) AS t
FROM events
""")
def from_days(spark, sf_dir):
    e = b.table(spark, sf_dir, "events")
    days = F.col("value") * 1000.0 + F.col("event_id").cast("double")
    return e.select("event_id", tm.from_days_since(days, "1950-01-01").alias("t"))


# ----------------------------------------------------------------- F-12, F-13
@register("composite_keys", sql="""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders),
k AS (SELECT o_orderkey, dt, least(dayofyear(dt), 361) AS dd FROM d),
e AS (SELECT o_orderkey, dt, CAST(round_even(dd / 8.0, 0) * 8 AS INTEGER) AS e0 FROM k)
SELECT o_orderkey,
       CAST(CASE WHEN e0 = 0 THEN 8 ELSE e0 END - 7 AS INTEGER) AS comp_start_doy,
       CAST(CASE WHEN e0 = 0 THEN 8 ELSE e0 END AS INTEGER) AS comp_end_doy,
       CAST(dayofyear(date_trunc('month', dt)) AS INTEGER) AS month_start_doy,
       CAST(dayofyear(last_day(dt)) AS INTEGER) AS month_end_doy
FROM e
""")
def composite_keys(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders")
    c8 = tm.eight_day_composite("o_orderdate")
    cm = tm.month_composite("o_orderdate")
    return o.select("o_orderkey", c8["comp_start_doy"].alias("comp_start_doy"), c8["comp_end_doy"].alias("comp_end_doy"),
                    cm["month_start_doy"].alias("month_start_doy"), cm["month_end_doy"].alias("month_end_doy"))


# ----------------------------------------------------------------- F-15
@register("month_sequence", sql="""
WITH r AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS z FROM orders GROUP BY o_custkey)
SELECT o_custkey, CAST(m AS DATE) AS month,
       CAST((year(z) - year(a)) * 12 + (month(z) - month(a)) + 1 AS INTEGER) AS n_months
FROM r, unnest(generate_series(date_trunc('month', a), date_trunc('month', z), INTERVAL 1 MONTH)) AS g(m)
""")
def month_sequence(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders")
    r = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z"))
    return r.select("o_custkey", F.explode(tm.month_sequence("a", "z")).alias("month"),
                    tm.whole_months_between("a", "z").alias("n_months"))


# ----------------------------------------------------------------- F-24, F-25, F-11
@register("parse_and_bins", sql="""
SELECT event_id,
       try_strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed,
       CASE WHEN d > 0 AND d <= 20 THEN '0 - 20m' WHEN d > 20 AND d <= 40 THEN '20 - 40m'
            WHEN d > 40 AND d <= 60 THEN '40 - 60m' WHEN d > 60 AND d <= 80 THEN '60 - 80m'
            WHEN d > 80 AND d <= 100 THEN '80 - 100m' END AS depth_bin,
       CASE WHEN d = floor(d) THEN CAST(CAST(d AS BIGINT) AS VARCHAR) ELSE CAST(d AS VARCHAR) END AS depth_text,
       'NRS' || CAST(user_id AS VARCHAR) || '_' ||
         CASE WHEN length(CAST(CAST(d AS BIGINT) AS VARCHAR)) >= 3 THEN CAST(CAST(d AS BIGINT) AS VARCHAR)
              ELSE lpad(CAST(CAST(d AS BIGINT) AS VARCHAR), 3, '0') END AS sample_code
FROM (SELECT event_id, user_id, ts, CAST(json_extract_string(props, '$.k') AS DOUBLE) * 11.0 AS d FROM events)
""")
def parse_and_bins(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", (F.get_json_object("props", "$.k").cast("double") * 11.0).alias("d"))
    return e.select(
        "event_id", tm.parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        lb.depth_bin("d").alias("depth_bin"), lb.whole_number_text("d").alias("depth_text"),
        lb.sample_code("NRS", "user_id", F.col("d").cast("long")).alias("sample_code"))
