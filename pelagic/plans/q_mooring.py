"""Mooring queries: depth-bin series, DOY climatology, depth slice, summaries, file names, smoother."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.functions.timeops import decimal_year
from pelagic.operators import mooring as mo
from pelagic.plans import bindings as b
from pelagic.plans.catalog import register, rounded


def series(spark, sf_dir):
    """Mooring view: station = event type, hourly time, depth = props.k, temperature = value."""
    e = b.table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("station"), F.date_trunc("hour", "ts").alias("time"),
                    F.get_json_object("props", "$.k").cast("double").alias("depth"), F.col("value").alias("temp"))


SQL_SERIES = """series AS (
  SELECT event_type AS station, date_trunc('hour', ts) AS time,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS depth, value AS temp FROM events)"""
_BIN = """CASE WHEN depth > 0 AND depth <= 20 THEN '0 - 20m' WHEN depth > 20 AND depth <= 40 THEN '20 - 40m'
            WHEN depth > 40 AND depth <= 60 THEN '40 - 60m' WHEN depth > 60 AND depth <= 80 THEN '60 - 80m'
            WHEN depth > 80 AND depth <= 100 THEN '80 - 100m' END"""


# ----------------------------------------------------------------- A-20 (+ F-11, F-17)
@register("depth_bin_series", sql=b.with_ctes(SQL_SERIES) + f""",
s AS (SELECT station, {_BIN} AS depth_bin, time, temp FROM series)
SELECT station, depth_bin, time, round(avg(temp), 6) + 0.0 AS temp,
       round(year(time) + (epoch_us(time) - epoch_us(make_timestamp(year(time), 1, 1, 0, 0, 0)))
             / (epoch_us(make_timestamp(year(time) + 1, 1, 1, 0, 0, 0)) - epoch_us(make_timestamp(year(time), 1, 1, 0, 0, 0))), 6) + 0.0
         AS decimal_year
FROM s WHERE depth_bin IS NOT NULL GROUP BY station, depth_bin, time
""")
def depth_bin_series(spark, sf_dir):
    r = mo.depth_bin_series(series(spark, sf_dir), "station", "time", "depth", "temp")
    return rounded(r.withColumn("decimal_year", decimal_year("time")))


# ----------------------------------------------------------------- A-21
@register("doy_climatology", sql=b.with_ctes(SQL_SERIES) + f""",
s AS (SELECT station, {_BIN} AS depth_bin, CAST(dayofyear(time) AS INTEGER) AS doy, temp FROM series)
SELECT station, depth_bin, doy, round(avg(temp), 6) + 0.0 AS temp
FROM s WHERE depth_bin IS NOT NULL GROUP BY station, depth_bin, doy
""")
def doy_climatology(spark, sf_dir):
    return rounded(mo.doy_climatology(series(spark, sf_dir), "station", "time", "depth", "temp"))


# ----------------------------------------------------------------- P-14
@register("depth_slice", sql=b.with_ctes(SQL_SERIES) + """
SELECT station, time, depth, temp FROM series
WHERE depth = 50 AND time >= TIMESTAMP '2024-01-05 00:00:00' AND time <= TIMESTAMP '2024-01-25 00:00:00'
""")
def depth_slice(spark, sf_dir):
    s = series(spark, sf_dir)
    return mo.depth_slice(s, "station", "time", "depth", 50.0, "2024-01-05 00:00:00", "2024-01-25 00:00:00") \
        .select("station", "time", "depth", "temp")


# ----------------------------------------------------------------- A-26 / A-27
@register("series_summary", sql=b.with_ctes(SQL_SERIES) + """
SELECT station, count(DISTINCT depth) AS n_depths, min(depth) AS min_depth, max(depth) AS max_depth,
       min(time) AS time_start, max(time) AS time_end
FROM series GROUP BY station
""")
def series_summary(spark, sf_dir):
    return mo.series_summary(series(spark, sf_dir), "station", "time", "depth")


# ----------------------------------------------------------------- K-02
@register("product_file_name", sql=b.with_ctes(SQL_SERIES) + """
SELECT station, depth,
       station || '_TEMP_' || CAST(CAST(depth AS BIGINT) AS VARCHAR) || 'm_' || strftime(min(time), '%Y%m%d')
         || '-' || strftime(max(time), '%Y%m%d') || '.csv' AS file_name
FROM series GROUP BY station, depth
""")
def product_file_name(spark, sf_dir):
    return mo.product_file_name(series(spark, sf_dir), "station", "time", "depth")


# ----------------------------------------------------------------- G-19 smoother over DOY per bin
_H = 3


@register("doy_smooth", sql=b.with_ctes(SQL_SERIES) + f""",
c AS (SELECT station, {_BIN} AS depth_bin, CAST(dayofyear(time) AS BIGINT) AS doy, avg(temp) AS temp
      FROM series GROUP BY 1, 2, 3),
c2 AS (SELECT * FROM c WHERE depth_bin IS NOT NULL),
ev AS (SELECT DISTINCT station, depth_bin, doy + o AS pos FROM c2, range(-{_H}, {_H} + 1) r(o)),
m AS (SELECT a.station, a.depth_bin, a.pos,
             pow(1 - pow(abs(c2.doy - a.pos) / {_H + 1}.0, 3), 3) AS w, CAST(c2.doy - a.pos AS DOUBLE) AS dx, c2.temp AS y
      FROM ev a JOIN c2 ON a.station = c2.station AND a.depth_bin = c2.depth_bin AND abs(c2.doy - a.pos) <= {_H}),
s AS (SELECT station, depth_bin, pos, sum(w) s0, sum(w * dx) s1, sum(w * dx * dx) s2, sum(w * y) t0, sum(w * dx * y) t1
      FROM m GROUP BY 1, 2, 3)
SELECT station, depth_bin, CAST(pos AS INTEGER) AS doy,
       round(CASE WHEN abs(s0 * s2 - s1 * s1) > 1e-12 THEN (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) ELSE t0 / s0 END, 6)
         + 0.0 AS smooth
FROM s
""")
def doy_smooth(spark, sf_dir):
    clim = mo.doy_climatology(series(spark, sf_dir), "station", "time", "depth", "temp")
    return rounded(mo.local_linear(clim, ["station", "depth_bin"], "doy", "temp", _H))


# ----------------------------------------------------------------- P-14 / R-11 the slice, or the depths on offer (station = user)
@register("depth_slice_or_available", sql="""
WITH series AS (SELECT user_id AS station, date_trunc('hour', ts) AS time, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS depth, value AS temp FROM events),
offers AS (SELECT station, string_agg(CAST(CAST(depth AS BIGINT) AS VARCHAR), ', ' ORDER BY depth) AS available
           FROM (SELECT DISTINCT station, depth FROM series WHERE depth IS NOT NULL) GROUP BY station HAVING max(CASE WHEN depth = 50 THEN 1 ELSE 0 END) = 0)
SELECT station, time, depth, temp, NULL AS available FROM series WHERE depth = 50 AND time >= TIMESTAMP '2024-01-05 00:00:00' AND time <= TIMESTAMP '2024-01-25 00:00:00'
UNION ALL SELECT station, NULL, NULL, NULL, available FROM offers
""")
def depth_slice_or_available(spark, sf_dir):
    users = b.table(spark, sf_dir, "events").select(F.col("user_id").alias("station"), F.date_trunc("hour", "ts").alias("time"),
                                                    F.get_json_object("props", "$.k").cast("double").alias("depth"), F.col("value").alias("temp"))
    r = mo.slice_or_depths(users, "station", "time", "depth", ["temp"], 50.0, "2024-01-05 00:00:00", "2024-01-25 00:00:00")
    return r.withColumn("available", F.array_join(F.transform("available", lambda d: d.cast("long").cast("string")), ", "))
