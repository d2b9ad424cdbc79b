"""Composed point extractions (G-04, G-09, G-10, G-12): a date key, then a cell lookup in the layer of that key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagic.functions.timeops import days_since, eight_day_composite
from pelagic.operators import asof
from pelagic.operators import grid as gr
from pelagic.plans import bindings as b
from pelagic.plans.catalog import register, rounded
from pelagic.plans.q_grid import LAT, LON


def _layers(spark, sf_dir, period: Column):
    """Layers of one product (return flag N) under another period key."""
    li = b.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "N")
    return (li.groupBy(period.alias("period"), (F.col("l_orderkey") % 60).cast("int").alias("lat_idx"),
                       (F.col("l_partkey") % 80).cast("int").alias("lon_idx")).agg(F.avg("l_quantity").alias("value")))


def _layers_sql(period: str) -> str:
    return f"""layers AS (SELECT {period} AS period, CAST(l_orderkey % 60 AS INTEGER) AS lat_idx,
         CAST(l_partkey % 80 AS INTEGER) AS lon_idx, avg(l_quantity) AS value
  FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL)"""


_FRAC = "(lat - (-10.0)) / (-0.5) AS fi, (lon - 110.0) / 0.5 AS fj"
_EDGE = """
SELECT p.sample, p.period, round(g.value, 6) + 0.0 AS value
FROM p LEFT JOIN layers g ON g.period = p.period AND g.lat_idx = CAST(floor(p.fi) AS INTEGER)
     AND g.lon_idx = CAST(floor(p.fj) AS INTEGER)
"""


def _edge(spark, sf_dir, points, layers):
    r = gr.grid_edge_cell(points, layers, "sample", "lat", "lon", LAT, LON, keys=["period"])
    return rounded(points.select("sample", "period").join(r, "sample"))


def _composite(date: str) -> Column:
    return F.concat_ws("_", F.year(date), eight_day_composite(date)["comp_end_doy"])


_COMPOSITE_SQL = ("CAST(year({0}) AS VARCHAR) || '_' || CAST(CASE WHEN round_even(least(dayofyear({0}), 361) / 8.0, 0) = 0 THEN 8 "
                  "ELSE CAST(round_even(least(dayofyear({0}), 361) / 8.0, 0) * 8 AS INTEGER) END AS VARCHAR)")


# ----------------------------------------------------------------- G-10, 8-day composites
@register("point_eight_day", sql=b.with_ctes(b.SQL_SAMPLES, _layers_sql(_COMPOSITE_SQL.format("l_shipdate"))) + f""",
p AS (SELECT sample, {_COMPOSITE_SQL.format("sample_date")} AS period, {_FRAC} FROM samples)""" + _EDGE)
def point_eight_day(spark, sf_dir):
    s = b.samples(spark, sf_dir).withColumn("period", _composite("sample_date"))
    return _edge(spark, sf_dir, s, _layers(spark, sf_dir, _composite("l_shipdate")))


# ----------------------------------------------------------------- G-10, months
@register("point_month", sql=b.with_ctes(b.SQL_SAMPLES, _layers_sql("strftime(l_shipdate, '%Y-%m')")) + f""",
p AS (SELECT sample, strftime(sample_date, '%Y-%m') AS period, {_FRAC} FROM samples)""" + _EDGE)
def point_month(spark, sf_dir):
    s = b.samples(spark, sf_dir).withColumn("period", gr.period_key("sample_date", "1m"))
    return _edge(spark, sf_dir, s, _layers(spark, sf_dir, gr.period_key("l_shipdate", "1m")))


# ----------------------------------------------------------------- G-09, weekly layers (the first layer after the date)
_DAY_SQL = "CAST(date_diff('day', DATE '1800-01-01', CAST({0} AS DATE)) AS BIGINT)"


@register("point_week", sql=b.with_ctes(
    b.SQL_SAMPLES, _layers_sql(_DAY_SQL.format("l_shipdate")).replace("WHERE ", "WHERE dayofweek(l_shipdate) = 0 AND ")) + f""",
axis AS (SELECT DISTINCT period FROM layers),
p AS (SELECT sample, (SELECT min(period) FROM axis WHERE axis.period > {_DAY_SQL.format("sample_date")}) AS period, {_FRAC}
      FROM samples)""" + _EDGE)
def point_week(spark, sf_dir):
    day = lambda c: F.round(days_since(c, "1800-01-01"), 0).cast("long")
    li = b.table(spark, sf_dir, "lineitem").where((F.col("l_returnflag") == "N") & (F.dayofweek("l_shipdate") == 1))
    layers = (li.groupBy(day("l_shipdate").alias("period"), (F.col("l_orderkey") % 60).cast("int").alias("lat_idx"),
                         (F.col("l_partkey") % 80).cast("int").alias("lon_idx")).agg(F.avg("l_quantity").alias("value")))
    s = b.samples(spark, sf_dir).withColumn("day", day("sample_date"))
    s = asof.forward_asof(s, layers.select("period"), "day", "period").withColumnRenamed("next_value", "period")
    return _edge(spark, sf_dir, s, layers)


# ----------------------------------------------------------------- G-12, months and a window on the axes
@register("point_month_window", sql=b.with_ctes(b.SQL_SAMPLES, _layers_sql("strftime(l_shipdate, '%Y-%m')")) + """,
w AS (SELECT sample, strftime(sample_date, '%Y-%m') AS period,
             (lat + 0.3 - (-10.0)) / (-0.5) AS alo, (lat - 0.3 - (-10.0)) / (-0.5) AS ahi,
             (lon - 0.3 - 110.0) / 0.5 AS blo, (lon + 0.3 - 110.0) / 0.5 AS bhi FROM samples),
k AS (SELECT sample, period, greatest(CAST(floor(least(alo, ahi)) AS INTEGER) + 1, 0) AS i, greatest(alo, ahi) AS ahi,
             greatest(CAST(floor(least(blo, bhi)) AS INTEGER) + 1, 0) AS j, greatest(blo, bhi) AS bhi FROM w),
p AS (SELECT sample, period, CASE WHEN i < ahi AND i < 60 THEN i END AS li, CASE WHEN j < bhi AND j < 80 THEN j END AS lj FROM k)
SELECT p.sample, p.period, round(g.value, 6) + 0.0 AS value
FROM p LEFT JOIN layers g ON g.period = p.period AND g.lat_idx = p.li AND g.lon_idx = p.lj
""")
def point_month_window(spark, sf_dir):
    s = b.samples(spark, sf_dir).withColumn("period", gr.period_key("sample_date", "1m"))
    layers = _layers(spark, sf_dir, gr.period_key("l_shipdate", "1m"))
    r = gr.grid_window_cell(s, layers, "sample", "lat", "lon", LAT, LON, 0.3, keys=["period"])
    return rounded(s.select("sample", "period").join(r, "sample"))


# ----------------------------------------------------------------- G-04 / F-15, monthly area series with every month
@register("area_series_months", sql=b.with_ctes(b.sql_grid_at("1m")) + """,
s AS (SELECT product, period, avg(value) AS value, count(value) AS n_cells FROM grid_at
      WHERE lat_idx BETWEEN 10 AND 11 AND lon_idx BETWEEN 20 AND 21 GROUP BY product, period),
m AS (SELECT DISTINCT s.product, strftime(t.d, '%Y-%m') AS period
      FROM s, (SELECT unnest(generate_series(DATE '1991-06-01', DATE '1999-03-01', INTERVAL 1 MONTH)) AS d) t)
SELECT m.product, m.period, round(s.value, 6) + 0.0 AS value, s.n_cells FROM m LEFT JOIN s USING (product, period)
""")
def area_series_months(spark, sf_dir):
    s = gr.grid_area_series(b.grid_at(spark, sf_dir, "1m"), LAT, LON, (-15.5, -15.0), (120.0, 120.5), keys=["product", "period"])
    return rounded(gr.month_spine(s, ["product"], "1991-06-01", "1999-03-15"))
