"""As-of join queries (J-05 nearest cast within tolerance, J-06 forward weekly axis)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.functions.timeops import days_since
from pelagic.operators import asof
from pelagic.plans import bindings as b
from pelagic.plans.catalog import r6, register


# ----------------------------------------------------------------- J-05 + F-23
@register("nearest_asof", bench=True, sql="""
WITH p AS (SELECT event_id, user_id, ts, CASE WHEN user_id % 5 = 0 THEN 15.0 ELSE 3.0 END AS tol
           FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS cast_id, user_id, ts FROM events WHERE event_type = 'view'),
cand AS (SELECT p.event_id, v.ts AS vts,
                abs(epoch_us(v.ts) - epoch_us(p.ts)) / 3600000000.0 AS d,
                row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(v.ts) - epoch_us(p.ts)), v.ts) AS rn
         FROM p JOIN v ON p.user_id = v.user_id),
best AS (SELECT c.event_id, c.vts, c.d FROM cand c JOIN p USING (event_id) WHERE c.rn = 1 AND c.d <= p.tol)
SELECT p.event_id, p.user_id, p.ts, v.ts AS match_time, v.cast_id, round(best.d, 6) + 0.0 AS diff_h
FROM p LEFT JOIN best USING (event_id) LEFT JOIN v ON v.user_id = p.user_id AND v.ts = best.vts
""")
def nearest_asof(spark, sf_dir):
    e = b.table(spark, sf_dir, "events")
    p = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = e.where(F.col("event_type") == "view").select(F.col("event_id").alias("cast_id"), "user_id", "ts")
    tol = F.when(F.col("user_id") % 5 == 0, F.lit(15.0)).otherwise(F.lit(3.0))
    r = asof.nearest_asof(p, v, "user_id", "ts", "ts", "event_id", "cast_id", tolerance_h=tol, max_tolerance_h=15.0)
    return r.select("event_id", "user_id", "ts", "match_time", "cast_id",
                    r6("diff_h").alias("diff_h"))


# ----------------------------------------------------------------- J-06
@register("forward_asof_week", sql="""
WITH o AS (SELECT o_orderkey, CAST(date_diff('day', DATE '1800-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS dd
           FROM orders),
p AS (SELECT o_orderkey, CAST(round_even((dd - 66410) / 7.0, 0) * 7 + 66410 AS BIGINT) AS tt FROM o),
axis AS (SELECT DISTINCT CAST(date_diff('day', DATE '1800-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS a
         FROM lineitem WHERE dayofweek(l_shipdate) = 0)
SELECT p.o_orderkey, p.tt, (SELECT min(a) FROM axis WHERE axis.a > p.tt) AS next_value FROM p
""")
def forward_asof_week(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders")
    dd = F.round(days_since("o_orderdate", "1800-01-01"), 0).cast("long")
    tt = (F.bround((dd - 66410) / F.lit(7.0), 0) * 7 + 66410).cast("long")
    pts = o.select("o_orderkey", tt.alias("tt"))
    li = b.table(spark, sf_dir, "lineitem")
    ax = (li.where(F.dayofweek("l_shipdate") == 1)
          .select(F.round(days_since("l_shipdate", "1800-01-01"), 0).cast("long").alias("a")))
    return asof.forward_asof(pts, ax, "tt", "a").select("o_orderkey", "tt", "next_value")


# ----------------------------------------------------------------- J-05, scalar tolerance of two days
@register("nearest_asof_wide", sql="""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS cast_id, user_id, ts FROM events WHERE event_type = 'view'),
cand AS (SELECT p.event_id, v.ts AS vts,
                abs(epoch_us(v.ts) - epoch_us(p.ts)) / 3600000000.0 AS d,
                row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(v.ts) - epoch_us(p.ts)), v.ts) AS rn
         FROM p JOIN v ON p.user_id = v.user_id),
best AS (SELECT event_id, vts, d FROM cand WHERE rn = 1 AND d <= 48.0)
SELECT p.event_id, p.user_id, p.ts, v.ts AS match_time, v.cast_id, round(best.d, 6) + 0.0 AS diff_h
FROM p LEFT JOIN best USING (event_id) LEFT JOIN v ON v.user_id = p.user_id AND v.ts = best.vts
""")
def nearest_asof_wide(spark, sf_dir):
    e = b.table(spark, sf_dir, "events")
    p = e.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = e.where(F.col("event_type") == "view").select(F.col("event_id").alias("cast_id"), "user_id", "ts")
    r = asof.nearest_asof(p, v, "user_id", "ts", "ts", "event_id", "cast_id", tolerance_h=48.0)
    return r.select("event_id", "user_id", "ts", "match_time", "cast_id", r6("diff_h").alias("diff_h"))
