"""Profile queries: mixed-layer depth, chlorophyll maximum, surface and depth-rounded means."""

from __future__ import annotations

from pelagic.operators import profile as pr
from pelagic.plans import bindings as b
from pelagic.plans.catalog import register, rounded

_P = b.with_ctes(b.SQL_PROFILE)


# ----------------------------------------------------------------- W-01..W-04
@register("mixed_layer", bench=True, sql=_P + """,
r AS (SELECT * FROM (
        SELECT "cast", depth AS rdepth, temp AS rtemp, salinity AS rsal,
               row_number() OVER (PARTITION BY "cast" ORDER BY abs(depth - ref_depth) ASC NULLS LAST, depth, row_id) AS rn
        FROM profile) WHERE rn = 1),
below AS (SELECT p.*, r.rtemp, r.rsal FROM profile p JOIN r USING ("cast") WHERE p.depth > r.rdepth),
t AS (SELECT "cast", depth AS MLD_temp FROM (
        SELECT "cast", depth, row_number() OVER (PARTITION BY "cast"
               ORDER BY abs(temp - (rtemp - 0.4)) ASC NULLS LAST, depth, row_id) AS rn FROM below) WHERE rn = 1),
s AS (SELECT "cast", depth AS MLD_sal FROM (
        SELECT "cast", depth, row_number() OVER (PARTITION BY "cast"
               ORDER BY abs(salinity - (rsal - 0.03)) ASC NULLS LAST, depth, row_id) AS rn FROM below) WHERE rn = 1),
mx AS (SELECT "cast", max(chl) AS mchl, count(*) - count(chl) AS nnull FROM below GROUP BY "cast"),
d AS (SELECT b."cast", min(b.depth) AS DCM FROM below b JOIN mx USING ("cast")
      WHERE mx.nnull = 0 AND b.chl > 0 AND b.chl = mx.mchl GROUP BY b."cast"),
casts AS (SELECT DISTINCT "cast" FROM profile)
SELECT casts."cast", t.MLD_temp, s.MLD_sal, d.DCM
FROM casts LEFT JOIN t USING ("cast") LEFT JOIN s USING ("cast") LEFT JOIN d USING ("cast")
""")
def mixed_layer(spark, sf_dir):
    p = b.profile(spark, sf_dir)
    return pr.mixed_layer(p, "cast", "depth", "temp", "salinity", "chl", ref_depth="ref_depth", order="row_id")


# ----------------------------------------------------------------- A-14
@register("surface_mean", sql=_P + """
SELECT "cast", round(avg(temp), 6) + 0.0 AS temp, round(avg(chl), 6) + 0.0 AS chl,
       round(avg(salinity), 6) + 0.0 AS salinity
FROM profile WHERE depth < 15 GROUP BY "cast"
""")
def surface_mean(spark, sf_dir):
    p = b.profile(spark, sf_dir)
    return rounded(pr.surface_mean(p, "cast", "depth", ["temp", "chl", "salinity"], 15.0))


# ----------------------------------------------------------------- A-15
@register("surface_pigment_mean", sql=_P + """
SELECT "cast", round(avg(chl), 6) + 0.0 AS chl FROM profile WHERE depth <= 25 GROUP BY "cast"
""")
def surface_pigment_mean(spark, sf_dir):
    p = b.profile(spark, sf_dir)
    return rounded(pr.surface_mean(p, "cast", "depth", ["chl"], 25.0, inclusive=True))


# ----------------------------------------------------------------- A-16
@register("rounded_depth_mean", sql=_P + """
SELECT "cast", round_even(depth, 0) AS depth, round(avg(temp), 6) + 0.0 AS temp, round(avg(chl), 6) + 0.0 AS chl
FROM profile GROUP BY "cast", round_even(depth, 0)
""")
def rounded_depth_mean(spark, sf_dir):
    p = b.profile(spark, sf_dir)
    return rounded(pr.rounded_depth_mean(p, ["cast"], "depth", ["temp", "chl"]))
