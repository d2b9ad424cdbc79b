"""Projection, text, melt, null-safe join and NaN queries (P-01, P-12, F-08, F-20, S-06, S-21, V-02, V-03, J-01, A-27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.functions.nulls import nan_to_null
from pelagic.functions.timeops import kelvin_to_celsius
from pelagic.operators import mooring as mo
from pelagic.operators import project as pj
from pelagic.operators import reshape as rs
from pelagic.plans import bindings as b
from pelagic.plans.catalog import r6, register, rounded


# ----------------------------------------------------------------- P-01 / P-12
@register("project_columns", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'NRS' AS project, CAST(NULL AS DOUBLE) AS secchi
FROM orders
""")
def project_columns(spark, sf_dir):
    o = pj.select_range(b.table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate")
    return pj.add_constants(o, {"project": "NRS", "secchi": F.lit(None).cast("double")})


# ----------------------------------------------------------------- F-08
@register("text_parts", sql="""
SELECT p_partkey, split_part(p_name, ' ', 2) AS part, substr(p_name, 4) AS stripped, substr(p_name, 1, 4) AS code FROM part
""")
def text_parts(spark, sf_dir):
    p = b.table(spark, sf_dir, "part")
    return p.select("p_partkey", pj.path_part("p_name", 2, " ").alias("part"), pj.strip_prefix("p_name", 3).alias("stripped"),
                    pj.first_chars("p_name", 4).alias("code"))


# ----------------------------------------------------------------- F-20 (with G-08: the harmonic value in Celsius)
@register("kelvin_shift", sql="""
SELECT event_id, round(value + 250.0 - 273.15, 6) + 0.0 AS celsius FROM events
""")
def kelvin_shift(spark, sf_dir):
    e = b.table(spark, sf_dir, "events")
    return e.select("event_id", r6(kelvin_to_celsius(F.col("value") + 250.0)).alias("celsius"))


# ----------------------------------------------------------------- S-21 / V-03
@register("melt_measures", sql="""
SELECT l_orderkey, l_linenumber, variable, value FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_linenumber % 3 <> 0 THEN l_discount END AS l_discount, l_tax FROM lineitem)
UNPIVOT (value FOR variable IN (l_quantity, l_discount, l_tax))
""")
def melt_measures(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_discount")).alias("l_discount"), "l_tax")
    return rs.melt(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


# ----------------------------------------------------------------- V-02 (absent cells stay null)
@register("group_totals_sparse_wide", sql=b.with_ctes(b.SQL_OBS) + """
SELECT sample, """ + ", ".join(f"sum(value) FILTER (WHERE grp = '{g}') AS \"{g}\"" for g in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + """
FROM obs GROUP BY sample
""")
def group_totals_sparse_wide(spark, sf_dir):
    o = b.obs(spark, sf_dir)
    sums = rs.sparse_matrix(o, "sample", "grp", "value")
    return rs.to_wide(sums, ["sample"], "grp", "value", values=rs.pivot_values(o, "grp"), unique_cells=True)


# ----------------------------------------------------------------- J-01 / N-8 (null keys match null keys)
@register("null_safe_join", sql="""
WITH a AS (SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_nationkey END AS k FROM supplier),
n AS (SELECT CASE WHEN n_nationkey = 0 THEN NULL ELSE n_nationkey END AS k, n_name FROM nation)
SELECT a.s_suppkey, a.k, n.n_name FROM a LEFT JOIN n ON a.k IS NOT DISTINCT FROM n.k
""")
def null_safe_join(spark, sf_dir):
    a = b.table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 9 != 0, F.col("s_nationkey")).alias("k"))
    n = b.table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") != 0, F.col("n_nationkey")).alias("k"), "n_name")
    return pj.key_join(a, n, "k", null_safe=True).select("s_suppkey", "k", "n_name")


# ----------------------------------------------------------------- S-06 / N-4
@register("nan_fold", sql="""
SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN value END AS value FROM events
""")
def nan_fold(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return nan_to_null(e)


# ----------------------------------------------------------------- A-26 / A-27 with the position centre
@register("station_extent", sql=b.with_ctes(b.SQL_SAMPLES) + """
SELECT station, count(DISTINCT biomass) AS n_depths, min(biomass) AS min_depth, max(biomass) AS max_depth,
       min(sample_date) AS time_start, max(sample_date) AS time_end,
       round((min(lat) + max(lat)) / 2, 6) + 0.0 AS lat_centre, round((min(lon) + max(lon)) / 2, 6) + 0.0 AS lon_centre
FROM samples GROUP BY station
""")
def station_extent(spark, sf_dir):
    s = mo.series_summary(b.samples(spark, sf_dir), "station", "sample_date", "biomass", lat="lat", lon="lon")
    return rounded(s, keep=("min_depth", "max_depth"))
