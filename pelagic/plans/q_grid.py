"""Gridded-product queries: nearest / box / bilinear / edge / window lookups, climatology, regrid,
coarsening, trend, area series and multi-product match-up."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pelagic.functions.timeops import harmonic
from pelagic.operators import grid as gr
from pelagic.plans import bindings as b
from pelagic.plans.catalog import register, rounded
from pelagic.session import checkpoint_dir
from pelagic.sources.readers import asked_periods, read_grid
from pelagic.sources.sinks import write_grid

LAT = gr.Axis(-10.0, -0.5, 60)
LON = gr.Axis(110.0, 0.5, 80)

_PTS = """pts AS (
  SELECT sample, lat, lon, CAST(year(sample_date) AS VARCHAR) AS period, sample_date,
         (lat - (-10.0)) / (-0.5) AS fi, (lon - 110.0) / 0.5 AS fj
  FROM samples)"""
_G = b.with_ctes(b.SQL_SAMPLES, b.SQL_GRID, _PTS)


def _points(spark, sf_dir):
    return b.samples(spark, sf_dir).withColumn("period", F.year("sample_date").cast("string"))


def _keys(product: str):
    return {"product": F.lit(product), "period": F.col("period")}


# ----------------------------------------------------------------- J-07
@register("grid_nearest", sql=_G + """,
p AS (SELECT sample, period,
             least(greatest(CAST(floor(fi + 0.5) AS INTEGER), 0), 59) AS lat_idx,
             least(greatest(CAST(floor(fj + 0.5) AS INTEGER), 0), 79) AS lon_idx FROM pts)
SELECT p.sample, p.lat_idx, p.lon_idx, g.value
FROM p LEFT JOIN grid g ON g.product = 'N' AND g.period = p.period AND g.lat_idx = p.lat_idx AND g.lon_idx = p.lon_idx
""")
def grid_nearest(spark, sf_dir):
    r = gr.grid_nearest(_points(spark, sf_dir), b.grid(spark, sf_dir), "sample", "lat", "lon", LAT, LON,
                        keys=["product", "period"], point_keys=_keys("N"))
    return r.select("sample", "lat_idx", "lon_idx", "value")


# ----------------------------------------------------------------- J-07, some coordinates unknown
@register("grid_nearest_nulls", sql=_G + """,
p AS (SELECT sample, period,
             CASE WHEN sample % 11 <> 0 THEN least(greatest(CAST(floor(fi + 0.5) AS INTEGER), 0), 59) END AS lat_idx,
             CASE WHEN sample % 7 <> 0 THEN least(greatest(CAST(floor(fj + 0.5) AS INTEGER), 0), 79) END AS lon_idx FROM pts)
SELECT p.sample, p.lat_idx, p.lon_idx, g.value
FROM p LEFT JOIN grid g ON g.product = 'N' AND g.period = p.period AND g.lat_idx = p.lat_idx AND g.lon_idx = p.lon_idx
""")
def grid_nearest_nulls(spark, sf_dir):
    p = _points(spark, sf_dir).withColumns({"lat": F.when(F.col("sample") % 11 != 0, F.col("lat")),
                                            "lon": F.when(F.col("sample") % 7 != 0, F.col("lon"))})
    r = gr.grid_nearest(p, b.grid(spark, sf_dir), "sample", "lat", "lon", LAT, LON,
                        keys=["product", "period"], point_keys=_keys("N"))
    return r.select("sample", "lat_idx", "lon_idx", "value")


# ----------------------------------------------------------------- J-09
@register("grid_box_mean", bench=True, sql=_G + """,
p AS (SELECT sample, period,
             least(greatest(CAST(floor(fi + 0.5) AS INTEGER), 0), 59) - 1 AS i0,
             least(greatest(CAST(floor(fj + 0.5) AS INTEGER), 0), 79) - 1 AS j0 FROM pts),
c AS (SELECT sample, period, i0 + di AS li, j0 + dj AS lj FROM p, range(0, 3) a(di), range(0, 3) b(dj)
      WHERE i0 + di BETWEEN 0 AND 59 AND j0 + dj BETWEEN 0 AND 79)
SELECT c.sample, round(avg(g.value), 6) + 0.0 AS value
FROM c LEFT JOIN grid g ON g.product = 'R' AND g.period = c.period AND g.lat_idx = c.li AND g.lon_idx = c.lj
GROUP BY c.sample
""")
def grid_box_mean(spark, sf_dir):
    r = gr.grid_box(_points(spark, sf_dir), b.grid(spark, sf_dir), "sample", "lat", "lon", LAT, LON, 3,
                    keys=["product", "period"], point_keys=_keys("R"))
    return rounded(r)


_CORNERS = """p AS (SELECT sample, period, sample_date, CAST(floor(fi) AS INTEGER) AS i0, CAST(floor(fj) AS INTEGER) AS j0,
             fi - floor(fi) AS ti, fj - floor(fj) AS tj FROM pts),
c AS (SELECT sample, period, sample_date, i0 AS li, j0 AS lj, (1.0 - ti) * (1.0 - tj) AS w FROM p
      UNION ALL SELECT sample, period, sample_date, i0, j0 + 1, (1.0 - ti) * tj FROM p WHERE tj > 0
      UNION ALL SELECT sample, period, sample_date, i0 + 1, j0, ti * (1.0 - tj) FROM p WHERE ti > 0
      UNION ALL SELECT sample, period, sample_date, i0 + 1, j0 + 1, ti * tj FROM p WHERE ti > 0 AND tj > 0)"""


# ----------------------------------------------------------------- J-12 / G-08
@register("grid_bilinear", sql=_G + "," + _CORNERS + """
SELECT c.sample, CASE WHEN count(*) = count(g.value) THEN round(sum(c.w * g.value), 6) + 0.0 END AS value
FROM c LEFT JOIN grid g ON g.product = 'A' AND g.period = c.period AND g.lat_idx = c.li AND g.lon_idx = c.lj
GROUP BY c.sample
""")
def grid_bilinear(spark, sf_dir):
    r = gr.grid_bilinear(_points(spark, sf_dir), b.grid(spark, sf_dir), "sample", "lat", "lon", LAT, LON,
                         keys=["product", "period"], point_keys=_keys("A"))
    return rounded(r)


# ----------------------------------------------------------------- J-10
@register("grid_edge_cell", sql=_G + """,
p AS (SELECT sample, period, CAST(floor(fi) AS INTEGER) AS li, CAST(floor(fj) AS INTEGER) AS lj FROM pts)
SELECT p.sample, g.value
FROM p LEFT JOIN grid g ON g.product = 'N' AND g.period = p.period AND g.lat_idx = p.li AND g.lon_idx = p.lj
""")
def grid_edge_cell(spark, sf_dir):
    return gr.grid_edge_cell(_points(spark, sf_dir), b.grid(spark, sf_dir), "sample", "lat", "lon", LAT, LON,
                             keys=["product", "period"], point_keys=_keys("N"))


# ----------------------------------------------------------------- J-11
@register("grid_window_cell", sql=_G + """,
w AS (SELECT sample, period,
             least((lat - 0.2 - (-10.0)) / (-0.5), (lat + 0.2 - (-10.0)) / (-0.5)) AS alo,
             greatest((lat - 0.2 - (-10.0)) / (-0.5), (lat + 0.2 - (-10.0)) / (-0.5)) AS ahi,
             least((lon - 0.2 - 110.0) / 0.5, (lon + 0.2 - 110.0) / 0.5) AS blo,
             greatest((lon - 0.2 - 110.0) / 0.5, (lon + 0.2 - 110.0) / 0.5) AS bhi FROM pts),
k AS (SELECT sample, period, greatest(CAST(floor(alo) AS INTEGER) + 1, 0) AS i, ahi,
             greatest(CAST(floor(blo) AS INTEGER) + 1, 0) AS j, bhi FROM w),
p AS (SELECT sample, period, CASE WHEN i < ahi AND i < 60 THEN i END AS li,
             CASE WHEN j < bhi AND j < 80 THEN j END AS lj FROM k)
SELECT p.sample, g.value
FROM p LEFT JOIN grid g ON g.product = 'N' AND g.period = p.period AND g.lat_idx = p.li AND g.lon_idx = p.lj
""")
def grid_window_cell(spark, sf_dir):
    return gr.grid_window_cell(_points(spark, sf_dir), b.grid(spark, sf_dir), "sample", "lat", "lon", LAT, LON,
                               0.2, keys=["product", "period"], point_keys=_keys("N"))


# ----------------------------------------------------------------- G-06 (J-13 + F-19)
@register("harmonic_nearest", sql=b.with_ctes(b.SQL_SAMPLES, b.SQL_CLIM) + """,
p AS (SELECT sample, CAST(dayofyear(sample_date) AS DOUBLE) AS doy,
             CAST(-20 - round_even(lat / 0.5, 0) AS INTEGER) AS li,
             CAST(round_even(lon / 0.5, 0) - 220 AS INTEGER) AS lj FROM samples)
SELECT p.sample, round(c.mean + c.an_cos * cos(p.doy * (2 * pi() / 366.0)) + c.an_sin * sin(p.doy * (2 * pi() / 366.0))
             + c.sa_cos * cos(2 * (p.doy * (2 * pi() / 366.0))) + c.sa_sin * sin(2 * (p.doy * (2 * pi() / 366.0))), 6)
         + 0.0 AS value
FROM p LEFT JOIN clim c ON c.lat_idx = p.li AND c.lon_idx = p.lj
""")
def harmonic_nearest(spark, sf_dir):
    s = b.samples(spark, sf_dir)
    p = s.select("sample", F.dayofyear("sample_date").cast("double").alias("doy"),
                 (F.lit(-20) - gr.node_key("lat", 0.5)).cast("int").alias("lat_idx"),
                 (gr.node_key("lon", 0.5) - 220).cast("int").alias("lon_idx"))
    j = p.join(b.clim(spark, sf_dir), ["lat_idx", "lon_idx"], "left")
    return rounded(j.select("sample", harmonic("doy", "mean", "an_cos", "an_sin", "sa_cos", "sa_sin").alias("value")))


# ----------------------------------------------------------------- G-07 bilinear climatology
@register("harmonic_bilinear", sql=b.with_ctes(b.SQL_SAMPLES, b.SQL_CLIM, _PTS) + "," + _CORNERS + """,
v AS (SELECT c.sample, c.w, CAST(dayofyear(c.sample_date) AS DOUBLE) * (2 * pi() / 366.0) AS t, k.*
      FROM c LEFT JOIN clim k ON k.lat_idx = c.li AND k.lon_idx = c.lj)
SELECT sample, CASE WHEN count(*) = count(lat_idx) THEN
         round(sum(w * (mean + an_cos * cos(t) + an_sin * sin(t) + sa_cos * cos(2 * t) + sa_sin * sin(2 * t))), 6) + 0.0
       END AS value
FROM v GROUP BY sample
""")
def harmonic_bilinear(spark, sf_dir):
    p = b.samples(spark, sf_dir).withColumn("doy", F.dayofyear("sample_date").cast("double"))

    def corner():
        return harmonic("doy", "__g_mean", "__g_an_cos", "__g_an_sin", "__g_sa_cos", "__g_sa_sin")

    r = gr.grid_bilinear(p, b.clim(spark, sf_dir), "sample", "lat", "lon", LAT, LON, corner_value=corner,
                         grid_cols=["mean", "an_cos", "an_sin", "sa_cos", "sa_sin"])
    return rounded(r)


# ----------------------------------------------------------------- G-13 regrid to half step
@register("regrid", sql=b.with_ctes(b.SQL_GRID) + """,
t AS (SELECT g.product, g.period, 2 * g.lat_idx + a AS flat, 2 * g.lon_idx + c AS flon
      FROM grid g, range(0, 2) x(a), range(0, 2) y(c)),
p AS (SELECT product, period, flat, flon, flat / 2.0 AS fi, flon / 2.0 AS fj FROM t),
q AS (SELECT product, period, flat, flon, CAST(floor(fi) AS INTEGER) AS i0, CAST(floor(fj) AS INTEGER) AS j0,
             fi - floor(fi) AS ti, fj - floor(fj) AS tj FROM p),
c AS (SELECT product, period, flat, flon, i0 AS li, j0 AS lj, (1.0 - ti) * (1.0 - tj) AS w FROM q
      UNION ALL SELECT product, period, flat, flon, i0, j0 + 1, (1.0 - ti) * tj FROM q WHERE tj > 0
      UNION ALL SELECT product, period, flat, flon, i0 + 1, j0, ti * (1.0 - tj) FROM q WHERE ti > 0
      UNION ALL SELECT product, period, flat, flon, i0 + 1, j0 + 1, ti * tj FROM q WHERE ti > 0 AND tj > 0)
SELECT c.product, c.period, CAST(c.flat AS INTEGER) AS fine_lat_idx, CAST(c.flon AS INTEGER) AS fine_lon_idx,
       CASE WHEN count(*) = count(g.value) THEN round(sum(c.w * g.value), 6) + 0.0 END AS value
FROM c LEFT JOIN grid g ON g.product = c.product AND g.period = c.period AND g.lat_idx = c.li AND g.lon_idx = c.lj
GROUP BY c.product, c.period, c.flat, c.flon
""")
def regrid(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    fine_lat = gr.Axis(LAT.origin, LAT.step / 2, 2 * LAT.n)
    fine_lon = gr.Axis(LON.origin, LON.step / 2, 2 * LON.n)
    two = F.sequence(F.lit(0), F.lit(1))
    t = (g.select("product", "period", "lat_idx", "lon_idx")
         .withColumn("__a", F.explode(two)).withColumn("__c", F.explode(two))
         .withColumn("fine_lat_idx", 2 * F.col("lat_idx") + F.col("__a"))
         .withColumn("fine_lon_idx", 2 * F.col("lon_idx") + F.col("__c"))
         .select("product", "period", "fine_lat_idx", "fine_lon_idx")
         .withColumn("lat", fine_lat.value("fine_lat_idx")).withColumn("lon", fine_lon.value("fine_lon_idx"))
         .withColumn("__id", F.struct("product", "period", "fine_lat_idx", "fine_lon_idx")))
    r = gr.grid_bilinear(t, g, "__id", "lat", "lon", LAT, LON, keys=["product", "period"])
    return rounded(r.select("__id.*", "value"))


# ----------------------------------------------------------------- A-23
@register("grid_coarsen", sql=b.with_ctes(b.SQL_GRID) + """
SELECT product, period, CAST(floor(lat_idx / 4) AS INTEGER) AS lat_idx, CAST(floor(lon_idx / 4) AS INTEGER) AS lon_idx,
       round(avg(value), 6) + 0.0 AS value
FROM grid GROUP BY 1, 2, 3, 4
""")
def grid_coarsen(spark, sf_dir):
    return rounded(gr.grid_coarsen(b.grid(spark, sf_dir), 4, keys=["product", "period"]))


# ----------------------------------------------------------------- A-24
@register("grid_trend", sql=b.with_ctes(b.SQL_GRID) + """,
t0 AS (SELECT min(yr) AS t0 FROM grid)
SELECT product, lat_idx, lon_idx,
       CASE WHEN max(CASE WHEN yr = (SELECT t0 FROM t0) THEN CASE WHEN value IS NULL THEN 1 ELSE 0 END END) = 0
            THEN round(regr_slope(value, CAST(yr AS DOUBLE)), 6) + 0.0 END AS slope
FROM grid GROUP BY product, lat_idx, lon_idx
""")
def grid_trend(spark, sf_dir):
    return rounded(gr.grid_trend(b.grid(spark, sf_dir), "yr", keys=["product"]))


# ----------------------------------------------------------------- A-22 / P-13 / G-04
@register("grid_area_series", sql=b.with_ctes(b.SQL_GRID) + """
SELECT product, period, round(avg(value), 6) + 0.0 AS value, count(value) AS n_cells FROM grid
WHERE -10.0 + CAST(lat_idx AS DOUBLE) * -0.5 BETWEEN -20.0 AND -15.0
  AND 110.0 + CAST(lon_idx AS DOUBLE) * 0.5 BETWEEN 120.0 AND 130.0
GROUP BY product, period
""")
def grid_area_series(spark, sf_dir):
    return rounded(gr.grid_area_series(b.grid(spark, sf_dir), LAT, LON, (-20.0, -15.0), (120.0, 130.0),
                                       keys=["product", "period"]))


# ----------------------------------------------------------------- G-01..G-03 multi-product match-up
@register("satellite_matchup", sql=_G + """,
p AS (SELECT sample, period,
             least(greatest(CAST(floor(fi + 0.5) AS INTEGER), 0), 59) - 1 AS i0,
             least(greatest(CAST(floor(fj + 0.5) AS INTEGER), 0), 79) - 1 AS j0 FROM pts),
c AS (SELECT sample, period, i0 + di AS li, j0 + dj AS lj FROM p, range(0, 2) a(di), range(0, 2) b(dj)
      WHERE i0 + di BETWEEN 0 AND 59 AND j0 + dj BETWEEN 0 AND 79),
m AS (SELECT c.sample, g.product, avg(g.value) AS v
      FROM c JOIN grid g ON g.period = c.period AND g.lat_idx = c.li AND g.lon_idx = c.lj GROUP BY 1, 2)
SELECT s.sample,
       round(max(v) FILTER (WHERE product = 'A'), 6) + 0.0 AS "A",
       round(max(v) FILTER (WHERE product = 'N'), 6) + 0.0 AS "N",
       round(max(v) FILTER (WHERE product = 'R'), 6) + 0.0 AS "R"
FROM samples s LEFT JOIN m USING (sample) GROUP BY s.sample
""")
def satellite_matchup(spark, sf_dir):
    s = b.samples(spark, sf_dir)
    r = gr.match_products(s, b.grid(spark, sf_dir), "sample", "lat", "lon", "sample_date", LAT, LON,
                          ["A", "N", "R"], "1y", 2)
    return rounded(r)


# ----------------------------------------------------------------- G-01 / G-02 / F-14 / F-21, the other resolutions
def _matchup_sql(res: str) -> str:
    cols = ", ".join(f"round(max(v) FILTER (WHERE product = '{p}'), 6) + 0.0 AS \"{p}_{res}\"" for p in ("A", "N", "R"))
    return b.with_ctes(b.SQL_SAMPLES, b.sql_grid_at(res), _PTS) + f""",
p AS (SELECT sample, {b.PERIOD_SQL[res].format("sample_date")} AS period,
             least(greatest(CAST(floor(fi + 0.5) AS INTEGER), 0), 59) - 1 AS i0,
             least(greatest(CAST(floor(fj + 0.5) AS INTEGER), 0), 79) - 1 AS j0 FROM pts),
c AS (SELECT sample, period, i0 + di AS li, j0 + dj AS lj FROM p, range(0, 3) a(di), range(0, 3) b(dj)),
m AS (SELECT c.sample, g.product, avg(g.value) AS v
      FROM c JOIN grid_at g ON g.period = c.period AND g.lat_idx = c.li AND g.lon_idx = c.lj GROUP BY 1, 2)
SELECT s.sample, {cols}
FROM samples s LEFT JOIN m USING (sample) GROUP BY s.sample
"""


def _matchup(name: str, res: str) -> None:
    @register(name, sql=_matchup_sql(res))
    def run(spark, sf_dir):
        return rounded(gr.match_products(b.samples(spark, sf_dir), b.grid_at(spark, sf_dir, res), "sample", "lat", "lon",
                                         "sample_date", LAT, LON, ["A", "N", "R"], res, 3, named=True))


for _name, _res in (("satellite_matchup_daily", "1d"), ("satellite_matchup_monthly", "1m"),
                    ("satellite_matchup_month_of_year", "1mNy"), ("satellite_matchup_all_years", "12mNy")):
    _matchup(_name, _res)


# ----------------------------------------------------------------- G-03 (+ J-08) altimetry match-up
@register("altimetry_matchup", sql=b.with_ctes(b.SQL_SAMPLES, b.SQL_ALT) + """,
p AS (SELECT sample, CAST(year(sample_date) AS VARCHAR) AS period, CAST(dayofyear(sample_date) AS INTEGER) AS doy,
             least(greatest(CAST(floor((lat - (-10.0)) / (-0.5) + 0.5) AS INTEGER), 0), 59) - 1 AS i0,
             least(greatest(CAST(floor((lon - 110.0) / 0.5 + 0.5) AS INTEGER), 0), 79) - 1 AS j0 FROM samples),
ax AS (SELECT DISTINCT period, doy AS a FROM alt),
k AS (SELECT DISTINCT period, doy FROM p),
nd AS (SELECT k.period, k.doy, arg_min(ax.a, abs(ax.a - k.doy) * 1000 + ax.a) AS s
       FROM k JOIN ax USING (period) GROUP BY k.period, k.doy),
c AS (SELECT p.sample, p.period, nd.s, p.i0, p.j0, p.i0 + di AS li, p.j0 + dj AS lj
      FROM p LEFT JOIN nd USING (period, doy), range(0, 3) x(di), range(0, 3) y(dj))
SELECT c.sample, round(avg(g.GSLA), 6) + 0.0 AS GSLA, round(avg(g.GSL), 6) + 0.0 AS GSL,
       round(avg(g.UCUR), 6) + 0.0 AS UCUR, round(avg(g.VCUR), 6) + 0.0 AS VCUR,
       round(110.0 + CAST(c.j0 AS DOUBLE) * 0.5, 6) + 0.0 AS Longitude_Actual,
       round(-10.0 + CAST(c.i0 AS DOUBLE) * -0.5, 6) + 0.0 AS Latitude_Actual
FROM c LEFT JOIN alt g ON g.period = c.period AND g.doy = c.s AND g.lat_idx = c.li AND g.lon_idx = c.lj
GROUP BY c.sample, c.i0, c.j0
""")
def altimetry_matchup(spark, sf_dir):
    r = gr.match_altimetry(b.samples(spark, sf_dir), b.alt_grid(spark, sf_dir), "sample", "lat", "lon",
                           "sample_date", LAT, LON, ["GSLA", "GSL", "UCUR", "VCUR"], n=3)
    return rounded(r)


# ----------------------------------------------------------------- irregular axes: J-07, J-10, J-11, J-12, G-13
# The same layers on axes whose steps widen towards the south and east; the grid carries its own coordinates,
# and the operators take the axes from it.
_LAT_NODE, _LON_NODE = "-10.0 - 0.375 * {0} - 0.00390625 * {0} * {0}", "110.0 + 0.25 * {0} + 0.0078125 * {0} * {0}"
_NODES = f""",
la AS (SELECT CAST(i AS INTEGER) AS i, {_LAT_NODE.format("i")} AS x FROM range(0, 60) t(i)),
lo AS (SELECT CAST(i AS INTEGER) AS i, {_LON_NODE.format("i")} AS x FROM range(0, 80) t(i))"""


def _widening(spark, sf_dir):
    """The layers with their coordinates, and the two axes read from them."""
    i, j = F.col("lat_idx").cast("double"), F.col("lon_idx").cast("double")
    g = b.grid(spark, sf_dir).withColumns({"lat": F.lit(-10.0) - F.lit(0.375) * i - F.lit(0.00390625) * i * i,
                                           "lon": F.lit(110.0) + F.lit(0.25) * j + F.lit(0.0078125) * j * j})
    return g, gr.axis_of(g, "lat_idx", "lat"), gr.axis_of(g, "lon_idx", "lon")


def _lookup_sql(lat: str, lon: str) -> str:
    return _G + _NODES + f""",
a AS (SELECT lat, {lat} AS li FROM (SELECT DISTINCT lat FROM pts)),
o AS (SELECT lon, {lon} AS lj FROM (SELECT DISTINCT lon FROM pts))
SELECT p.sample, a.li AS lat_idx, o.lj AS lon_idx, g.value
FROM pts p JOIN a USING (lat) JOIN o USING (lon)
LEFT JOIN grid g ON g.product = 'N' AND g.period = p.period AND g.lat_idx = a.li AND g.lon_idx = o.lj
"""


def _cell(spark, sf_dir, index):
    g, la, lo = _widening(spark, sf_dir)
    p = _points(spark, sf_dir).withColumns({"lat_idx": index(la, "lat"), "lon_idx": index(lo, "lon")})
    cells = g.where(F.col("product") == "N").select("period", "lat_idx", "lon_idx", "value")
    return p.join(cells, ["period", "lat_idx", "lon_idx"], "left").select("sample", "lat_idx", "lon_idx", "value")


@register("grid_nearest_irregular", sql=_lookup_sql("(SELECT i FROM la ORDER BY abs(x - lat), i DESC LIMIT 1)",
                                                    "(SELECT i FROM lo ORDER BY abs(x - lon), i DESC LIMIT 1)"))
def grid_nearest_irregular(spark, sf_dir):
    g, la, lo = _widening(spark, sf_dir)
    r = gr.grid_nearest(_points(spark, sf_dir), g, "sample", "lat", "lon", la, lo, keys=["product", "period"], point_keys=_keys("N"))
    return r.select("sample", "lat_idx", "lon_idx", "value")


@register("grid_edge_irregular", sql=_lookup_sql("coalesce((SELECT max(i) FROM la WHERE x >= lat), -1)",
                                                 "coalesce((SELECT max(i) FROM lo WHERE x <= lon), -1)"))
def grid_edge_irregular(spark, sf_dir):
    return _cell(spark, sf_dir, lambda axis, x: axis.floor_index(x))


@register("grid_window_irregular", sql=_lookup_sql("(SELECT min(i) FROM la WHERE x > lat - 0.3 AND x < lat + 0.3)",
                                                   "(SELECT min(i) FROM lo WHERE x > lon - 0.3 AND x < lon + 0.3)"))
def grid_window_irregular(spark, sf_dir):
    return _cell(spark, sf_dir, lambda axis, x: gr.window_index(axis, x, 0.3))


# nodes around a coordinate: (index, weight); one node where the coordinate is on it, none beyond the ends
_AROUND = """{0}axis AS (SELECT i, x, lead(x) OVER (ORDER BY i) AS nx FROM {1}),
{0}w AS (SELECT c.{2} AS c, n.i AS i, 1.0 - (CASE WHEN c.{2} = x THEN 0.0 ELSE (c.{2} - x) / (nx - x) END) AS w FROM (SELECT DISTINCT {2} FROM {3}) c
         JOIN {0}axis n ON c.{2} = x OR (c.{2} > least(x, nx) AND c.{2} < greatest(x, nx))
       UNION ALL SELECT c.{2}, n.i + 1, (c.{2} - x) / (nx - x) FROM (SELECT DISTINCT {2} FROM {3}) c
         JOIN {0}axis n ON c.{2} > least(x, nx) AND c.{2} < greatest(x, nx))"""


@register("grid_bilinear_irregular", sql=_G + _NODES + "," + _AROUND.format("a", "la", "lat", "pts") + "," + _AROUND.format("o", "lo", "lon", "pts") + """,
c AS (SELECT p.sample, p.period, aw.i AS li, ow.i AS lj, aw.w * ow.w AS w FROM pts p JOIN aw ON aw.c = p.lat JOIN ow ON ow.c = p.lon)
SELECT s.sample, CASE WHEN count(c.w) > 0 AND count(c.w) = count(g.value) THEN round(sum(c.w * g.value), 6) + 0.0 END AS value
FROM samples s LEFT JOIN c USING (sample)
LEFT JOIN grid g ON g.product = 'A' AND g.period = c.period AND g.lat_idx = c.li AND g.lon_idx = c.lj
GROUP BY s.sample
""")
def grid_bilinear_irregular(spark, sf_dir):
    g, la, lo = _widening(spark, sf_dir)
    return rounded(gr.grid_bilinear(_points(spark, sf_dir), g, "sample", "lat", "lon", la, lo, keys=["product", "period"],
                                    point_keys=_keys("A")))


@register("regrid_irregular", sql=b.with_ctes(b.SQL_GRID) + _NODES + """,
ta AS (SELECT CAST(j AS INTEGER) AS j, -10.0 + j * -0.3 AS lat FROM range(0, 120) t(j)),
tb AS (SELECT CAST(j AS INTEGER) AS j, 110.0 + j * 0.3 AS lon FROM range(0, 160) t(j)),""" + _AROUND.format("a", "la", "lat", "ta") + ","
          + _AROUND.format("o", "lo", "lon", "tb") + """,
an AS (SELECT ta.j, aw.i, aw.w, count(*) OVER (PARTITION BY ta.j) AS n FROM ta JOIN aw ON aw.c = ta.lat),
bn AS (SELECT tb.j, ow.i, ow.w, count(*) OVER (PARTITION BY tb.j) AS n FROM tb JOIN ow ON ow.c = tb.lon)
SELECT g.product, g.period, an.j AS lat_idx, bn.j AS lon_idx,
       CASE WHEN count(g.value) = max(an.n * bn.n) THEN round(sum(an.w * bn.w * g.value), 6) + 0.0 END AS value
FROM grid g JOIN an ON an.i = g.lat_idx JOIN bn ON bn.i = g.lon_idx
GROUP BY g.product, g.period, an.j, bn.j
""")
def regrid_irregular(spark, sf_dir):
    g, la, lo = _widening(spark, sf_dir)
    return rounded(gr.regrid(g, la, lo, gr.Axis(-10.0, -0.3, 120), gr.Axis(110.0, 0.3, 160), keys=["product", "period"]))


# ----------------------------------------------------------------- K-06 -> S-20 -> G-01: layers stored, pruned by what the points ask for
@register("satellite_matchup_layers", sql=_matchup_sql("1y"))
def satellite_matchup_layers(spark, sf_dir):
    """Yearly layers are written clustered in both axes; the match-up reads the layers of its points' years only."""
    path = f"{checkpoint_dir(spark)}/grid-layers-{uuid.uuid4()}"
    write_grid(b.grid_at(spark, sf_dir, "1y").withColumn("resolution", F.lit("1y")), path)
    s = b.samples(spark, sf_dir)
    schema = "lat_idx int, lon_idx int, value double, product string, resolution string, period string"
    layers = read_grid(spark, path, ["A", "N", "R"], asked_periods(s, gr.period_key("sample_date", "1y")), "1y", schema)
    return rounded(gr.match_products(s, layers, "sample", "lat", "lon", "sample_date", LAT, LON, ["A", "N", "R"], "1y", 3, named=True))


# ----------------------------------------------------------------- R-14 the map of an area (P-13 + A-23 + log10)
@register("area_map_log", sql=b.with_ctes(b.SQL_GRID) + """,
c AS (SELECT product, period, -10.0 + CAST(lat_idx AS DOUBLE) * -0.5 AS lat, 110.0 + CAST(lon_idx AS DOUBLE) * 0.5 AS lon, lat_idx, lon_idx, value FROM grid),
k AS (SELECT *, CAST((lat_idx - 10) // 4 AS INTEGER) AS lat_block, CAST((lon_idx - 20) // 4 AS INTEGER) AS lon_block FROM c
      WHERE lat BETWEEN -30.0 AND -15.0 AND lon BETWEEN 120.0 AND 140.0)
SELECT product, period, lat_block, lon_block, round(avg(lat), 6) + 0.0 AS lat, round(avg(lon), 6) + 0.0 AS lon, round(avg(value), 6) + 0.0 AS value,
       round(log10(avg(value)), 6) + 0.0 AS log10
FROM k GROUP BY product, period, lat_block, lon_block
""")
def area_map_log(spark, sf_dir):
    return rounded(gr.area_map(b.grid(spark, sf_dir), LAT, LON, (-30.0, -15.0), (120.0, 140.0), 4, keys=["product", "period"]))
