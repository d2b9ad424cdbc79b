"""QC, replicate means, key spines, water-quality product (P-05..P-08, A-06, A-17, A-18, U-01, J-01, F-10, R-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.operators import qc
from pelagic.plans import bindings as b
from pelagic.plans import products as pr
from pelagic.plans.catalog import register, rounded


# chemistry-like view: (trip, depth text incl. 'WC') with two flagged measures
def chem(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem")
    depth = F.when(F.col("l_linenumber") == 7, F.lit("WC")).otherwise(((F.col("l_linenumber") % 3) * 10).cast("string"))
    return li.select(
        F.col("l_orderkey").alias("trip"), depth.alias("depth"),
        F.col("l_quantity").alias("silicate"), (F.col("l_partkey") % 10).cast("int").alias("silicate_flag"),
        F.col("l_extendedprice").alias("nitrate"), (F.col("l_suppkey") % 10).cast("int").alias("nitrate_flag"),
    )


SQL_CHEM = """chem AS (
  SELECT l_orderkey AS trip,
         CASE WHEN l_linenumber = 7 THEN 'WC' ELSE CAST((l_linenumber % 3) * 10 AS VARCHAR) END AS depth,
         l_quantity AS silicate, CAST(l_partkey % 10 AS INTEGER) AS silicate_flag,
         l_extendedprice AS nitrate, CAST(l_suppkey % 10 AS INTEGER) AS nitrate_flag
  FROM lineitem)"""

_MASKED = """masked AS (
  SELECT trip, depth,
         CASE WHEN silicate_flag IS NULL OR silicate_flag NOT IN (3, 4, 9) THEN silicate END AS silicate,
         CASE WHEN nitrate_flag IS NULL OR nitrate_flag NOT IN (3, 4, 9) THEN nitrate END AS nitrate
  FROM chem)"""


def _masked(spark, sf_dir):
    return qc.mask_flags(chem(spark, sf_dir), {"silicate": "silicate_flag", "nitrate": "nitrate_flag"})


# ----------------------------------------------------------------- P-05 + A-17
@register("qc_mask_replicate_mean", sql=b.with_ctes(SQL_CHEM, _MASKED) + """
SELECT trip, depth, round(avg(silicate), 6) + 0.0 AS silicate, round(avg(nitrate), 6) + 0.0 AS nitrate
FROM masked GROUP BY trip, depth
""")
def qc_mask_replicate_mean(spark, sf_dir):
    return rounded(qc.replicate_mean(_masked(spark, sf_dir), ["trip", "depth"], ["silicate", "nitrate"]))


# ----------------------------------------------------------------- P-06
@register("qc_keep", sql=b.with_ctes(SQL_CHEM) + """
SELECT trip, depth, round(avg(nitrate), 6) + 0.0 AS nitrate, count(*) AS n
FROM chem WHERE nitrate_flag IN (0, 1, 2, 5, 8) GROUP BY trip, depth
""")
def qc_keep(spark, sf_dir):
    k = qc.keep_flags(chem(spark, sf_dir), "nitrate_flag")
    return rounded(k.groupBy("trip", "depth").agg(F.avg("nitrate").alias("nitrate"), F.count(F.lit(1)).alias("n")))


# ----------------------------------------------------------------- A-18
@register("mean_of_means", sql=b.with_ctes(SQL_CHEM, _MASKED) + """,
d AS (SELECT trip, depth, avg(silicate) AS silicate, avg(nitrate) AS nitrate FROM masked GROUP BY trip, depth)
SELECT trip, round(avg(silicate), 6) + 0.0 AS silicate, round(avg(nitrate), 6) + 0.0 AS nitrate
FROM d GROUP BY trip
""")
def mean_of_means(spark, sf_dir):
    return rounded(qc.mean_of_means(_masked(spark, sf_dir), "trip", "depth", ["silicate", "nitrate"]))


# Fixed values of the binding: nine flagged chemistry measures (value, flag).
NUTRIENTS = {"silicate": ("l_quantity", "l_partkey % 10"), "phosphate": ("l_discount * 10", "l_orderkey % 10"),
             "ammonium": ("l_tax * 100", "(l_partkey + 1) % 10"), "nitrate": ("l_extendedprice", "l_suppkey % 10"),
             "nitrite": ("l_quantity / 16", "(l_suppkey + 3) % 10"), "oxygen": ("l_extendedprice / 128", "l_linenumber + 1"),
             "dic": ("2000 + l_quantity", "l_partkey % 7"), "alkalinity": ("2300 + l_discount * 100", "l_suppkey % 7"),
             "salinity": ("35 + l_tax", "l_orderkey % 7")}


def nutrients(spark, sf_dir):
    """All chemistry measures per (trip, depth), bad ones masked."""
    li = b.table(spark, sf_dir, "lineitem")
    depth = F.when(F.col("l_linenumber") == 7, F.lit("WC")).otherwise(((F.col("l_linenumber") % 3) * 10).cast("string"))
    c = li.select(F.col("l_orderkey").alias("trip"), depth.alias("depth"), *[F.expr(v).cast("double").alias(n) for n, (v, _) in NUTRIENTS.items()],
                  *[F.expr(f).cast("int").alias(f"{n}_flag") for n, (_, f) in NUTRIENTS.items()])
    return qc.mask_flags(c, {n: f"{n}_flag" for n in NUTRIENTS})


SQL_CHEM9 = ("chem9 AS (SELECT l_orderkey AS trip, CASE WHEN l_linenumber = 7 THEN 'WC' ELSE CAST((l_linenumber % 3) * 10 AS VARCHAR) END AS depth, "
             + ", ".join(f"CASE WHEN {f} NOT IN (3, 4, 9) THEN CAST({v} AS DOUBLE) END AS {n}" for n, (v, f) in NUTRIENTS.items()) + " FROM lineitem)")


# ----------------------------------------------------------------- R-5 water quality
SQL_PIG = """pig AS (
  SELECT l_orderkey AS trip, CAST((l_linenumber % 2) * 20 AS VARCHAR) AS depth, l_tax * 100.0 AS chla
  FROM lineitem WHERE l_returnflag = 'R')"""


def pigments(spark, sf_dir):
    return b.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("trip"), ((F.col("l_linenumber") % 2) * 20).cast("string").alias("depth"),
        (F.col("l_tax") * 100.0).alias("chla"))


# Fixed values of the binding: the other sources, (return flag, depth step, depths, value columns).
_SOURCES = {"pico": ("A", 25, 3, {"prochlorococcus": "l_quantity", "synecochoccus": "l_extendedprice / 64", "picoeukaryotes": "l_discount * 1000"}),
            "tss": ("N", 20, 2, {"tss": "l_discount * 100", "inorganic": "l_tax * 100", "organic": "l_quantity / 32"})}
# The cast's depth is rounded to whole metres; its means only join keys that another source has.
_CTD = {"CTDDensity": "1020 + l_discount", "CTDTemperature": "l_quantity", "CTDConductivity": "l_tax * 10", "CTDSalinity": "35 + l_tax",
        "CTDChlF": "l_extendedprice / 4096", "CTDTurbidity": "l_discount * 8"}
_CTD_DEPTH = "l_linenumber * 5 + l_discount"
_KEYED = [("chem9", list(NUTRIENTS)), ("pig", ["chla"]), ("wc", ["biomass", "secchi"]), *[(n, list(v[3])) for n, v in _SOURCES.items()]]


def _water_sql() -> str:
    every = [*_KEYED, ("ctd", list(_CTD))]
    ctes = [b.SQL_SAMPLES, SQL_CHEM9, SQL_PIG,
            "wc AS (SELECT o_orderkey AS trip, 'WC' AS depth, o_totalprice / 16384.0 AS biomass, o_totalprice / 65536.0 AS secchi FROM orders)"]
    for name, (flag, step, n, values) in _SOURCES.items():
        columns = ", ".join(f"CAST({v} AS DOUBLE) AS {c}" for c, v in values.items())
        ctes.append(f"{name} AS (SELECT l_orderkey AS trip, CAST((l_linenumber % {n}) * {step} AS VARCHAR) AS depth, {columns} "
                    f"FROM lineitem WHERE l_returnflag = '{flag}')")
    columns = ", ".join(f"CAST({v} AS DOUBLE) AS {c}" for c, v in _CTD.items())
    ctes.append(f"ctd AS (SELECT l_orderkey AS trip, CAST(CAST(round_even({_CTD_DEPTH}, 0) AS BIGINT) AS VARCHAR) AS depth, {columns} FROM lineitem)")
    for name, values in every:
        means = ", ".join(f"avg({v}) AS {v}" for v in values)
        ctes.append(f"m_{name} AS (SELECT trip, depth, {means} FROM {name} GROUP BY trip, depth)")
    spine = " UNION ".join(f"SELECT trip, depth FROM {name}" for name, _ in _KEYED)
    columns = ", ".join(f"round(m_{name}.{v}, 6) + 0.0 AS {v}" for name, values in every for v in values)
    joins = " ".join(f"LEFT JOIN m_{name} ON m_{name}.trip = k.trip AND m_{name}.depth = k.depth" for name, _ in every)
    code = "CASE WHEN regexp_full_match(k.depth, '[0-9]+') AND length(k.depth) < 3 THEN lpad(k.depth, 3, '0') ELSE k.depth END"
    return (b.with_ctes(*ctes, f"k AS ({spine})") + f"SELECT k.trip, k.depth, 'NRS' || CAST(k.trip AS VARCHAR) || '_' || {code} AS sample_code, "
            f"s.station, s.sample_date, s.lat, s.lon, {columns} FROM k {joins} LEFT JOIN samples s ON s.sample = k.trip")


# ----------------------------------------------------------------- R-5, all columns of the product
@register("water_quality", bench=True, sql=_water_sql())
def water_quality(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem")
    wc = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trip"), F.lit("WC").alias("depth"),
                                                 (F.col("o_totalprice") / 16384.0).alias("biomass"), (F.col("o_totalprice") / 65536.0).alias("secchi"))
    frames = {"chem9": nutrients(spark, sf_dir), "pig": pigments(spark, sf_dir), "wc": wc}
    for name, (flag, step, n, values) in _SOURCES.items():
        frames[name] = li.where(F.col("l_returnflag") == flag).select(
            F.col("l_orderkey").alias("trip"), ((F.col("l_linenumber") % n) * step).cast("string").alias("depth"),
            *[F.expr(v).cast("double").alias(c) for c, v in values.items()])
    cast = li.select(F.col("l_orderkey").alias("trip"), F.bround(F.expr(_CTD_DEPTH), 0).cast("long").cast("string").alias("depth"),
                     *[F.expr(v).cast("double").alias(c) for c, v in _CTD.items()])
    trips = b.samples(spark, sf_dir).withColumnRenamed("sample", "trip")
    return rounded(pr.water_quality(trips, [(frames[n], v) for n, v in _KEYED], attributes=["station", "sample_date", "lat", "lon"],
                                    attached=[(cast, list(_CTD))]), keep=("lat", "lon"))


# ----------------------------------------------------------------- A-06 audit
@register("dup_audit", sql="""
SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1
""")
def dup_audit(spark, sf_dir):
    return qc.duplicate_keys(b.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


# ----------------------------------------------------------------- W-05 / W-06
@register("first_per_key", sql="""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1
""")
def first_per_key(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return qc.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ----------------------------------------------------------------- P-07 / P-08 / P-11 / S-06
@register("qc_filters", sql="""
SELECT event_id, user_id, CASE WHEN value > 2.0 AND value < 40.0 THEN value END AS value
FROM events
WHERE props IS NOT NULL AND user_id NOT IN (3, 5, 7)
""")
def qc_filters(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select("event_id", "user_id", "value", "props")
    e = qc.drop_nulls(e, ["props"])
    e = qc.exclude_ids(e, "user_id", [3, 5, 7])
    e = qc.valid_range(e, "value", 2.0, 40.0)
    return e.select("event_id", "user_id", "value")
