"""Domain views over the driver's test tables.

Each view exists twice: as a Spark DataFrame builder and as a SQL CTE for the
DuckDB oracle.  Both must define the same rows; the oracle side is written as
plain SQL, independently of the operators it checks.

* ``samples``   orders: sample = o_orderkey, station = o_custkey % 10,
                sample_date = o_orderdate, lat/lon derived from the keys.
* ``obs``       lineitem x part: taxon = p_name, genus/species = words 1/2,
                grp = p_type, value = l_quantity, biovolume = l_extendedprice,
                flag = l_linenumber.
* ``changelog`` taxa of genus ``blue``/``hot`` read from part, parent
                ``old <species>``, start date from the name.
* ``profile``   events: cast = user + day, depth = props.k + quarter steps, temp = value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------- samples
def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("sample"),
        (F.col("o_custkey") % 10).alias("station"),
        F.col("o_orderdate").alias("sample_date"),
        (F.lit(-10.0) - (F.col("o_custkey") % 30).cast("double") - (F.col("o_orderkey") % 10).cast("double") / 10.0).alias("lat"),
        (F.lit(110.0) + (F.col("o_custkey") % 40).cast("double") + (F.col("o_orderkey") % 7).cast("double") / 10.0).alias("lon"),
        F.col("o_orderstatus").alias("sample_type"),
        F.col("o_totalprice").alias("biomass"),
    )


SQL_SAMPLES = """samples AS (
  SELECT o_orderkey AS sample, o_custkey % 10 AS station, o_orderdate AS sample_date,
         -10.0 - CAST(o_custkey % 30 AS DOUBLE) - CAST(o_orderkey % 10 AS DOUBLE) / 10.0 AS lat,
         110.0 + CAST(o_custkey % 40 AS DOUBLE) + CAST(o_orderkey % 7 AS DOUBLE) / 10.0 AS lon,
         o_orderstatus AS sample_type, o_totalprice AS biomass
  FROM orders)"""


# --------------------------------------------------------------------------- obs
def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return j.select(
        F.col("l_orderkey").alias("sample"),
        F.col("p_name").alias("taxon"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("genus"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("species"),
        F.col("p_type").alias("grp"),
        F.col("l_quantity").alias("value"),
        F.col("l_extendedprice").alias("biovolume"),
        F.col("l_linenumber").alias("flag"),
        F.col("l_discount").alias("discount"),
        F.col("p_size").cast("double").alias("size_mm"),
    )


SQL_OBS = """obs AS (
  SELECT l_orderkey AS sample, p_name AS taxon,
         split_part(p_name, ' ', 1) AS genus, split_part(p_name, ' ', 2) AS species,
         p_type AS grp, l_quantity AS value, l_extendedprice AS biovolume,
         l_linenumber AS flag, l_discount AS discount, CAST(p_size AS DOUBLE) AS size_mm
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


# --------------------------------------------------------------------------- changelog
# Fixed values of the binding: genera whose taxa form the change log.
CHANGELOG_GENERA = ("blue", "hot")


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    g = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    sp = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    days = (F.ascii(sp) - 97) * 90 + (F.length(g) - 3) * 30
    return (p.where(g.isin(*CHANGELOG_GENERA)).select("p_name").distinct()
            .select(F.col("p_name").alias("taxon"),
                    F.date_add(F.lit("1995-01-01").cast("date"), days).cast("timestamp_ntz").alias("start_date"),
                    F.concat(F.lit("old "), sp).alias("parent")))


SQL_CHANGELOG = """changelog AS (
  SELECT p_name AS taxon,
         CAST(DATE '1995-01-01' + CAST((ascii(split_part(p_name, ' ', 2)) - 97) * 90
              + (length(split_part(p_name, ' ', 1)) - 3) * 30 AS INTEGER) AS TIMESTAMP) AS start_date,
         'old ' || split_part(p_name, ' ', 2) AS parent
  FROM (SELECT DISTINCT p_name FROM part WHERE split_part(p_name, ' ', 1) IN ('blue', 'hot')))"""


# --------------------------------------------------------------------------- profile
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("cast"),
        F.col("user_id").alias("station"),
        F.col("ts").alias("cast_time"),
        (F.get_json_object("props", "$.k").cast("double") + (F.col("event_id") % 4).cast("double") * 0.25).alias("depth"),
        F.when(F.col("user_id") % 7 == 0, F.lit(5.0)).otherwise(F.lit(10.0)).alias("ref_depth"),
        F.col("value").alias("temp"),
        (F.lit(30.0) + F.col("value") / 10.0).alias("salinity"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("chl"),
        F.col("event_type").alias("kind"),
        F.col("event_id").alias("row_id"),
    )


SQL_PROFILE = """profile AS (
  SELECT CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS "cast",
         user_id AS station, ts AS cast_time,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) + CAST(event_id % 4 AS DOUBLE) * 0.25 AS depth,
         CASE WHEN user_id % 7 = 0 THEN 5.0 ELSE 10.0 END AS ref_depth,
         value AS temp, 30.0 + value / 10.0 AS salinity,
         CASE WHEN event_type = 'error' THEN NULL ELSE value END AS chl,
         event_type AS kind, event_id AS row_id
  FROM events)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --------------------------------------------------------------------------- grids
# Gridded layers derived from lineitem: product = return flag, period = ship
# year, cell = (orderkey mod 60, partkey mod 80); value = mean quantity.
# Axes: lat = -10 - 0.5 i (60 nodes), lon = 110 + 0.5 j (80 nodes).
def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_returnflag").alias("product"),
                       F.year("l_shipdate").cast("string").alias("period"),
                       F.year("l_shipdate").alias("yr"),
                       (F.col("l_orderkey") % 60).cast("int").alias("lat_idx"),
                       (F.col("l_partkey") % 80).cast("int").alias("lon_idx"))
            .agg(F.avg("l_quantity").alias("value")))


SQL_GRID = """grid AS (
  SELECT l_returnflag AS product, CAST(year(l_shipdate) AS VARCHAR) AS period,
         CAST(year(l_shipdate) AS INTEGER) AS yr,
         CAST(l_orderkey % 60 AS INTEGER) AS lat_idx, CAST(l_partkey % 80 AS INTEGER) AS lon_idx,
         avg(l_quantity) AS value
  FROM lineitem GROUP BY ALL)"""


# The same layers at another resolution: the period is the key of that resolution.
def grid_at(spark: SparkSession, sf_dir: str, res: str) -> DataFrame:
    from pelagic.operators.grid import period_key

    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_returnflag").alias("product"), period_key("l_shipdate", res).alias("period"),
                       (F.col("l_orderkey") % 60).cast("int").alias("lat_idx"),
                       (F.col("l_partkey") % 80).cast("int").alias("lon_idx"))
            .agg(F.avg("l_quantity").alias("value")))


# DuckDB date formats of the period keys.
PERIOD_SQL = {"1d": "strftime({0}, '%Y-%m-%d')", "1m": "strftime({0}, '%Y-%m')", "1y": "strftime({0}, '%Y')",
              "1mNy": "strftime({0}, '%m')", "12mNy": "'all'"}


def sql_grid_at(res: str) -> str:
    return f"""grid_at AS (
  SELECT l_returnflag AS product, {PERIOD_SQL[res].format("l_shipdate")} AS period,
         CAST(l_orderkey % 60 AS INTEGER) AS lat_idx, CAST(l_partkey % 80 AS INTEGER) AS lon_idx,
         avg(l_quantity) AS value
  FROM lineitem GROUP BY ALL)"""


# Harmonic climatology coefficients per cell (same axes), from lineitem.
def clim(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy((F.col("l_orderkey") % 60).cast("int").alias("lat_idx"),
                       (F.col("l_partkey") % 80).cast("int").alias("lon_idx"))
            .agg(F.avg("l_quantity").alias("mean"), (F.avg("l_discount") * 10).alias("an_cos"),
                 (F.avg("l_tax") * 10).alias("an_sin"), (F.avg("l_linenumber") / 10).alias("sa_cos"),
                 (F.avg("l_discount") * -5).alias("sa_sin")))


SQL_CLIM = """clim AS (
  SELECT CAST(l_orderkey % 60 AS INTEGER) AS lat_idx, CAST(l_partkey % 80 AS INTEGER) AS lon_idx,
         avg(l_quantity) AS mean, avg(l_discount) * 10 AS an_cos, avg(l_tax) * 10 AS an_sin,
         avg(l_linenumber) / 10 AS sa_cos, avg(l_discount) * -5 AS sa_sin
  FROM lineitem GROUP BY ALL)"""


# Daily altimetry-like layers: period = ship year, slice = day of year, four measures.
def alt_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.year("l_shipdate").cast("string").alias("period"), F.dayofyear("l_shipdate").alias("doy"),
                       (F.col("l_orderkey") % 60).cast("int").alias("lat_idx"),
                       (F.col("l_partkey") % 80).cast("int").alias("lon_idx"))
            .agg(F.avg("l_discount").alias("GSLA"), F.avg("l_tax").alias("GSL"),
                 (F.avg("l_quantity") / 10).alias("UCUR"), (F.avg("l_extendedprice") / 10000).alias("VCUR")))


SQL_ALT = """alt AS (
  SELECT CAST(year(l_shipdate) AS VARCHAR) AS period, CAST(dayofyear(l_shipdate) AS INTEGER) AS doy,
         CAST(l_orderkey % 60 AS INTEGER) AS lat_idx, CAST(l_partkey % 80 AS INTEGER) AS lon_idx,
         avg(l_discount) AS GSLA, avg(l_tax) AS GSL, avg(l_quantity) / 10 AS UCUR, avg(l_extendedprice) / 10000 AS VCUR
  FROM lineitem GROUP BY ALL)"""
