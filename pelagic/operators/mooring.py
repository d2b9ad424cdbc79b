"""Mooring time-series products (S-21, S-22, S-24, A-20, A-21, A-26, A-27, P-14, K-02, G-19).

Series arrive long: (station, time, depth, temp).  Every product is one
grouped query with the station as a key instead of a per-station loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.functions.labels import depth_bin, whole_number_text

# Depth-bin edges of the mooring products (metres, right-closed).
DEPTH_EDGES = (0, 20, 40, 60, 80, 100)


def melt_matrix(df: DataFrame, ids: Sequence[str], values: str, depths: str, times: str) -> DataFrame:
    """S-21: a TEMP[depth, time] matrix stored per row as ``values`` (array of arrays, depth-major)
    with axis arrays ``depths`` and ``times`` -> long (ids, depth, time, temp), nulls dropped."""
    a = df.select(*ids, depths, times, F.posexplode(values).alias("__di", "__row"))
    b = a.select(*ids, F.col(depths)[F.col("__di")].alias("depth"), times,
                 F.posexplode("__row").alias("__ti", "temp"))
    return (b.select(*ids, "depth", F.col(times)[F.col("__ti")].alias("time"), "temp")
            .where(F.col("temp").isNotNull()))


def depth_bin_series(df: DataFrame, station: str, time: str, depth: str, temp: str,
                     edges: Sequence[float] = DEPTH_EDGES) -> DataFrame:
    """A-20: mean temperature per (station, depth bin, time); rows outside the bins dropped."""
    return (df.withColumn("depth_bin", depth_bin(depth, edges)).where(F.col("depth_bin").isNotNull())
            .groupBy(station, "depth_bin", time).agg(F.avg(temp).alias(temp)))


def doy_climatology(df: DataFrame, station: str, time: str, depth: str, temp: str,
                    edges: Sequence[float] = DEPTH_EDGES) -> DataFrame:
    """A-21: mean temperature per (station, depth bin, day of year) (D-20: DOY, not time stamp)."""
    return (df.withColumn("depth_bin", depth_bin(depth, edges)).where(F.col("depth_bin").isNotNull())
            .withColumn("doy", F.dayofyear(time))
            .groupBy(station, "depth_bin", "doy").agg(F.avg(temp).alias(temp)))


def depth_slice(df: DataFrame, station: str, time: str, depth: str, at_depth: float,
                start: str = "1970-01-01", end: str | None = None) -> DataFrame:
    """P-14: rows of one exact depth within [start, end] (end defaults to no upper bound)."""
    cond = (F.col(depth) == F.lit(at_depth)) & (F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (F.col(time) <= F.lit(end).cast("timestamp_ntz"))
    return df.where(cond)


def available_depths(df: DataFrame, station: str, depth: str) -> DataFrame:
    """P-14 fallback: the distinct depths a station offers (returned when a slice is empty)."""
    return df.select(station, depth).distinct()


def slice_or_depths(df: DataFrame, station: str, time: str, depth: str, values: Sequence[str], at_depth: float,
                    start: str = "1970-01-01", end: str | None = None) -> DataFrame:
    """P-14 / R-11: the slice of one exact depth, and for each station that does not offer it the depths it does.

    Columns: station, time, depth, ``values``, ``available`` (null on rows of the
    slice; else the station's depths, ascending, and all else null).  A station that
    offers the depth but has no row in the period answers with neither.
    """
    rows = depth_slice(df, station, time, depth, at_depth, start, end)
    offers = df.where(F.col(depth).isNotNull()).groupBy(station).agg(F.sort_array(F.collect_set(depth)).alias("available"))  # a station's depth axis
    offers = offers.where(~F.array_contains("available", F.lit(at_depth)))
    return rows.select(station, time, depth, *values).unionByName(offers, allowMissingColumns=True)


def series_summary(df: DataFrame, station: str, time: str, depth: str,
                   lat: str | None = None, lon: str | None = None) -> DataFrame:
    """A-26 / A-27: per station depth count and range, time coverage and position centre (D-18)."""
    aggs = [F.count_distinct(depth).alias("n_depths"), F.min(depth).alias("min_depth"),
            F.max(depth).alias("max_depth"), F.min(time).alias("time_start"), F.max(time).alias("time_end")]
    if lat and lon:
        aggs += [((F.min(lat) + F.max(lat)) / 2).alias("lat_centre"), ((F.min(lon) + F.max(lon)) / 2).alias("lon_centre")]
    return df.groupBy(station).agg(*aggs)


def product_file_name(df: DataFrame, station: str, time: str, depth: str, var: str = "TEMP") -> DataFrame:
    """K-02: ``<site>_<VAR>_<depth>m_<yyyyMMdd>-<yyyyMMdd>.csv`` per (station, depth) from the time range."""
    g = df.groupBy(station, depth).agg(F.min(time).alias("__a"), F.max(time).alias("__z"))
    name = F.concat(F.col(station).cast("string"), F.lit(f"_{var}_"), whole_number_text(depth), F.lit("m_"),
                    F.date_format("__a", "yyyyMMdd"), F.lit("-"), F.date_format("__z", "yyyyMMdd"), F.lit(".csv"))
    return g.select(station, depth, name.alias("file_name"))


def catalogue_pick(catalogue: DataFrame, site_col: str, url_col: str, pattern: str = "gridded_timeseries",
                   version: str | None = None) -> DataFrame:
    """S-22: per site the latest catalogue entry whose address matches ``pattern`` (null-safe regex).

    Latest by ``version`` (ties to the greater address), or by the address itself,
    whose names end in their creation date.
    """
    found = catalogue.where(F.coalesce(F.col(url_col).rlike(pattern), F.lit(False)))
    order = F.struct(F.col(version), F.col(url_col)) if version else F.col(url_col)
    return found.groupBy(site_col).agg(F.max_by(F.col(url_col), order).alias(url_col))


def local_linear(df: DataFrame, by: Sequence[str], x: str, y: str, half_width: int, out: str = "smooth") -> DataFrame:
    """G-19: tricube-weighted local-linear smoother on an integer axis (e.g. day of year).

    Points are first summed per (by, x); each such sum is copied to the 2h+1
    evaluation positions it can influence (bounded fan-out), then per (by, position)
    the weighted moments give the local-linear fit at that position.
    Evaluated at every position that has data within ``half_width``.
    """
    h = int(half_width)
    e = (df.select(*by, F.col(x).cast("long").alias("__x"), F.col(y).cast("double").alias("__y"))
         .groupBy(*by, "__x").agg(F.count(F.lit(1)).alias("__n"), F.sum("__y").alias("__y"))
         .withColumn("__off", F.explode(F.sequence(F.lit(-h), F.lit(h))))
         .withColumn("__at", F.col("__x") + F.col("__off")))
    u = F.abs(F.col("__off")).cast("double") / F.lit(float(h + 1))
    w = F.pow(F.lit(1.0) - F.pow(u, 3), 3)
    dx = (F.col("__x") - F.col("__at")).cast("double")
    wn = F.col("__w") * F.col("__n")
    m = e.withColumn("__w", w).groupBy(*by, "__at").agg(
        F.sum(wn).alias("s0"), F.sum(wn * dx).alias("s1"), F.sum(wn * dx * dx).alias("s2"),
        F.sum(F.col("__w") * F.col("__y")).alias("t0"), F.sum(F.col("__w") * dx * F.col("__y")).alias("t1"))
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    fit: Column = F.when(F.abs(det) > F.lit(1e-12), (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / det) \
        .otherwise(F.col("t0") / F.col("s0"))
    return m.select(*by, F.col("__at").cast("int").alias(x), fit.alias(out))
