"""Gridded products as long tables (J-07..J-13, F-14, F-19, A-22..A-24, G-01..G-13).

A grid is a long DataFrame ``(keys..., lat_idx, lon_idx, value)`` on two axes,
regular (:class:`Axis`) or of any sorted nodes (:class:`NodeAxis`); a layer is a
value of the key columns (product, period).  Every point lookup is turned into equi-joins on
integer cell indices: a point is exploded into the bounded set of cells it
needs (1 for nearest, n*n for a box, 4 for bilinear) and joined to the grid
on (keys, lat_idx, lon_idx).  The grid side is never broadcast as a whole;
Spark shuffles both sides on the cell key (or broadcasts when AQE measures
the grid to be small).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagic.functions.nulls import _c
from pelagic.functions.timeops import month_sequence
from pelagic.operators.axes import Axis, NodeAxis, axis_from, literal_array


AnyAxis = Axis | NodeAxis


def _join_cells(cells: DataFrame, grid: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    g = grid.select(*[F.col(k).alias(f"__g_{k}") for k in keys],
                    F.col("lat_idx").alias("__g_lat"), F.col("lon_idx").alias("__g_lon"),
                    F.col(value).alias("__v"))
    cond = (cells["__lat"] == g["__g_lat"]) & (cells["__lon"] == g["__g_lon"])
    for k in keys:
        cond = cond & (cells[f"__p_{k}"] == g[f"__g_{k}"])
    return cells.join(g, cond, "left")


def _point_keys(points: DataFrame, keys: Sequence[str], point_keys: dict[str, Column] | None) -> DataFrame:
    point_keys = point_keys or {}
    return points.withColumns({f"__p_{k}": point_keys.get(k, F.col(k)) for k in keys})


def grid_nearest(points: DataFrame, grid: DataFrame, pid: str, lat: str, lon: str, lat_axis: AnyAxis,
                 lon_axis: AnyAxis, keys: Sequence[str] = (), point_keys: dict[str, Column] | None = None,
                 value: str = "value", out: str = "value") -> DataFrame:
    """J-07 (+J-08 with a DOY key): value of the nearest cell, each axis searched independently."""
    p = _point_keys(points, keys, point_keys).withColumn("__lat", lat_axis.nearest(lat)) \
        .withColumn("__lon", lon_axis.nearest(lon))
    j = _join_cells(p, grid, keys, value)
    return j.select(*points.columns, F.col("__lat").alias("lat_idx"), F.col("__lon").alias("lon_idx"),
                    F.col("__v").alias(out))


def grid_box(points: DataFrame, grid: DataFrame, pid: str, lat: str, lon: str, lat_axis: AnyAxis, lon_axis: AnyAxis,
             n: int, keys: Sequence[str] = (), point_keys: dict[str, Column] | None = None,
             value: str = "value", out: str = "value") -> DataFrame:
    """J-09: mean of the n x n box starting at nearest - floor(n/2) (off-centre for even n, N-21).

    Cells past the border or missing are ignored, as are null values;
    a box with no value gives null.  Output: one row per point id.
    """
    half = n // 2
    offs = F.sequence(F.lit(0), F.lit(n - 1))
    p = (_point_keys(points, keys, point_keys)
         .withColumn("__i0", lat_axis.nearest(lat) - half).withColumn("__j0", lon_axis.nearest(lon) - half)
         .withColumn("__di", F.explode(offs)).withColumn("__dj", F.explode(offs))
         .withColumn("__lat", F.col("__i0") + F.col("__di")).withColumn("__lon", F.col("__j0") + F.col("__dj"))
         .where(lat_axis.inside(F.col("__lat")) & lon_axis.inside(F.col("__lon"))))
    j = _join_cells(p, grid, keys, value)
    return j.groupBy(pid).agg(F.avg("__v").alias(out))


def bilinear_corners(points: DataFrame, lat: str, lon: str, lat_axis: AnyAxis, lon_axis: AnyAxis) -> DataFrame:
    """J-12: the (up to) four surrounding nodes of each point with bilinear weights.

    A point on a grid line uses one node along that axis (D-09), so its
    value does not depend on a neighbour that may lie outside the grid.
    """
    (i0, ti), (j0, tj) = lat_axis.bracket(lat), lon_axis.bracket(lon)
    t, u = F.col("__ti"), F.col("__tj")
    corners = F.array(*[
        F.struct(F.lit(di).alias("di"), F.lit(dj).alias("dj"),
                 ((t if di else (F.lit(1.0) - t)) * (u if dj else (F.lit(1.0) - u))).alias("w"))
        for di in (0, 1) for dj in (0, 1)])
    p = points.withColumns({"__i0": i0, "__j0": j0, "__ti": ti, "__tj": tj}).withColumn("__c", F.explode(corners))
    keep = ((F.col("__c.di") == 0) | (F.col("__ti") > 0)) & ((F.col("__c.dj") == 0) | (F.col("__tj") > 0))
    return (p.where(keep)
            .withColumn("__lat", F.col("__i0") + F.col("__c.di")).withColumn("__lon", F.col("__j0") + F.col("__c.dj"))
            .withColumn("__w", F.col("__c.w")).drop("__c", "__i0", "__j0", "__ti", "__tj"))


def grid_bilinear(points: DataFrame, grid: DataFrame, pid: str, lat: str, lon: str, lat_axis: AnyAxis,
                  lon_axis: AnyAxis, keys: Sequence[str] = (), point_keys: dict[str, Column] | None = None,
                  value: str = "value", out: str = "value",
                  corner_value: Callable[[], Column] | None = None, grid_cols: Sequence[str] = ()) -> DataFrame:
    """J-12 / G-07 / G-08 / G-11 / G-13: bilinear interpolation; null if a needed corner is missing or null.

    ``corner_value`` may compute the corner value from joined grid columns
    (``grid_cols``, available as ``__g_<name>``) and point columns, e.g. a
    harmonic climatology evaluated at the point's day of year.
    """
    c = bilinear_corners(_point_keys(points, keys, point_keys), lat, lon, lat_axis, lon_axis)
    g = grid.select(*[F.col(k).alias(f"__g_{k}") for k in keys],
                    F.col("lat_idx").alias("__g_lat"), F.col("lon_idx").alias("__g_lon"),
                    *([F.col(value).alias("__v")] if corner_value is None else []),
                    *[F.col(x).alias(f"__g_{x}") for x in grid_cols])
    cond = (c["__lat"] == g["__g_lat"]) & (c["__lon"] == g["__g_lon"])
    for k in keys:
        cond = cond & (c[f"__p_{k}"] == g[f"__g_{k}"])
    j = c.join(g, cond, "left")
    if corner_value is not None:
        j = j.withColumn("__v", F.when(F.col("__g_lat").isNotNull(), corner_value()))
    agg = j.groupBy(pid).agg(F.sum(F.col("__w") * F.col("__v")).alias("__s"),
                             F.count_if(F.col("__v").isNull()).alias("__miss"))
    return agg.select(pid, F.when(F.col("__miss") == 0, F.col("__s")).alias(out))


def grid_edge_cell(points: DataFrame, grid: DataFrame, pid: str, lat: str, lon: str, lat_axis: AnyAxis,
                   lon_axis: AnyAxis, keys: Sequence[str] = (), point_keys: dict[str, Column] | None = None,
                   value: str = "value", out: str = "value") -> DataFrame:
    """J-10: cell at the last lon node <= x and the last lat node on the point's side (floor indices)."""
    p = (_point_keys(points, keys, point_keys).withColumn("__lat", lat_axis.floor_index(lat))
         .withColumn("__lon", lon_axis.floor_index(lon)))
    j = _join_cells(p, grid, keys, value)
    return j.select(pid, F.col("__v").alias(out))


def window_index(axis: AnyAxis, x: str | Column, half_width: float) -> Column:
    """J-11: first node index strictly inside (x - hw, x + hw), or null."""
    return axis.first_within(x, half_width)


def grid_window_cell(points: DataFrame, grid: DataFrame, pid: str, lat: str, lon: str, lat_axis: AnyAxis,
                     lon_axis: AnyAxis, half_width: float, keys: Sequence[str] = (),
                     point_keys: dict[str, Column] | None = None, value: str = "value", out: str = "value") -> DataFrame:
    """J-11: value of the first cell whose node lies within the open half-width window on both axes."""
    p = (_point_keys(points, keys, point_keys).withColumn("__lat", window_index(lat_axis, lat, half_width))
         .withColumn("__lon", window_index(lon_axis, lon, half_width)))
    j = _join_cells(p, grid, keys, value)
    return j.select(pid, F.col("__v").alias(out))


def node_key(x: str | Column, step: float) -> Column:
    """J-13: nearest node by rounding half-even on the step (D-08: the step, not whole degrees)."""
    return F.bround(_c(x) / F.lit(step), 0).cast("long")


def grid_coarsen(grid: DataFrame, k: int, keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """A-23: mean of k x k blocks (nulls ignored)."""
    return (grid.groupBy(*keys, F.floor(F.col("lat_idx") / k).cast("int").alias("lat_idx"),
                         F.floor(F.col("lon_idx") / k).cast("int").alias("lon_idx"))
            .agg(F.avg(value).alias(value)))


def grid_trend(grid: DataFrame, t: str, keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """A-24: per cell least-squares slope of value on ``t``; null when the first layer is null (D-19).

    The first layer is the smallest ``t`` over the whole grid (one scalar).
    """
    t0 = grid.agg(F.min(t)).first()[0]
    first_null = F.max(F.when(F.col(t) == F.lit(t0), F.col(value).isNull().cast("int")))
    return (grid.groupBy(*keys, "lat_idx", "lon_idx")
            .agg(F.regr_slope(F.col(value), F.col(t).cast("double")).alias("__s"), first_null.alias("__fn"))
            .select(*keys, "lat_idx", "lon_idx", F.when(F.col("__fn") == 0, F.col("__s")).alias("slope")))


def grid_area_series(grid: DataFrame, lat_axis: AnyAxis, lon_axis: AnyAxis, lat_range: tuple[float, float],
                     lon_range: tuple[float, float], keys: Sequence[str], value: str = "value") -> DataFrame:
    """P-13 + A-22 / G-04: bounding-box subset, then the mean per layer (a point time series)."""
    la, lo = lat_axis.value("lat_idx"), lon_axis.value("lon_idx")
    box = la.between(*sorted(lat_range)) & lo.between(*sorted(lon_range))
    return grid.where(box).groupBy(*keys).agg(F.avg(value).alias(value), F.count(value).alias("n_cells"))


def area_map(grid: DataFrame, lat_axis: AnyAxis, lon_axis: AnyAxis, lat_range: tuple[float, float], lon_range: tuple[float, float],
             k: int, keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """R-14: the map of an area: box subset (P-13), means of k x k blocks from the box's first node on (A-23), and their log10.

    One row per layer and block with a value: keys, lat and lon (mean of the block's
    nodes that have a cell), ``value`` and ``log10`` (null for a value that is not positive).
    """
    def block(axis: AnyAxis, index: str, bounds: tuple[float, float]) -> tuple[Column, Column]:
        inside = [i for i, x in enumerate(axis.coordinates()) if min(bounds) <= x <= max(bounds)]
        first, last = (inside[0], inside[-1]) if inside else (0, -1)
        return F.col(index).between(first, last), F.floor((F.col(index) - F.lit(first)) / F.lit(k)).cast("int")

    (in_lat, by_lat), (in_lon, by_lon) = block(lat_axis, "lat_idx", lat_range), block(lon_axis, "lon_idx", lon_range)
    cells = grid.where(in_lat & in_lon).select(*keys, by_lat.alias("lat_block"), by_lon.alias("lon_block"), lat_axis.value("lat_idx").alias("__lat"),
                                               lon_axis.value("lon_idx").alias("__lon"), F.col(value).alias(value))
    means = cells.groupBy(*keys, "lat_block", "lon_block").agg(F.avg("__lat").alias("lat"), F.avg("__lon").alias("lon"), F.avg(value).alias(value))
    return means.where(F.col(value).isNotNull()).withColumn("log10", F.when(F.col(value) > 0, F.log10(value)))


def month_spine(series: DataFrame, keys: Sequence[str], start: str, end: str, period: str = "period") -> DataFrame:
    """G-04: a monthly series with every month from ``start`` to ``end`` for each key; months without a layer are null.

    The spine is the (few) distinct keys, each exploded over the month list.
    """
    months = F.transform(month_sequence(F.lit(start), F.lit(end)), lambda d: F.date_format(d, "yyyy-MM"))
    spine = series.select(*keys).distinct().withColumn(period, F.explode(months))
    return spine.join(series, [*keys, period], "left")


def axis_of(grid: DataFrame, index: str, coord: str) -> AnyAxis:
    """The axis of a grid's own coordinates, one per index (the nodes of one dimension): regular, or by its nodes."""
    rows = grid.groupBy(index).agg(F.min(coord).alias("a"), F.max(coord).alias("b")).where(F.col(index).isNotNull()).collect()
    if any(r["a"] != r["b"] for r in rows):
        raise ValueError(f"an index of {index} has several coordinates")
    return axis_from({r[index]: r["a"] for r in rows})


def _shares(axis: AnyAxis, to: AnyAxis) -> list[list[tuple[int, float, int]]]:
    """Per node of ``axis`` the nodes of ``to`` it helps to make: (target, weight, nodes the target needs)."""
    nodes = axis.coordinates()
    up = -1.0 if len(nodes) > 1 and nodes[1] < nodes[0] else 1.0
    rising = [v * up for v in nodes]
    out: list[list[tuple[int, float, int]]] = [[] for _ in nodes]
    for j, x in enumerate(to.coordinates()):
        k = bisect_right(rising, x * up) - 1
        if k < 0 or x * up > rising[-1]:
            continue  # beyond the source's ends
        t = (x * up - rising[k]) / (rising[k + 1] - rising[k]) if k + 1 < len(nodes) else 0.0
        if t == 0.0:  # on a node: no neighbour is needed (D-09)
            out[k].append((j, 1.0, 1))
        else:
            out[k].append((j, 1.0 - t, 2))
            out[k + 1].append((j, t, 2))
    return out


def regrid(grid: DataFrame, lat_axis: AnyAxis, lon_axis: AnyAxis, to_lat: AnyAxis, to_lon: AnyAxis,
           keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """G-13: every layer on the nodes of two other axes, bilinear between any sorted nodes.

    Each source cell is sent to the target cells it helps to make, with its
    weight, and they are summed per layer and target: one shuffle, combined
    map-side, no join.  Null if a needed source cell is missing or null; target
    cells beyond the source's ends, or without any source cell, have no row.
    """
    def sent(axis: AnyAxis, to: AnyAxis, index: str) -> Column:
        flat, ends = [], [0]
        for s in _shares(axis, to):
            flat += s
            ends.append(len(flat))
        i = F.col(index)
        first = F.get(literal_array(ends, "int"), i)
        many = F.get(literal_array(ends, "int"), i + 1) - first
        whole = F.arrays_zip(literal_array([f[0] for f in flat], "int").alias("j"), literal_array([f[1] for f in flat]).alias("w"),
                             literal_array([f[2] for f in flat], "int").alias("need"))
        return F.slice(whole, first + 1, many)

    near = (grid.select(*keys, F.col(value).alias("__v"), sent(lat_axis, to_lat, "lat_idx").alias("__a"), sent(lon_axis, to_lon, "lon_idx").alias("__b"))
            .withColumn("__a", F.explode("__a")).withColumn("__b", F.explode("__b")))
    sums = near.groupBy(*keys, F.col("__a.j").alias("lat_idx"), F.col("__b.j").alias("lon_idx")).agg(
        F.sum(F.col("__a.w") * F.col("__b.w") * F.col("__v")).alias("__s"), F.count("__v").alias("__n"),
        F.max(F.col("__a.need") * F.col("__b.need")).alias("__need"))
    return sums.select(*keys, "lat_idx", "lon_idx", F.when(F.col("__n") == F.col("__need"), F.col("__s")).alias(value))


def period_key(date: str | Column, res: str) -> Column:
    """F-14: resolution selector -> period key of a product layer.

    ``1d`` date, ``1m`` first of month, ``1y`` year, ``1mNy`` month of year
    (multi-year monthly climatology), ``12mNy`` the single all-year layer.
    Matched exactly (N-23).
    """
    d = _c(date).cast("date")
    keys = {
        "1d": F.date_format(d, "yyyy-MM-dd"),
        "1m": F.date_format(d, "yyyy-MM"),
        "1y": F.date_format(d, "yyyy"),
        "1mNy": F.date_format(d, "MM"),
        "12mNy": F.lit("all"),
    }
    if res not in keys:
        raise ValueError(f"unknown resolution {res!r}")
    return keys[res]


def match_products(points: DataFrame, grid: DataFrame, pid: str, lat: str, lon: str, date: str,
                   lat_axis: AnyAxis, lon_axis: AnyAxis, products: Sequence[str], res: str, n: int,
                   product_col: str = "product", period_col: str = "period", value: str = "value",
                   named: bool = False) -> DataFrame:
    """G-01 / G-02: box-mean match-up of every point for each product, one column per product.

    Points fan out to their n x n cells once; one join on (period, cell) meets
    every product's layer, and one conditional aggregation per point makes the
    columns.  A missing layer gives null (unmatched join) instead of an error.
    ``named`` calls the columns ``<product>_<resolution>`` (F-21).
    """
    half = n // 2
    offs = F.sequence(F.lit(0), F.lit(n - 1))
    cells = (points.select(pid, period_key(date, res).alias("__period"), (lat_axis.nearest(lat) - half).alias("__i0"),
                           (lon_axis.nearest(lon) - half).alias("__j0"))
             .withColumn("__di", F.explode(offs)).withColumn("__dj", F.explode(offs))
             .select(pid, "__period", (F.col("__i0") + F.col("__di")).alias("__lat"), (F.col("__j0") + F.col("__dj")).alias("__lon")))
    g = grid.where(F.col(product_col).isin(list(products))).select(
        F.col(product_col).alias("__product"), F.col(period_col).alias("__period"), F.col("lat_idx").alias("__lat"),
        F.col("lon_idx").alias("__lon"), F.col(value).alias("__v"))
    met = cells.join(g, ["__period", "__lat", "__lon"], "left")
    return met.groupBy(pid).agg(*[F.avg(F.when(F.col("__product") == p, F.col("__v"))).alias(f"{p}_{res}" if named else p)
                                  for p in products])


def nearest_slice(points: DataFrame, axis: DataFrame, by: str, key: str, axis_key: str, out: str = "slice") -> DataFrame:
    """J-08: per point the nearest available slice value (e.g. day of year) within its ``by`` layer.

    Works on the distinct (layer, key) values: both sides are unioned and
    scanned in order per layer (a layer holds at most one row per slice), the
    previous and next slice are compared and a tie goes to the earlier one.
    """
    k = points.select(by, F.col(key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    a = axis.select(by, F.col(axis_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    u = k.withColumn("__side", F.lit(1)).unionByName(a.withColumn("__side", F.lit(0)))
    w = Window.partitionBy(by).orderBy("__k", "__side")
    ax = F.when(F.col("__side") == 0, F.col("__k"))
    prev = F.last(ax, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt = F.first(ax, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    m = u.select(by, "__k", "__side", prev.alias("__p"), nxt.alias("__n")).where(F.col("__side") == 1)
    best = (F.when(F.col("__p").isNull(), F.col("__n")).when(F.col("__n").isNull(), F.col("__p"))
            .when(F.col("__k") - F.col("__p") <= F.col("__n") - F.col("__k"), F.col("__p")).otherwise(F.col("__n")))
    m = m.select(by, F.col("__k").alias(key), best.alias(out))
    return points.join(m, [by, key], "left")


def match_altimetry(points: DataFrame, grid: DataFrame, pid: str, lat: str, lon: str, date: str,
                    lat_axis: AnyAxis, lon_axis: AnyAxis, measures: Sequence[str], n: int = 1,
                    period: str = "period", slice_col: str = "doy") -> DataFrame:
    """G-03: altimetry match-up: yearly layer, nearest day-of-year slice (J-08), n x n box mean of
    every measure (nulls ignored), and the coordinates of the box origin cell.

    Both box axes are shifted by floor(n/2) (D-07: the source shifts longitude twice and latitude never).
    """
    p = points.select(pid, lat, lon, F.year(date).cast("string").alias(period),
                      F.dayofyear(date).alias("__doy"))
    p = nearest_slice(p, grid.select(period, slice_col), period, "__doy", slice_col, out="__slice")
    half = n // 2
    offs = F.sequence(F.lit(0), F.lit(n - 1))
    c = (p.withColumn("__i0", lat_axis.nearest(lat) - half).withColumn("__j0", lon_axis.nearest(lon) - half)
         .withColumn("__di", F.explode(offs)).withColumn("__dj", F.explode(offs))
         .withColumn("__lat", F.col("__i0") + F.col("__di")).withColumn("__lon", F.col("__j0") + F.col("__dj")))
    g = grid.select(F.col(period).alias("__gp"), F.col(slice_col).alias("__gs"), F.col("lat_idx").alias("__gl"),
                    F.col("lon_idx").alias("__go"), *[F.col(m).alias(f"__m_{m}") for m in measures])
    j = c.join(g, (c[period] == g["__gp"]) & (c["__slice"] == g["__gs"]) & (c["__lat"] == g["__gl"])
               & (c["__lon"] == g["__go"]), "left")
    agg = j.groupBy(pid, "__i0", "__j0").agg(*[F.avg(f"__m_{m}").alias(m) for m in measures])
    return agg.select(pid, *measures, lon_axis.value("__j0").alias("Longitude_Actual"),
                      lat_axis.value("__i0").alias("Latitude_Actual"))
