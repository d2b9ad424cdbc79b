"""Multilevel B-spline approximation of scattered (x, y, z) onto a regular grid (G-16).

Lee, Wolberg & Shin (1997): at level k a cubic B-spline control lattice of
(m_x 2^k + 3) x (m_y 2^k + 3) nodes is fitted to the residuals of the
previous levels; the surface is the sum of the level functions.

Points at one place are merged once.  Distributed form, per level: places are summed per lattice *cell* (16 pairs of
numerator and denominator, combined map-side, so only cells are shuffled);
the small cell table fans out to its 16 control nodes; and places look up
their cell's 16 node values by one equi-join, the residual being an expression.
The iteration cuts lineage once per level with a reliable checkpoint into the
shared checkpoint folder.
Everything can be keyed by ``by`` (e.g. one surface per station).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagic.session import checkpoint_dir


def _basis(t: Column, a: int) -> Column:
    if a == 0:
        return F.pow(F.lit(1.0) - t, 3) / 6.0
    if a == 1:
        return (F.lit(3.0) * F.pow(t, 3) - F.lit(6.0) * t * t + F.lit(4.0)) / 6.0
    if a == 2:
        return (F.lit(-3.0) * F.pow(t, 3) + F.lit(3.0) * t * t + F.lit(3.0) * t + F.lit(1.0)) / 6.0
    return F.pow(t, 3) / 6.0


def _in_cell(df: DataFrame, u: str, v: str, mx: int, my: int) -> DataFrame:
    """Lattice coordinates (``u``/``v`` in [0, mx] x [0, my]) -> first node (__ci, __cj) of the cell and place (__s, __t) in it."""
    fu = F.least(F.floor(F.col(u)), F.lit(mx - 1))
    fv = F.least(F.floor(F.col(v)), F.lit(my - 1))
    return df.withColumns({"__ci": fu.cast("int") - 1, "__cj": fv.cast("int") - 1,
                           "__s": F.col(u) - fu, "__t": F.col(v) - fv}).drop(u, v)


def _weights() -> list[Column]:
    """The 16 tensor-product weights of a place in its cell; number 4 a + c belongs to node (ci + a, cj + c)."""
    s, t = F.col("__s"), F.col("__t")
    return [_basis(s, a) * _basis(t, c) for a in range(4) for c in range(4)]


def _lattice(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """BA step: phi_c = w z / sum(w^2); node = sum(w^2 phi_c) / sum(w^2), null where no point has weight.

    A row stands for ``__n`` points at its place, ``__r`` is their mean (phi_c is linear in z)."""
    s, t = F.col("__s"), F.col("__t")
    w2 = sum(_basis(s, a) ** 2 for a in range(4)) * sum(_basis(t, c) ** 2 for c in range(4))
    w = _weights()
    cells = rows.groupBy(*by, "__ci", "__cj").agg(
        *[F.sum(w[k] ** 3 * F.col("__r") * F.col("__n") / w2).alias(f"__num{k}") for k in range(16)],
        *[F.sum(w[k] ** 2 * F.col("__n")).alias(f"__den{k}") for k in range(16)])
    nodes = F.inline(F.array(*[F.struct((F.col("__ci") + k // 4).alias("__ni"), (F.col("__cj") + k % 4).alias("__nj"),
                                        F.col(f"__num{k}").alias("__num"), F.col(f"__den{k}").alias("__den")) for k in range(16)]))
    return (cells.select(*by, nodes).groupBy(*by, "__ni", "__nj")
            .agg(F.try_divide(F.sum("__num"), F.sum("__den")).alias("__node")))


def _value(rows: DataFrame, lattice: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """``rows`` (placed in cells) with the surface value of ``lattice`` at their place; the place columns go."""
    keys = [*by, "__ci", "__cj"]
    places = F.inline(F.array(*[F.struct(F.lit(k).alias("__k"), (F.col("__ci") + k // 4).alias("__ni"),
                                         (F.col("__cj") + k % 4).alias("__nj")) for k in range(16)]))
    fan = rows.select(*keys).distinct().select(*keys, places).join(lattice, [*by, "__ni", "__nj"])
    cells = fan.groupBy(*keys).agg(*[F.max(F.when(F.col("__k") == k, F.col("__node"))).alias(f"__n{k}") for k in range(16)])
    w = _weights()
    value = sum((w[k] * F.coalesce(F.col(f"__n{k}"), F.lit(0.0)) for k in range(1, 16)),
                w[0] * F.coalesce(F.col("__n0"), F.lit(0.0)))
    return (rows.join(cells, keys, "left").withColumn(out, value)
            .drop("__ci", "__cj", "__s", "__t", *[f"__n{k}" for k in range(16)]))


def _scaled(df: DataFrame, bbox: DataFrame | tuple, by: Sequence[str], x: str, y: str, mx: int, my: int) -> DataFrame:
    """Data coordinates -> lattice coordinates of a level; ``bbox`` is a per-group table or, without
    groups, the four bounds as Python numbers (no join with a one-row table)."""
    if by:
        j = df.join(bbox, list(by), "inner")
        xmin, xmax, ymin, ymax = (F.col(c) for c in ("__xmin", "__xmax", "__ymin", "__ymax"))
    else:
        j = df
        xmin, xmax, ymin, ymax = (F.lit(float(v)) for v in bbox)
    sx = F.when(xmax > xmin, (F.col(x) - xmin) / (xmax - xmin))
    sy = F.when(ymax > ymin, (F.col(y) - ymin) / (ymax - ymin))
    j = j.withColumn("__u", F.coalesce(sx, F.lit(0.0)) * mx).withColumn("__v", F.coalesce(sy, F.lit(0.0)) * my)
    return j.drop("__xmin", "__xmax", "__ymin", "__ymax") if by else j


def bspline_surface(df: DataFrame, x: str, y: str, z: str, by: Sequence[str] = (), nx: int = 200, ny: int = 200,
                    mx: int = 1, my: int = 1, levels: int = 8, checkpoint_every: int = 1) -> DataFrame:
    """G-16: surface values on an ``nx`` x ``ny`` grid spanning each group's data box.

    Output: (by..., gx, gy, x, y, z) with grid indices gx in [0, nx), gy in [0, ny).
    ``mx``/``my`` are the initial lattice sizes along x and y (the source uses 1 and 5).
    """
    by = list(by)
    pts = df.select(*by, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"),
                    F.col(z).cast("double").alias("__r")).where(
        F.col("__x").isNotNull() & F.col("__y").isNotNull() & F.col("__r").isNotNull())
    checkpoint_dir(df.sparkSession)
    # points at one place get one surface value and have the same weights: one row, their number and mean, does for all levels
    pts = _cut(pts.groupBy(*by, "__x", "__y").agg(F.avg("__r").alias("__r"), F.count(F.lit(1)).alias("__n")))
    bbox = pts.groupBy(*by).agg(F.min("__x").alias("__xmin"), F.max("__x").alias("__xmax"),
                                F.min("__y").alias("__ymin"), F.max("__y").alias("__ymax"))
    if not by:
        r = bbox.first()
        if r is None or r["__xmin"] is None:
            raise ValueError("no points")
        box = (r["__xmin"], r["__xmax"], r["__ymin"], r["__ymax"])
        base = pts.sparkSession.range(1).select(*[F.lit(float(v)).alias(c) for v, c in
                                                  zip(box, ("__xmin", "__xmax", "__ymin", "__ymax"))])
    else:
        box, base = bbox, bbox
    gx = F.explode(F.sequence(F.lit(0), F.lit(nx - 1)))
    gy = F.explode(F.sequence(F.lit(0), F.lit(ny - 1)))
    grid = (base.withColumn("gx", gx).withColumn("gy", gy)
            .withColumn("__x", F.col("__xmin") + (F.col("__xmax") - F.col("__xmin")) * F.col("gx") / max(nx - 1, 1))
            .withColumn("__y", F.col("__ymin") + (F.col("__ymax") - F.col("__ymin")) * F.col("gy") / max(ny - 1, 1))
            .select(*by, "gx", "gy", "__x", "__y"))
    # Levels run over the data places only (residual update); each level's
    # lattice is kept (small: one row per control node) and the grid is
    # evaluated once at the end against all levels in a single join.
    rows = pts
    lattices = []
    for k in range(levels):
        kx, ky = mx * 2 ** k, my * 2 ** k
        placed = _in_cell(_scaled(rows, box, by, "__x", "__y", kx, ky), "__u", "__v", kx, ky)
        lattice = _cut(_lattice(placed, by))  # reused by the residual update and the final refinement
        lattices.append(lattice)
        if k + 1 < levels:
            rows = _value(placed, lattice, by, "__f").withColumn("__r", F.col("__r") - F.col("__f")).drop("__f")
            if checkpoint_every and (k + 1) % checkpoint_every == 0:
                rows = _cut(rows)
    # B-spline refinement folds all levels into the finest lattice exactly
    # (each coarse node feeds 5 x 5 fine nodes), so the grid is evaluated once.
    total = lattices[0]
    for k in range(1, levels):
        kx, ky = mx * 2 ** k, my * 2 ** k
        fine = _refine(total, by, kx, ky)
        total = fine.unionByName(lattices[k]).groupBy(*by, "__ni", "__nj").agg(F.sum("__node").alias("__node"))
        if k % 3 == 0:
            total = _cut(total)
    kx, ky = mx * 2 ** (levels - 1), my * 2 ** (levels - 1)
    g = _in_cell(_scaled(grid, box, by, "__x", "__y", kx, ky), "__u", "__v", kx, ky)
    return _value(g, total, by, z).select(*by, "gx", "gy", F.col("__x").alias(x), F.col("__y").alias(y), z)


def _refine(lat: DataFrame, by: Sequence[str], kx: int, ky: int) -> DataFrame:
    """Cubic B-spline subdivision of a lattice for (kx/2, ky/2) cells onto the (kx, ky) lattice.

    Per axis, coarse node i feeds fine nodes 2i-2 .. 2i+2 with weights
    1/8, 1/2, 3/4, 1/2, 1/8; fine nodes outside [-1, k+1] are dropped.
    """
    mask = [(-2, 0.125), (-1, 0.5), (0, 0.75), (1, 0.5), (2, 0.125)]
    terms = F.array(*[F.struct(F.lit(di).alias("di"), F.lit(dj).alias("dj"), F.lit(wi * wj).alias("w"))
                      for di, wi in mask for dj, wj in mask])
    f = (lat.withColumn("__t", F.explode(terms))
         .select(*by, (F.col("__ni") * 2 + F.col("__t.di")).alias("__ni"), (F.col("__nj") * 2 + F.col("__t.dj")).alias("__nj"),
                 (F.col("__node") * F.col("__t.w")).alias("__node"))
         .where(F.col("__ni").between(-1, kx + 1) & F.col("__nj").between(-1, ky + 1)))
    return f.groupBy(*by, "__ni", "__nj").agg(F.sum("__node").alias("__node"))


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: computed once, survives lost executors, nothing stays cached."""
    return df.checkpoint(eager=True)
