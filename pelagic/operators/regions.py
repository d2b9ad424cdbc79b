"""Point-in-polygon region overlay and ordered bounding-box fallback (J-14, J-15, G-14).

Polygons arrive as a vertex table ``([layer], polygon_id, ring_id, vertex_no, x, y)``
(x = longitude, y = latitude); holes are extra rings.  All layers are overlaid in
one pass, by equi-joins on the cells of a quad-tree:

1. The edges mark the finest cells they touch: the border cells.  A larger cell
   without border cells inside is plain, all in or all out; the largest such
   cells that are in (by their centre) are the inner cells.
2. A place in an inner cell of a polygon is inside, no edge is looked at.
3. A place in a border cell is tested against the polygon's edges in the place's
   row of finest cells: the only ones that a horizontal ray from it can cross.

Even-odd crossing count per (place, polygon); a place on an edge counts as inside
(as the source's overlay does); the first polygon in ``order`` of each layer wins.
Places are distinct coordinates, however many points share them.  The index grows
with the layers' outlines, not with the points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_SLACK = 1e-6  # cells are widened by this share of their size when edges mark them


def polygon_edges(vertices: DataFrame, pid: str = "polygon_id", ring: str = "ring_id",
                  vno: str = "vertex_no", x: str = "x", y: str = "y") -> DataFrame:
    """Closed-ring edges (x1, y1) -> (x2, y2); the last vertex connects back to the first.

    Vertices are ordered by number, even where a text source left the numbers as text.
    """
    layer = [F.col("layer")] if "layer" in vertices.columns else []
    w = Window.partitionBy(*layer, pid, ring).orderBy(F.col(vno).cast("long"))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt_x = F.coalesce(F.lead(x).over(w), F.first(x).over(whole))
    nxt_y = F.coalesce(F.lead(y).over(w), F.first(y).over(whole))
    return vertices.select(*layer, F.col(pid).alias("polygon_id"), F.col(x).cast("double").alias("x1"),
                           F.col(y).cast("double").alias("y1"), nxt_x.cast("double").alias("x2"),
                           nxt_y.cast("double").alias("y2"))


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("long")


def _rows(edges: DataFrame, size: float, out: str) -> DataFrame:
    """Each edge once per row of cells it reaches (a little widened)."""
    slack = F.lit(size * _SLACK)
    return edges.withColumn(out, F.explode(F.sequence(_cell(F.least("y1", "y2") - slack, size), _cell(F.greatest("y1", "y2") + slack, size))))


def border_cells(edges: DataFrame, size: float) -> DataFrame:
    """The cells (layer, polygon_id, cx, cy) that an edge touches: per row the stretch of the edge inside it."""
    r = _rows(edges, size, "cy")
    slack = F.lit(size * _SLACK)
    y1, y2, x1, x2 = (F.col(c) for c in ("y1", "y2", "x1", "x2"))
    lo = F.greatest(F.least(y1, y2), F.col("cy") * F.lit(size) - slack)
    hi = F.least(F.greatest(y1, y2), (F.col("cy") + 1) * F.lit(size) + slack)

    def at(y: Column) -> Column:
        return x1 + (y - y1) * (x2 - x1) / (y2 - y1)

    xa = F.when(y1 == y2, F.least(x1, x2)).otherwise(F.least(at(lo), at(hi)))
    xb = F.when(y1 == y2, F.greatest(x1, x2)).otherwise(F.greatest(at(lo), at(hi)))
    cells = F.sequence(_cell(xa - slack, size), _cell(xb + slack, size))
    return r.select("layer", "polygon_id", F.explode(cells).alias("cx"), "cy").distinct()


def _inside(candidates: DataFrame, edges: DataFrame, keys: list[str], px: str, py: str) -> DataFrame:
    """The rows (``keys``) whose point is inside: even-odd over the joined edges; on an edge is inside."""
    x1, y1, x2, y2, x, y = (F.col(c) for c in ("x1", "y1", "x2", "y2", px, py))
    j = candidates.join(edges, ["layer", "polygon_id", "band"])
    spans = (y1 > y) != (y2 > y)
    crosses = spans & (x < x1 + (y - y1) * (x2 - x1) / F.when(spans, y2 - y1))
    on_edge = (((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)) == 0) & \
        x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))
    return (j.groupBy(*keys).agg(F.sum(F.coalesce(crosses, F.lit(False)).cast("int")).alias("__n"), F.max(on_edge.cast("int")).alias("__on"))
            .where((F.col("__n") % 2 == 1) | (F.col("__on") == 1)).select(*keys))


def inner_cells(edges: DataFrame, border: DataFrame, tile: float, depth: int) -> DataFrame:
    """The largest cells (level, cx, cy) of a quad-tree that lie inside a polygon and touch no edge."""
    up = F.array(*[F.struct(F.lit(lv).alias("level"), F.shiftright("cx", depth - lv).alias("cx"), F.shiftright("cy", depth - lv).alias("cy"))
                   for lv in range(depth + 1)])
    marked = border.select("layer", "polygon_id", F.explode(up).alias("c")).select("layer", "polygon_id", "c.*").distinct()
    quarter = F.array(*[F.struct((F.col("cx") * 2 + a).alias("cx"), (F.col("cy") * 2 + b).alias("cy")) for a in (0, 1) for b in (0, 1)])
    parts = marked.where(F.col("level") < depth).select("layer", "polygon_id", (F.col("level") + 1).alias("level"), F.explode(quarter).alias("c"))
    box = edges.groupBy("layer", "polygon_id").agg(
        _cell(F.min(F.least("x1", "x2")), tile).alias("a"), _cell(F.max(F.greatest("x1", "x2")), tile).alias("b"),
        _cell(F.min(F.least("y1", "y2")), tile).alias("c"), _cell(F.max(F.greatest("y1", "y2")), tile).alias("d"))
    tiles = box.withColumn("cx", F.explode(F.sequence("a", "b"))).withColumn("cy", F.explode(F.sequence("c", "d")))
    cells = parts.select("layer", "polygon_id", "level", "c.cx", "c.cy").unionByName(
        tiles.select("layer", "polygon_id", F.lit(0).alias("level"), "cx", "cy"))
    cells = cells.join(marked, ["layer", "polygon_id", "level", "cx", "cy"], "left_anti")
    size = F.lit(tile) / F.pow(F.lit(2.0), F.col("level"))
    centres = cells.withColumns({"x": (F.col("cx") + 0.5) * size, "y": (F.col("cy") + 0.5) * size}).withColumn("band", _cell(F.col("y"), tile))
    return _inside(centres, _rows(edges, tile, "band"), ["layer", "polygon_id", "level", "cx", "cy"], "x", "y")


def containing(places: DataFrame, vertices: DataFrame, tile: float = 1.0, depth: int = 3) -> DataFrame:
    """Every (place, layer, polygon) that holds it; ``places`` has distinct __px, __py.

    ``tile``: size of the largest cells; the finest are 2^depth times smaller.
    """
    if "layer" not in vertices.columns:
        vertices = vertices.withColumn("layer", F.lit(""))
    edges = polygon_edges(vertices)
    fine = tile / (1 << depth)
    border = border_cells(edges, fine)
    keys = ["__px", "__py", "layer", "polygon_id"]
    levels = F.array(*[F.struct(F.lit(lv).alias("level"), _cell(F.col("__px"), tile / (1 << lv)).alias("cx"),
                                _cell(F.col("__py"), tile / (1 << lv)).alias("cy")) for lv in range(depth + 1)])
    at = places.select("__px", "__py", F.explode(levels).alias("c")).select("__px", "__py", "c.*")
    inner = at.join(inner_cells(edges, border, tile, depth), ["level", "cx", "cy"]).select(*keys)
    # the finest level, from the same rows: both branches read the places once
    near = at.join(border.withColumn("level", F.lit(depth)), ["level", "cx", "cy"]).drop("level")
    on_border = _inside(near.withColumnRenamed("cy", "band"), _rows(edges, fine, "band"), keys, "__px", "__py")
    return inner.unionByName(on_border)


def overlay_layers(points: DataFrame, lon: str, lat: str, vertices: DataFrame, attrs: DataFrame, layers: Sequence[str],
                   attr: str, order: str = "polygon_id", tile: float = 1.0, depth: int = 3) -> DataFrame:
    """G-14: ``points`` plus one column per layer: ``attr`` of its first polygon (by ``order``) holding the point, or null.

    ``vertices`` and ``attrs`` (one row per polygon) have a ``layer`` column.
    """
    hits = containing(_places(points, lon, lat), vertices, tile, depth)
    a = attrs.select("layer", "polygon_id", F.col(order).alias("__ord"), F.col(attr).alias("__attr"))
    first = hits.join(a, ["layer", "polygon_id"]).groupBy("__px", "__py").agg(
        *[F.min_by(F.when(F.col("layer") == x, F.col("__attr")), F.when(F.col("layer") == x, F.col("__ord"))).alias(x) for x in layers])
    same = (points[lon].cast("double") == first["__px"]) & (points[lat].cast("double") == first["__py"])
    return points.join(first, same, "left").select(*points.columns, *layers)


def _places(points: DataFrame, lon: str, lat: str) -> DataFrame:
    p = points.select(F.col(lon).cast("double").alias("__px"), F.col(lat).cast("double").alias("__py"))
    return p.where(F.col("__px").isNotNull() & F.col("__py").isNotNull()).distinct()


def overlay(points: DataFrame, lon: str, lat: str, vertices: DataFrame, attrs: DataFrame,
            order: str = "polygon_id", attr_cols: Sequence[str] = (), tile: float = 1.0, depth: int = 3) -> DataFrame:
    """J-14: attributes of the first polygon (by ``order``) containing each point; none -> nulls.

    ``attrs`` has one row per polygon_id with ``order`` and ``attr_cols``.
    Returns ``points`` + ``attr_cols``.
    """
    hits = containing(_places(points, lon, lat), vertices, tile, depth)
    a = attrs.select("polygon_id", F.col(order).alias("__ord"), *attr_cols)
    first = hits.join(a, "polygon_id").groupBy("__px", "__py").agg(F.min_by(F.struct(*attr_cols), F.col("__ord")).alias("__a"))
    same = (points[lon].cast("double") == first["__px"]) & (points[lat].cast("double") == first["__py"])
    out = points.join(first, same, "left")
    return out.select(*points.columns, *[F.col(f"__a.{c}").alias(c) for c in attr_cols])


def zone_by_place(df: DataFrame, lon: str, lat: str, vertices: DataFrame, attrs: DataFrame, default: str,
                  zone: str = "zone", out: str = "tz") -> DataFrame:
    """J-17: the time zone of each row's place from a layer of zone polygons; ``default`` outside all of them."""
    found = overlay(df, lon, lat, vertices, attrs.withColumnRenamed(zone, out), attr_cols=[out])
    return found.withColumn(out, F.coalesce(F.col(out), F.lit(default)))


def layer_boxes(vertices: DataFrame, attrs: DataFrame, label: str, polygon: str = "polygon_id",
                x: str = "x", y: str = "y") -> list[tuple[str, float, float, float, float]]:
    """J-15: the bounding boxes of a polygon layer, (label, lat_lo, lat_hi, lon_lo, lon_hi) in polygon order (one row per polygon)."""
    box = vertices.groupBy(polygon).agg(F.min(y).alias("a"), F.max(y).alias("b"), F.min(x).alias("c"), F.max(x).alias("d"))
    rows = box.join(attrs.select(polygon, F.col(label).alias("__label")), polygon).orderBy(polygon).collect()
    return [(r["__label"], r["a"], r["b"], r["c"], r["d"]) for r in rows]


def bbox_fallback(df: DataFrame, region: str, lat: str, lon: str,
                  boxes: Sequence[tuple[str, float, float, float, float]]) -> DataFrame:
    """J-15: where ``region`` is null, the label of the first box (label, lat_lo, lat_hi, lon_lo, lon_hi)
    containing the point (ordered ``when`` chain; bounds inclusive)."""
    expr: Column | None = None
    for label, la0, la1, lo0, lo1 in boxes:
        cond = F.col(lat).between(la0, la1) & F.col(lon).between(lo0, lo1)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(region, F.coalesce(F.col(region), expr))
