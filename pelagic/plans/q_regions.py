"""Region queries: point-in-polygon overlay of samples on polygons attached to the region table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.operators import regions as rg
from pelagic.plans import bindings as b
from pelagic.plans.catalog import register

# Fixed values of the binding: polygon rings per region key, as
# (region key, ring, [(lon, lat), ...]).  Region 1 is concave, region 2 has
# a hole (ring 2), region 4 shares an edge with region 0.
POLYGONS = [
    (0, 1, [(110, -10), (130, -10), (130, -16), (110, -16)]),
    (1, 1, [(110, -16), (140, -16), (140, -22), (130, -22), (130, -18), (120, -18), (120, -22), (110, -22)]),
    (2, 1, [(115, -22), (145, -22), (145, -30), (115, -30)]),
    (2, 2, [(125, -24), (135, -24), (135, -28), (125, -28)]),
    (3, 1, [(110, -30), (150, -30), (130, -40)]),
    (4, 1, [(130, -10), (150, -10), (150, -16), (130, -16)]),
]

# Fixed values of the binding: ordered fallback boxes (label, lat_lo, lat_hi, lon_lo, lon_hi).
FALLBACK_BOXES = [
    ("Coral Sea", -22.0, -16.0, 140.0, 155.0),
    ("Southern Ocean", -45.0, -30.0, 105.0, 155.0),
    ("Indian Ocean", -45.0, -10.0, 105.0, 115.0),
]


def _vertex_rows():
    return [(r, ring, i, float(x), float(y)) for r, ring, pts in POLYGONS for i, (x, y) in enumerate(pts)]


def vertices(spark, sf_dir):
    """Vertex table of the regions present in the region table."""
    v = spark.createDataFrame(_vertex_rows(), "polygon_id long, ring_id int, vertex_no int, x double, y double")
    reg = b.table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("polygon_id"))
    return v.join(reg, "polygon_id", "left_semi")


def _sql_vertices():
    rows = ", ".join(f"({r}, {ring}, {i}, {float(x)}, {float(y)})" for r, ring, i, x, y in _vertex_rows())
    return (f"v AS (SELECT * FROM (VALUES {rows}) t(polygon_id, ring_id, vertex_no, x, y) "
            "WHERE polygon_id IN (SELECT r_regionkey FROM region))")


_SQL_OVERLAY = b.with_ctes(b.SQL_SAMPLES, _sql_vertices()) + """,
e AS (SELECT polygon_id, CAST(x AS DOUBLE) AS x1, CAST(y AS DOUBLE) AS y1,
             CAST(coalesce(lead(x) OVER w, first_value(x) OVER w2) AS DOUBLE) AS x2,
             CAST(coalesce(lead(y) OVER w, first_value(y) OVER w2) AS DOUBLE) AS y2
      FROM v WINDOW w AS (PARTITION BY polygon_id, ring_id ORDER BY vertex_no),
                    w2 AS (PARTITION BY polygon_id, ring_id ORDER BY vertex_no
                           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
t AS (SELECT s.sample, e.polygon_id,
             sum(CASE WHEN (e.y1 > s.lat) <> (e.y2 > s.lat)
                       AND s.lon < e.x1 + (s.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) AS n,
             max(CASE WHEN (e.x2 - e.x1) * (s.lat - e.y1) - (e.y2 - e.y1) * (s.lon - e.x1) = 0
                       AND s.lon BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                       AND s.lat BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) AS on_edge
      FROM samples s CROSS JOIN e GROUP BY s.sample, e.polygon_id),
hit AS (SELECT t.sample, min(t.polygon_id) AS pid FROM t WHERE n % 2 = 1 OR on_edge = 1 GROUP BY t.sample),
r AS (SELECT s.sample, s.lat, s.lon, r.r_name AS region
      FROM samples s LEFT JOIN hit USING (sample) LEFT JOIN region r ON r.r_regionkey = hit.pid)
"""


# ----------------------------------------------------------------- J-14 / G-14
@register("region_overlay", bench=True, sql=_SQL_OVERLAY + "SELECT sample, region FROM r")
def region_overlay(spark, sf_dir):
    s = b.samples(spark, sf_dir).select("sample", "lat", "lon")
    attrs = b.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("polygon_id"), F.col("r_name").alias("region"))
    r = rg.overlay(s, "lon", "lat", vertices(spark, sf_dir), attrs, attr_cols=["region"])
    return r.select("sample", "region")


# ----------------------------------------------------------------- J-15
@register("region_bbox_fallback", sql=_SQL_OVERLAY + """
SELECT sample, coalesce(region,
         CASE WHEN lat BETWEEN -22.0 AND -16.0 AND lon BETWEEN 140.0 AND 155.0 THEN 'Coral Sea'
              WHEN lat BETWEEN -45.0 AND -30.0 AND lon BETWEEN 105.0 AND 155.0 THEN 'Southern Ocean'
              WHEN lat BETWEEN -45.0 AND -10.0 AND lon BETWEEN 105.0 AND 115.0 THEN 'Indian Ocean' END) AS region
FROM r
""")
def region_bbox_fallback(spark, sf_dir):
    s = b.samples(spark, sf_dir).select("sample", "lat", "lon")
    attrs = b.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("polygon_id"), F.col("r_name").alias("region"))
    r = rg.overlay(s, "lon", "lat", vertices(spark, sf_dir), attrs, attr_cols=["region"])
    return rg.bbox_fallback(r, "region", "lat", "lon", FALLBACK_BOXES).select("sample", "region")


# ----------------------------------------------------------------- J-15, boxes of the layer itself
@register("region_bbox_layer", sql=_SQL_OVERLAY + """,
box AS (SELECT polygon_id, min(y) AS a, max(y) AS b, min(x) AS c, max(x) AS d FROM v GROUP BY polygon_id),
inb AS (SELECT r.sample, min(polygon_id) AS pid FROM r JOIN box ON r.lat BETWEEN a AND b AND r.lon BETWEEN c AND d
        WHERE r.region IS NULL GROUP BY r.sample)
SELECT r.sample, coalesce(r.region, g.r_name) AS region
FROM r LEFT JOIN inb USING (sample) LEFT JOIN region g ON g.r_regionkey = inb.pid
""")
def region_bbox_layer(spark, sf_dir):
    s = b.samples(spark, sf_dir).select("sample", "lat", "lon")
    attrs = b.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("polygon_id"), F.col("r_name").alias("region"))
    v = vertices(spark, sf_dir)
    r = rg.overlay(s, "lon", "lat", v, attrs, attr_cols=["region"])
    return rg.bbox_fallback(r, "region", "lat", "lon", rg.layer_boxes(v, attrs, "region")).select("sample", "region")


# ----------------------------------------------------------------- G-14 / R-15: three layers in one pass
# Fixed values of the binding: the rings of two more layers, per region key.  The provinces overlap (the
# smaller key wins) and one is a strip across many cells; the planning regions are triangles around a hole.
PROVINCES = [
    (0, 1, [(108.3, -9.7), (131.1, -12.2), (127.4, -25.9), (109.2, -21.4)]),
    (1, 1, [(120, -15), (152, -15), (152, -27), (120, -27)]),
    (3, 1, [(110.01, -20.1), (149.9, -38.2), (149.9, -38.7), (110.01, -20.6)]),
]
PLANNING = [
    (1, 1, [(110, -10), (150, -10), (130, -40)]),
    (1, 2, [(125.5, -15.5), (134.5, -15.5), (130, -22)]),
    (2, 1, [(110, -40), (130, -40), (110, -10)]),
    (4, 1, [(150, -10), (150, -40), (130, -40)]),
]
LAYERS = {"meso": POLYGONS, "province": PROVINCES, "planning": PLANNING}


def _layer_rows():
    return [(layer, r, ring, i, float(x), float(y)) for layer, polygons in LAYERS.items() for r, ring, pts in polygons
            for i, (x, y) in enumerate(pts)]


def _layer_vertices(spark, sf_dir):
    v = spark.createDataFrame(_layer_rows(), "layer string, polygon_id long, ring_id int, vertex_no int, x double, y double")
    reg = b.table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("polygon_id"))
    return v.join(reg, "polygon_id", "left_semi")


_LAYERS_SQL = b.with_ctes(b.SQL_SAMPLES) + """,
v AS (SELECT * FROM (VALUES """ + ", ".join(f"('{l}', {r}, {g}, {i}, {x}, {y})" for l, r, g, i, x, y in _layer_rows()) + """) t(layer, polygon_id, ring_id, vertex_no, x, y)
      WHERE polygon_id IN (SELECT r_regionkey FROM region)),
e AS (SELECT layer, polygon_id, CAST(x AS DOUBLE) AS x1, CAST(y AS DOUBLE) AS y1,
             CAST(coalesce(lead(x) OVER w, first_value(x) OVER w2) AS DOUBLE) AS x2,
             CAST(coalesce(lead(y) OVER w, first_value(y) OVER w2) AS DOUBLE) AS y2
      FROM v WINDOW w AS (PARTITION BY layer, polygon_id, ring_id ORDER BY vertex_no),
                    w2 AS (PARTITION BY layer, polygon_id, ring_id ORDER BY vertex_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
pl AS (SELECT DISTINCT lat, lon FROM samples),
t AS (SELECT s.lat, s.lon, e.layer, e.polygon_id,
             sum(CASE WHEN (e.y1 > s.lat) <> (e.y2 > s.lat)
                       AND s.lon < e.x1 + (s.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) AS n,
             max(CASE WHEN (e.x2 - e.x1) * (s.lat - e.y1) - (e.y2 - e.y1) * (s.lon - e.x1) = 0
                       AND s.lon BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                       AND s.lat BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) AS on_edge
      FROM pl s CROSS JOIN e GROUP BY ALL),
hit AS (SELECT lat, lon, layer, min(polygon_id) AS pid FROM t WHERE n % 2 = 1 OR on_edge = 1 GROUP BY ALL)
SELECT s.sample, """ + ", ".join(f"max(CASE WHEN hit.layer = '{l}' THEN r.r_name || ' {l}' END) AS {l}" for l in LAYERS) + """
FROM samples s LEFT JOIN hit ON hit.lat = s.lat AND hit.lon = s.lon LEFT JOIN region r ON r.r_regionkey = hit.pid GROUP BY s.sample
"""


@register("region_layers", sql=_LAYERS_SQL)
def region_layers(spark, sf_dir):
    s = b.samples(spark, sf_dir).select("sample", "lat", "lon")
    names = b.table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("polygon_id"), "r_name")
    attrs = names.select("polygon_id", F.explode(F.array(*map(F.lit, LAYERS))).alias("layer"), "r_name")
    attrs = attrs.select("layer", "polygon_id", F.concat_ws(" ", "r_name", "layer").alias("name"))
    r = rg.overlay_layers(s, "lon", "lat", _layer_vertices(spark, sf_dir), attrs, list(LAYERS), "name")
    return r.select("sample", *LAYERS)
