"""Mooring temperature surface per station (G-16), rows-only (an iterative approximation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pelagic.functions.timeops import days_since
from pelagic.operators.surface import bspline_surface
from pelagic.plans.catalog import register
from pelagic.plans.q_mooring import series


@register("mooring_surface")
def mooring_surface(spark, sf_dir):
    s = series(spark, sf_dir).withColumn("t", days_since("time", "1950-01-01"))
    # 200 x 200 output grid, initial lattice 1 x 5, 8 levels (the source's settings)
    return bspline_surface(s, "t", "depth", "temp", by=["station"], nx=200, ny=200, mx=1, my=5, levels=8)
