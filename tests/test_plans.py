"""Plan checks: no Python UDF evaluation, no Cartesian product,
no broadcast nested-loop join, and pruned scans."""

import re

import pytest

from conftest import SF_SMALL
from pelagic.plans import catalog as _c

_c.load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(_c.QUERIES))
def test_plan_shape(spark, name):
    p = _plan(_c.QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
    assert "CartesianProduct" not in p, name
    assert "BroadcastNestedLoopJoin" not in p, name


def test_scan_pruning_and_pushdown(spark):
    df = _c.QUERIES["qc_filters"](spark, SF_SMALL)
    p = _plan(df)
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schema and all("ts" not in s.split(",") for s in schema)  # unused column not read
    assert "PushedFilters: [IsNotNull(props)" in p or "IsNotNull(props)" in p


@pytest.mark.parametrize("name, scans", [("absence_matrix_genus", 5), ("mixed_layer", 2), ("water_quality", 7), ("station_indices", 9), ("region_layers", 4), ("nearest_asof", 4),
                                         ("satellite_matchup", 2), ("doy_smooth", 1), ("region_overlay", 4)])
def test_scans_are_shared_and_no_window_is_one_task(spark, name, scans):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan shows what is reused
    try:
        p = _plan(_c.QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert p.count("FileScan parquet") <= scans
    assert "SinglePartition" not in p


def test_recorder_queries_take_every_sample(spark, catalog):
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    for name, more in (("recorder_indices", {"CTD_SST", "MLD_temp", "silicate"}), ("recorder_indices_props", {"CTD_SST", "WaterDepth_m", "sat_chla"})):
        out = catalog.QUERIES[name](spark, SF_SMALL)
        assert more <= set(out.columns) and out.count() == n
        assert "sample_type <>" not in catalog.ORACLES[name]


def test_water_quality_shuffles_its_sources_once(spark):
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(_c.QUERIES["water_quality"](spark, SF_SMALL)))
    assert sum("depth#" in keys for keys in dealt) == 1 and not any("__source#" in keys for keys in dealt)


@pytest.mark.parametrize("name", ["station_indices", "recorder_indices"])
def test_station_records_are_dealt_by_sample_once(spark, name):
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(_c.QUERIES[name](spark, SF_SMALL)))
    assert dealt and not any("__tn#" in keys or "depth#" in keys for keys in dealt)  # no second shuffle of sums per taxon or depth
