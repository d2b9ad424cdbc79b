"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

from oracle_check import compare, duck
from conftest import SF_SMALL
from pelagic.plans import catalog as _c

_c.load_all()
NAMES = sorted(_c.QUERIES)
# Wide queries find their labels, their oracles list them: compared where every label occurs.
ALL_LABELS = {"larval_matrix", "larval_matrix_project", "raw_matrix_wide"}
SF_LABELS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_LABELS, duck(SF_LABELS)) if name in ALL_LABELS else compare(spark, name, SF_SMALL, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_every_query_but_random_ones_has_an_oracle():
    assert set(_c.QUERIES) - set(_c.ORACLES) <= {"mooring_surface"}


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["sample", "n_species", "shannon", "evenness"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
