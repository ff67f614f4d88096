"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

from oracle import compare, duck
import gable.ml.queries  # noqa: F401
from gable.plans.catalog import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(spark, name, SF, con)
    assert ok, msg
