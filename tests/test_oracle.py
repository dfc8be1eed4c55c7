"""Every checked query against its SQL twin on the smallest test tables."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from tillwatch.plans.oracle import ORACLE  # noqa: E402
from tillwatch.plans.queries import REGISTRY  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    return check.database(SF_DIR)


def test_every_report_query_has_its_twin():
    assert set(REGISTRY) == set(ORACLE) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_twin(name, spark, database):
    problem, _ = check.difference(
        entry.queries()[name], entry.oracle_sql()[name], spark, database, SF_DIR
    )
    assert problem == ""


def test_the_flagship_report_has_a_stable_schema(spark):
    board = entry.entry(spark)
    assert board.columns[:3] == ["service", "date", "last_success_time"] and board.count() == 7
