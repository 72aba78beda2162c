"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = os.environ.get("BAGYARD_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from bagyard.plans.oracles import ORACLES as OWN_ORACLES
    from bagyard.plans.queries import QUERIES as OWN_QUERIES

    assert set(OWN_QUERIES) == set(OWN_ORACLES)
    assert set(OWN_QUERIES) <= set(QUERIES) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert ok, msg


def test_bindings_match(spark, con):
    from bagyard.sources import testdata as T
    from bagyard.sources.testdata_sql import BINDINGS, with_bindings

    for n in BINDINGS:
        ok, msg = compare(getattr(T, n)(spark, SF), con, with_bindings(f"SELECT * FROM {n}", n))
        assert ok, f"{n}: {msg}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["deposit_id", "sdo_name", "kind", "parent_sdo", "path", "mime_type", "accessible_to", "visible_to", "checksum", "control_group", "title"]
