"""Differential test: every registered query against its DuckDB oracle."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from checks.compare import duck_connect, frame_digest

from skuflow.plans.queries import REGISTRY

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_report_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    ddf = duck.execute(E.oracle_sql()[name]).fetchdf()
    scols, sn, sh, _ = frame_digest(sdf)
    dcols, dn, dh, _ = frame_digest(ddf)
    assert scols == dcols
    assert sn == dn
    assert sh == dh


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "email" in df.columns
