"""Every registered query against its SQL counterpart; queries without one must return rows."""

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from rentlens.plans import catalogue
from rentlens.plans.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_registration():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.queries())


@pytest.fixture(scope="module")
def inputs(spark):
    """Shared by the queries without SQL, so that the study behind most of them is computed once."""
    return catalogue.Inputs(spark, FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, inputs, name):
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert getattr(catalogue, name)(inputs).count() > 0
    else:
        assert difference(driver.queries()[name](spark, FOLDER), con, sql) == ""


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["ANO", "CODIGO_LOCALIDAD", "ESTRATO", "CODIGO_BARRIO", "TASA_RENTA", "CLASE_PREDIO"]
    assert df.count() > 0
