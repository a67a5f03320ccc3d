"""Every registered query against its SQL in an independent engine, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

#: The text-preparation queries have tests of their own.
NAMES = [n for n in contract.queries() if not n.startswith("op") and n != "pipeline"]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """These run as in production, with code generation."""
    quick = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {key: spark.conf.get(key) for key in quick}
    for key, value in quick.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_sql():
    assert set(NAMES) <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "CodigoData",
        "ProdutoId",
        "FilialId",
        "TotalDevolvido",
        "TotalEmEstoque",
        "TotalQuantidadeVendida",
        "TotalValorVendido",
        "TicketMedio",
    ]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, engine, name):
    result = contract.queries()[name](spark, SF_DIR).toArrow()
    columns = ", ".join(f'"{c}"' for c in sorted(result.column_names))
    expected = engine.sql(contract.oracle_sql()[name])
    assert sorted(expected.columns) == sorted(result.column_names)
    got = engine.sql(f"select {columns} from result order by all").fetchall()
    want = engine.sql(f"select {columns} from expected order by all").fetchall()
    assert got == want
