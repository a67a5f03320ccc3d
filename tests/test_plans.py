"""The plans that make the queries hold at scale."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from finlake import Lake
from finlake.operators import explore, maintenance, summaries
from finlake.plans.ingest import _latest_versions
from finlake.plans.jobs import build_report
from finlake.sources.daily_csv import SPECS, read_days
from finlake.sources.lake import path_exists

from __spark_entry__ import LAKE_SPECS, raw_lake

DAY = "2025-04-15"


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake.at(str(tmp_path))
    for name in ("returns", "stock", "sales"):
        spec = SPECS[name]
        rows = spark.createDataFrame([], spec.struct())
        path = lake.silver_path(spec.domain, spec.table)
        maintenance.create(rows, path, spec.date_col)
    return lake


def test_joins_reuse_the_partitioning_of_the_aggregations(spark, lake, plan):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(build_report(spark, lake, "products"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    operators = text.split("\n\n")[0]
    assert operators.count("Exchange") == 3
    assert operators.count("SortMergeJoin") == 2


def test_one_day_reads_one_partition_and_the_needed_columns(spark, lake, plan):
    text = plan(build_report(spark, lake, "products", DAY))
    for column in ("data_devolucao", "data_referencia", "data_venda"):
        assert any("PartitionFilters" in s and f"({column}#" in s for s in text.splitlines())
    assert "motivo" not in text and "pedido_id" not in text


def test_report_filters_reach_the_scan(spark, tmp_path, plan, frame):
    path = str(tmp_path / "gold")
    rows = frame(
        [(DAY, 1, "SP01", 4, 2.0)],
        "CodigoData date, ProdutoId int, FilialId string, TotalQuantidadeVendida bigint, "
        "TicketMedio double",
    )
    maintenance.create(rows, path, "CodigoData", order=("ProdutoId",))
    stored = spark.read.parquet(path)
    text = plan(explore.report_series(stored, "products", ["SP01"], DAY, DAY, 1))
    scan = next(part for part in text.split("\n\n") if "PartitionFilters" in part)
    assert "CodigoData" in scan.split("PartitionFilters")[1].splitlines()[0]
    assert "EqualTo(FilialId,SP01)" in scan and "EqualTo(ProdutoId,1)" in scan
    assert "TicketMedio" not in scan


def test_preview_is_a_top_k(plan, frame):
    rows = frame([(DAY, "SP01", "ISS", 1.0)], "CodigoData date, FilialId string, TipoImposto string, x double")
    assert "TakeOrderedAndProject" in plan(explore.preview(rows, "taxes"))


def test_money_is_added_without_a_decimal_per_row(plan, frame):
    rows = frame(
        [(DAY, "ISS", 1.0, "SP01")],
        "data_pagamento date, tipo_imposto string, valor_pago double, filial_id string",
    )
    partial = plan(summaries.tax_summary(rows)).split("partial_", 1)[1].splitlines()[0]
    # A decimal is made only of what a double holds beyond six places.
    assert "decimal" in partial and "decimal" not in re.sub(r"CASE WHEN .*? END", "", partial)


def final_plans(spark):
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    runs = store.executionsList()
    return [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]


def test_a_hot_stored_id_is_split(spark, tmp_path):
    path = str(tmp_path / "orders")
    rows = spark.range(60_000, numPartitions=6).selectExpr(
        "date_add(date'2025-01-01', cast(id % 3 as int)) as day",
        "if(id % 2 = 0, 'hot', cast(id as string)) as id",
        "uuid() as note",
    )
    maintenance.create(rows, path, "day")
    batch = spark.sql("select date'2025-01-01' as day, id, 'x' as note from values ('hot'), ('1'), ('new') as t(id)")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    seen = len(final_plans(spark))
    try:
        counts = maintenance.upsert(spark, path, batch, "id", "day")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert counts["matched_ids"] == 2 + 2  # an id and day at a time
    searches = [p for p in final_plans(spark)[seen:] if "/hits" in p and "_copies" in p]
    assert any("skew=true" in plan for plan in searches)
    rewrites = [p for p in final_plans(spark)[seen:] if "/updates" in p and "LeftOuter" in p]
    assert any("skew=true" in plan for plan in rewrites)


def test_rows_without_an_id_pass_by_the_join(spark, tmp_path, plan):
    rows = spark.createDataFrame(
        [("a", 1, DAY), ("a", 2, "2025-04-16"), (None, 3, DAY)], "id string, x int, _file_day string"
    ).withColumn("_file_day", F.col("_file_day").cast("date"))
    merged = _latest_versions(rows, "id", str(tmp_path / "folder"))
    text = plan(merged).split("\n\n")[0]
    assert text.count("Join") == 1 and "Union" in text
    assert sorted((r.id or "", r.x) for r in merged.collect()) == [("", 3), ("a", 2)]


def test_ids_of_one_file_travel_without_their_rows(spark, tmp_path):
    rows = spark.range(1000).selectExpr("cast(id as string) as id", "uuid() as note", f"date'{DAY}' as _file_day")
    seen = len(final_plans(spark))
    assert _latest_versions(rows, "id", str(tmp_path / "folder")).count() == 1000
    searches = [p for p in final_plans(spark)[seen:] if "/folder/" in p]
    assert searches and not any("first(" in p or "SortAggregate" in p for p in searches)


def test_raw_files_join_the_lines_of_orders_once(spark, tmp_path):
    line = (
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    tables = {
        "region": ("r_regionkey bigint, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey bigint, n_name string, n_regionkey bigint", [(0, "N", 0)]),
        "customer": ("c_custkey bigint, c_nationkey bigint", [(1, 0)]),
        "supplier": ("s_suppkey bigint, s_nationkey bigint", [(1, 0)]),
        "part": ("p_partkey bigint, p_brand string", [(1, "A"), (2, "B")]),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
            [(1, 1, 9.5, datetime(2025, 4, 2), "1")],
        ),
        "lineitem": (
            line,
            [
                (1, n, 1 + n % 2, 1, float(n), 10.0 * n, 0.25, flag, "O", datetime(2025, 3 + n % 2, 5))
                for n, flag in enumerate("NNRRAA")
            ],
        ),
    }
    for name, (columns, rows) in tables.items():
        spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / f"{name}.parquet"))
    seen = len(final_plans(spark))
    lake, days = raw_lake(spark, str(tmp_path), *LAKE_SPECS)
    scans = [p for p in final_plans(spark)[seen:] if "/lineitem.parquet" in p]
    assert len(scans) == 1
    assert [str(day) for day in days] == ["2025-03-01", "2025-04-01"]
    found = {}
    for name, spec in LAKE_SPECS.items():
        (files,) = read_days(spark, lake, spec, days)
        rows = files.drop("_file_day").collect()
        assert all(r[spec.date_col] == r._file_day for r in files.collect())
        found[name] = sorted(tuple(str(v) for v in row) for row in rows)
    assert found["sales"] == [("2025-03-01", "A", "ASIA", "0", "0.0"), ("2025-04-01", "B", "ASIA", "1", "10.0")]
    assert [row[1:] for row in found["returns"]] == [("A", "ASIA", "2", "2025-03-01"), ("B", "ASIA", "3", "2025-04-01")]
    assert found["stock"] == [("A", "ASIA", "4", "2025-03-01"), ("B", "ASIA", "5", "2025-04-01")]
    assert found["freight"] == [("1", "9.5", "2025-04-01", "1", "N")]
    assert sorted(float(row[2]) for row in found["taxes"]) == [0.0, 2.5, 5.0, 7.5, 10.0, 12.5]
    assert not path_exists(spark, f"{lake.bronze}/rows/base")
