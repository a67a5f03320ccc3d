import random
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException

from finlake import SPECS, Lake, backfill, ingest, ingest_range, refresh_gold, run_day
from finlake.operators.explore import open_report
from finlake.operators.maintenance import UpsertConflict
from finlake.sources.daily_csv import day_path, read_day, read_days
from finlake.sources.lake import read_table

from frames import bag

DAYS = ["2025-04-15", "2025-04-16", "2025-04-17"]
SALES = "data_venda,produto_id,filial_id,quantidade,valor_unitario"
RETURNS = "pedido_id,produto_id,quantidade,motivo,data_devolucao,filial_id"
FREIGHT = "pedido_id,valor_frete,data_envio,transportadora,filial_id"


@pytest.fixture
def lake(tmp_path):
    return Lake.at(str(tmp_path))


def put(tmp_path, lake, name, day, header, *lines):
    path = tmp_path / day_path(lake, SPECS[name], day).removeprefix(f"{tmp_path}/")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")


def silver(spark, lake, name, evolved=True):
    spec = SPECS[name]
    path = lake.silver_path(spec.domain, spec.table)
    return read_table(spark, path, spec.date_col, evolved=evolved)


def test_types_are_declared_whatever_the_file_holds(spark, lake, tmp_path):
    for day, price in zip(DAYS, ("100", "100.5")):
        put(tmp_path, lake, "sales", day, SALES, f"{day},1,SP01,2,{price}")
        ingest(spark, lake, SPECS["sales"], day)
    stored = silver(spark, lake, "sales", evolved=False)
    assert dict(stored.dtypes)["valor_unitario"] == "double"
    assert sorted(r.valor_unitario for r in stored.collect()) == [100.0, 100.5]


def test_types_can_be_inferred(spark, lake, tmp_path):
    put(tmp_path, lake, "sales", DAYS[0], SALES, f"{DAYS[0]},1,SP01,2,10.5")
    batch = read_day(spark, lake, replace(SPECS["sales"], schema=None), DAYS[0])
    assert [kind for _, kind in batch.dtypes] == ["date", "int", "string", "int", "double"]


def test_the_narrowest_type_that_holds_all_values_of_all_files(spark, lake, tmp_path):
    spec = replace(SPECS["sales"], schema=None)
    header = "data_venda,whole,big,huge,mixed,real,flag,time,odd,none"
    put(tmp_path, lake, "sales", DAYS[0], header, f"{DAYS[0]},1,1,1,1,1.5,true,2025-01-01 10:00:00,1,")
    put(tmp_path, lake, "sales", DAYS[1], header, f"{DAYS[1]},-7,3000000000,99999999999999999999,2.25,1e3,FALSE,2025-01-02,x,")
    put(tmp_path, lake, "sales", DAYS[2], header)
    for folder in (None, str(tmp_path / "copy")):
        (rows,) = read_days(spark, lake, spec, DAYS, folder)
        assert [kind for _, kind in rows.dtypes] == [
            "date", "int", "bigint", "decimal(38,0)", "double", "double", "boolean", "timestamp", "string", "string", "date"
        ]
        assert sorted(r.mixed for r in rows.collect()) == [1.0, 2.25]


def test_undeclared_files_are_read_once(spark, lake, tmp_path, capsys):
    spec = replace(SPECS["sales"], schema=None)
    put(tmp_path, lake, "sales", DAYS[0], SALES, f"{DAYS[0]},1,SP01,2,10")
    rows = read_day(spark, lake, spec, DAYS[0], str(tmp_path / "copy"))
    (tmp_path / day_path(lake, spec, DAYS[0]).removeprefix(f"{tmp_path}/")).unlink()
    assert rows.collect()[0].valor_unitario == 10
    rows.explain("formatted")
    assert "Scan csv" not in capsys.readouterr().out


def test_whole_numbers_one_day_and_others_the_next(spark, lake, tmp_path):
    spec = replace(SPECS["sales"], schema=None, widen=True)
    for day, price in zip(DAYS, ("100", "100.5", "7")):
        put(tmp_path, lake, "sales", day, SALES, f"{day},1,SP01,2,{price}")
        ingest(spark, lake, spec, day)
    stored = silver(spark, lake, "sales")
    assert dict(stored.dtypes)["valor_unitario"] == "double"
    assert sorted(r.valor_unitario for r in stored.collect()) == [7.0, 100.0, 100.5]
    put(tmp_path, lake, "sales", DAYS[2], SALES, f"{DAYS[2]},one,SP01,2,7")
    with pytest.raises(Exception, match="column produto_id: one does not fit int"):
        ingest(spark, lake, spec, DAYS[2])


def test_headers_of_many_files_by_one_job(spark, lake, tmp_path, monkeypatch):
    from finlake.sources import daily_csv

    monkeypatch.setattr(daily_csv, "FEW", 1)
    monkeypatch.setattr(daily_csv, "read_head", None)  # the driver opens none of them
    more = "canal," + SALES
    put(tmp_path, lake, "sales", DAYS[0], "\ufeff" + SALES, f"{DAYS[0]},1,SP01,2,1.0")
    put(tmp_path, lake, "sales", DAYS[1], more)
    folder = tmp_path / day_path(lake, SPECS["sales"], DAYS[2]).removeprefix(f"{tmp_path}/")
    folder.mkdir()
    for i, text in enumerate(["", f"{more}\nweb,{DAYS[2]},1,SP01,2,1.0\n", f"{more}\nweb,{DAYS[2]},2,SP01,2,1.0\n"]):
        (folder / f"part-{i}.csv").write_text(text)
    frames = read_days(spark, lake, SPECS["sales"], DAYS)
    assert [f.columns[0] for f in frames] == ["data_venda", "canal"]
    assert [f.count() for f in frames] == [1, 2]
    (folder / "part-1.csv").write_text("")
    (folder / "part-2.csv").write_text("")
    with pytest.raises(ValueError, match="empty"):
        read_days(spark, lake, SPECS["sales"], DAYS)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_days(spark, lake, SPECS["sales"], [*DAYS, "2025-04-20"])


def test_the_day_is_that_of_the_daily_file(spark, lake, tmp_path):
    """Also of a folder of part files, whatever these are called."""
    folder = tmp_path / day_path(lake, SPECS["sales"], DAYS[0]).removeprefix(f"{tmp_path}/")
    folder.mkdir(parents=True)
    (folder / "late_2025_04_17.csv").write_text(f"{SALES}\n{DAYS[0]},2,SP01,2,1.0\n")
    (rows,) = read_days(spark, lake, SPECS["sales"], DAYS[0])
    assert [str(r._file_day) for r in rows.collect()] == [DAYS[0]]


def test_the_day_is_found_below_a_folder_named_like_a_file(spark, lake, tmp_path):
    spec = replace(SPECS["sales"], table="vendas.csv")
    file = tmp_path / day_path(lake, spec, DAYS[1]).removeprefix(f"{tmp_path}/")
    file.parent.mkdir(parents=True)
    file.write_text(f"{SALES}\n{DAYS[1]},1,SP01,1,1.0\n")
    (rows,) = read_days(spark, lake, spec, DAYS[1])
    assert [str(r._file_day) for r in rows.collect()] == [DAYS[1]]


def test_columns_may_come_in_any_order_and_case(spark, lake, tmp_path):
    header = "Quantidade,filial_id,DATA_VENDA,produto_id,valor_unitario"
    put(tmp_path, lake, "sales", DAYS[0], header, f"7,SP01,{DAYS[0]},3,1.5")
    for _ in range(2):
        ingest(spark, lake, SPECS["sales"], DAYS[0])
        rows = silver(spark, lake, "sales").collect()
        assert [(r.quantidade, r.produto_id, r.filial_id) for r in rows] == [(7, 3, "SP01")]


def test_missing_file_raises_and_changes_nothing(spark, lake, tmp_path):
    put(tmp_path, lake, "sales", DAYS[0], SALES, f"{DAYS[0]},1,SP01,2,1.0")
    ingest(spark, lake, SPECS["sales"], DAYS[0])
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest(spark, lake, SPECS["sales"], DAYS[1])
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest_range(spark, lake, SPECS["sales"], DAYS)
    assert silver(spark, lake, "sales").count() == 1


def test_malformed_value_raises(spark, lake, tmp_path):
    put(tmp_path, lake, "sales", DAYS[0], SALES, f"{DAYS[0]},one,SP01,2,1.0")
    with pytest.raises(Exception, match="MALFORMED|produto_id|FAILFAST|FAILED"):
        ingest(spark, lake, SPECS["sales"], DAYS[0])


def test_header_only_file_empties_the_day(spark, lake, tmp_path):
    for day in DAYS[:2]:
        put(tmp_path, lake, "sales", day, SALES, f"{day},1,SP01,2,1.0")
        ingest(spark, lake, SPECS["sales"], day)
    put(tmp_path, lake, "sales", DAYS[0], SALES)
    ingest(spark, lake, SPECS["sales"], DAYS[0])
    assert [str(r.data_venda) for r in silver(spark, lake, "sales").collect()] == [DAYS[1]]


def test_new_column_enters_a_replaced_table_but_not_an_upserted_one(spark, lake, tmp_path):
    put(tmp_path, lake, "sales", DAYS[0], SALES, f"{DAYS[0]},1,SP01,2,1.0")
    put(tmp_path, lake, "sales", DAYS[1], SALES + ",canal", f"{DAYS[1]},1,SP01,2,1.0,web")
    put(tmp_path, lake, "freight", DAYS[0], FREIGHT, f"a,1.0,{DAYS[0]},Loggi,SP01")
    put(tmp_path, lake, "freight", DAYS[1], FREIGHT + ",peso", f"a,2.0,{DAYS[1]},Loggi,SP01,3")
    for name in ("sales", "freight"):
        for day in DAYS[:2]:
            ingest(spark, lake, SPECS[name], day)
    assert {(str(r.data_venda), r.canal) for r in silver(spark, lake, "sales").collect()} == {
        (DAYS[0], None),
        (DAYS[1], "web"),
    }
    freight = silver(spark, lake, "freight")
    assert "peso" not in freight.columns
    assert [(r.valor_frete, str(r.data_envio)) for r in freight.collect()] == [(2.0, DAYS[1])]


def random_files(tmp_path, lake, seed):
    """Three days of sales and returns with late, early, undated, moved and id-less rows."""
    pick = random.Random(seed)
    dates = [*DAYS, "2025-04-10", "2025-04-20", ""]
    orders = []
    for number, day in enumerate(DAYS):

        def line(day=day):
            when = pick.choice([day, day, day, pick.choice(dates)])
            return when, pick.choice([1, 2, ""]), pick.choice(["SP01", "RJ01"]), pick.randrange(50)

        sales = [f"{d},{p},{b},{q},{pick.randrange(9999) / 100}" for d, p, b, q in (line() for _ in range(12))]
        fresh = [f"r{number}{i}" for i in range(4)]
        ids = [*fresh, *pick.sample(orders, min(3, len(orders))), "", ""]
        orders += fresh
        returns = [f"{i},{p},{q},x,{d},{b}" for i in ids for d, p, b, q in [line()]]
        put(tmp_path, lake, "sales", day, SALES, *sales)
        put(tmp_path, lake, "returns", day, RETURNS, *returns)


@pytest.mark.parametrize("name", ["returns", "sales"])
def test_ranges_equal_days_in_order(spark, tmp_path, name):
    """Bulk ingestion, onto nothing and onto an existing table, against one day at a time."""
    daily, bulk = (Lake.at(str(tmp_path / name)) for name in ("daily", "bulk"))
    for lake in (daily, bulk):
        random_files(tmp_path, lake, seed=7)
    for day in DAYS + DAYS[1:]:
        ingest(spark, daily, SPECS[name], day)
    ingest_range(spark, bulk, SPECS[name], DAYS)
    ingest_range(spark, bulk, SPECS[name], DAYS[1:])
    assert bag(silver(spark, bulk, name)) == bag(silver(spark, daily, name))


def test_range_refuses_a_repeated_id_in_a_later_file(spark, lake, tmp_path):
    put(tmp_path, lake, "freight", DAYS[0], FREIGHT, f"a,1.0,{DAYS[0]},Loggi,SP01")
    put(tmp_path, lake, "freight", DAYS[1], FREIGHT, *[f"a,2.0,{DAYS[1]},Loggi,SP01"] * 2)
    with pytest.raises(UpsertConflict):
        ingest_range(spark, lake, SPECS["freight"], DAYS[:2])


def test_first_file_may_repeat_an_id_that_is_updated_later(spark, tmp_path):
    daily, bulk = (Lake.at(str(tmp_path / name)) for name in ("daily", "bulk"))
    for lake in (daily, bulk):
        lines = [f"a,{i}.0,{DAYS[0]},Loggi,SP01" for i in range(3)]
        put(tmp_path, lake, "freight", DAYS[0], FREIGHT, *lines)
        put(tmp_path, lake, "freight", DAYS[1], FREIGHT, f"a,9.0,{DAYS[2]},Loggi,SP01")
    for day in DAYS[:2]:
        ingest(spark, daily, SPECS["freight"], day)
    ingest_range(spark, bulk, SPECS["freight"], DAYS[:2])
    assert bag(silver(spark, bulk, "freight")) == bag(silver(spark, daily, "freight"))
    assert [r.valor_frete for r in silver(spark, bulk, "freight").collect()] == [9.0] * 3


def clean_files(tmp_path, lake):
    for number, day in enumerate(DAYS):
        put(tmp_path, lake, "sales", day, SALES, f"{day},1,SP01,{number + 1},10.25")
        put(tmp_path, lake, "stock", day, "produto_id,filial_id,quantidade_disponivel,data_referencia",
            *([f"1,SP01,5,{day}"] if number != 1 else []))
        put(tmp_path, lake, "taxes", day, "data_pagamento,tipo_imposto,valor_pago,filial_id",
            f"{day},ISS,7.5,SP01")
        put(tmp_path, lake, "freight", day, FREIGHT, f"f{number},3.25,{day},Loggi,SP01")
        put(tmp_path, lake, "returns", day,
            RETURNS,
            f"r{number},1,1,x,{day},SP01")


def test_backfill_equals_daily_runs(spark, tmp_path):
    daily, bulk = (Lake.at(str(tmp_path / name)) for name in ("daily", "bulk"))
    for lake in (daily, bulk):
        clean_files(tmp_path, lake)
    backfill(spark, daily, DAYS, replay=True)
    backfill(spark, bulk, DAYS)
    for name in ("products", "freight", "taxes"):
        expected = bag(open_report(spark, daily, name))
        assert len(expected) == (2 if name == "products" else 3)
        assert bag(open_report(spark, bulk, name)) == expected
        refresh_gold(spark, bulk, name, DAYS)
        run_day(spark, bulk, DAYS[1])
        assert bag(open_report(spark, bulk, name)) == expected


def test_moved_order_leaves_the_old_day_stale_until_it_is_refreshed(spark, lake, tmp_path):
    clean_files(tmp_path, lake)
    backfill(spark, lake, DAYS)
    put(tmp_path, lake, "freight", DAYS[2], FREIGHT, f"f0,9.0,{DAYS[2]},Loggi,SP01")

    def totals():
        rows = open_report(spark, lake, "freight").collect()
        return {str(r.CodigoData): r.TotalFretePago for r in rows}

    ingest(spark, lake, SPECS["freight"], DAYS[2])
    refresh_gold(spark, lake, "freight", DAYS[2])
    assert totals() == {DAYS[0]: 3.25, DAYS[1]: 3.25, DAYS[2]: 12.25}
    refresh_gold(spark, lake, "freight", DAYS)
    assert totals() == {DAYS[1]: 3.25, DAYS[2]: 12.25}


def test_unfinished_summary_is_built_again(spark, lake, tmp_path):
    clean_files(tmp_path, lake)
    backfill(spark, lake, DAYS)
    marker = tmp_path / "gold" / "tributario" / "tb_gd_resumo_impostos_pagos" / "_SUCCESS"
    marker.unlink()
    refresh_gold(spark, lake, "taxes", DAYS[0])
    assert open_report(spark, lake, "taxes").count() == 3


def test_delta_needs_its_package(spark, tmp_path):
    lake = Lake.at(str(tmp_path), fmt="delta")
    clean_files(tmp_path, lake)
    with pytest.raises(RuntimeError, match="Delta"):
        ingest(spark, lake, SPECS["sales"], DAYS[0])


def inferred(name):
    return replace(SPECS[name], schema=None)


def test_inferred_types_never_lose_digits(spark, lake, tmp_path):
    for day, price in zip(DAYS, ("100", "100.5")):
        put(tmp_path, lake, "sales", day, SALES, f"{day},1,SP01,2,{price}")
    spec = inferred("sales")
    ingest(spark, lake, spec, DAYS[0])
    with pytest.raises(Exception, match="valor_unitario: 100.5 does not fit int"):
        ingest(spark, lake, spec, DAYS[1])
    put(tmp_path, lake, "sales", DAYS[1], SALES, f"{DAYS[1]},1,SP01,2,7.0")
    ingest(spark, lake, spec, DAYS[1])  # a whole number fits
    stored = spark.read.parquet(lake.silver_path(spec.domain, spec.table))
    assert sorted(r.valor_unitario for r in stored.collect()) == [7, 100]


def test_a_range_takes_the_common_type(spark, lake, tmp_path):
    for day, price in zip(DAYS, ("100", "100.5")):
        put(tmp_path, lake, "sales", day, SALES, f"{day},1,SP01,2,{price}")
    spec = inferred("sales")
    ingest_range(spark, lake, spec, DAYS[:2])
    stored = spark.read.parquet(lake.silver_path(spec.domain, spec.table))
    assert sorted(r.valor_unitario for r in stored.collect()) == [100.0, 100.5]


def test_a_new_column_never_loses_digits(spark, lake, tmp_path):
    put(tmp_path, lake, "sales", DAYS[0], SALES + ",peso", f"{DAYS[0]},1,SP01,2,1.0,1")
    put(tmp_path, lake, "sales", DAYS[1], SALES + ",peso", f"{DAYS[1]},1,SP01,2,1.0,1.9")
    ingest(spark, lake, SPECS["sales"], DAYS[0])
    with pytest.raises(Exception, match="peso: 1.9 does not fit int"):
        ingest(spark, lake, SPECS["sales"], DAYS[1])


def test_an_empty_file_is_no_empty_day(spark, lake, tmp_path):
    for day in DAYS[:2]:
        put(tmp_path, lake, "sales", day, SALES, f"{day},1,SP01,2,1.0")
        ingest(spark, lake, SPECS["sales"], day)
    (tmp_path / day_path(lake, SPECS["sales"], DAYS[0])).write_bytes(b"")
    with pytest.raises(ValueError, match="is empty"):
        ingest(spark, lake, SPECS["sales"], DAYS[0])
    with pytest.raises(ValueError, match="is empty"):
        ingest_range(spark, lake, SPECS["sales"], DAYS[:2])
    assert silver(spark, lake, "sales").count() == 2


def test_no_days_is_an_error(spark, lake):
    with pytest.raises(ValueError, match="no days"):
        backfill(spark, lake, [])


def test_headers_need_no_job_per_file(spark, lake, tmp_path):
    days = [f"2025-06-{n:02d}" for n in range(1, 13)]
    for day in days:
        put(tmp_path, lake, "sales", day, SALES, f"{day},1,SP01,2,1.0")
    counts = []
    for some in (days[:2], days):
        group = f"headers-{len(some)}"
        spark.sparkContext.setJobGroup(group, "")
        frames = read_days(spark, lake, SPECS["sales"], some)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        assert sum(f.count() for f in frames) == len(some)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]


def test_a_finished_summary_is_complete_without_sparks_marker(spark, lake, tmp_path):
    for day in DAYS[:2]:
        put(tmp_path, lake, "taxes", day, "data_pagamento,tipo_imposto,valor_pago,filial_id", f"{day},ISS,1.0,SP01")
        ingest(spark, lake, SPECS["taxes"], day)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        refresh_gold(spark, lake, "taxes", DAYS[0])
        table = tmp_path / "gold" / "tributario" / "tb_gd_resumo_impostos_pagos"
        other = {f: f.stat().st_mtime_ns for f in table.glob(f"CodigoData={DAYS[1]}/*.parquet")}
        refresh_gold(spark, lake, "taxes", DAYS[0])
        assert {f: f.stat().st_mtime_ns for f in table.glob(f"CodigoData={DAYS[1]}/*.parquet")} == other
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
