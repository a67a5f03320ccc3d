import pytest

import finlake.__main__ as cli
from finlake import Lake
from finlake.operators.explore import open_report
from finlake.sources.lake import file_sizes, read_table

from frames import bag
from test_pipeline import DAYS, FREIGHT, clean_files, put


def test_backfill_then_run_day(spark, tmp_path):
    lake = Lake.at(str(tmp_path))
    clean_files(tmp_path, lake)
    cli.main(["backfill", str(tmp_path), DAYS[0], DAYS[-1]])
    before = bag(open_report(spark, lake, "taxes"))
    assert len(before) == 3
    cli.main(["run-day", str(tmp_path), DAYS[1]])
    assert bag(open_report(spark, lake, "taxes")) == before


def test_one_source_and_one_summary(spark, tmp_path):
    lake = Lake.at(str(tmp_path))
    clean_files(tmp_path, lake)
    for day in DAYS:
        cli.main(["ingest", str(tmp_path), "taxes", day])
    cli.main(["refresh", str(tmp_path), "taxes", *DAYS])
    assert len(bag(open_report(spark, lake, "taxes"))) == 3


def test_changed_days_and_compaction(spark, tmp_path):
    lake = Lake.at(str(tmp_path))
    clean_files(tmp_path, lake)
    for day in DAYS:
        cli.main(["run-day", str(tmp_path), day, "--changed-days"])
    put(tmp_path, lake, "freight", DAYS[2], FREIGHT, f"f0,7.25,{DAYS[1]},Loggi,SP01")
    cli.main(["run-day", str(tmp_path), DAYS[2], "--changed-days"])
    days = sorted(str(r.CodigoData) for r in open_report(spark, lake, "freight").collect())
    assert days == DAYS[1:]  # f0 left the first day
    path = lake.silver_path("frete", "frete")
    rows = bag(read_table(spark, path, "data_envio"))
    cli.main(["compact", str(tmp_path), "freight"])
    assert bag(read_table(spark, path, "data_envio")) == rows
    assert all(len(sizes) == 1 for sizes in file_sizes(spark, path).values())
    with pytest.raises(ValueError, match="OPTIMIZE"):
        cli.main(["--format", "delta", "compact", str(tmp_path), "freight"])
