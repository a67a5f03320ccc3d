"""Id search, kept schemas, safe overwrites, compaction and changed days."""

import json
import os
import subprocess
import sys
from datetime import date
from glob import glob
from math import ceil

import pytest
from pyspark.sql import functions as F

from finlake import SPECS, Lake, ingest, refresh_gold, run_day
from finlake.operators import explore, maintenance as m
from finlake.plans.jobs import build_report
from finlake.sources import lake as tables
from finlake.sources.lake import kept_schema, read_table, table_schema

from frames import bag
from test_pipeline import DAYS, FREIGHT, clean_files, put

SCHEMA = "id string, day date, amount int"
A, B, C = "2025-04-15", "2025-04-16", "2025-04-17"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "silver" / "table")


# --- search by id ------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "decimal(20,2)", "double"])
def test_filter_holds_all_ids_and_few_others(spark, kind):
    ids = spark.range(40_000).select(F.col("id").cast("int").alias("n"))
    of_kind = F.date_from_unix_date("n") if kind == "date" else F.col("n").cast(kind)
    ids = ids.select("n", of_kind.alias("id"))
    batch = ids.where("n % 20 = 7")
    bloom, words = m.id_filter(batch.select("id"), "id", 2000)
    assert words == 512 and bloom.count() <= words
    passed = {r.n for r in m.may_match(ids, "id", bloom, words).collect()}
    wanted = set(range(7, 40_000, 20))
    assert wanted <= passed and len(passed - wanted) < 0.03 * 40_000


def test_filter_has_a_bound_and_only_weakens_beyond_it(spark, monkeypatch):
    assert [m._words(n) for n in (0, 1, 4, 5, 9, 1 << 40)] == [1, 1, 1, 2, 4, m.FILTER_WORDS]
    monkeypatch.setattr(m, "FILTER_WORDS", 8)
    ids = spark.range(3000)
    bloom, words = m.id_filter(ids, "id", 3000)
    assert words == 8 and bloom.count() == 8
    assert m.may_match(ids, "id", bloom, words).count() == 3000


SEARCH = """
import sys
from finlake.session import local_session
from finlake.operators import maintenance
work, n = sys.argv[1], int(sys.argv[2])
spark = local_session(2, memory="1g", conf={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + work + "/events",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "2"})
rows = spark.range(n).selectExpr("id * 2654435761 % 1000003 as id", "date'2025-01-01' as day", "id as amount")
maintenance.create(rows, work + "/t", "day")
spark.sparkContext.setJobGroup("search", "search")
ids = maintenance.read_table(spark, work + "/t", "day").select("id", "day")
batch = spark.range(300).selectExpr("id * 2654435761 * 7 % 1000003 as id")
wanted = maintenance.materialize(batch, work + "/f/wanted")
bounds = wanted.selectExpr("count(*) as n", "min(id) as low", "max(id) as high").first().asDict()
found = maintenance._search(ids, "id", wanted, bounds, work + "/f")
spark.sparkContext.setJobGroup("final", "final")
print("found", found.count())
spark.stop()
"""


def shuffled(work, n):
    """Records that the search's join shuffles, by the event log, and the rows it finds."""
    os.makedirs(f"{work}/events")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", SEARCH, work, str(n)], capture_output=True, text=True, timeout=300,
        env=os.environ | {"PYTHONPATH": root},
    )
    found = int(done.stdout.split("found")[1])
    stages, records = set(), 0
    for file in glob(f"{work}/events/*"):
        for event in map(json.loads, open(file)):
            if event["Event"] == "SparkListenerJobStart" and event["Properties"].get("spark.jobGroup.id") == "final":
                stages |= set(event["Stage IDs"])
            if event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in stages:
                records += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
    return records, found


def test_rows_shuffled_grow_with_the_batch_and_not_with_the_table(tmp_path):
    small, found_small = shuffled(str(tmp_path / "a"), 5_000)
    large, found_large = shuffled(str(tmp_path / "b"), 400_000)
    assert found_small == found_large == 300
    assert small < 1_000 and large < 5_000  # of 400,000 stored rows, one in a hundred or so passes by chance


def test_bounds_of_the_batch_reach_the_scan(spark, path, capsys):
    m.create(spark.range(100).selectExpr("id", "date'2025-01-01' as day"), path, "day")
    ids = read_table(spark, path, "day").select("id")
    wanted = m.materialize(spark.range(3, 5), f"{path}_f/wanted")
    m._search(ids, "id", wanted, {"n": 2, "low": 3, "high": 4}, f"{path}_f").explain("formatted")
    assert "GreaterThanOrEqual(id,3), LessThanOrEqual(id,4)" in capsys.readouterr().out


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_upsert_is_the_same_with_and_without_the_filter(spark, path, frame, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        m.create(frame([(f"i{n}", (A, B, None)[n % 3], n) for n in range(300)], SCHEMA), path, "day")
        changed = set()
        batch = frame([("i3", B, -3), ("i4", B, -4), ("i5", C, -5), ("new", C, 1), (None, None, 2), ("z", A, 9)], SCHEMA)
        counts = m.upsert(spark, path, batch, "id", "day", changed=changed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts["matched_ids"] == 3
    want = {f"i{n}": ((A, B, None)[n % 3], n) for n in range(300)}
    want |= {"i3": (B, -3), "i4": (B, -4), "i5": (C, -5), "new": (C, 1), "z": (A, 9)}
    rows = read_table(spark, path, "day").collect()
    assert {r.id: (r.day and r.day.isoformat(), r.amount) for r in rows if r.id} == want and len(rows) == 303
    assert changed == {None, *map(date.fromisoformat, (A, B, C))}


def test_a_batch_without_ids_only_adds_rows(spark, path, frame):
    m.create(frame([("a", A, 1)], SCHEMA), path, "day")
    changed = set()
    counts = m.upsert(spark, path, frame([(None, B, 2), (None, None, 3)], SCHEMA), "id", "day", changed=changed)
    assert counts == {"matched_ids": 0, "days_rewritten": 0, "days_emptied": 0}
    assert changed == {date.fromisoformat(B), None} and read_table(spark, path, "day").count() == 3
    changed.clear()
    m.upsert(spark, path, frame([], SCHEMA), "id", "day", changed=changed)
    assert changed == set() and read_table(spark, path, "day").count() == 3


# --- columns kept beside the table ---------------------------------------------------


def spoil(path):
    """Make every data file unreadable; whoever opens a footer now fails."""
    for file in glob(f"{path}/day=*/*.parquet"):
        with open(file, "wb") as out:
            out.write(b"not a parquet file")


def test_append_with_a_new_column_opens_no_old_footer(spark, path, frame):
    m.create(frame([("a", A, 1)], SCHEMA), path, "day")
    spoil(path)
    m.append(frame([("b", B, 2, "x")], SCHEMA + ", note string"), path, "day")
    assert read_table(spark, path, "day").columns == ["id", "amount", "note", "day"]
    new = read_table(spark, path, "day").where(F.col("day") == F.lit(B).cast("date"))
    assert [tuple(r) for r in new.collect()] == [("b", 2, "x", date.fromisoformat(B))]


def test_replace_with_a_new_column_opens_no_old_footer(spark, path, frame):
    m.create(frame([("a", A, 1)], SCHEMA), path, "day")
    spoil(path)
    m.replace_days(frame([("b", B, 2, "x")], SCHEMA + ", note string"), path, "day", B)
    assert kept_schema(spark, path).fieldNames() == ["id", "amount", "note", "day"]


@pytest.mark.parametrize("damage", [None, "", "{", '{"check": 1, "schema": {}}', "cut", "checksum"])
def test_a_missing_or_damaged_file_falls_back_to_the_footers(spark, path, frame, damage):
    m.create(frame([("a", A, 1)], SCHEMA), path, "day")
    m.append(frame([("b", B, 2, "x")], SCHEMA + ", note string"), path, "day")
    file = f"{path}/{tables.SCHEMA_FILE}"
    text = open(file).read()
    if damage != "checksum":
        os.remove(f"{path}/.{tables.SCHEMA_FILE}.crc")
    if damage is None:
        os.remove(file)
    else:
        with open(file, "w") as out:
            out.write(text.replace('"amount"', '"amuont"') if damage == "cut" else damage)
    assert kept_schema(spark, path) is None
    assert table_schema(spark, path, "day").fieldNames() == ["id", "amount", "note", "day"]
    m.append(frame([("c", C, 3, "y", 1.5)], SCHEMA + ", note string, rate double"), path, "day")
    assert kept_schema(spark, path).fieldNames() == ["id", "amount", "note", "rate", "day"]
    rows = {r.id: (r.note, r.rate) for r in read_table(spark, path, "day").collect()}
    assert rows == {"a": (None, None), "b": ("x", None), "c": ("y", 1.5)}


def test_upsert_keeps_columns_of_other_days_without_footers(spark, path, frame):
    m.create(frame([("a", A, 1)], SCHEMA), path, "day")
    m.append(frame([("b", B, 2, "x")], SCHEMA + ", note string"), path, "day")
    batch = frame([("b", B, 5, "z"), ("n", A, 7, None)], SCHEMA + ", note string")
    m.upsert(spark, path, batch, "id", "day")
    assert {r.id: (r.amount, r.note) for r in read_table(spark, path, "day").collect()} == {
        "a": (1, None), "b": (5, "z"), "n": (7, None)
    }


def test_columns_widen_without_a_rewrite(spark, path, frame):
    m.create(frame([("a", A, 1)], SCHEMA), path, "day")
    wide = m.widen(spark, path, "day", frame([], "id string, day date, amount double").schema)
    assert wide["amount"].dataType.simpleString() == "double"
    m.append(frame([("b", B, 2.5)], "id string, day date, amount double"), path, "day")
    assert {r.id: r.amount for r in read_table(spark, path, "day").collect()} == {"a": 1.0, "b": 2.5}
    text = m.widen(spark, path, "day", frame([], "id int, day date, amount string").schema)
    assert [f.dataType.simpleString() for f in text] == ["string", "double", "date"]
    same = m.widen(spark, path, "day", frame([], "amount decimal(38,0)").schema, declared=wide)
    assert same["amount"].dataType.simpleString() == "double"


# --- overwriting ------------------------------------------------------------------------


def test_a_failed_overwrite_leaves_the_old_table_whole(spark, path, frame):
    m.create(frame([("a", A, 1), ("b", B, 2)], SCHEMA), path, "day")
    old = bag(read_table(spark, path, "day"))
    rows = spark.range(1000, numPartitions=8).selectExpr(
        f"cast(id as string) as id", f"date'{C}' as day", "if(id = 990, cast(raise_error('half-way') as int), 1) as amount"
    )
    with pytest.raises(Exception, match="half-way"):
        m.create(rows, path, "day")
    assert bag(read_table(spark, path, "day")) == old
    assert tables.table_exists(spark, path, complete=True)
    assert os.listdir(os.path.dirname(path)) == ["table"]


def test_a_killed_overwrite_leaves_the_old_table_whole(spark, path, frame, monkeypatch):
    m.create(frame([("a", A, 1)], SCHEMA), path, "day")

    def dies(*_):
        raise SystemExit

    monkeypatch.setattr(m, "replace_folder", dies)
    with pytest.raises(SystemExit):
        m.create(frame([("z", C, 9)], SCHEMA), path, "day")
    assert [r.id for r in read_table(spark, path, "day").collect()] == ["a"]
    monkeypatch.undo()
    m.create(frame([("z", C, 9)], SCHEMA), path, "day")
    assert [r.id for r in read_table(spark, path, "day").collect()] == ["z"]


def test_a_table_can_be_overwritten_with_what_is_read_from_it(spark, path, frame):
    m.create(frame([("a", A, 1), ("b", B, 2)], SCHEMA), path, "day")
    m.create(read_table(spark, path, "day").where("id = 'b'").withColumn("more", F.lit(1)), path, "day", order=("id",))
    assert [(r.id, r.more) for r in read_table(spark, path, "day").collect()] == [("b", 1)]


# --- compaction -----------------------------------------------------------------------------


def test_compaction_keeps_rows_and_bounds_files(spark, path, frame):
    m.create(frame([(f"s{n}", A, n) for n in range(50)], SCHEMA), path, "day", order=("id",))
    for part in range(4):
        m.append(frame([(f"{d}{part}{n}", d, n) for d in (A, B) for n in range(100)] + [(None, None, part)], SCHEMA), path, "day")
    m.append(frame([("x", C, 1, "n")], SCHEMA + ", note string"), path, "day")
    old, sizes = bag(read_table(spark, path, "day")), tables.file_sizes(spark, path)
    target = max(sum(v) for v in sizes.values()) // 2
    counts = m.compact_days(spark, path, "day", order=("id",), target_bytes=target)
    assert bag(read_table(spark, path, "day")) == old
    left = tables.file_sizes(spark, path)
    assert all(len(left[day]) <= ceil(sum(sizes[day]) / target) for day in sizes)
    assert counts["files_after"] < counts["files_before"] and counts["days"] == 3
    assert m.compact_days(spark, path, "day", target_bytes=target)["days"] == 0
    for file in glob(f"{path}/day={A}/*.parquet"):
        ids = [r.id for r in spark.read.parquet(file).collect()]
        assert ids == sorted(ids)


def test_compaction_of_some_days(spark, path, frame):
    for n in range(3):
        rows = frame([(f"a{n}", A, n), (f"b{n}", B, n), (f"c{n}", None, n)], SCHEMA)
        m.append(rows, path, "day") if n else m.create(rows, path, "day")
    before = tables.file_sizes(spark, path)
    m.compact_days(spark, path, "day", days=[A, None])
    after = tables.file_sizes(spark, path)
    assert len(after[f"day={B}"]) == len(before[f"day={B}"]) == 3
    assert [len(after[k]) for k in after if k != f"day={B}"] == [1, 1]
    assert read_table(spark, path, "day").count() == 9


def test_compaction_of_an_empty_table(spark, path, frame):
    m.create(frame([], SCHEMA), path, "day")
    assert m.compact_days(spark, path, "day") == {"days": 0, "files_before": 0, "files_after": 0}


# --- changed days ---------------------------------------------------------------------------


def test_refresh_of_changed_days_equals_a_full_build(spark, tmp_path):
    lake = Lake.at(str(tmp_path))
    clean_files(tmp_path, lake)
    for day in DAYS:
        run_day(spark, lake, day)
    put(tmp_path, lake, "freight", DAYS[2], FREIGHT, f"f0,7.25,{DAYS[1]},Loggi,SP01")
    run_day(spark, lake, DAYS[2])
    stale = bag(explore.open_report(spark, lake, "freight"))
    full = bag(build_report(spark, lake, "freight"))
    assert stale != full
    changed = set()
    put(tmp_path, lake, "freight", DAYS[2], FREIGHT, f"f0,8.5,{DAYS[0]},Loggi,SP01")
    ingest(spark, lake, SPECS["freight"], DAYS[2], changed)
    assert {date.fromisoformat(DAYS[0]), date.fromisoformat(DAYS[1])} <= changed
    refresh_gold(spark, lake, "freight", changed | {date.fromisoformat(DAYS[2])})
    assert bag(explore.open_report(spark, lake, "freight")) == bag(build_report(spark, lake, "freight"))


def test_run_day_with_changed_days(spark, tmp_path):
    lake = Lake.at(str(tmp_path))
    clean_files(tmp_path, lake)
    for day in DAYS:
        run_day(spark, lake, day, changed_days=True)
    put(tmp_path, lake, "freight", DAYS[2], FREIGHT, f"f0,7.25,{DAYS[1]},Loggi,SP01")
    run_day(spark, lake, DAYS[2], changed_days=True)
    for name in ("products", "freight", "taxes"):
        assert bag(explore.open_report(spark, lake, name)) == bag(build_report(spark, lake, name))


def test_changed_days_of_a_replaced_table(spark, path, frame):
    m.create(frame([("a", A, 1)], SCHEMA), path, "day")
    changed = set()
    m.replace_days(frame([("b", A, 1), ("c", B, 1), ("d", None, 1)], SCHEMA), path, "day", [A, C], changed=changed)
    assert changed == {None, *map(date.fromisoformat, (A, B, C))}


# --- answers from partitions and one scan -----------------------------------------------------


def test_days_and_bounds_read_no_data_column(spark, path, capsys, frame):
    rows = frame([(A, "SP01", 1.0), (C, "SP02", 2.0)], "CodigoData date, FilialId string, TotalFretePago double")
    m.create(rows, path, "CodigoData")
    m.clear_day(spark, path, "CodigoData", date.fromisoformat(C))  # a day without rows does not count
    stored = read_table(spark, path, "CodigoData")
    for answer in (explore.option_values(stored, "CodigoData"), explore.date_bounds(stored)):
        capsys.readouterr()
        answer.explain("formatted")
        assert "ReadSchema: struct<>" in capsys.readouterr().out
        assert {v for r in answer.collect() for v in r} == {date.fromisoformat(A)}


def test_selection_sizes_by_one_scan(spark, frame, capsys):
    rows = frame(
        [(A, 1, "x"), (A, 2, "x"), (B, 1, "y"), (C, 1, "z"), (A, 1, None)], "CodigoData date, ProdutoId int, FilialId string"
    )
    sets = [[], ["x"], ["x", "y"], ["nowhere"], ["z"]]
    for product in (explore.ALL_PRODUCTS, 1):
        sizes = explore.selection_sizes(rows, "products", sets, A, B, product)
        want = [explore.filter_report(rows, "products", s, A, B, product).count() for s in sets]
        assert [r.n_rows for r in sizes.orderBy("selection").collect()] == want
    capsys.readouterr()
    sizes.explain()
    assert capsys.readouterr().out.count("Scan ") == 1
    assert [r.n_rows for r in explore.selection_sizes(rows, "products", [[]], A, B).collect()] == [0]
