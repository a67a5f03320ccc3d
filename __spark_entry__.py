
from __future__ import annotations

import atexit
import contextlib
import importlib
import os
import sys
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import replace
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finlake import Lake, backfill, ingest, ingest_range, refresh_gold, run_day
from finlake.operators import explore, maintenance, summaries
from finlake.operators.reports import REPORTS
from finlake.sources.lake import delete_folder, materialize, read_table
from finlake.sources.daily_csv import day_path
from fixture_views import (
    BASE_COLUMNS,
    LAKE_SPECS,
    LAKE_VIEWS,
    needed,
    oracle,
    run_sql,
    view,
    write_files,
)

Query = Callable[[SparkSession, str], DataFrame]

DAY = "1998-03-01"
NEXT_DAY = "1998-04-01"
FIRST, LAST = "1997-01-01", "1999-06-01"
BRANCHES = ["ASIA", "EUROPE"]
NATIONS = ["NATION_1", "NATION_12", "NATION_23"]
PRODUCT = "Brand#23"

# Batches and tables that the write queries and their SQL have in common.
RESTATED_DAY = f"""
    select date '{DAY}' as data_venda, produto_id, filial_id, sum(quantidade) as quantidade,
           cast(sum(valor_unitario) as decimal(18,2)) as valor_unitario
    from sales group by produto_id, filial_id
    union all
    select date '{NEXT_DAY}', produto_id, 'LATE', count(*), max(valor_unitario)
    from sales group by produto_id
    union all
    select cast(null as date), 'UNDATED', filial_id, count(*), min(valor_unitario)
    from sales group by filial_id
"""
ORDERS_TABLE = """
    select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority,
           cast(date_trunc('month', o_orderdate) as date) as order_month
    from {orders}
"""
# Pending orders are completed (and move to the month of their last shipment),
# every customer gets an opening entry, and every nation an entry without an id.
ORDERS_BATCH = """
    select o.o_orderkey, 'F' as o_orderstatus,
           cast(sum(cast(l.l_extendedprice as decimal(18,2))) as double) as o_totalprice,
           o.o_orderpriority, cast(date_trunc('month', max(l.l_shipdate)) as date) as order_month
    from {orders} o join {lineitem} l on o.o_orderkey = l.l_orderkey
    where o.o_orderstatus = 'P'
    group by o.o_orderkey, o.o_orderpriority
    union all
    select -1 - c_custkey, 'N', c_acctbal, c_mktsegment, date '1995-01-01' from {customer}
    union all
    select null, 'X', cast(n_nationkey as double), n_name, date '1996-01-01' from {nation}
"""


# Orders of two months move on by a month and cost twice as much; a few new ones come in between.
MOVED_FREIGHT = """
    select concat('', pedido_id) as pedido_id, 2 * valor_frete as valor_frete,
           cast(data_envio + interval 1 month as date) as data_envio, transportadora, filial_id
    from freight_by_month where data_envio in (date '1996-05-01', date '1997-11-01')
    union all
    select concat('new-', pedido_id), valor_frete, date '1999-12-01', transportadora, filial_id
    from freight_by_month where data_envio = date '1995-02-01'
"""


# --- summaries -----------------------------------------------------------------


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = (view(spark, sf_dir, name) for name in ("returns", "stock", "sales"))
    return summaries.product_summary(*sources)


def _freight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.freight_summary(view(spark, sf_dir, "freight"))


def _taxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.tax_summary(view(spark, sf_dir, "taxes"))


def product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.in_report_order(_products(spark, sf_dir), "products")


def product_summary_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = {"returns": "data_devolucao", "stock": "data_referencia", "sales": "data_venda"}
    return summaries.product_summary(
        *(
            view(spark, sf_dir, name).where(F.col(column) == F.lit(DAY).cast("date"))
            for name, column in dated.items()
        )
    )


# --- table maintenance -----------------------------------------------------------


def _fresh_lake(spark: SparkSession) -> Lake:
    """A lake of its own in a folder that all executors share, removed when this process ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    root = f"{shared.rstrip('/')}/finlake_query_{uuid.uuid4().hex}"
    atexit.register(_remove, spark, root)
    return Lake.at(root)


def _remove(spark: SparkSession, root: str) -> None:
    """Best effort: the session may have ended before."""
    with contextlib.suppress(Exception):
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _sales_table(spark: SparkSession, sf_dir: str) -> str:
    path = _fresh_lake(spark).silver_path("vendas", "vendas")
    maintenance.create(view(spark, sf_dir, "sales"), path, "data_venda", order=("produto_id",))
    return path


def delete_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _sales_table(spark, sf_dir)
    maintenance.delete_day(spark, path, "data_venda", DAY)
    return read_table(spark, path, "data_venda")


def replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _sales_table(spark, sf_dir)
    schema = read_table(spark, path, "data_venda").schema
    batch = maintenance.conform(run_sql(spark, sf_dir, RESTATED_DAY, "sales"), schema)
    maintenance.replace_days(batch, path, "data_venda", DAY)
    return read_table(spark, path, "data_venda")


def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _sales_table(spark, sf_dir)
    batch = view(spark, sf_dir, "sales").withColumn("canal", F.lit("web"))
    maintenance.append(batch, path, "data_venda")
    return read_table(spark, path, "data_venda", evolved=True)


def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _sales_table(spark, sf_dir)
    maintenance.create(run_sql(spark, sf_dir, RESTATED_DAY, "sales"), path, "data_venda")
    return read_table(spark, path, "data_venda")


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh_lake(spark).silver_path("pedidos", "pedidos")
    orders = run_sql(spark, sf_dir, ORDERS_TABLE)
    maintenance.create(orders, path, "order_month", order=("o_orderkey",))
    batch = run_sql(spark, sf_dir, ORDERS_BATCH)
    maintenance.upsert(spark, path, batch, "o_orderkey", "order_month")
    return read_table(spark, path, "order_month")


def compact_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that came in many small files a month; the result also says how many files each month has left."""
    path = _fresh_lake(spark).silver_path("pedidos", "pedidos")
    orders = run_sql(spark, sf_dir, ORDERS_TABLE)
    maintenance.create(orders, path, "order_month", order=("o_orderkey",))
    for part in range(3):
        more = orders.where(F.col("o_orderkey") % 3 == part).withColumn("o_orderkey", -F.col("o_orderkey"))
        maintenance.append(more, path, "order_month")
    maintenance.compact_days(spark, path, "order_month", order=("o_orderkey",))
    files = F.count_distinct("_metadata.file_path").alias("files")
    stored = read_table(spark, path, "order_month")
    return stored.groupBy("order_month").agg(
        F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("keys"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"), files,
    )


# --- pipeline --------------------------------------------------------------------


def raw_lake(spark: SparkSession, sf_dir: str, *names: str) -> tuple[Lake, list[date]]:
    """Raw files of some sources for every day of the test tables (header only where empty).

    The join that several of them need is written once, and each source goes from there to its files in one pass.
    """
    lake = _fresh_lake(spark)
    joined = [name for name in names if "base" in needed(LAKE_VIEWS[name])]
    folder = f"{lake.bronze}/rows/base"

    def join() -> dict[str, DataFrame]:
        if len(joined) < 2:
            return {}
        return {"base": materialize(view(spark, sf_dir, "base").select(*BASE_COLUMNS), folder)}

    def write(name: str, stored: Future) -> set[date | None]:
        day, seen = F.col(LAKE_SPECS[name].date_col), Observation()
        rows = view(spark, sf_dir, LAKE_VIEWS[name], **(stored.result() if name in joined else {}))
        found = F.collect_set(day).alias("days"), F.count_if(day.isNull()).alias("undated")
        write_files(rows.observe(seen, *found), lake, name)
        return {*seen.get["days"], *([None] if seen.get["undated"] else [])}

    with ThreadPoolExecutor(len(names) + 1) as pool:
        stored = pool.submit(join)
        written = dict(zip(names, pool.map(lambda name: write(name, stored), names)))
    delete_folder(spark, folder)
    days = set().union(*written.values())
    for name, own in written.items():
        spec = LAKE_SPECS[name]
        for day in days - own:
            empty = spark.createDataFrame([], spec.struct()).coalesce(1)
            empty.write.option("header", True).csv(day_path(lake, spec, day))
    return lake, sorted(days)


def csv_day_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = raw_lake(spark, sf_dir, "sales")
    spec = LAKE_SPECS["sales"]
    for day in (DAY, NEXT_DAY, DAY):
        ingest(spark, lake, spec, day)
    return read_table(spark, lake.silver_path(spec.domain, spec.table), spec.date_col)


def csv_inferred_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days of a source whose columns are not declared; one day comes a second time."""
    lake, days = raw_lake(spark, sf_dir, "sales")
    spec = replace(LAKE_SPECS["sales"], schema=None)
    ingest_range(spark, lake, spec, days)
    ingest(spark, lake, spec, DAY)
    return read_table(spark, lake.silver_path(spec.domain, spec.table), spec.date_col)


def csv_widened_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without declared columns: whole amounts on its first day, others on the next, then all days at once."""
    lake, days = raw_lake(spark, sf_dir, "sales")
    spec = replace(LAKE_SPECS["sales"], schema=None, widen=True)
    first = view(spark, sf_dir, "sales").where(F.col("data_venda") == F.lit(DAY).cast("date"))
    whole = first.withColumn("valor_unitario", F.floor("valor_unitario").cast("int"))
    whole.write.mode("overwrite").option("header", True).csv(day_path(lake, spec, DAY))
    for day in (DAY, NEXT_DAY):
        ingest(spark, lake, spec, day)
    ingest_range(spark, lake, spec, days)
    return read_table(spark, lake.silver_path(spec.domain, spec.table), spec.date_col)


def stored_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of a stored summary and its bounds, for which no data column is read."""
    stored = stored_report(spark, sf_dir, "taxes")
    days = explore.option_values(stored, "CodigoData").select(F.lit("day").alias("what"), "CodigoData")
    bounds = explore.date_bounds(stored)
    ends = [bounds.select(F.lit(c).alias("what"), F.col(c).alias("CodigoData")) for c in bounds.columns]
    return days.unionByName(ends[0]).unionByName(ends[1])


def stored_report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A summary as it is stored, built from cleaned tables."""
    lake = _fresh_lake(spark)
    for source in REPORTS[name].sources:
        spec = LAKE_SPECS[source]
        rows = maintenance.conform(view(spark, sf_dir, LAKE_VIEWS[source]), spec.struct())
        maintenance.create(rows, lake.silver_path(spec.domain, spec.table), spec.date_col)
    refresh_gold(spark, lake, name, DAY, LAKE_SPECS)
    return explore.open_report(spark, lake, name)


def stored_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_report(spark, sf_dir, "products")
    frames = [
        explore.option_values(stored, column).select(
            F.lit(column).alias("option"), F.col(column).cast("string").alias("value")
        )
        for column in ("CodigoData", "FilialId", "ProdutoId")
    ]
    first = explore.default_branch(stored).select(F.lit("default").alias("option"), F.col("FilialId").alias("value"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(first)


def selection_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a selection of no, one and several branches has."""
    selections = [BRANCHES[:n] for n in range(3)]
    sizes = explore.selection_sizes(_products(spark, sf_dir), "products", selections, FIRST, LAST)
    return sizes.select(F.col("selection").alias("branches"), "n_rows")


def in_doubles(spark: SparkSession, sf_dir: str, name: str, amount: str) -> DataFrame:
    """A source whose amount is a double, as files have it."""
    return view(spark, sf_dir, name).withColumn(amount, F.col(amount).cast("double"))


def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _fresh_lake(spark)
    for name in ("returns", "stock", "sales"):
        spec = LAKE_SPECS[name]
        rows = view(spark, sf_dir, LAKE_VIEWS[name])
        rows = maintenance.conform(rows, spec.struct())
        path = lake.silver_path(spec.domain, spec.table)
        maintenance.create(rows, path, spec.date_col, order=("produto_id",))
    refresh_gold(spark, lake, "products", DAY, LAKE_SPECS)
    batch = run_sql(spark, sf_dir, RESTATED_DAY, "sales")
    batch = maintenance.conform(batch, LAKE_SPECS["sales"].struct())
    maintenance.replace_days(batch, path, "data_venda", DAY)
    refresh_gold(spark, lake, "products", DAY, LAKE_SPECS)
    return explore.open_report(spark, lake, "products")


def refresh_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freight per day after an upsert that moves orders between days, of which only the changed days are computed anew."""
    lake, spec = _fresh_lake(spark), LAKE_SPECS["freight"]
    path = lake.silver_path(spec.domain, spec.table)
    rows = maintenance.conform(view(spark, sf_dir, LAKE_VIEWS["freight"]), spec.struct())
    maintenance.create(rows, path, spec.date_col, order=(spec.id_col,))
    refresh_gold(spark, lake, "freight", DAY, LAKE_SPECS)
    changed: set = set()
    batch = maintenance.conform(run_sql(spark, sf_dir, MOVED_FREIGHT, LAKE_VIEWS["freight"]), spec.struct())
    maintenance.upsert(spark, path, batch, spec.id_col, spec.date_col, changed=changed)
    refresh_gold(spark, lake, "freight", changed, LAKE_SPECS)
    return explore.open_report(spark, lake, "freight")


#: What the product summary holds beside its measure.
MORE_MEASURES = ("TotalDevolvido", "TotalEmEstoque", "TotalValorVendido", "TicketMedio")


def all_reports(spark: SparkSession, lake: Lake) -> DataFrame:
    """The three stored summaries, every column of them."""

    def columns(name: str, stored: DataFrame) -> DataFrame:
        report = REPORTS[name]
        item = next(k for k in report.keys if k not in ("CodigoData", "FilialId"))
        more = [
            (F.col(c) if c in stored.columns else F.lit(None)).cast("double").alias(c)
            for c in MORE_MEASURES
        ]
        total = F.col(report.measure).cast("double").alias("total")
        return stored.select(F.lit(name).alias("report"), "CodigoData", "FilialId", F.col(item).alias("item"), total, *more)

    frames = [columns(name, explore.open_report(spark, lake, name)) for name in REPORTS]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def run_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, _ = raw_lake(spark, sf_dir, *LAKE_SPECS)
    for day in (DAY, NEXT_DAY):
        run_day(spark, lake, day, LAKE_SPECS)
    return all_reports(spark, lake)


def backfill_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, days = raw_lake(spark, sf_dir, *LAKE_SPECS)
    backfill(spark, lake, days, LAKE_SPECS)
    return all_reports(spark, lake)


# --- contract --------------------------------------------------------------------


def _optional(name: str):
    """A module of the text-preparation part, or None if that part has been taken out."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name in ("finlake.llm", "finlake.llm.queries", "corpus_pipeline"):
            return None
        raise


def _importable(query: Query) -> Query:
    """The query, with this folder on the path of Spark's Python workers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        here = os.path.dirname(os.path.abspath(__file__))
        spark.sparkContext.environment.setdefault("PYTHONPATH", here)
        return query(spark, sf_dir)

    return run


TEXT = _optional("finlake.llm.queries")
PIPELINE = _optional("corpus_pipeline")


def entry(spark: SparkSession) -> DataFrame:
    return product_summary(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    own = _report_queries()
    if TEXT:
        own |= {name: _importable(query) for name, query in TEXT.QUERIES.items()}
    if TEXT and PIPELINE:
        own["pipeline"] = _importable(PIPELINE.run)
    return own


def _report_queries() -> dict[str, Query]:
    return {
        "returns_summary": lambda s, d: summaries.returns_summary(view(s, d, "returns")),
        "stock_summary": lambda s, d: summaries.stock_summary(view(s, d, "stock")),
        "sales_summary": lambda s, d: summaries.sales_summary(view(s, d, "sales")),
        "product_summary": product_summary,
        "product_summary_day": product_summary_day,
        "product_preview": lambda s, d: explore.preview(_products(s, d), "products"),
        "freight_summary_sql": lambda s, d: summaries.freight_summary_sql(view(s, d, "freight")),
        "freight_summary_df": _freight,
        "tax_summary": lambda s, d: explore.in_report_order(_taxes(s, d), "taxes"),
        "tax_report_rows": lambda s, d: explore.filter_report(
            _taxes(s, d), "taxes", BRANCHES, FIRST, LAST
        ),
        "product_report_rows": lambda s, d: explore.filter_report(
            _products(s, d), "products", BRANCHES, FIRST, LAST, PRODUCT
        ),
        "product_report_rows_all": lambda s, d: explore.filter_report(
            _products(s, d), "products", BRANCHES, FIRST, LAST
        ),
        "empty_selection": selection_sizes,
        "stored_product_series": lambda s, d: explore.report_series(
            stored_report(s, d, "products"), "products", BRANCHES, FIRST, LAST, PRODUCT
        ),
        "stored_tax_rows": lambda s, d: explore.filter_report(
            stored_report(s, d, "taxes"), "taxes", BRANCHES, FIRST, LAST
        ),
        "stored_options": stored_options,
        "sales_summary_double": lambda s, d: summaries.sales_summary(
            in_doubles(s, d, "sales", "valor_unitario")
        ),
        "freight_summary_double": lambda s, d: summaries.freight_summary(
            in_doubles(s, d, "freight", "valor_frete")
        ),
        "tax_summary_double": lambda s, d: summaries.tax_summary(
            in_doubles(s, d, "taxes", "valor_pago")
        ),
        "csv_inferred_ingest": csv_inferred_ingest,
        "csv_widened_ingest": csv_widened_ingest,
        "stored_dates": stored_dates,
        "tax_series": lambda s, d: explore.report_series(
            _taxes(s, d), "taxes", BRANCHES, FIRST, LAST
        ),
        "freight_series": lambda s, d: explore.report_series(
            _freight(s, d), "freight", NATIONS, FIRST, LAST
        ),
        "product_series": lambda s, d: explore.report_series(
            _products(s, d), "products", BRANCHES, FIRST, LAST, PRODUCT
        ),
        "branch_options": lambda s, d: explore.option_values(_freight(s, d), "FilialId"),
        "product_options": lambda s, d: explore.option_values(_products(s, d), "ProdutoId"),
        "date_options": lambda s, d: explore.option_values(_taxes(s, d), "CodigoData"),
        "default_branch": lambda s, d: explore.default_branch(_freight(s, d)),
        "date_bounds": lambda s, d: explore.date_bounds(_products(s, d)),
        "delete_day": delete_day,
        "replace_day": replace_day,
        "append_evolve": append_evolve,
        "overwrite_table": overwrite_table,
        "upsert_orders": upsert_orders,
        "compact_days": compact_days,
        "refresh_changed": refresh_changed,
        "csv_day_ingest": csv_day_ingest,
        "gold_refresh": gold_refresh,
        "run_day": run_day_query,
        "backfill": backfill_query,
    }


_RETURNS = """
    select data_devolucao as "CodigoData", produto_id as "ProdutoId", filial_id as "FilialId",
           cast(sum(quantidade) as bigint) as "TotalDevolvido"
    from returns group by all
"""
_STOCK = """
    select data_referencia as "CodigoData", produto_id as "ProdutoId", filial_id as "FilialId",
           cast(sum(quantidade_disponivel) as bigint) as "TotalEmEstoque"
    from stock group by all
"""
# The average ticket is rounded half-up in whole cents: floor((2c + q) / 2q).
_SALES = """
    select data_venda as "CodigoData", produto_id as "ProdutoId", filial_id as "FilialId",
           cast(sum(quantidade) as bigint) as "TotalQuantidadeVendida",
           cast(sum(valor_unitario) as double) as "TotalValorVendido",
           cast((2 * cast(sum(valor_unitario) * 100 as bigint) + cast(sum(quantidade) as bigint))
                // (2 * cast(sum(quantidade) as bigint)) as double) / 100 as "TicketMedio"
    from {sales} group by all
"""
_PRODUCTS = f"""
    select * from ({_RETURNS}) r
    join ({_STOCK}) e using ("CodigoData", "ProdutoId", "FilialId")
    join ({_SALES}) v using ("CodigoData", "ProdutoId", "FilialId")
"""
_FREIGHT = """
    select data_envio as "CodigoData", filial_id as "FilialId",
           transportadora as "Transportadora",
           cast(sum(valor_frete) as double) as "TotalFretePago"
    from {freight} group by all
"""
_TAXES = """
    select data_pagamento as "CodigoData", filial_id as "FilialId",
           tipo_imposto as "TipoImposto",
           cast(round(sum(valor_pago), 4) as double) as "TotalImpostoPago"
    from taxes group by all
"""
_PRODUCT_VIEWS = ("returns", "stock", "sales")


def _listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _series(inner: str, measure: str, branches: list[str], total: str, more: str = "") -> str:
    return f"""
        select "CodigoData", "FilialId", {total} as "{measure}"
        from ({inner})
        where "FilialId" in ({_listed(branches)})
          and "CodigoData" between date '{FIRST}' and date '{LAST}' {more}
        group by all
    """


def oracle_sql() -> dict[str, str]:
    own = _report_sql()
    if TEXT:
        own |= TEXT.ORACLE
    if TEXT and PIPELINE and PIPELINE.ORACLE_SQL:
        own["pipeline"] = PIPELINE.ORACLE_SQL
    return own


def _report_sql() -> dict[str, str]:
    sales = _SALES.format(sales="sales")
    products = _PRODUCTS.format(sales="sales")
    freight = _FREIGHT.format(freight="freight")
    in_range = (
        f"\"FilialId\" in ({_listed(BRANCHES)})"
        f" and \"CodigoData\" between date '{FIRST}' and date '{LAST}'"
    )
    other_days = f"data_venda <> date '{DAY}' or data_venda is null"
    restated = f"""(
        select data_venda, produto_id, filial_id, cast(quantidade as bigint) as quantidade,
               cast(valor_unitario as decimal(18,2)) as valor_unitario from ({RESTATED_DAY})
    )"""
    replaced = f"select * from sales where {other_days} union all select * from {restated}"
    two_days = f"date '{DAY}', date '{NEXT_DAY}'"
    more = ", ".join(f'cast("{c}" as double) as "{c}"' for c in MORE_MEASURES)
    reports = f"""
        select 'products' as report, "CodigoData", "FilialId", "ProdutoId" as item,
               cast("TotalQuantidadeVendida" as double) as total, {more} from ({products})
        union all
        select 'freight', "CodigoData", "FilialId", "Transportadora", "TotalFretePago", null, null, null, null
        from ({_FREIGHT.format(freight="freight_by_month")})
        union all
        select 'taxes', "CodigoData", "FilialId", "TipoImposto", "TotalImpostoPago", null, null, null, null
        from ({_TAXES})
    """
    product_series = oracle(
        _series(
            products,
            "TotalQuantidadeVendida",
            BRANCHES,
            'cast(coalesce(sum("TotalQuantidadeVendida"), 0) as bigint)',
            f"and \"ProdutoId\" = '{PRODUCT}'",
        ),
        *_PRODUCT_VIEWS,
    )
    options = " union all ".join(
        f"""select distinct '{column}' as option, cast("{column}" as varchar) as value from ({products})"""
        for column in ("CodigoData", "FilialId", "ProdutoId")
    )
    sizes = " union all ".join(
        f"""select {n} as branches, count(*) as n_rows from ({products})
        where {"false" if not n else '"FilialId" in (' + _listed(BRANCHES[:n]) + ")"}
          and "CodigoData" between date '{FIRST}' and date '{LAST}'"""
        for n in range(3)
    )
    report_views = (*_PRODUCT_VIEWS, "freight_by_month", "taxes")
    euros = "coalesce(cast(sum(cast({} as decimal(22,6))) as double), 0)".format
    return {
        "returns_summary": oracle(_RETURNS, "returns"),
        "stock_summary": oracle(_STOCK, "stock"),
        "sales_summary": oracle(sales, "sales"),
        "product_summary": oracle(products, *_PRODUCT_VIEWS),
        "product_summary_day": oracle(
            f"select * from ({products}) where \"CodigoData\" = date '{DAY}'", *_PRODUCT_VIEWS
        ),
        "product_preview": oracle(
            f'select * from ({products}) order by "CodigoData", "ProdutoId", "FilialId" limit 5',
            *_PRODUCT_VIEWS,
        ),
        "freight_summary_sql": oracle(freight, "freight"),
        "freight_summary_df": oracle(freight, "freight"),
        "tax_summary": oracle(_TAXES, "taxes"),
        "tax_report_rows": oracle(f"select * from ({_TAXES}) where {in_range}", "taxes"),
        "product_report_rows": oracle(
            f"select * from ({products}) where {in_range} and \"ProdutoId\" = '{PRODUCT}'",
            *_PRODUCT_VIEWS,
        ),
        "product_report_rows_all": oracle(
            f"select * from ({products}) where {in_range}", *_PRODUCT_VIEWS
        ),
        "empty_selection": oracle(sizes, *_PRODUCT_VIEWS),
        "stored_product_series": product_series,
        "stored_tax_rows": oracle(f"select * from ({_TAXES}) where {in_range}", "taxes"),
        "stored_options": oracle(
            f"""{options} union all select 'default', min("FilialId") from ({products})""", *_PRODUCT_VIEWS
        ),
        "sales_summary_double": oracle(sales, "sales"),
        "freight_summary_double": oracle(freight, "freight"),
        "tax_summary_double": oracle(_TAXES, "taxes"),
        "csv_widened_ingest": oracle(
            f"""
            select data_venda, produto_id, filial_id, cast(quantidade as integer) as quantidade,
                   cast(case when data_venda = date '{DAY}' then floor(valor_unitario) else valor_unitario end as double)
                       as valor_unitario
            from sales where data_venda is not null
            """,
            "sales",
        ),
        "stored_dates": oracle(
            f"""
            select distinct 'day' as what, "CodigoData" from ({_TAXES}) where "CodigoData" is not null
            union all select 'first_day', min("CodigoData") from ({_TAXES})
            union all select 'last_day', max("CodigoData") from ({_TAXES})
            """,
            "taxes",
        ),
        "csv_inferred_ingest": oracle(
            "select data_venda, produto_id, filial_id, cast(quantidade as integer) as quantidade, "
            "cast(valor_unitario as double) as valor_unitario from sales where data_venda is not null",
            "sales",
        ),
        "tax_series": oracle(
            _series(_TAXES, "TotalImpostoPago", BRANCHES, euros('"TotalImpostoPago"')), "taxes"
        ),
        "freight_series": oracle(
            _series(freight, "TotalFretePago", NATIONS, euros('"TotalFretePago"')), "freight"
        ),
        "product_series": product_series,
        "branch_options": oracle(f'select distinct "FilialId" from ({freight})', "freight"),
        "product_options": oracle(
            f'select distinct "ProdutoId" from ({products})', *_PRODUCT_VIEWS
        ),
        "date_options": oracle(f'select distinct "CodigoData" from ({_TAXES})', "taxes"),
        "default_branch": oracle(
            f'select min("FilialId") as "FilialId" from ({freight})', "freight"
        ),
        "date_bounds": oracle(
            'select min("CodigoData") as first_day, max("CodigoData") as last_day '
            f"from ({products})",
            *_PRODUCT_VIEWS,
        ),
        "delete_day": oracle(f"select * from sales where {other_days}", "sales"),
        "replace_day": oracle(replaced, "sales"),
        "append_evolve": oracle(
            "select *, cast(null as varchar) as canal from sales "
            "union all select *, 'web' from sales",
            "sales",
        ),
        "overwrite_table": oracle(f"select * from {restated}", "sales"),
        "upsert_orders": oracle(
            f"""
            select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, order_month
            from ({ORDERS_TABLE}) t
            where not exists (select 1 from ({ORDERS_BATCH}) b where b.o_orderkey = t.o_orderkey)
            union all select * from ({ORDERS_BATCH})
            """
        ),
        "compact_days": oracle(
            f"""
            select order_month, 2 * count(*) as n_rows, cast(0 as bigint) as keys,
                   cast(2 * sum(cast(o_totalprice as decimal(18,2))) as double) as total, cast(1 as bigint) as files
            from ({ORDERS_TABLE}) group by order_month
            """
        ),
        "refresh_changed": oracle(
            _FREIGHT.format(
                freight=f"""(
                    select concat('', pedido_id) as pedido_id, valor_frete, data_envio, transportadora, filial_id
                    from freight_by_month where data_envio not in (date '1996-05-01', date '1997-11-01')
                    union all select * from ({MOVED_FREIGHT})
                )"""
            ),
            "freight_by_month",
        ),
        "csv_day_ingest": oracle(
            "select data_venda, produto_id, filial_id, cast(quantidade as integer) as quantidade, "
            f"cast(valor_unitario as double) as valor_unitario from sales "
            f"where data_venda in ({two_days})",
            "sales",
        ),
        "gold_refresh": oracle(
            f"""
            select * from ({products}) where "CodigoData" <> date '{DAY}'
            union all
            select * from ({_PRODUCTS.format(sales=f"({replaced})")})
            where "CodigoData" = date '{DAY}'
            """,
            *_PRODUCT_VIEWS,
        ),
        "run_day": oracle(
            f'select * from ({reports}) where "CodigoData" in ({two_days})', *report_views
        ),
        "backfill": oracle(reports, *report_views),
    }
