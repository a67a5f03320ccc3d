"""The test tables seen as the five sources. One SQL text serves Spark and the checking engine.

A "day" is the first day of a month, so that the three-way join of the product
summary has rows even in the smallest data set.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake import SPECS, Lake, SourceSpec

#: What other views take from "base".
BASE_COLUMNS = [
    *("dt", "produto_id", "filial_id", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
    *("l_quantity", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus"),
]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Each view lists the views it needs before it.
_VIEWS = {
    "base": (
        (),
        """
        select cast(date_trunc('month', l.l_shipdate) as date) as dt,
               p.p_brand as produto_id, b.r_name as filial_id, l.*
        from {lineitem} l
        join {part} p on l.l_partkey = p.p_partkey
        join (
            select s.s_suppkey, r.r_name
            from {supplier} s
            join {nation} n on s.s_nationkey = n.n_nationkey
            join {region} r on n.n_regionkey = r.r_regionkey
        ) b on l.l_suppkey = b.s_suppkey
        """,
    ),
    "sales": (
        ("base",),
        """
        select dt as data_venda, produto_id, filial_id, cast(l_quantity as bigint) as quantidade,
               cast(l_extendedprice as decimal(18,2)) as valor_unitario
        from base where l_returnflag = 'N'
        """,
    ),
    "returns": (
        ("base",),
        """
        select dt as data_devolucao, produto_id, filial_id, cast(l_quantity as bigint) as quantidade
        from base where l_returnflag = 'R'
        """,
    ),
    "stock": (
        ("base",),
        """
        select dt as data_referencia, produto_id, filial_id,
               cast(l_quantity as bigint) as quantidade_disponivel
        from base where l_returnflag = 'A'
        """,
    ),
    "taxes": (
        ("base",),
        """
        select dt as data_pagamento, l_returnflag || l_linestatus as tipo_imposto,
               cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) as valor_pago,
               filial_id
        from base
        """,
    ),
    "freight": (
        (),
        """
        select o.o_orderkey as pedido_id, cast(o.o_totalprice as decimal(18,2)) as valor_frete,
               cast(o.o_orderdate as date) as data_envio, o.o_orderpriority as transportadora,
               n.n_name as filial_id
        from {orders} o
        join {customer} c on o.o_custkey = c.c_custkey
        join {nation} n on c.c_nationkey = n.n_nationkey
        """,
    ),
    # Returns with an order id: one per line of an order, summed where a line repeats.
    "returns_by_order": (
        ("base",),
        """
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, dt) as pedido_id,
               dt as data_devolucao, produto_id, filial_id,
               cast(sum(l_quantity) as bigint) as quantidade
        from base where l_returnflag = 'R'
        group by l_orderkey, l_linenumber, l_partkey, l_suppkey, dt, produto_id, filial_id
        """,
    ),
    "freight_by_month": (
        ("freight",),
        """
        select pedido_id, valor_frete, cast(date_trunc('month', data_envio) as date) as data_envio,
               transportadora, filial_id
        from freight
        """,
    ),
}


def needed(*views: str, stored: Iterable[str] = ()) -> list[str]:
    """The named views and what they need, each after what it needs; what a ``stored`` one needs is left out."""
    order: list[str] = []

    def need(view: str) -> None:
        for dependency in () if view in stored else _VIEWS[view][0]:
            need(dependency)
        if view not in order:
            order.append(view)

    for view in views:
        need(view)
    return order


def with_views(sql: str, *views: str, stored: Iterable[str] = ()) -> str:
    """The statement with the named views, and what they need, as CTEs; ``stored`` ones are tables of that name."""
    texts = {view: f"select * from {{{view}}}" if view in stored else _VIEWS[view][1] for view in needed(*views, stored=stored)}
    ctes = ",\n".join(f"{view} as ({text})" for view, text in texts.items())
    return f"with {ctes}\n{sql}" if ctes else sql


@cache
def _table(application: str, sf_dir: str, name: str) -> DataFrame:
    """One relation per table and application, so its footer is read once."""
    return SparkSession.active().read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str, *views: str, **stored: DataFrame) -> DataFrame:
    """The statement over the tables; ``stored`` views are taken from these frames instead of being computed."""
    text = with_views(sql, *views, stored=stored)
    application = spark.sparkContext.applicationId
    used = [name for name in TABLES if f"{{{name}}}" in text]
    return spark.sql(text, **{name: _table(application, sf_dir, name) for name in used}, **stored)


def oracle(sql: str, *views: str) -> str:
    return with_views(sql, *views).format(**{name: name for name in TABLES})


def view(spark: SparkSession, sf_dir: str, name: str, **stored: DataFrame) -> DataFrame:
    return run_sql(spark, sf_dir, f"select * from {name}", name, **stored)


# The sources as they are declared to the library when the test tables feed them.
# Files are written as `file=<prefix>_<day>.csv`, the name Spark gives to the
# folder of a partition; branches and products have the test tables' types.
LAKE_SPECS: dict[str, SourceSpec] = {
    name: replace(SPECS[name], prefix=f"file={SPECS[name].prefix}", schema=schema)
    for name, schema in {
        "returns": "pedido_id string, produto_id string, filial_id string, quantidade int, "
        "data_devolucao date",
        "stock": "produto_id string, filial_id string, quantidade_disponivel int, "
        "data_referencia date",
        "sales": "data_venda date, produto_id string, filial_id string, quantidade int, "
        "valor_unitario double",
        "freight": "pedido_id string, valor_frete double, data_envio date, "
        "transportadora string, filial_id string",
        "taxes": "data_pagamento date, tipo_imposto string, valor_pago double, filial_id string",
    }.items()
}

LAKE_VIEWS = {
    "returns": "returns_by_order",
    "stock": "stock",
    "sales": "sales",
    "freight": "freight_by_month",
    "taxes": "taxes",
}


def write_files(rows: DataFrame, lake: Lake, name: str) -> None:
    """Write one raw CSV (a folder of part files) per day of the frame."""
    spec = LAKE_SPECS[name]
    prefix = spec.prefix.removeprefix("file=")
    token = F.date_format(spec.date_col, "yyyy_MM_dd")
    (
        rows.select(*spec.struct().fieldNames())
        .hint("rebalance", spec.date_col)
        .withColumn("file", F.concat(F.lit(f"{prefix}_"), token, F.lit(".csv")))
        .write.partitionBy("file")
        .option("header", True)
        .mode("append")
        .csv(f"{lake.bronze}/{spec.system}/{spec.table}")
    )
