"""The daily summaries, as pure functions from DataFrames to DataFrames.

Each fact is aggregated before it is joined, so rows never multiply and a key
that holds a large share of the rows shrinks to one row per map task before the
shuffle. Grouping and join keys are the same three columns in the same order:
the joins reuse the partitioning of the aggregations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.money import exact_sum, exact_sum_sql, ratio, rounded

PRODUCT_KEYS = ["CodigoData", "ProdutoId", "FilialId"]
FREIGHT_KEYS = ["CodigoData", "FilialId", "Transportadora"]
TAX_KEYS = ["CodigoData", "FilialId", "TipoImposto"]


def _per_product(facts: DataFrame, date_col: str, *measures: Column) -> DataFrame:
    keys = zip((date_col, "produto_id", "filial_id"), PRODUCT_KEYS)
    return facts.groupBy(*(F.col(c).alias(k) for c, k in keys)).agg(*measures)


def returns_summary(returns: DataFrame) -> DataFrame:
    """Units returned per day, product and branch."""
    return _per_product(
        returns, "data_devolucao", F.sum("quantidade").alias("TotalDevolvido")
    )


def stock_summary(stock: DataFrame) -> DataFrame:
    """Units in stock per day, product and branch."""
    return _per_product(
        stock, "data_referencia", F.sum("quantidade_disponivel").alias("TotalEmEstoque")
    )


def sales_summary(sales: DataFrame) -> DataFrame:
    """Units sold, value sold and average ticket per day, product and branch.

    The value is the sum of unit prices (not price times quantity), and the
    ticket is that sum over the sum of quantities.
    """
    value = exact_sum(sales, "valor_unitario")
    units = F.sum("quantidade")
    return _per_product(
        sales,
        "data_venda",
        units.alias("TotalQuantidadeVendida"),
        rounded(value, 2).alias("TotalValorVendido"),
        ratio(value, units, 2).alias("TicketMedio"),
    )


def product_summary(returns: DataFrame, stock: DataFrame, sales: DataFrame) -> DataFrame:
    """Returns, stock and sales side by side, for keys that have all three."""
    return (
        returns_summary(returns)
        .join(stock_summary(stock), PRODUCT_KEYS)
        .join(sales_summary(sales), PRODUCT_KEYS)
    )


def freight_summary(freight: DataFrame) -> DataFrame:
    """Freight paid per day, branch and carrier."""
    return freight.groupBy(
        F.col("data_envio").alias("CodigoData"),
        F.col("filial_id").alias("FilialId"),
        F.col("transportadora").alias("Transportadora"),
    ).agg(rounded(exact_sum(freight, "valor_frete"), 4).alias("TotalFretePago"))


def freight_summary_sql(freight: DataFrame) -> DataFrame:
    """:func:`freight_summary` in SQL, in report order.

    The frame is handed to the statement as an argument, so concurrent callers
    share no view name.
    """
    return freight.sparkSession.sql(
        f"""
        SELECT data_envio AS CodigoData, filial_id AS FilialId, transportadora AS Transportadora,
               CAST(ROUND({exact_sum_sql(freight, "valor_frete")}, 4) AS DOUBLE) AS TotalFretePago
        FROM {{freight}}
        GROUP BY ALL
        ORDER BY CodigoData, FilialId, Transportadora
        """,
        freight=freight,
    )


def tax_summary(taxes: DataFrame) -> DataFrame:
    """Tax paid per day, branch and kind of tax."""
    return taxes.groupBy(
        F.col("data_pagamento").alias("CodigoData"),
        F.col("filial_id").alias("FilialId"),
        F.col("tipo_imposto").alias("TipoImposto"),
    ).agg(rounded(exact_sum(taxes, "valor_pago"), 4).alias("TotalImpostoPago"))
