import pytest

from finlake.operators import summaries

from frames import bag

SALES = "data_venda date, produto_id int, filial_id string, quantidade int, valor_unitario double"
RETURNS = "data_devolucao date, produto_id int, filial_id string, quantidade int"
STOCK = "data_referencia date, produto_id int, filial_id string, quantidade_disponivel int"
D = "2025-04-15"


def test_value_is_the_sum_of_unit_prices(frame):
    sales = frame([(D, 1, "SP01", 10, 2.5), (D, 1, "SP01", 5, 3.0)], SALES)
    row = summaries.sales_summary(sales).first()
    assert (row.TotalQuantidadeVendida, row.TotalValorVendido) == (15, 5.5)
    assert row.TicketMedio == 0.37


def test_zero_quantity_gives_no_ticket(frame):
    sales = frame([(D, 1, "SP01", 0, 2.5)], SALES)
    assert summaries.sales_summary(sales).first().TicketMedio is None


def test_ties_round_half_up_in_decimal(frame):
    sales = frame([(D, 1, "SP01", 8, 0.04), (D, 2, "SP01", 1, 1.005)], SALES)
    rows = {r.ProdutoId: r for r in summaries.sales_summary(sales).collect()}
    assert rows[1].TicketMedio == 0.01
    assert rows[2].TotalValorVendido == 1.01


def test_sum_does_not_depend_on_partitioning(spark, frame):
    rows = [(D, 1, "SP01", 1, i / 100) for i in range(1, 2000)]
    sales = frame(rows, SALES)
    totals = {
        summaries.sales_summary(sales.repartition(n)).first().TotalValorVendido for n in (1, 3, 7)
    }
    assert totals == {19990.0}


def test_product_needs_returns_stock_and_sales(frame):
    sales = frame([(D, 1, "SP01", 1, 1.0), (D, 2, "SP01", 1, 1.0)], SALES)
    stock = frame([(D, 1, "SP01", 7), (D, 2, "SP01", 7), (D, 1, "SP01", 3)], STOCK)
    returns = frame([(D, 1, "SP01", 2), (D, 1, "SP01", 2), (D, 3, "SP01", 9)], RETURNS)
    rows = summaries.product_summary(returns, stock, sales).collect()
    assert [(r.ProdutoId, r.TotalDevolvido, r.TotalEmEstoque) for r in rows] == [(1, 4, 10)]


def test_null_keys_leave_the_product_summary(frame):
    sales = frame([(D, None, "SP01", 1, 1.0), (D, 1, None, 1, 1.0)], SALES)
    stock = frame([(D, None, "SP01", 7), (D, 1, None, 7)], STOCK)
    returns = frame([(D, None, "SP01", 2), (D, 1, None, 2)], RETURNS)
    assert summaries.product_summary(returns, stock, sales).count() == 0


def test_null_branch_stays_in_taxes_and_freight(frame):
    taxes = frame(
        [(D, "ISS", 1.0, None), (D, "ISS", 2.0, None)],
        "data_pagamento date, tipo_imposto string, valor_pago double, filial_id string",
    )
    freight = frame(
        [("a", 1.25, D, "Loggi", None), ("b", 2.5, D, "Loggi", None)],
        "pedido_id string, valor_frete double, data_envio date, transportadora string, "
        "filial_id string",
    )
    assert summaries.tax_summary(taxes).first().TotalImpostoPago == 3.0
    assert summaries.freight_summary(freight).first().TotalFretePago == 3.75


def test_sql_and_dataframe_freight_agree_and_ignore_case(frame):
    rows = [("a", 1.00005, D, "Loggi", "SP01"), ("b", 2.5, D, "Loggi", "SP01")]
    freight = frame(
        rows,
        "PEDIDO_ID string, VALOR_FRETE double, DATA_ENVIO date, Transportadora string, "
        "FILIAL_ID string",
    )
    by_sql = summaries.freight_summary_sql(freight)
    assert bag(by_sql) == bag(summaries.freight_summary(freight))
    assert by_sql.first().TotalFretePago == 3.5001


TAXES = "data_pagamento date, tipo_imposto string, valor_pago double, filial_id string"


def taxes(spark, amounts, parts=3):
    values = spark.createDataFrame([(float(a),) for a in amounts], "valor_pago double").repartition(parts)
    return values.selectExpr("date'2025-04-15' as data_pagamento", "'ISS' as tipo_imposto", "valor_pago", "'SP01' as filial_id")


def total(frame):
    return [row.TotalImpostoPago for row in summaries.tax_summary(frame).collect()]


def test_small_amounts_add_up(spark):
    many = spark.range(100_000).selectExpr(
        "date'2025-04-15' as data_pagamento", "'ISS' as tipo_imposto", "4e-7D as valor_pago", "'SP01' as filial_id"
    )
    assert total(many) == [0.04]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_what_cannot_be_added_raises(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for amounts in ([1.0, float("nan")], [float("inf")], [9e18, 9e18], [-1e300]):
            with pytest.raises(Exception, match="cannot add|too large"):
                total(taxes(spark, amounts))
        assert total(taxes(spark, [0.1, 0.2, -0.05])) == [0.25]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_sums_do_not_depend_on_partitions(spark):
    amounts = [((-1) ** i) * (i % 97) / 7 + 1e-9 * i for i in range(3000)]
    assert len({tuple(total(taxes(spark, amounts, parts))) for parts in (1, 2, 7)}) == 1
