from datetime import date

import pytest

from finlake.operators import explore

TAXES = "CodigoData date, FilialId string, TipoImposto string, TotalImpostoPago double"
PRODUCTS = "CodigoData date, ProdutoId int, FilialId string, TotalQuantidadeVendida bigint"


@pytest.fixture
def taxes(frame):
    return frame(
        [
            ("2025-04-15", "SP01", "ISS", 0.1),
            ("2025-04-15", "SP01", "PIS", 0.2),
            ("2025-04-16", "SP02", "ISS", None),
            ("2025-04-17", "SP01", "ISS", 5.0),
            ("2025-04-17", None, "ISS", 6.0),
            (None, "SP01", "ISS", 7.0),
        ],
        TAXES,
    )


@pytest.fixture
def products(frame):
    return frame(
        [("2025-04-15", 1, "SP01", 4), ("2025-04-15", 2, "SP01", 6), ("2025-04-16", 1, "SP02", 8)],
        PRODUCTS,
    )


def test_range_includes_both_ends(taxes):
    rows = explore.filter_report(taxes, "taxes", ["SP01", "SP02"], "2025-04-15", "2025-04-16")
    assert rows.count() == 3


def test_no_branch_and_no_range_mean_no_rows(taxes):
    assert explore.filter_report(taxes, "taxes", [], "2025-04-15", "2025-04-17").count() == 0
    assert explore.filter_report(taxes, "taxes", ["SP01"], None, None).count() == 0


def test_series_adds_exactly_and_counts_all_null_as_zero(taxes):
    branches = ["SP01", "SP02"]
    rows = explore.report_series(taxes, "taxes", branches, "2025-04-15", "2025-04-17").collect()
    assert {(r.CodigoData.day, r.FilialId): r.TotalImpostoPago for r in rows} == {
        (15, "SP01"): 0.3,
        (16, "SP02"): 0.0,
        (17, "SP01"): 5.0,
    }


@pytest.mark.parametrize(
    "product, expected", [("*", [8, 10]), (None, [8, 10]), (1, [4, 8]), (3, [])]
)
def test_product_is_optional(products, product, expected):
    series = explore.report_series(
        products, "products", ["SP01", "SP02"], "2025-04-15", "2025-04-16", product
    )
    assert sorted(r.TotalQuantidadeVendida for r in series.collect()) == expected
    assert series.schema["TotalQuantidadeVendida"].dataType.typeName() == "long"


def test_options_and_bounds(taxes):
    values = [r.FilialId for r in explore.option_values(taxes, "FilialId").collect()]
    assert values == ["SP01", "SP02"]
    assert explore.default_branch(taxes).first().FilialId == "SP01"
    bounds = explore.date_bounds(taxes).first()
    assert tuple(bounds) == (date(2025, 4, 15), date(2025, 4, 17))


def test_options_and_bounds_of_an_empty_table(taxes):
    nothing = taxes.where("false")
    assert explore.option_values(nothing, "FilialId").count() == 0
    assert explore.default_branch(nothing).count() == 0
    assert tuple(explore.date_bounds(nothing).first()) == (None, None)


def test_preview_is_ordered(products):
    rows = explore.preview(products, "products", 2).collect()
    assert [r.ProdutoId for r in rows] == [1, 2]
