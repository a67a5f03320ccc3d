"""The three reports: where each is stored, what it is built from, what it measures."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from finlake.operators import summaries


@dataclass(frozen=True)
class Report:
    name: str
    table: str
    sources: tuple[str, ...]
    keys: tuple[str, ...]
    measure: str
    build: Callable[..., DataFrame]

    @property
    def has_product(self) -> bool:
        return "ProdutoId" in self.keys


# Table paths below the gold folder, and the measure each report plots.
REPORTS = {
    report.name: report
    for report in (
        Report(
            name="products",
            table="vendas/tb_gd_resumo_produtos_filiais",
            sources=("returns", "stock", "sales"),
            keys=tuple(summaries.PRODUCT_KEYS),
            measure="TotalQuantidadeVendida",
            build=summaries.product_summary,
        ),
        Report(
            name="freight",
            table="logistica/tb_gd_resumo_fretes_pagos",
            sources=("freight",),
            keys=tuple(summaries.FREIGHT_KEYS),
            measure="TotalFretePago",
            build=summaries.freight_summary,
        ),
        Report(
            name="taxes",
            table="tributario/tb_gd_resumo_impostos_pagos",
            sources=("taxes",),
            keys=tuple(summaries.TAX_KEYS),
            measure="TotalImpostoPago",
            build=summaries.tax_summary,
        ),
    )
}


def get_report(report: Report | str) -> Report:
    return report if isinstance(report, Report) else REPORTS[report]
