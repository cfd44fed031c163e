"""The star schema as four frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallymill.sources.tables import read_warehouse


@dataclass(frozen=True)
class Star:
    """Dimension keys are unique; the reports rely on that to sum before they join."""

    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame

    @classmethod
    def from_warehouse(cls, spark: SparkSession, warehouse: str) -> Star:
        return cls(
            *[
                read_warehouse(spark, warehouse, table)
                for table in ("dim_customer", "dim_product", "dim_date", "fact_sales")
            ]
        )
