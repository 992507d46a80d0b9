"""Bronze → silver → gold as tables, each stage replacing its own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gapledger import constants as C
from gapledger.operators.gold import (
    GOLD_CIRCULAR_COLUMNS,
    GOLD_POLICY_COLUMNS,
    fit_gold,
    gold_vectors,
)
from gapledger.operators.silver import silver_circulars, silver_policies
from gapledger.sources.tables import load_table, save_table


@dataclass(frozen=True)
class TableNames:
    database: str = "default"
    policies: str = "policies"
    circulars: str = "rbi"

    def of(self, layer: str, what: str) -> str:
        return f"{self.database}.{layer}_{what}"


def run_bronze(
    policies: DataFrame, circulars: DataFrame, names: TableNames = TableNames(),
    fmt: str = "parquet",
) -> tuple[DataFrame, DataFrame]:
    return (
        save_table(policies, names.of("bronze", names.policies), fmt),
        save_table(circulars, names.of("bronze", names.circulars), fmt),
    )


def run_silver(
    spark: SparkSession, names: TableNames = TableNames(), fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    policies = load_table(spark, names.of("bronze", names.policies))
    circulars = load_table(spark, names.of("bronze", names.circulars))
    return (
        save_table(silver_policies(policies), names.of("silver", names.policies), fmt),
        save_table(silver_circulars(circulars), names.of("silver", names.circulars), fmt),
    )


def run_gold(
    spark: SparkSession, names: TableNames = TableNames(), fmt: str = "parquet",
    num_features: int = C.HASH_FEATURES,
) -> tuple[DataFrame, DataFrame]:
    """One model per table; the two are never mixed."""
    policies = load_table(spark, names.of("silver", names.policies))
    circulars = load_table(spark, names.of("silver", names.circulars))
    gold_policies = gold_vectors(fit_gold(policies, num_features), policies, GOLD_POLICY_COLUMNS)
    gold_circulars = gold_vectors(
        fit_gold(circulars, num_features), circulars, GOLD_CIRCULAR_COLUMNS
    )
    return (
        save_table(gold_policies, names.of("gold", names.policies), fmt),
        save_table(gold_circulars, names.of("gold", names.circulars), fmt),
    )
