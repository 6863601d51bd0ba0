"""Silver to gold: one row per branch-month and article."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.functions.metrics import target_class
from saleslake.operators.aggregates import (
    attach,
    product_sums,
    top_day,
    top_product,
    top_weekday,
    with_margin_ratios,
)
from saleslake.operators.cleaning import add_month_name
from saleslake.operators.contract import check_contract
from saleslake.operators.trends import (
    bucket_sales,
    daily_totals,
    monthly_trend,
    trend_flags,
    weekly_trend,
)
from saleslake.schemas import GOLD, GOLD_INPUT, UNIT
from saleslake.sources.staging import Stage


def unit_summary(products: DataFrame, daily: DataFrame, scope: str = "chain") -> DataFrame:
    """One row per branch-month: best product, day and weekday, and the trend flags."""
    summary = attach(top_product(products), top_day(bucket_sales(daily, "DIA_MES")))
    summary = attach(summary, top_weekday(bucket_sales(daily, "DIA_SEMANA")))
    flags = trend_flags(weekly_trend(daily, scope), monthly_trend(daily, scope), scope)
    return attach(summary, flags, ["SUCURSAL"] if scope == "chain" else UNIT)


def gold_build(silver: DataFrame, scope: str, stage: Stage) -> DataFrame:
    """Gold rows of all branch-months in ``silver``, a stored table.

    Everything follows from two aggregates of silver, products and daily totals. ``stage``
    writes the results that have several consumers (these two) or whose size decides a join
    (the branch-month summary) while the plan is built; silver is then read exactly twice.
    """
    check_contract(silver, GOLD_INPUT).require("silver")
    products = with_margin_ratios(stage(product_sums(silver)))
    daily = stage(daily_totals(silver))
    summary = stage(unit_summary(products, daily, scope))
    result = attach(products, summary).withColumn(
        "CUMPLIMIENTO_OBJETIVO", target_class(F.col("MARGEN_PORC_USD"))
    )
    return add_month_name(result).select(*GOLD.fieldNames(), *UNIT)
