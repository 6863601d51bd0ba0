"""Monthly aggregates, best row per group, and the joins that attach it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.metrics import margin_ratio
from saleslake.operators.sales import keep_first
from saleslake.schemas import GOLD_MEASURES, PRODUCT_KEYS, UNIT


def sum_by(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], drop_null_keys: bool = True
) -> DataFrame:
    """Sums per key; a sum over nothing but nulls is 0."""
    rows = df.dropna(subset=list(keys)) if drop_null_keys else df
    zero = F.lit(0)
    return rows.groupBy(*keys).agg(*[F.coalesce(F.sum(m), zero).alias(m) for m in measures])


def product_sums(silver: DataFrame) -> DataFrame:
    """One row per branch-month and article, with the sums of its measures."""
    return sum_by(silver, PRODUCT_KEYS, GOLD_MEASURES)


def with_margin_ratios(products: DataFrame) -> DataFrame:
    """Both margin ratios of summed rows; they follow from the sums, so a stored table need not hold them."""
    return products.withColumns(
        {
            f"MARGEN_PORC_{currency}": margin_ratio(
                F.col(f"MARGEN_{currency}"), F.col(f"VENTA_{currency}")
            )
            for currency in ("ARS", "USD")
        }
    )


def product_months(silver: DataFrame) -> DataFrame:
    """One row per branch-month and article, with both margin ratios."""
    return with_margin_ratios(product_sums(silver))


def top_by(
    df: DataFrame, group: Sequence[str], measure: str, tie_break: Sequence[str | Column]
) -> DataFrame:
    """Row with the largest measure per group; ``tie_break`` makes the order total."""
    return keep_first(df, group, [F.col(measure).desc(), *tie_break])


def top_product(products: DataFrame) -> DataFrame:
    best = top_by(products, UNIT, "MARGEN_USD", ["ID_ARTICULO", "DESC_ARTICULO"])
    return best.select(*UNIT, F.col("DESC_ARTICULO").alias("PRODUCTO_TOP_MARGEN"))


def top_day(day_sales: DataFrame) -> DataFrame:
    best = top_by(day_sales, UNIT, "VENTA_USD", ["DIA_MES"])
    return best.select(*UNIT, F.col("DIA_MES").cast("int").alias("DIA_MES_TOP_VENTAS"))


def top_weekday(weekday_sales: DataFrame) -> DataFrame:
    best = top_by(weekday_sales, UNIT, "VENTA_USD", ["DIA_SEMANA"])
    return best.select(*UNIT, F.col("DIA_SEMANA").alias("DIA_SEMANA_TOP_VENTAS"))


def attach(df: DataFrame, summary: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """Left join of a one-row-per-key summary.

    No broadcast hint: the summary grows with branches and months, so Spark decides by the
    size it knows (file or shuffle statistics) and splits a hot key of the large side when
    it has to shuffle.
    """
    return df.join(summary, list(keys), "left")
