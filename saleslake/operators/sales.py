"""Line-level money columns, duplicate removal and the positive-sales filter."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslake.schemas import TICKET_LINE_KEYS, UNIT


def metrics_ars(df: DataFrame) -> DataFrame:
    quantity = F.col("CANTIDAD_VENDIDA")
    return margin_ars(
        df.withColumns(
            {
                "VENTA_ARS": quantity * F.col("VALOR_ARTICULO"),
                "COSTO_ARS": quantity * F.col("COSTO_ARTICULO"),
            }
        )
    )


def margin_ars(df: DataFrame) -> DataFrame:
    return df.withColumn("MARGEN_ARS", F.col("VENTA_ARS") - F.col("COSTO_ARS"))


def metrics_usd(df: DataFrame) -> DataFrame:
    """The ARS metrics in USD; null where the rate is missing or zero."""
    return df.withColumns(
        {f"{m}_USD": F.try_divide(f"{m}_ARS", "TIPO_CAMBIO") for m in ("VENTA", "COSTO", "MARGEN")}
    )


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """First row per key in a total order.

    ``row_number() = 1`` lets Spark drop all but one row per key on the map side, so a key
    with very many copies sends one row per map task to the reducer that holds it.
    """
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def dedup_lines(df: DataFrame, source_order: Sequence[str]) -> DataFrame:
    """First line per date, ticket and article within a branch-month."""
    return keep_first(df, [*UNIT, *TICKET_LINE_KEYS], list(source_order))


def positive_sales(df: DataFrame) -> DataFrame:
    """Lines with sales above zero; belongs after the duplicate removal."""
    return df.where(F.col("VENTA_ARS") > 0)
