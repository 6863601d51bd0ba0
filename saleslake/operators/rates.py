"""Monthly exchange rates: one rate per month, forward fill, and the join to sales.

A month number is ``12 * year + month``. A rates table is reduced to one row per calendar
month of the years 1 to 9999 before it is broadcast, so the broadcast side holds at most
119,988 rows of two numbers whatever the input holds.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslake.functions.numeric import parse_double
from saleslake.operators.cleaning import normalize_headers
from saleslake.operators.contract import check_contract
from saleslake.schemas import RATE_COLUMNS, RATES

RATE = "exchange_rate_ars_usd"


def month_number(year: Column, month: Column) -> Column:
    return (year * 12 + month).cast("int")


def conform_rates(raw: DataFrame) -> DataFrame:
    """Rates table with normalised headers and declared types; other columns are kept."""
    rates = normalize_headers(raw, "lower")
    check_contract(rates, RATE_COLUMNS).require("exchange rates")
    return rates.withColumns(
        {f.name: parse_double(F.col(f.name)).try_cast(f.dataType) for f in RATES.fields}
    )


def on_calendar() -> Column:
    return F.col("month").between(1, 12) & F.col("year").between(1, 9999)


def unique_rates(rates: DataFrame, order_col: str) -> DataFrame:
    """One rate per calendar month: the first non-null one in file order."""
    first = F.min_by(RATE, F.when(F.col(RATE).isNotNull(), F.col(order_col)))
    return rates.where(on_calendar()).groupBy("year", "month").agg(first.alias(RATE))


def fill_rates(rates: DataFrame) -> DataFrame:
    """Every month from the first to the last one, each with the latest rate known by then.

    The unpartitioned window sees one row per calendar month, which is bounded (see above).
    """
    number = month_number(F.col("year"), F.col("month"))
    span = rates.agg(F.min(number).alias("lo"), F.max(number).alias("hi"))
    months = span.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("n"))
    known = rates.select(number.alias("n"), RATE)
    so_far = W.orderBy("n").rowsBetween(W.unboundedPreceding, W.currentRow)
    return months.join(known, "n", "left").select(
        F.floor((F.col("n") - 1) / 12).cast("int").alias("year"),
        ((F.col("n") - 1) % 12 + 1).cast("int").alias("month"),
        F.last(RATE, ignorenulls=True).over(so_far).alias(RATE),
    )


def join_rates(df: DataFrame, rates: DataFrame, fill: str = "none") -> DataFrame:
    """Left join of the month's rate as TIPO_CAMBIO.

    ``rates`` are reduced to one row per calendar month here, so that no caller can multiply
    lines or broadcast more than the calendar: by file order where they have ``ord``, else
    the smallest rate of the month.
    ``fill="calendar"`` carries the latest known rate into months without one, including
    months after the end of the rates table.
    """
    sales_month = month_number(F.col("YEAR"), F.col("MONTH"))
    order = "ord" if "ord" in rates.columns else RATE
    rates = unique_rates(rates, order)
    if fill == "calendar":
        rates = fill_rates(rates)
        last = rates.agg(F.max(month_number(F.col("year"), F.col("month")))).scalar()
        sales_month = F.least(sales_month, last)
    elif fill != "none":
        raise ValueError(f"fill must be 'none' or 'calendar', not {fill!r}")
    lookup = rates.select(
        month_number(F.col("year"), F.col("month")).alias("_month"),
        F.col(RATE).alias("TIPO_CAMBIO"),
    )
    keyed = df.withColumn("_month", sales_month)
    return keyed.join(F.broadcast(lookup), "_month", "left").drop("_month")


def rate_gap_report(df: DataFrame) -> DataFrame:
    """Rows per month and how many of them have no rate."""
    return df.groupBy("YEAR", "MONTH").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("TIPO_CAMBIO").isNull()).alias("without_rate"),
    )
