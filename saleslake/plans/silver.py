"""Bronze to silver: types, money metrics, exchange rate, calendar, duplicates, positive sales."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from saleslake.operators.cleaning import add_calendar, coerce_numbers
from saleslake.operators.contract import check_contract
from saleslake.operators.rates import join_rates
from saleslake.operators.sales import dedup_lines, metrics_ars, metrics_usd, positive_sales
from saleslake.schemas import EXTRA, RAW_REQUIRED, SILVER, SOURCE_COLUMNS, UNIT


def silver_lines(
    typed: DataFrame,
    rates: DataFrame,
    fill: str = "none",
    source_order: Sequence[str] = SOURCE_COLUMNS,
) -> DataFrame:
    """Silver lines from typed sales lines; columns beyond the contract travel along in ``_extra``.

    Duplicates go before everything that is computed from the typed columns: the derived
    columns depend on the row alone, so they need not travel through the shuffle. The
    positive filter has to follow the duplicate removal.
    """
    return first_lines(dedup_lines(typed, source_order), rates, fill)


def first_lines(typed: DataFrame, rates: DataFrame, fill: str = "none") -> DataFrame:
    """Silver lines from typed sales lines without duplicates."""
    sold = positive_sales(metrics_ars(typed))
    enriched = add_calendar(metrics_usd(join_rates(sold, rates, fill)))
    extra = [EXTRA] if EXTRA in typed.columns else []
    return enriched.select(*SILVER.fieldNames(), *extra, *UNIT)


def silver_build(
    bronze: DataFrame,
    rates: DataFrame,
    fill: str = "none",
    source_order: Sequence[str] = SOURCE_COLUMNS,
) -> DataFrame:
    """Silver lines of all branch-months in ``bronze``; ``rates`` holds one row per month."""
    check_contract(bronze, RAW_REQUIRED).require("bronze")
    return silver_lines(coerce_numbers(bronze), rates, fill, source_order)
