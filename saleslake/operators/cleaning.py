"""Header and cell clean-up of text tables, typed columns, calendar columns."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.dates import DATE_FORMATS, month_es, to_ts, weekday_es
from saleslake.functions.numeric import to_double, to_int
from saleslake.functions.text import strip, text_or
from saleslake.operators.contract import ContractError
from saleslake.schemas import DOUBLE_COLUMNS, INTEGER_COLUMNS


def normalize_headers(df: DataFrame, case: str = "upper") -> DataFrame:
    """Trim all headers and give them one case; two headers that become equal are rejected."""
    fold = {"upper": str.upper, "lower": str.lower}[case]
    names = [fold(c.strip()) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ContractError(f"duplicate columns after normalisation: {', '.join(twice)}")
    return df.toDF(*names)


def _text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def trim_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim every text column, or those named."""
    return df.withColumns({c: strip(F.col(c)) for c in (_text_columns(df) if columns is None else columns)})


def cast_text(df: DataFrame, null_text: str = "nan", columns: Sequence[str] | None = None) -> DataFrame:
    """Every column, or those named, as text, missing cells as ``null_text``."""
    chosen = df.columns if columns is None else columns
    return df.select(*[text_or(F.col(c), null_text).alias(c) if c in chosen else c for c in df.columns])


def coerce_numbers(
    df: DataFrame,
    integers: Sequence[str] = INTEGER_COLUMNS,
    doubles: Sequence[str] = DOUBLE_COLUMNS,
) -> DataFrame:
    typed = {c: to_int(F.col(c)) for c in integers} | {c: to_double(F.col(c)) for c in doubles}
    return df.withColumns(typed)


def coerce_date(
    df: DataFrame, column: str = "FECHA", formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    return df.withColumn(column, to_ts(F.col(column), formats))


def valid_dates(df: DataFrame, column: str = "FECHA") -> DataFrame:
    """Drop the rows whose date did not parse."""
    return df.dropna(subset=[column])


def add_unit(df: DataFrame, branch: Column, date: str = "FECHA") -> DataFrame:
    """Partition columns of a dated row."""
    return df.withColumns({"SUCURSAL": branch, "YEAR": F.year(date), "MONTH": F.month(date)})


def add_calendar(df: DataFrame, date: str = "FECHA") -> DataFrame:
    """Day of month and Spanish weekday."""
    return df.withColumns(
        {"DIA_MES": F.dayofmonth(date).cast("bigint"), "DIA_SEMANA": weekday_es(F.col(date))}
    )


def add_month_name(df: DataFrame) -> DataFrame:
    return df.withColumn("MONTH_NAME", month_es(F.col("MONTH")))
