"""Timestamps, calendar parts and Spanish names."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish names, Monday first and January first.
WEEKDAYS = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
MONTHS = [
    "Enero",
    "Febrero",
    "Marzo",
    "Abril",
    "Mayo",
    "Junio",
    "Julio",
    "Agosto",
    "Septiembre",
    "Octubre",
    "Noviembre",
    "Diciembre",
]
DAYS_OF_MONTH = list(range(1, 32))
ISO = "ISO"  # a date, or date and time with T or a blank, seconds and fraction optional
DATE_FORMATS = (ISO, "yyyyMMdd")
# Shapes that keep other texts away from a parser: a failing one costs far more than a match.
SHAPES = {
    ISO: r"^\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d{1,9})?)?)?$",
    "yyyyMMdd": r"^\d{8}$",
}


def to_ts(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp by the first format that fits; null where none does."""
    text = F.trim(c.cast("string"))

    def read(format: str) -> Column:
        read = text.try_cast("timestamp") if format == ISO else F.try_to_timestamp(text, F.lit(format))
        return F.when(text.rlike(SHAPES[format]), read) if format in SHAPES else read

    return F.coalesce(*[read(f) for f in formats])


def _name(names: Sequence[str], position: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), position)


def weekday_es(c: Column) -> Column:
    return _name(WEEKDAYS, F.weekday(c))


def month_es(month: Column) -> Column:
    return _name(MONTHS, month - 1)
