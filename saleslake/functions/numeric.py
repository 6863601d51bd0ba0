"""Text to number, with a fixed value for anything that is no plain number."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cast alone would accept "12d", "nan" or "Infinity", and a cast that fails costs a hundred
# times as much as one that succeeds.
PLAIN_INTEGER = r"^\s*[+-]?\d+\s*$"
PLAIN_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def to_int(c: Column) -> Column:
    """Whole number, truncated toward zero; 0 where the text is no number.

    Integers are cast directly, which keeps those beyond 2^53 exact.
    """
    text = c.cast("string")
    whole = F.when(text.rlike(PLAIN_INTEGER), text.try_cast("bigint")).otherwise(
        parse_double(c).try_cast("bigint")
    )
    return F.coalesce(whole, F.lit(0).cast("bigint"))


def parse_double(c: Column) -> Column:
    """Double; null where the text is no number."""
    text = c.cast("string")
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def to_double(c: Column) -> Column:
    """Double; 0.0 where the text is no number."""
    return F.coalesce(parse_double(c), F.lit(0.0))
