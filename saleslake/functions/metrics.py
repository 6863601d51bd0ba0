"""Money metrics, margin ratios and the margin target."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The target and the classes around it.
TARGET = 0.20
BELOW, EQUAL, ABOVE, UNKNOWN = "no alcanzó", "igualó", "superó", "sin datos"


def margin_ratio(margin: Column, sales: Column) -> Column:
    """Margin over sales; 0 where it is undefined."""
    return F.coalesce(F.try_divide(margin, sales), F.lit(0.0))


def target_class(ratio: Column, target: float = TARGET) -> Column:
    """Class of a margin ratio; null and NaN count as unknown, not as above."""
    return (
        F.when(ratio.isNull() | F.isnan(ratio), UNKNOWN)
        .when(ratio < target, BELOW)
        .when(ratio == target, EQUAL)
        .otherwise(ABOVE)
    )
