"""Sales profiles over weekdays or days of the month, and how a branch follows the overall one.

All profile functions take daily totals (sum and line count per branch-month and date parts)
instead of lines: means of lines follow from them, and a whole set of profiles then costs
one pass over the sales.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.dates import DAYS_OF_MONTH, WEEKDAYS
from saleslake.schemas import UNIT

THRESHOLD = 0.7  # fixed value
LINES = "LINEAS"
DOMAINS = {"DIA_SEMANA": WEEKDAYS, "DIA_MES": DAYS_OF_MONTH}


def daily_totals(silver: DataFrame, measure: str = "VENTA_USD") -> DataFrame:
    """Sum and number of non-null lines per branch-month, day of month and weekday.

    No line is left out: a line without a day counts for its weekday and the other way round.
    The sum is written in terms of the count, so that all consumers need the same two
    aggregates and share one exchange.
    """
    lines = F.count(measure)
    total = F.when(lines == 0, F.lit(0.0)).otherwise(F.sum(measure))
    return silver.groupBy(*UNIT, "DIA_MES", "DIA_SEMANA").agg(
        total.alias(measure), lines.alias(LINES)
    )


def _known(bucket: str) -> Column:
    """The bucket as an aggregate: a filter on it stays above the aggregate, so that consumers
    with different buckets still share the daily totals below."""
    return F.max(bucket).alias("_known")


def bucket_sales(daily: DataFrame, bucket: str, measure: str = "VENTA_USD") -> DataFrame:
    """Sales per branch-month and bucket (day of month or weekday)."""
    sums = daily.groupBy(*UNIT, bucket).agg(F.sum(measure).alias(measure), _known(bucket))
    return sums.where("_known IS NOT NULL").drop("_known")


def profile(
    daily: DataFrame, keys: Sequence[str], bucket: str, measure: str = "VENTA_USD"
) -> DataFrame:
    """Mean per line for each bucket and key; null where no line has a value."""
    mean = F.try_divide(F.sum(measure), F.sum(LINES).cast("double"))
    means = daily.groupBy(*keys, bucket).agg(mean.alias(measure), _known(bucket))
    return means.where("_known IS NOT NULL").drop("_known")


def weekday_profile(daily: DataFrame, measure: str = "VENTA_USD") -> DataFrame:
    """Overall weekday profile over all seven days, Monday first; absent days are null."""
    spark = daily.sparkSession
    week = spark.range(1, 8, numPartitions=1).select(
        F.col("id").cast("int").alias("ORDEN"),
        F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), (F.col("id") - 1).cast("int")).alias(
            "DIA_SEMANA"
        ),
    )
    overall = profile(daily, [], "DIA_SEMANA", measure)
    return week.join(overall, "DIA_SEMANA", "left").orderBy("ORDEN")


def day_profile(daily: DataFrame, measure: str = "VENTA_USD") -> DataFrame:
    """Overall day-of-month profile in day order."""
    return profile(daily, [], "DIA_MES", measure).orderBy("DIA_MES")


def pivot_profile(
    daily: DataFrame, entity: Sequence[str], bucket: str, measure: str = "VENTA_USD"
) -> DataFrame:
    """Profiles side by side, one column per bucket of the fixed domain."""
    means = profile(daily, entity, bucket, measure)
    return means.groupBy(*entity).pivot(bucket, DOMAINS[bucket]).agg(F.first(measure))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; null where either side does not vary."""
    complete = x.isNotNull() & y.isNotNull()
    px, py = F.when(complete, x), F.when(complete, y)
    r = F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))
    return F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)


def trend(
    daily: DataFrame,
    bucket: str,
    prefix: str,
    scope: str = "chain",
    threshold: float = THRESHOLD,
    measure: str = "VENTA_USD",
) -> DataFrame:
    """Correlation of each branch's profile with the overall one, and whether it follows it.

    ``scope="chain"``: one row per branch, compared with all branches over all months.
    ``scope="partition"``: one row per branch-month, whose overall profile is its own.
    """
    if scope == "chain":
        entity = ["SUCURSAL"]
        own = profile(daily, entity, bucket, measure)
        overall = profile(daily, [], bucket, measure).withColumnRenamed(measure, "_all")
        if bucket == "DIA_SEMANA":  # the seven names only, so the broadcast has seven rows
            names = F.max(F.when(F.col(bucket).isin(WEEKDAYS), F.col(bucket))).alias("_known")
            week = overall.groupBy(bucket).agg(F.max("_all").alias("_all"), names)
            overall = F.broadcast(week.where("_known IS NOT NULL").drop("_known"))
        # A null-safe join lets no null filter down to the sales: both sides share one pass.
        same = F.col(bucket).eqNullSafe(F.col("_bucket"))
        pairs = own.join(overall.withColumnRenamed(bucket, "_bucket"), same, "left")
    elif scope == "partition":
        entity = UNIT
        known = F.col(bucket).isin(WEEKDAYS) if bucket == "DIA_SEMANA" else F.lit(True)
        pairs = profile(daily, entity, bucket, measure).withColumn(
            "_all", F.when(known, F.col(measure))
        )
    else:
        raise ValueError(f"scope must be 'chain' or 'partition', not {scope!r}")
    r = F.round(correlation(F.col(measure), F.col("_all")), 12)
    return (
        pairs.groupBy(*entity)
        .agg(r.alias(f"CORRELACION_{prefix}"))
        .withColumn(
            f"SIGUE_TENDENCIA_{prefix}",
            F.coalesce(F.col(f"CORRELACION_{prefix}") >= threshold, F.lit(False)),
        )
    )


def weekly_trend(daily: DataFrame, scope: str = "chain", threshold: float = THRESHOLD) -> DataFrame:
    return trend(daily, "DIA_SEMANA", "SEMANAL", scope, threshold)


def monthly_trend(daily: DataFrame, scope: str = "chain", threshold: float = THRESHOLD) -> DataFrame:
    return trend(daily, "DIA_MES", "MENSUAL", scope, threshold)


def trend_flags(weekly: DataFrame, monthly: DataFrame, scope: str = "chain") -> DataFrame:
    """Both trends side by side, also for a branch that has only one of them."""
    keys = ["SUCURSAL"] if scope == "chain" else UNIT
    return weekly.join(monthly, keys, "full")
