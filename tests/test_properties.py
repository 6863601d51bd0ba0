"""Results must not depend on row order or partitioning."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslake.functions.dates import WEEKDAYS
from saleslake.operators.aggregates import top_by
from saleslake.operators.sales import dedup_lines
from saleslake.operators.trends import bucket_sales, daily_totals, monthly_trend
from saleslake.schemas import UNIT

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
LINE = st.tuples(
    st.sampled_from(["a", "b"]), st.integers(1, 3), st.integers(1, 3), st.integers(1, 28),
    st.one_of(st.none(), st.integers(-50, 200).map(float)),
)


def table(spark, lines):
    rows = [
        (b, 2024, 1, datetime(2024, 1, 1), t, a, d, WEEKDAYS[(d - 1) % 7], v, i)
        for i, (b, t, a, d, v) in enumerate(lines)
    ]
    ddl = (
        "SUCURSAL string, YEAR int, MONTH int, FECHA timestamp, NUMERO_TICKET bigint, "
        "ID_ARTICULO bigint, DIA_MES bigint, DIA_SEMANA string, VENTA_USD double, pos int"
    )
    return spark.createDataFrame(rows, ddl)


def spread(df, n):
    return df.orderBy(F.hash("pos", F.lit(n))).repartition(n)


def rows(df):
    return sorted(df.collect(), key=repr)


@FEW
@given(st.lists(LINE, min_size=1, max_size=40), st.integers(1, 5))
def test_first_line_and_best_row(spark, lines, n):
    df = table(spark, lines)
    expected = {}
    for b, t, a, d, v in lines:
        expected.setdefault((b, t, a), (d, v))
    got = rows(dedup_lines(spread(df, n), ["pos"]))
    assert {(r.SUCURSAL, r.NUMERO_TICKET, r.ID_ARTICULO): (r.DIA_MES, r.VENTA_USD) for r in got} == expected
    best = top_by(spread(df, n), UNIT, "VENTA_USD", ["DIA_MES", "pos"])
    assert rows(best) == rows(top_by(df, UNIT, "VENTA_USD", ["DIA_MES", "pos"]))


@FEW
@given(st.lists(LINE, min_size=1, max_size=40))
def test_totals_add_up_and_correlations_are_bounded(spark, lines):
    daily = daily_totals(table(spark, lines))
    for bucket in ("DIA_MES", "DIA_SEMANA"):
        total = bucket_sales(daily, bucket).agg(F.sum("VENTA_USD")).first()[0]
        assert total == sum(v for *_, v in lines if v is not None)
    for scope, allowed in (("chain", None), ("partition", {None, 1.0})):
        values = {r.CORRELACION_MENSUAL for r in monthly_trend(daily, scope).collect()}
        assert all(v is None or -1 <= v <= 1 for v in values)
        assert allowed is None or values <= allowed
