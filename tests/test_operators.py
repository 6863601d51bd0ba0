from datetime import datetime

import pytest
from pyspark.sql import functions as F

from saleslake.functions.dates import WEEKDAYS
from saleslake.operators.aggregates import product_months, sum_by, top_day, top_product, top_weekday
from saleslake.operators.audit import raw_audit
from saleslake.operators.cleaning import cast_text, normalize_headers, trim_all
from saleslake.operators.contract import (
    ContractError,
    check_contract,
)
from saleslake.operators.rates import (
    conform_rates,
    fill_rates,
    join_rates,
    rate_gap_report,
    unique_rates,
)
from saleslake.operators.sales import dedup_lines, metrics_usd, positive_sales
from saleslake.operators.trends import (
    bucket_sales,
    daily_totals,
    monthly_trend,
    profile,
    trend_flags,
    weekday_profile,
    weekly_trend,
)
from saleslake.schemas import RAW, RAW_REQUIRED, UNIT

UNIT_DDL = "SUCURSAL string, YEAR int, MONTH int"
LINE_DDL = f"{UNIT_DDL}, DIA_MES bigint, DIA_SEMANA string, VENTA_USD double"


def rates(spark, rows):
    return spark.createDataFrame(rows, "year int, month int, exchange_rate_ars_usd double, ord int")


def sales_of(spark, months):
    return spark.createDataFrame([("N", y, m) for y, m in months], UNIT_DDL)


def by_month(df):
    return {(r.YEAR, r.MONTH): r.TIPO_CAMBIO for r in df.collect()}


def test_return_listed_first_hides_its_twin(spark):
    ddl = f"{UNIT_DDL}, FECHA timestamp, NUMERO_TICKET bigint, ID_ARTICULO bigint, q int, pos int"
    day = datetime(2024, 1, 5)
    lines = spark.createDataFrame(
        [("N", 2024, 1, day, 1, 7, 3, 2), ("N", 2024, 1, day, 1, 7, -1, 1)], ddl
    ).withColumn("VENTA_ARS", F.col("q") * 1.0)
    first = dedup_lines(lines, ["pos"])
    assert [r.q for r in first.collect()] == [-1]
    assert positive_sales(first).count() == 0


def test_first_rate_of_a_month_wins(spark):
    one = unique_rates(rates(spark, [(2024, 1, 900.0, 2), (2024, 1, 800.0, 1), (2024, 2, None, 3),
                                     (2024, 2, 5.0, 4), (2024, 13, 1.0, 5)]), "ord")
    assert sorted(tuple(r) for r in one.collect()) == [(2024, 1, 800.0), (2024, 2, 5.0)]


def test_rates_join_neither_fans_out_nor_fills(spark):
    one = unique_rates(rates(spark, [(2024, 1, 800.0, 1), (2024, 1, 900.0, 2)]), "ord")
    joined = join_rates(sales_of(spark, [(2024, 1), (2024, 1), (2024, 2)]), one)
    assert joined.count() == 3
    assert by_month(joined) == {(2024, 1): 800.0, (2024, 2): None}
    report = {r.MONTH: (r.row_count, r.without_rate) for r in rate_gap_report(joined).collect()}
    assert report == {1: (2, 0), 2: (1, 1)}


def test_calendar_fill_covers_gaps_and_later_months(spark):
    one = unique_rates(rates(spark, [(2023, 12, 700.0, 1), (2024, 2, 800.0, 2)]), "ord")
    filled = {(r.year, r.month): r.exchange_rate_ars_usd for r in fill_rates(one).collect()}
    assert filled == {(2023, 12): 700.0, (2024, 1): 700.0, (2024, 2): 800.0}
    months = [(2023, 11), (2024, 1), (2024, 2), (2025, 6)]
    assert by_month(join_rates(sales_of(spark, months), one, fill="calendar")) == {
        (2023, 11): None,
        (2024, 1): 700.0,
        (2024, 2): 800.0,
        (2025, 6): 800.0,
    }


def test_rates_contract(spark):
    good = spark.createDataFrame([(" 2024", "1", "800.5")], [" Year", "MONTH ", "exchange_rate_ARS_usd"])
    assert [tuple(r) for r in conform_rates(good).collect()] == [(2024, 1, 800.5)]
    with pytest.raises(ContractError, match="exchange_rate_ars_usd"):
        conform_rates(good.drop("exchange_rate_ARS_usd"))


def test_zero_rate_is_no_rate(spark):
    row = spark.createDataFrame([(1.0, 1.0, 1.0, 0.0)], ["VENTA_ARS", "COSTO_ARS", "MARGEN_ARS", "TIPO_CAMBIO"])
    assert metrics_usd(row).first().VENTA_USD is None


def test_ties(spark):
    products = spark.createDataFrame(
        [("N", 2024, 1, 7, "siete", 5.0), ("N", 2024, 1, 3, "tres", 5.0), ("N", 2024, 1, 1, "uno", 4.0)],
        f"{UNIT_DDL}, ID_ARTICULO bigint, DESC_ARTICULO string, MARGEN_USD double",
    )
    assert top_product(products).first().PRODUCTO_TOP_MARGEN == "tres"
    days = spark.createDataFrame(
        [("N", 2024, 1, 9, 1.0), ("N", 2024, 1, 4, 1.0)], f"{UNIT_DDL}, DIA_MES bigint, VENTA_USD double"
    )
    assert top_day(days).first().DIA_MES_TOP_VENTAS == 4
    week = spark.createDataFrame(
        [("N", 2024, 1, "Lunes", 1.0), ("N", 2024, 1, "Domingo", 1.0)],
        f"{UNIT_DDL}, DIA_SEMANA string, VENTA_USD double",
    )
    assert top_weekday(week).first().DIA_SEMANA_TOP_VENTAS == "Domingo"


def test_sums_of_nulls_and_null_keys(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), (None, 1.0)], "k string, v double")
    assert [tuple(r) for r in sum_by(rows, ["k"], ["v"]).collect()] == [("a", 0.0)]


def test_month_without_rate_counts_as_zero(spark):
    ddl = (f"{UNIT_DDL}, ID_ARTICULO bigint, DESC_ARTICULO string, CANTIDAD_VENDIDA bigint, "
           "VENTA_ARS double, COSTO_ARS double, MARGEN_ARS double, VENTA_USD double, "
           "COSTO_USD double, MARGEN_USD double")  # fmt: skip
    silver = spark.createDataFrame([("N", 2024, 1, 1, "a", 2, 10.0, 6.0, 4.0, None, None, None)], ddl)
    row = product_months(silver).first()
    assert (row.VENTA_USD, row.MARGEN_PORC_USD, row.MARGEN_PORC_ARS) == (0.0, 0.0, 0.4)


def lines(spark, rows):
    return spark.createDataFrame([(b, 2024, 1, d, WEEKDAYS[(d - 1) % 7], v) for b, d, v in rows], LINE_DDL)


def test_trend_of_flat_or_single_profiles_is_unknown(spark):
    daily = daily_totals(lines(spark, [("one", 1, 5.0), ("flat", 1, 3.0), ("flat", 2, 3.0),
                                       ("up", 1, 1.0), ("up", 2, 9.0), ("up", 3, 4.0)]))
    trends = {r.SUCURSAL: tuple(r)[1:] for r in weekly_trend(daily).collect()}
    assert trends["one"] == (None, False) and trends["flat"] == (None, False)
    assert trends["up"][1] is True and -1 <= trends["up"][0] <= 1


def test_trend_against_numpy(spark):
    import numpy as np

    rows = [(b, d, float((d * k) % 11 + k)) for b, k in (("a", 3), ("b", 5), ("c", 7)) for d in range(1, 29)]
    rows += [("a", 30, None)]
    daily = daily_totals(lines(spark, rows))
    got = {r.SUCURSAL: r.CORRELACION_MENSUAL for r in monthly_trend(daily).collect()}
    overall = [np.mean([v for _, d, v in rows if d == day]) for day in range(1, 29)]
    for branch in "abc":
        own = [v for b, d, v in rows if b == branch and d <= 28]
        assert got[branch] == pytest.approx(np.corrcoef(own, overall)[0, 1], abs=1e-9)


def test_partition_scope_is_one_or_unknown(spark):
    daily = daily_totals(lines(spark, [("a", 1, 5.0), ("a", 2, 7.0), ("b", 1, 3.0)]))
    both = trend_flags(weekly_trend(daily, "partition"), monthly_trend(daily, "partition"), "partition")
    got = {r.SUCURSAL: tuple(r)[3:] for r in both.collect()}
    assert got == {"a": (1.0, True, 1.0, True), "b": (None, False, None, False)}


def test_profile_is_the_mean_of_lines(spark):
    daily = daily_totals(lines(spark, [("a", 1, 1.0), ("a", 1, 2.0), ("a", 8, 6.0), ("a", 8, None)]))
    means = profile(daily, ["SUCURSAL"], "DIA_SEMANA").collect()
    assert [(r.DIA_SEMANA, r.VENTA_USD) for r in means] == [("Lunes", 3.0)]


def test_contracts(spark):
    df = spark.createDataFrame([(1, 2)], ["FECHA", "OBS"])
    report = check_contract(df, ["FECHA", "COSTO_ARTICULO"])
    assert (report.missing, report.unexpected, report.accepted) == (("COSTO_ARTICULO",), ("OBS",), False)
    with pytest.raises(ContractError, match="FECHA"):
        normalize_headers(spark.createDataFrame([(1, 2)], [" fecha ", "FECHA"]))
    assert normalize_headers(spark.createDataFrame([(1, 2)], [" fecha ", "Obs"])).columns == ["FECHA", "OBS"]


def test_no_line_is_lost_for_an_unknown_weekday_or_day(spark):
    rows = [("a", 2024, 1, 5, "Miercoles", 100.0), ("a", 2024, 1, 6, "Jueves", 10.0), ("a", 2024, 1, None, "Jueves", 7.0), ("a", 2024, 1, 7, None, 3.0)]
    silver = spark.createDataFrame(rows, f"{UNIT_DDL}, DIA_MES long, DIA_SEMANA string, VENTA_USD double")
    daily = daily_totals(silver)
    assert top_day(bucket_sales(daily, "DIA_MES")).first().DIA_MES_TOP_VENTAS == 5
    assert {r.DIA_SEMANA: r.VENTA_USD for r in bucket_sales(daily, "DIA_SEMANA").collect()} == {"Miercoles": 100.0, "Jueves": 17.0}
    assert {r.DIA_SEMANA for r in weekday_profile(daily).collect()} == set(WEEKDAYS)
    for scope in ("chain", "partition"):  # one weekday of the seven: nothing to correlate
        assert weekly_trend(daily, scope).first().CORRELACION_SEMANAL is None
        assert monthly_trend(daily, scope).first().CORRELACION_MENSUAL == 1.0


def test_sheet_with_only_bad_dates_is_empty(spark):
    rows = [("a", 1, None), ("a", 2, "bad"), ("b", 2, "bad"), ("b", 3, " 20240105")]
    raw = spark.createDataFrame([("raw/Ventas_N.xlsx", s, 0, n, None, RAW_REQUIRED, [d] if d else None) for s, n, d in rows], RAW)
    got = {r.sheet: (r.status, r.reason, r.data_rows, r.bad_dates) for r in raw_audit(raw).collect()}
    assert got == {"a": ("empty", "no_valid_dates", 1, 1), "b": ("ok", None, 2, 1)}


def test_repeated_rates_multiply_no_line(spark):
    sales = spark.createDataFrame([("a", 2024, 1), ("a", 2024, 2)], UNIT_DDL)
    rates = spark.createDataFrame([(2024, 1, 9.0), (2024, 1, 8.0), (2024, 13, 1.0), (2024, 2, 5.0)], "year int, month int, exchange_rate_ars_usd double")
    got = sorted((r.MONTH, r.TIPO_CAMBIO) for r in join_rates(sales, rates).collect())
    assert got == [(1, 8.0), (2, 5.0)]


def test_text_tables(spark):
    df = spark.createDataFrame([("\t a ", 1), (None, None)], "s string, n int")
    assert [tuple(r) for r in trim_all(df).collect()] == [("a", 1), (None, None)]
    assert [tuple(r) for r in cast_text(df).collect()] == [("\t a ", "1"), ("nan", "nan")]
