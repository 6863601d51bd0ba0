from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from saleslake.functions.dates import month_es, to_ts, weekday_es
from saleslake.functions.metrics import margin_ratio, target_class
from saleslake.functions.numeric import to_double, to_int
from saleslake.functions.text import branch_from_path, partition_values, strip

GOOD = {
    "12": (12, 12.0),
    "12.7": (12, 12.7),
    "-12.7": (-12, -12.7),
    "1e3": (1000, 1000.0),
    " 7 ": (7, 7.0),
    "+5": (5, 5.0),
    ".5": (0, 0.5),
    "5.": (5, 5.0),
    "1.0": (1, 1.0),
    "9007199254740993": (9007199254740993, 9007199254740992.0),
}
BAD = [
    "nan", "NaN", "None", "", "1,234", "12d", "12f", "0x10", "True", "1_000", "inf", "-", ".",
    "1e", "99999999999999999999d",
]


def values(spark, texts, *columns):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", *columns)
    return {r[0]: tuple(r)[1:] for r in rows.collect()}


def test_numbers(spark):
    got = values(spark, [*GOOD, *BAD, None], to_int(F.col("t")), to_double(F.col("t")))
    assert {t: got[t] for t in GOOD} == GOOD
    assert {got[t] for t in [*BAD, None]} == {(0, 0.0)}


def test_number_beyond_bigint_is_bad(spark):
    assert values(spark, ["99999999999999999999"], to_int(F.col("t"))) == {
        "99999999999999999999": (0,)
    }


def test_dates(spark):
    texts = ["2024-01-05", "2024-02-01 10:30:00", "nan", "NaT", "05/03/2024", "2024", "2024-13-01"]
    got = values(spark, texts, to_ts(F.col("t")))
    assert got["2024-01-05"] == (datetime(2024, 1, 5),)
    assert got["2024-02-01 10:30:00"] == (datetime(2024, 2, 1, 10, 30),)
    assert {got[t] for t in texts[2:]} == {(None,)}


def test_iso_variants(spark):
    want = {
        "2024-01-05T10:30:00": datetime(2024, 1, 5, 10, 30),
        "2024-01-05 10:30": datetime(2024, 1, 5, 10, 30),
        "2024-01-05 10:30:00.250": datetime(2024, 1, 5, 10, 30, 0, 250_000),
        "20240105": datetime(2024, 1, 5),
        "20241305": None,
        "2024-01-05T25:00": None,
    }
    got = values(spark, list(want), to_ts(F.col("t")))
    assert got == {t: (v,) for t, v in want.items()}


def test_date_format_is_opt_in(spark):
    formats = ["yyyy-MM-dd", "dd/MM/yyyy"]
    got = values(spark, ["05/03/2024", "2024-01-05"], to_ts(F.col("t"), formats))
    assert got == {"05/03/2024": (datetime(2024, 3, 5),), "2024-01-05": (datetime(2024, 1, 5),)}


@pytest.mark.parametrize(
    ("path", "branch"),
    [
        ("raw/Ventas_Norte.xlsx", "Norte"),
        ("raw/VENTAS - San Juan.XLSX", "SanJuan"),
        ("raw/2024/ventas-Sur.xlsx", "Sur"),
        ("Ventas.xlsx", ""),
        ("raw/Centro ventas_2.v1.xlsx", "Centro2.v1"),
    ],
)
def test_branch_names(spark, path, branch):
    assert values(spark, [path], branch_from_path(F.col("t"))) == {path: (branch,)}


def test_partition_names_are_decoded(spark, tmp_path):
    names = ["San Juan", "a:b", "50% + x", "ñ"]
    spark.createDataFrame([(n, 2024, 1, 1) for n in names], "sucursal string, year int, month int, x int").write.partitionBy("sucursal", "year", "month").parquet(str(tmp_path / "layer"))
    files = spark.read.parquet(str(tmp_path / "layer"))
    branch, _, _ = partition_values(F.col("_metadata.file_path"))
    assert {r[0] for r in files.select(branch).collect()} == set(names)


def test_partition_values(spark):
    good, bad = "x/sucursal=007/year=2024/month=01/f.parquet", "x/sucursal=7/year=y/month=1/f"
    got = values(spark, [good, bad], *partition_values(F.col("t")))
    assert got == {good: ("007", 2024, 1), bad: (None, None, None)}


def test_strip_takes_all_whitespace(spark):
    texts = ["\t a b \n", " x ", "plain", "　"]
    assert values(spark, texts, strip(F.col("t"))) == {t: (t.strip(),) for t in texts}


def test_target_classes(spark):
    ratios = [(0.1,), (2.0 / 10.0,), (0.3,), (None,), (float("nan"),)]
    rows = spark.createDataFrame(ratios, "r double").select(target_class(F.col("r"))).collect()
    assert [r[0] for r in rows] == ["no alcanzó", "igualó", "superó", "sin datos", "sin datos"]


def test_margin_ratio(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (0.0, 0.0), (None, 1.0)], "m double, v double")
    assert [r[0] for r in rows.select(margin_ratio(F.col("m"), F.col("v"))).collect()] == [0.25, 0, 0]


def test_spanish_names(spark):
    days = [(date(2024, 1, 1) + timedelta(days=i),) for i in range(7)]
    names = [r[0] for r in spark.createDataFrame(days, "d date").select(weekday_es(F.col("d"))).collect()]
    assert names == ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
    months = spark.range(1, 13).select(month_es(F.col("id").cast("int"))).collect()
    assert (months[0][0], months[8][0], months[11][0]) == ("Enero", "Septiembre", "Diciembre")
