"""What the physical plans must and must not contain."""

import os
import re

from pyspark.sql import functions as F

from saleslake.operators.contract import header_names, usual_header, with_contract
from saleslake.plans.bronze import bronze_build
from saleslake.checks.queries import QUERIES, stored_layer
from saleslake.checks.sales_view import bronze_view, rates_view, raw_view, silver_view
from saleslake.operators.trends import daily_totals, monthly_trend, trend_flags, weekly_trend

from saleslake.plans.gold import gold_build
from saleslake.plans.silver import silver_build
from saleslake.schemas import SILVER
from saleslake.sources.layers import read_layer
from saleslake.sources.staging import shared_dir, stage

SF_DIR = "/root/testdata/sf0.001"
POSITION = ["_pos_line", "_pos_supplier", "_pos_quantity", "_pos_price"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    df.collect()
    text = plan(df)
    return text[: text.index("Initial Plan")]


def silver_plan(spark):
    return plan(
        silver_build(bronze_view(spark, SF_DIR), rates_view(spark, SF_DIR), source_order=POSITION)
    )


def test_no_python_workers_outside_the_workbook_reader(spark):
    silver = silver_view(spark, SF_DIR)
    for df in (
        bronze_build(raw_view(spark, SF_DIR)),
        silver_build(bronze_view(spark, SF_DIR), rates_view(spark, SF_DIR), source_order=POSITION),
        gold_build(silver, "chain", lambda df: df),
        gold_build(silver, "partition", lambda df: df),
    ):
        assert not re.search(r"EvalPython|InPandas|MapInArrow", plan(df))


def test_no_cross_joins(spark):
    for name in ("silver_build", "silver_build_filled", "trend_flags", "profile_weekday", "load_audit"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_bronze_needs_no_shuffle_of_its_own(spark):
    raw = raw_view(spark, SF_DIR)
    assert plan(bronze_build(raw)).count("Exchange") == plan(raw).count("Exchange")


def test_rates_are_broadcast(spark):
    assert re.search(r"BroadcastHashJoin \[_month#\d+\], \[_month#\d+\], LeftOuter", silver_plan(spark))


def test_duplicates_are_dropped_before_the_shuffle(spark):
    lines = silver_plan(spark).splitlines()
    limits = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l]
    exchanges = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(SUCURSAL" in l]
    assert limits[0] < exchanges[0] < limits[1]
    assert "Partial" in lines[limits[1]]


def test_positive_filter_stays_above_the_duplicate_removal(spark):
    lines = silver_plan(spark).splitlines()
    positive = next(i for i, l in enumerate(lines) if "Filter" in l and "> 0.0" in l)
    window = next(i for i, l in enumerate(lines) if "Window [" in l)
    assert positive < window


def test_partition_filters_and_column_pruning(spark):
    silver = read_layer(spark, stored_layer(spark, SF_DIR, "silver"), SILVER)
    text = plan(
        silver.where("YEAR = 1997 and MONTH <= 3 and SUCURSAL = 'NATION_1'").select("VENTA_USD")
    )
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert "year" in filters and "month" in filters and "sucursal" in filters
    assert "ReadSchema: struct<VENTA_USD:double>" in text


def test_every_staged_table_has_a_folder_of_its_own(spark):
    root = f"{shared_dir(spark)}/staged/{spark.sparkContext.applicationId}".removeprefix("file://")
    source = f"{shared_dir(spark)}/changing"
    spark.range(3).write.mode("overwrite").parquet(source)
    first = stage(spark.read.parquet(source))
    spark.range(5).write.mode("overwrite").parquet(source)
    second = stage(spark.read.parquet(source))
    assert (first.count(), second.count()) == (3, 5)
    assert len(os.listdir(root)) >= 2


def test_trends_share_one_pass_over_the_sales(spark):
    silver = read_layer(spark, stored_layer(spark, SF_DIR, "silver"), SILVER)
    daily = daily_totals(silver)
    text = executed(trend_flags(weekly_trend(daily), monthly_trend(daily)))
    scans = re.findall(r"FileScan parquet", text)
    assert "ReusedExchange" in text and len(scans) == 1


def test_staged_gold_reads_silver_twice_and_joins_by_known_size(spark):
    silver = read_layer(spark, stored_layer(spark, SF_DIR, "silver"), SILVER)
    plans = []

    def recording(df):
        plans.append(plan(df))
        return stage(df)

    final = plan(gold_build(silver, "chain", recording))
    products, daily, summary = plans
    assert products.count("FileScan") == daily.count("FileScan") == 1
    assert "sucursal#" not in summary + final
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    assert "Exchange hashpartitioning" not in final


def test_a_usual_header_is_known_from_the_contract(spark):
    """The pattern accepts just those headers whose names, by the general rules, are the required ones in order."""
    required = ["FECHA", "A.B", "TOTAL"]
    cells = [["FECHA", " fecha ", "\tFECHA", "FECHA\tA.B", "FECHA ", "FE CHA", None], ["A.B", "a.b  ", "AxB", "", None], ["TOTAL", "Total\n", " ", "fecha"]]
    headers = [[a, b, c] for a in cells[0] for b in cells[1] for c in cells[2]]
    headers += [["FECHA\tA.B", None, "TOTAL"], ["FECHA\tA.B", "TOTAL"], ["FECHA", "A.B", "TOTAL", "NOTA"], ["FECHA", "A.B"], [], None]
    df = spark.createDataFrame([(h,) for h in headers], "header array<string>")
    usual = usual_header(F.col("header"), required)
    rows = df.select(usual.alias("usual"), header_names(F.col("header")).alias("names"), "header").collect()
    assert sum(bool(r.usual) for r in rows) == 4
    assert all(r.names == required for r in rows if r.usual)
    judged = with_contract(df, required).collect()
    assert [r.names for r in judged] == [r.names for r in rows]
    assert [r.in_order for r in judged] == [None if r.names is None else r.names[:3] == required for r in rows]


def test_the_branch_of_a_raw_row_is_found_once(spark):
    raw = spark.createDataFrame([], "path string, sheet string, sheet_no int, row_no bigint, error string, header array<string>, cells array<string>")
    plan = bronze_build(raw)._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Generate inline")
    assert "regexp_extract(" in below and "regexp_extract(" not in above
