"""Steps whose tasks have to grow in number, not in size, with the rows."""

import re
import time
from pathlib import Path

from pyspark.sql import functions as F

from saleslake.checks import queries, sales_view
from saleslake.sources import staging
from saleslake.sources.layers import write_layer


def test_workbooks_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name"))
    rows.write.parquet(f"{tmp_path}/supplier.parquet")
    files = queries.list_workbooks(spark, queries.stored_layer(spark, str(tmp_path), "workbooks"))
    writers = files.select(F.regexp_extract("path", r"/part-(\d+)", 1).alias("task")).distinct()
    assert (files.count(), writers.count() > 1) == (300, True)
    assert queries.workbook_listing(spark, str(tmp_path)).where("has_content").select("s_suppkey").distinct().count() == 300


def star_tables(spark, folder, lines=3000, articles=40):
    """Sales of few customers, with ticket numbers on both sides of several ranges."""
    ticket = F.col("id") % 500 * 701
    tables = {
        "region": spark.createDataFrame([(0, "R0")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(n, f"NATION_{n}", 0) for n in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": spark.range(9).select(F.col("id").alias("c_custkey"), (F.col("id") % 3).cast("int").alias("c_nationkey")),
        "orders": spark.range(500).select(
            ticket.alias("o_orderkey"),
            (F.col("id") % 9).alias("o_custkey"),
            F.expr("timestamp'1996-01-01' + make_interval(0, 0, 0, cast(id * 2 % 900 as int))").alias("o_orderdate"),
        ),
        "part": spark.range(articles).select(
            F.col("id").alias("p_partkey"), F.concat(F.lit("p"), "id").alias("p_name"), F.lit("b").alias("p_brand"),
            F.lit("t").alias("p_type"), F.lit(3).alias("p_size"), F.lit(9.5).alias("p_retailprice"),
        ),
        "lineitem": spark.range(lines).select(
            ticket.alias("l_orderkey"), (F.col("id") % articles).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"),
            (F.col("id") % 5).cast("int").alias("l_linenumber"), (F.col("id") % 4 + 1.0).alias("l_quantity"),
            (F.col("id") + 10.0).alias("l_extendedprice"), F.lit(0.1).alias("l_tax"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_over_tasks_by_their_number(spark, tmp_path, monkeypatch):
    sf_dir = star_tables(spark, tmp_path)
    whole = sales_view.sales_view(spark, sf_dir)
    rows = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(sales_view, "LINES_PER_TASK", 100, raising=False)
    many = sales_view.sales_view(spark, sf_dir)
    assert re.findall(r"hashpartitioning\(l_partkey#\d+L, (\d+)\)", plan_of(many)) == ["31"]
    assert len(rows) == 3000 and sorted(map(tuple, many.collect())) == rows


def test_rows_are_numbered_without_one_task_per_branch_and_year(spark, tmp_path):
    raw = sales_view.raw_view(spark, star_tables(spark, tmp_path), numbered=True)
    windows = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*?) ASC", plan_of(raw))
    assert windows and all("_range" in w for w in windows)
    cells = {h.strip().upper(): F.col("cells")[i] for i, h in enumerate(sales_view.UNTIDY)}
    ticket = F.expr("try_cast(" + "cells[" + str(list(cells).index("NUMERO_TICKET")) + "] as bigint)")
    found = raw.select("path", "sheet", "row_no", ticket.alias("ticket")).collect()
    assert len(found) == 3000
    for sheet in {(r.path, r.sheet) for r in found}:
        mine = sorted((r for r in found if (r.path, r.sheet) == sheet), key=lambda r: r.row_no)
        tickets = [r.ticket for r in mine if r.ticket is not None]
        assert [r.row_no for r in mine] == list(range(2, len(mine) + 2)) and tickets == sorted(tickets)


def test_a_layer_is_copied_without_a_shuffle(spark, tmp_path, monkeypatch):
    sf_dir, hints = star_tables(spark, tmp_path), []
    monkeypatch.setattr(queries, "write_layer", lambda df, root, **how: hints.append(how) or write_layer(df, root, **how))
    queries.stored_layer(spark, sf_dir, "silver")
    hints.clear()
    copied = queries.partition_rewrite(spark, sf_dir)
    assert hints == [{"clustered": True}, {}]
    others = "NOT (SUCURSAL = 'NATION_2' AND YEAR = 1996 AND MONTH = 5)"
    kept = queries.scan_silver(spark, sf_dir).where(others)
    assert sorted(map(repr, copied.where(others).collect())) == sorted(map(repr, kept.collect()))


def test_a_mixed_layer_is_written_without_a_shuffle_of_its_text(spark, tmp_path, monkeypatch):
    sf_dir, hints = star_tables(spark, tmp_path), []
    numbered = sorted(map(tuple, sales_view.raw_view(spark, sf_dir, numbered=True).collect()), key=repr)
    monkeypatch.setattr(sales_view, "LINES_PER_TASK", 100)
    staged = sales_view.staged_sales(spark, sf_dir)
    assert len(staged.inputFiles()) >= 3000 // (100 // sales_view.FILES_PER_TASK)
    raw = sales_view.raw_view(spark, sf_dir, numbered=True, sales=staged)
    assert sorted(map(tuple, raw.collect()), key=repr) == numbered
    monkeypatch.setattr(queries, "write_layer", lambda df, root, **how: hints.append(how) or write_layer(df, root, **how))
    queries.stored_layer(spark, sf_dir, "mixed")
    assert hints == [{"clustered": True}] * 4


def test_articles_are_no_broadcast_where_lines_are_dealt(spark, tmp_path, monkeypatch):
    """The file of the articles is small, the table in a task's memory need not be."""
    sf_dir = star_tables(spark, tmp_path)
    monkeypatch.setattr(sales_view, "LINES_PER_TASK", 100)
    joins = re.findall(r"(\w+Join) \[l_partkey#\d+L\]", plan_of(sales_view.sales_view(spark, sf_dir)))
    assert joins and set(joins) == {"SortMergeJoin"}


def test_gold_stages_no_column_that_follows_from_others(spark, tmp_path, monkeypatch):
    sf_dir, staged = star_tables(spark, tmp_path), []
    silver = queries._silver_of_dirty(spark, sf_dir).select(*queries.GOLD_INPUT, *queries.UNIT)
    wanted = sorted(map(repr, queries.rounded(queries.gold_build(silver, "partition", queries.stage)).collect()))
    monkeypatch.setattr(queries, "stage", lambda df, *rest: staged.append(df.columns) or staging.stage(df, *rest))
    found = queries.gold_layer_partition(spark, sf_dir)
    lines = next(c for c in staged if {"ID_ARTICULO", "DIA_MES"} <= set(c))
    assert not {"MARGEN_ARS", "VENTA_USD", "COSTO_USD", "MARGEN_USD"} & set(lines)
    products = next(c for c in staged if "ID_ARTICULO" in c and "DIA_MES" not in c)
    assert not {"MARGEN_PORC_ARS", "MARGEN_PORC_USD"} & set(products)
    assert wanted and sorted(map(repr, found.collect())) == wanted


def test_layers_are_shuffled_as_plain_lines(spark, tmp_path, monkeypatch):
    """Amounts, names and texts that follow from a line are made after its last shuffle."""
    sf_dir, written = star_tables(spark, tmp_path), {}

    def kept(df, root, **how):
        written[root] = (re.findall(r"Exchange (\w+)partitioning\(([^)]*)", plan_of(df)), df.columns, how)
        write_layer(df, root, **how)

    monkeypatch.setattr(queries, "write_layer", kept)
    bronze, silver = (queries.stored_layer(spark, sf_dir, name) for name in ("bronze", "silver"))
    for root in (bronze, silver):
        exchanges, _, how = written[root]
        assert how == {"clustered": True} and any("n_name" in keys and "_month" in keys for _, keys in exchanges)
    silver_rows = sales_view.silver_view(spark, sf_dir).select(*queries.stored_silver(spark, sf_dir).columns)
    assert sorted(map(repr, queries.scan_silver(spark, sf_dir).collect())) == sorted(map(repr, silver_rows.collect()))
    bronze_rows = queries.bronze_layer(spark, sf_dir)
    assert sorted(map(repr, queries.scan_bronze(spark, sf_dir).collect())) == sorted(map(repr, bronze_rows.collect()))


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(f.getPath()) for f in manager.localDirs()]
    blocks = lambda: {b for d in folders for b in d.rglob("shuffle_*.data")}
    units = spark.range(1000).select("id", F.lit("B").alias("SUCURSAL"), F.lit(1996).alias("YEAR"), (F.col("id") % 3).cast("int").alias("MONTH"))
    there = blocks()
    write_layer(units.repartition(7, "id"), f"{tmp_path}/layer")
    staged = staging.stage(units.repartition(5, "id"))
    for _ in range(50):
        if not blocks() - there:
            break
        time.sleep(0.1)
    assert not blocks() - there and len(staged.collect()) == 1000


def test_rows_of_gold_are_numbered_from_staged_lines(spark, tmp_path, monkeypatch):
    sf_dir, staged = star_tables(spark, tmp_path), []
    monkeypatch.setattr(sales_view, "stage", lambda df, *rest: staged.append(df.columns) or staging.stage(df, *rest))
    queries.medallion_gold(spark, sf_dir)
    assert any({"_place", "l_extendedprice"} <= set(c) and "DESC_ARTICULO" not in c for c in staged)


def test_parts_of_a_mixed_layer_are_told_by_a_number_that_files_can_be_passed_over_by(spark, tmp_path, monkeypatch):
    sf_dir, plans = star_tables(spark, tmp_path), []
    monkeypatch.setattr(queries, "write_layer", lambda df, root, **how: plans.append(plan_of(df)) or write_layer(df, root, **how))
    queries.stored_layer(spark, sf_dir, "mixed")
    assert [re.findall(r"PushedFilters: \[[^\]]*EqualTo\(_writer,(\d)\)", p) for p in plans] == [["0"], ["1"], ["2"], ["3"]]


def test_a_write_has_its_own_settings(spark):
    keys = (staging.CLEAN_UP, staging.METHOD_LIMIT)
    before = [spark.conf.get(k) for k in keys]
    with staging.write_settings(spark):
        assert [spark.conf.get(k) for k in keys] == ["true", "8000"]
    assert [spark.conf.get(k) for k in keys] == before
