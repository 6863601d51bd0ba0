"""One query per operator over the test tables; ``oracles`` holds the same results in SQL.

Sums of doubles depend on the order of addition, so aggregated doubles are rounded in the
output, never before.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.checks.sales_view import (
    FILES_PER_TASK,
    LINES_PER_TASK,
    POSITION,
    bronze_view,
    dirty_view,
    rate_rows,
    rates_view,
    raw_view,
    sales_view,
    silver_view,
    staged_sales,
    table,
    unit_sales,
)
from saleslake.functions.dates import to_ts
from saleslake.functions.metrics import margin_ratio, target_class
from saleslake.functions.numeric import to_double, to_int
from saleslake.functions.text import branch_from_path, partition_values
from saleslake.operators.aggregates import (
    attach,
    product_months,
    top_day,
    top_product,
    top_weekday,
)
from saleslake.operators.audit import raw_audit
from saleslake.operators.cleaning import (
    add_calendar,
    add_month_name,
    add_unit,
    cast_text,
    coerce_date,
    normalize_headers,
    trim_all,
    valid_dates,
)
from saleslake.operators.contract import contract_report
from saleslake.operators.rates import fill_rates, join_rates, rate_gap_report
from saleslake.operators.sales import dedup_lines, margin_ars, metrics_ars, metrics_usd, positive_sales
from saleslake.operators.trends import (
    bucket_sales,
    daily_totals,
    day_profile,
    monthly_trend,
    pivot_profile,
    profile,
    trend_flags,
    weekday_profile,
    weekly_trend,
)
from saleslake.plans.bronze import bronze_build
from saleslake.plans.gold import gold_build
from saleslake.plans.jobs import run_silver
from saleslake.plans.silver import silver_build
from saleslake.schemas import (
    BRONZE_STORED,
    DOUBLE_COLUMNS,
    EXTRA,
    GOLD_INPUT,
    INTEGER_COLUMNS,
    RAW_REQUIRED,
    SILVER,
    UNIT,
)
from saleslake.sources.layers import read_any_layer, read_layer, write_layer
from saleslake.sources.rates_file import load_rates, read_rates
from saleslake.sources.staging import delete_at_exit, shared_dir, stage
from saleslake.sources.tables import (
    create_database,
    preview,
    register_rates_table,
    register_table,
    repair_partitions,
)
from saleslake.sources.workbooks import list_workbooks

Query = Callable[[SparkSession, str], DataFrame]

# Decimals of aggregated doubles in query outputs. No exact ARS amount of the
# test tables ends halfway at the fifth decimal, where engines round differently.
DECIMALS = {
    "VENTA_ARS": 5,
    "COSTO_ARS": 5,
    "MARGEN_ARS": 5,
    "VENTA_USD": 4,
    "COSTO_USD": 4,
    "MARGEN_USD": 4,
    "MARGEN_PORC_ARS": 6,
    "MARGEN_PORC_USD": 6,
    "CORRELACION_SEMANAL": 6,
    "CORRELACION_MENSUAL": 6,
}
LINE_KEYS = ["NUMERO_TICKET", "ID_ARTICULO", *POSITION]


def rounded(df: DataFrame, decimals: dict[str, int] = DECIMALS) -> DataFrame:
    """Rounding on doubles as such; ``round`` would go through decimals for every value."""
    scales = {c: 10.0**n for c, n in decimals.items() if c in df.columns}
    return df.withColumns({c: F.rint(F.col(c) * scale) / scale for c, scale in scales.items()})


_stored: dict[tuple[str, str, str], str] = {}
DATABASE = "saleslake_checks"


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused folder that all executors see; the session's end deletes it."""
    folder = f"{shared_dir(spark)}/checks/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    delete_at_exit(spark, folder)
    return folder


def stored_layer(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a layer or of files made from the test sales, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        root = new_folder(spark, name)
        if name == "bronze":
            write_layer(bronze_build(raw_view(spark, sf_dir, sales=unit_sales(spark, sf_dir))), root, clustered=True)
        elif name == "silver":
            write_layer(silver_view(spark, sf_dir, by_unit=True), root, clustered=True)
        elif name == "mixed":
            _write_mixed(bronze_build(raw_view(spark, sf_dir, numbered=True, sales=staged_sales(spark, sf_dir))), root)
        elif name == "rates":
            _write_rates(spark, sf_dir, root)
        elif name == "workbooks":
            _write_workbooks(spark, sf_dir, root)
        else:
            raise ValueError(name)
        _stored[key] = root
    return _stored[key]


def _branch_number(branch: str = "SUCURSAL") -> Column:
    return F.when(F.col(branch) != "", F.substring_index(branch, "_", -1)).cast("int")


def _is_damaged() -> Column:
    """The one branch-month that a mixed layer holds in a broken form."""
    return (F.col("SUCURSAL") == "NATION_5") & (F.col("YEAR") == 1997) & (F.col("MONTH") == 3)


def _write_mixed(bronze: DataFrame, root: str) -> None:
    """A bronze layer by several writers: our own columns, numbers instead of text, whole prices, and columns beyond the contract.

    One branch-month lacks a column. The numbered lines come by branch and month already, so their text is staged
    and written as it lies, without a shuffle; small files bound the lines of a task that reads them.
    """
    number = _branch_number()
    writer = F.when(_is_damaged(), 3).when((number % 5).isin(0, 1, 4), 0).when(number % 5 == 2, 1).when(number % 5 == 3, 2)
    # By the number of its writer, a reader passes over the files of others.
    staged = stage(bronze.withColumn("_writer", writer), LINES_PER_TASK // FILES_PER_TASK)
    own, typed, priced, damaged = (staged.where(F.col("_writer") == k).drop("_writer") for k in range(4))
    whole = [c for c in bronze.columns if c != EXTRA]
    numbers = {c: to_int(F.col(c)) for c in ("NUMERO_TICKET", "CANTIDAD_VENDIDA")} | {c: to_double(F.col(c)) for c in ("VALOR_ARTICULO", "COSTO_ARTICULO")}
    typed = typed.withColumns(numbers).select(*whole, F.concat(F.lit("nota "), "ID_ARTICULO").alias("NOTA"))
    priced = priced.withColumn("VALOR_ARTICULO", to_int(F.col("VALOR_ARTICULO"))).select(*whole, F.concat(F.lit("obs "), "FAMILIA").alias("OBS"))
    for part in (own, typed, priced, damaged.drop("COSTO_ARTICULO")):
        write_layer(part, root, clustered=True)


def _write_rates(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The rates as CSV files with untidy headers; the order of files and lines is that of ``ord``."""
    text = rate_rows(spark, sf_dir).repartitionByRange(3, "ord").sortWithinPartitions("ord").select(
        F.col("year").alias(" Year "), F.col("month").alias("MONTH"), F.col("exchange_rate_ars_usd").alias("Exchange_Rate_ARS_USD")
    )
    text.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(root)


SUFFIXES = ["xlsx", "XLSX", "Xlsx", "txt"]
WORKBOOKS_PER_TASK = 200
COMMITTER = "mapreduce.fileoutputcommitter.algorithm.version"


def _write_workbooks(spark: SparkSession, sf_dir: str, root: str) -> None:
    """One file per supplier, below a folder of its name; a quarter of them have another suffix than workbooks.

    The rows are few bytes, the files are the work: their number decides the number of tasks, and each task
    moves its own files to their place, where else the driver moves one after the other.
    """
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("content"))
    tasks = max(spark.sparkContext.defaultParallelism, suppliers.count() // (len(SUFFIXES) * WORKBOOKS_PER_TASK) + 1)
    for place, suffix in enumerate(SUFFIXES):
        mine = suppliers.where(F.col("s_suppkey") % len(SUFFIXES) == place).repartition(tasks, "s_suppkey")
        mine.write.mode("append").option("extension", suffix).option(COMMITTER, "2").partitionBy("s_suppkey").csv(root)


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, stored_layer(spark, sf_dir, "silver"), SILVER)


# Sources and tables


def scan_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = read_layer(spark, stored_layer(spark, sf_dir, "bronze"), BRONZE_STORED)
    return _comparable_bronze(bronze)


def scan_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_silver(spark, sf_dir)


def scan_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze files of several writers as one table; the broken branch-month is left out."""
    bronze = read_any_layer(spark, stored_layer(spark, sf_dir, "mixed"), BRONZE_STORED)
    notes = [F.col(EXTRA)[name].alias(name) for name in ("OBS", "NOTA")]
    return _money_as_numbers(bronze).select(*RAW_REQUIRED, *UNIT, "_src_file", "_src_row", *notes)


def silver_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a silver run over bronze files of several writers and rates files."""
    bronze, rates = stored_layer(spark, sf_dir, "mixed"), stored_layer(spark, sf_dir, "rates")
    return run_silver(spark, bronze, rates, new_folder(spark, "silver")).drop("run_id", "run_at")


def workbook_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below a folder that are workbooks by their suffix in any case."""
    files = list_workbooks(spark, stored_layer(spark, sf_dir, "workbooks"))
    supplier = F.regexp_extract("path", r"s_suppkey=(\d+)", 1).cast("bigint")
    return files.select(
        supplier.alias("s_suppkey"), F.substring_index("path", ".", -1).alias("suffix"), (F.col("length") > 0).alias("has_content")
    )


def rates_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_rates(spark, stored_layer(spark, sf_dir, "rates")).drop("ord")


def rates_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per month of rates files, the first one in the order of files and lines."""
    return load_rates(spark, stored_layer(spark, sf_dir, "rates"))


def rates_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rates files as a catalog table."""
    create_database(spark, DATABASE, new_folder(spark, "database"))
    return spark.table(register_rates_table(spark, DATABASE, "rates", stored_layer(spark, sf_dir, "rates")))


def partition_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after one branch-month has been written again with other rows; the others stay."""
    root, silver = new_folder(spark, "rewritten"), stored_silver(spark, sf_dir)
    write_layer(silver, root, clustered=True)
    unit = (F.col("SUCURSAL") == "NATION_2") & (F.col("YEAR") == 1996) & (F.col("MONTH") == 5)
    changed = silver.where(unit & (F.col("NUMERO_TICKET") % 2 == 0))
    write_layer(changed.withColumn("CANTIDAD_VENDIDA", F.col("CANTIDAD_VENDIDA") + 1000), root)
    return read_layer(spark, root, SILVER)


def _silver_table(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType = SILVER, repair: bool = True) -> str:
    create_database(spark, DATABASE, new_folder(spark, "database"))
    return register_table(spark, DATABASE, name, schema, stored_layer(spark, sf_dir, "silver"), repair)


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver through a catalog table, and how many rows it had before its partitions were registered."""
    name = _silver_table(spark, sf_dir, "scanned", repair=False)
    before = spark.table(name).count()
    repair_partitions(spark, name)
    return spark.table(name).withColumn("rows_before", F.lit(before).cast("bigint"))


def table_redefine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of silver under a wider definition of their table, and how many of them changed by that."""
    narrow = T.StructType([f for f in SILVER if not f.name.endswith("_USD")])
    wide = T.StructType([*SILVER.fields, T.StructField("OBSERVACION", T.StringType())])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listing = files.load(stored_layer(spark, sf_dir, "silver")).select("path", "length", "modificationTime")
    name = _silver_table(spark, sf_dir, "redefined", narrow)
    before = stage(listing)
    _silver_table(spark, sf_dir, "redefined", wide)
    changed = stage(listing).exceptAll(before).count() + before.exceptAll(listing).count()
    return spark.table(name).withColumn("files_changed", F.lit(changed).cast("bigint"))


def partition_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    branch, year, month = partition_values(F.col("_metadata.file_path"))
    files = spark.read.schema(SILVER).parquet(stored_layer(spark, sf_dir, "silver"))
    located = files.select(branch.alias("SUCURSAL"), year.alias("YEAR"), month.alias("MONTH"))
    return located.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("row_count"))


def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = (F.col("YEAR") == 1997) & (F.col("MONTH") <= 3)
    branch = F.col("SUCURSAL").isin("NATION_1", "NATION_2", "NATION_3")
    return stored_silver(spark, sf_dir).where(chosen & branch)


def preview_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("VENTA_ARS").desc(), "NUMERO_TICKET", "ID_ARTICULO"]
    return preview(spark, _silver_table(spark, sf_dir, "previewed"), 10, order)


# Clean-up and columns


def header_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = sales_view(spark, sf_dir).select(*RAW_REQUIRED)
    untidy = [f" {c.title()} " if i % 2 else c.lower() for i, c in enumerate(RAW_REQUIRED)]
    return normalize_headers(sales.toDF(*untidy))


def trim_all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = trim_all(dirty_view(spark, sf_dir), RAW_REQUIRED)
    return _money_as_numbers(trimmed).select("TICKET", *POSITION, *RAW_REQUIRED)


def cast_text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = dirty_view(spark, sf_dir).select("TICKET", *RAW_REQUIRED)
    typed = dirty.withColumns({c: to_int(F.col(c)) for c in ("ID_SUCURSAL", "FAMILIA")})
    return _money_as_numbers(cast_text(typed))


def contract_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_report(raw_view(spark, sf_dir), RAW_REQUIRED)


def branch_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = raw_view(spark, sf_dir).select("path", branch_from_path(F.col("path")).alias("SUCURSAL"))
    return named.groupBy("path", "SUCURSAL").agg(F.count(F.lit(1)).alias("row_count"))


def derive_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = valid_dates(coerce_date(dirty_view(spark, sf_dir).drop(*UNIT)))
    return add_unit(dated, F.col("DESCRIP_SUCURSAL")).select("TICKET", *POSITION, "FECHA", *UNIT)


def coerce_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = {c: to_int(F.col(c)) for c in INTEGER_COLUMNS}
    return dirty_view(spark, sf_dir).withColumns(typed).select("TICKET", *POSITION, *typed)


def coerce_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = {c: to_double(F.col(c)) for c in DOUBLE_COLUMNS}
    return dirty_view(spark, sf_dir).withColumns(typed).select("TICKET", *POSITION, *typed)


def coerce_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = dirty_view(spark, sf_dir)
    return dirty.select("TICKET", *POSITION, to_ts(F.col("FECHA")).alias("FECHA"))


def ars_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["VENTA_ARS", "COSTO_ARS", "MARGEN_ARS"]
    return metrics_ars(sales_view(spark, sf_dir)).select(*LINE_KEYS, *columns)


def usd_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["TIPO_CAMBIO", "VENTA_USD", "COSTO_USD", "MARGEN_USD"]
    priced = join_rates(metrics_ars(sales_view(spark, sf_dir)), rates_view(spark, sf_dir))
    return metrics_usd(priced).select(*LINE_KEYS, *columns)


def calendar_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = add_calendar(sales_view(spark, sf_dir))
    return dated.groupBy("FECHA", "DIA_MES", "DIA_SEMANA").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def month_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = add_month_name(sales_view(spark, sf_dir))
    return named.groupBy("MONTH", "MONTH_NAME").agg(F.count(F.lit(1)).alias("row_count"))


def _family_ratios(spark: SparkSession, sf_dir: str, by: list[str]) -> tuple[DataFrame, Column]:
    sums = silver_view(spark, sf_dir).groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("VENTA_ARS", "MARGEN_ARS", "VENTA_USD", "MARGEN_USD")]
    )
    return sums, margin_ratio(F.col("MARGEN_USD"), F.col("VENTA_USD"))


def margin_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["SUCURSAL", "YEAR", "MONTH", "FAMILIA"]
    sums, usd = _family_ratios(spark, sf_dir, by)
    ars = margin_ratio(F.col("MARGEN_ARS"), F.col("VENTA_ARS"))
    return rounded(sums.select(*by, ars.alias("MARGEN_PORC_ARS"), usd.alias("MARGEN_PORC_USD")))


def target_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes without the zero default, so that months without a rate come out as unknown."""
    by = ["SUCURSAL", "YEAR", "MONTH", "FAMILIA"]
    sums, _ = _family_ratios(spark, sf_dir, by)
    ratio = F.try_divide("MARGEN_USD", "VENTA_USD")
    return sums.select(*by, target_class(ratio).alias("CUMPLIMIENTO_OBJETIVO"))


# Filters, rates, duplicates


def filter_valid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_view(spark, sf_dir).select("TICKET", *POSITION, "FECHA")


def filter_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = {c: to_int(F.col(c)) for c in ("CANTIDAD_VENDIDA", "ID_ARTICULO")} | {
        c: to_double(F.col(c)) for c in ("VALOR_ARTICULO", "COSTO_ARTICULO")
    }
    priced = metrics_ars(dirty_view(spark, sf_dir).withColumns(typed))
    return positive_sales(priced).select(
        "TICKET", *POSITION, "ID_ARTICULO", "CANTIDAD_VENDIDA", "VENTA_ARS"
    )


def rate_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_gap_report(join_rates(sales_view(spark, sf_dir), rates_view(spark, sf_dir)))


def rates_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_rates(sales_view(spark, sf_dir), rates_view(spark, sf_dir))
    return joined.select(*LINE_KEYS, "YEAR", "MONTH", "TIPO_CAMBIO")


def rates_join_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_rates(sales_view(spark, sf_dir), rates_view(spark, sf_dir), fill="calendar")
    return joined.groupBy("YEAR", "MONTH", "TIPO_CAMBIO").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def rates_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_rates(rates_view(spark, sf_dir))


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dedup_lines(sales_view(spark, sf_dir), POSITION)
    return lines.select(*LINE_KEYS, "FECHA", *UNIT, "CANTIDAD_VENDIDA")


# Aggregates and best rows


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_months(silver_view(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_totals(silver_view(spark, sf_dir))


def agg_product_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_products(spark, sf_dir))


def agg_day_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bucket_sales(_daily(spark, sf_dir), "DIA_MES"))


def agg_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bucket_sales(_daily(spark, sf_dir), "DIA_SEMANA"))


def best_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_product(_products(spark, sf_dir))


def best_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_day(bucket_sales(_daily(spark, sf_dir), "DIA_MES"))


def best_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_weekday(bucket_sales(_daily(spark, sf_dir), "DIA_SEMANA"))


def _gold_input(silver: DataFrame) -> DataFrame:
    """What gold needs of silver lines, staged; margins and amounts in USD are made again from the stored columns.

    Amounts hardly compress, while a line has one of a few rates.
    """
    again = ["MARGEN_ARS", "VENTA_USD", "COSTO_USD", "MARGEN_USD"]
    stored = stage(silver.select(*[c for c in GOLD_INPUT if c not in again], "TIPO_CAMBIO", *UNIT))
    return metrics_usd(margin_ars(stored)).select(*GOLD_INPUT, *UNIT)


def _product_keys(products: DataFrame) -> DataFrame:
    return rounded(products.select(*UNIT, "ID_ARTICULO", "DESC_ARTICULO", "MARGEN_USD"))


def join_best_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = stage(_products(spark, sf_dir))
    return attach(_product_keys(products), stage(top_product(products)))


def join_best_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _gold_input(silver_view(spark, sf_dir))
    best = top_day(bucket_sales(daily_totals(silver), "DIA_MES"))
    return attach(_product_keys(product_months(silver)), stage(best))


def join_best_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _gold_input(silver_view(spark, sf_dir))
    best = top_weekday(bucket_sales(daily_totals(silver), "DIA_SEMANA"))
    return attach(_product_keys(product_months(silver)), stage(best))


# Profiles and trends

_MEAN = {"VENTA_USD": 4}


def profile_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(weekday_profile(_daily(spark, sf_dir)), _MEAN)


def profile_branch_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile(_daily(spark, sf_dir), ["SUCURSAL"], "DIA_SEMANA"), _MEAN)


def profile_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(day_profile(_daily(spark, sf_dir)), _MEAN)


def profile_branch_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile(_daily(spark, sf_dir), ["SUCURSAL"], "DIA_MES"), _MEAN)


def _pivot(spark: SparkSession, sf_dir: str, bucket: str) -> DataFrame:
    wide = pivot_profile(_daily(spark, sf_dir), ["SUCURSAL"], bucket)
    return rounded(wide, {c: 4 for c in wide.columns if c != "SUCURSAL"})


def pivot_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir, "DIA_SEMANA")


def pivot_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir, "DIA_MES")


def trend_weekly_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(weekly_trend(_daily(spark, sf_dir)))


def trend_weekly_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(weekly_trend(_daily(spark, sf_dir), scope="partition"))


def trend_monthly_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monthly_trend(_daily(spark, sf_dir)))


def trend_monthly_chain_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lower threshold, so that both flag values occur in these tables."""
    return rounded(monthly_trend(_daily(spark, sf_dir), threshold=0.3))


def trend_monthly_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monthly_trend(_daily(spark, sf_dir), scope="partition"))


def flags_by_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _daily(spark, sf_dir)
    return rounded(trend_flags(weekly_trend(daily), monthly_trend(daily)))


# Layers and audit


def _money_as_numbers(df: DataFrame) -> DataFrame:
    """Money text as numbers: engines write the same double differently."""
    return df.withColumns({c: to_double(F.col(c)) for c in DOUBLE_COLUMNS})


def _comparable_bronze(bronze: DataFrame) -> DataFrame:
    note = F.col(EXTRA)["OBS"].alias("OBS")
    return _money_as_numbers(bronze).select(*RAW_REQUIRED, *UNIT, "_src_file", "_src_row", note)


def bronze_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable_bronze(bronze_build(raw_view(spark, sf_dir)))


def _silver_of_dirty(spark: SparkSession, sf_dir: str, fill: str = "none") -> DataFrame:
    return silver_build(bronze_view(spark, sf_dir), rates_view(spark, sf_dir), fill, POSITION)


def silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_of_dirty(spark, sf_dir)


def silver_layer_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_of_dirty(spark, sf_dir, fill="calendar")


def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages write tables while the plan is built; ``stage`` overwrites them on the next call."""
    silver = _gold_input(_silver_of_dirty(spark, sf_dir))
    return rounded(gold_build(silver, "chain", stage))


def gold_layer_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _gold_input(_silver_of_dirty(spark, sf_dir))
    return rounded(gold_build(silver, "partition", stage))


def medallion_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sheet rows to gold: duplicates go by file, sheet and row."""
    bronze = bronze_build(raw_view(spark, sf_dir, numbered=True, sales=staged_sales(spark, sf_dir)))
    silver = _gold_input(silver_build(bronze, rates_view(spark, sf_dir)))
    return rounded(gold_build(silver, "chain", stage))


def raw_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_audit(raw_view(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "scan_bronze": scan_bronze,
    "scan_silver": scan_silver,
    "scan_mixed": scan_mixed,
    "list_workbooks": workbook_listing,
    "partition_rewrite": partition_rewrite,
    "table_scan": table_scan,
    "table_redefine": table_redefine,
    "rates_table": rates_table,
    "rates_load": rates_load,
    "rates_first": rates_first,
    "partition_from_path": partition_from_path,
    "partition_prune": partition_prune,
    "preview_top10": preview_top10,
    "header_normalize": header_normalize,
    "trim_all": trim_all_cells,
    "cast_text": cast_text_cells,
    "contract_report": contract_units,
    "branch_from_filename": branch_from_filename,
    "derive_calendar": derive_calendar,
    "coerce_int": coerce_int,
    "coerce_double": coerce_double,
    "coerce_timestamp": coerce_timestamp,
    "metrics_ars": ars_metrics,
    "metrics_usd": usd_metrics,
    "calendar_columns": calendar_columns,
    "month_name": month_name,
    "margin_ratio": margin_ratios,
    "target_class": target_classes,
    "filter_valid_date": filter_valid_date,
    "filter_positive": filter_positive,
    "rate_gap_report": rate_gaps,
    "join_rates": rates_join,
    "join_rates_filled": rates_join_filled,
    "rates_ffill": rates_ffill,
    "dedup_first": dedup_first,
    "agg_product_month": agg_product_month,
    "agg_day_of_month": agg_day_of_month,
    "agg_weekday": agg_weekday,
    "top_product": best_product,
    "top_day": best_day,
    "top_weekday": best_weekday,
    "join_best_product": join_best_product,
    "join_best_day": join_best_day,
    "join_best_weekday": join_best_weekday,
    "profile_weekday": profile_weekday,
    "profile_branch_weekday": profile_branch_weekday,
    "pivot_weekday": pivot_weekday,
    "trend_weekly_chain": trend_weekly_chain,
    "trend_weekly_partition": trend_weekly_partition,
    "profile_day": profile_day,
    "profile_branch_day": profile_branch_day,
    "pivot_day": pivot_day,
    "trend_monthly_chain": trend_monthly_chain,
    "trend_monthly_chain_low": trend_monthly_chain_low,
    "trend_monthly_partition": trend_monthly_partition,
    "trend_flags": flags_by_branch,
    "bronze_build": bronze_layer,
    "silver_build": silver_layer,
    "silver_build_filled": silver_layer_filled,
    "gold_build": gold_layer,
    "gold_build_partition": gold_layer_partition,
    "medallion_gold": medallion_gold,
    "load_audit": raw_load_audit,
    "silver_audit": silver_audit,
}
