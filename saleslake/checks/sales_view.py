"""Branch sales derived from the star-schema tables: typed, damaged text, and raw sheet rows.

The SQL in ``oracles`` builds the same views. Joins start from orders and customers, so the
line items are shuffled for their order key and their article key only, with plain numbers: names
of branches and zones come afterwards. Lines and tickets are merged on the order key: both grow
with the data, and a key has a handful of lines. The number of tasks grows with the lines: adaptive
execution sizes tasks by compressed bytes, a small part of what a task has to sort later.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saleslake.operators.cleaning import add_unit, coerce_date, valid_dates
from saleslake.operators.rates import unique_rates
from saleslake.operators.sales import dedup_lines
from saleslake.plans.silver import first_lines, silver_lines
from saleslake.schemas import RAW_REQUIRED, UNIT
from saleslake.sources.staging import stage

POSITION = ["_pos_line", "_pos_supplier", "_pos_quantity", "_pos_price"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINES_PER_TASK = 200_000


def dealt(df: DataFrame, lines: int, *keys: str, hint: str | None = None) -> DataFrame:
    """Rows dealt by keys over tasks of a fixed number of sales lines; left to Spark where one round of tasks does.

    A ``hint`` names the join of dealt rows: the planner knows the bytes of a file only, and a file of few of them
    can be a table that no task should hold as a whole.
    """
    tasks = lines // LINES_PER_TASK + 1
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    spread = df.repartition(tasks, *keys)
    return spread.hint(hint) if hint else spread


# What the columns of the sales are made of: lines are numbered and staged as these, before names and texts multiply them.
LINE_COLUMNS = [
    "o_orderdate", "l_orderkey", "c_nationkey", "n_name", "n_regionkey", "r_name", "l_partkey", "p_name", "p_size", "p_brand", "p_type",
    "p_retailprice", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax",
]


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sales lines with unit columns and source position."""
    return _sales_columns(_joined_lines(spark, sf_dir))


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines with the columns of their ticket, article, branch and zone, as the tables have them."""
    items = table(spark, sf_dir, "lineitem")
    count = items.count()
    branches = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    tickets = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    of_ticket = F.col("l_orderkey") == F.col("o_orderkey")
    sold = dealt(items, count, "l_orderkey").join(dealt(tickets, count, "o_orderkey").hint("merge"), of_ticket)
    parts = dealt(table(spark, sf_dir, "part"), count, "p_partkey", hint="merge")
    return (
        dealt(sold, count, "l_partkey")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(branches, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def _sales_columns(lines: DataFrame, *further: str) -> DataFrame:
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    sales = lines.select(
        F.col("o_orderdate").cast("timestamp").alias("FECHA"),
        F.col("l_orderkey").alias("NUMERO_TICKET"),
        F.lit(1).cast("bigint").alias("CANTIDAD_TICKET"),
        F.col("c_nationkey").cast("bigint").alias("ID_SUCURSAL"),
        F.col("n_name").alias("DESCRIP_SUCURSAL"),
        F.col("n_regionkey").cast("bigint").alias("ID_ZONA_SUPERVISION"),
        F.col("r_name").alias("DESC_ZONA_SUPERVICION"),
        F.col("l_partkey").alias("ID_ARTICULO"),
        F.col("p_name").alias("DESC_ARTICULO"),
        F.col("p_size").cast("bigint").alias("FAMILIA"),
        F.col("p_brand").alias("DESC_FAMILIA"),
        (F.col("p_size") % 7).cast("bigint").alias("DEPARTAMENTO"),
        F.col("p_type").alias("DESC_DEPARTAMENTO"),
        (F.col("l_partkey") % 5).alias("RUBRO"),
        F.concat(F.lit("R"), F.col("l_partkey") % 5).alias("DESC_RUBRO"),
        (F.col("l_partkey") % 25).alias("SUBRUBRO"),
        F.concat(F.lit("S"), F.col("l_partkey") % 25).alias("DESC_SUBRUBRO"),
        F.col("l_quantity").cast("bigint").alias("CANTIDAD_VENDIDA"),
        (price / F.col("l_quantity")).alias("VALOR_ARTICULO"),
        (price * (F.lit(1.0) + tax)).alias("VENTA_BRUTA"),
        F.lit(0.0).alias("MONTO_IMPUESTOS_INTERNOS"),
        (price * tax).alias("MONTO_IVA"),
        (F.lit(2.0) * F.col("p_retailprice")).alias("COSTO_ARTICULO"),
        F.col("l_linenumber").alias("_pos_line"),
        F.col("l_suppkey").alias("_pos_supplier"),
        F.col("l_quantity").alias("_pos_quantity"),
        F.col("l_extendedprice").alias("_pos_price"),
        *further,
    )
    return add_unit(sales, F.col("DESCRIP_SUCURSAL"))


def _by_unit(lines: DataFrame) -> DataFrame:
    """Lines dealt by branch and month, so that a layer made of them is written where they are.

    A line of plain columns is a third of what its names and amounts make of it in a layer.
    """
    date = F.col("o_orderdate").cast("timestamp")
    dated = lines.select(*LINE_COLUMNS, F.year(date).alias("_year"), F.month(date).alias("_month"))
    return dated.hint("rebalance", "n_name", "_year", "_month")


def unit_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``sales_view`` by branch and month, for a layer."""
    return _sales_columns(_by_unit(_joined_lines(spark, sf_dir)))


def unit_first_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``unit_sales`` without duplicates, which go while the lines still lie by their article."""
    lines = _joined_lines(spark, sf_dir)
    sales = _sales_columns(lines, *LINE_COLUMNS)
    return _sales_columns(_by_unit(dedup_lines(sales, POSITION)))


def rate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates file content: one row per month with orders, with gaps, repeats and a null.

    Months 17, 34, … are absent, month 20 comes twice, month 30 has no rate, and month 40
    comes first without and then with a rate. Month 25 comes a second time as month 13 of its year,
    which is no month. ``ord`` is the row order of the file.
    """
    n = (F.col("year") - 1995) * 12 + F.col("month")
    months = (
        table(spark, sf_dir, "orders")
        .select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .distinct()
        .where(n % 17 != 0)
    )
    repeats = F.when(n.isin(20, 25, 40), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = months.select("year", "month", n.alias("n"), F.explode(repeats).alias("repeat"))
    no_month = (F.col("n") == 25) & (F.col("repeat") == 1)
    no_rate = (F.col("n") == 30) | ((F.col("n") == 40) & (F.col("repeat") == 0))
    rate = F.lit(800.37) + 5 * F.col("n") + 50 * F.col("repeat")
    return rows.select(
        "year",
        F.when(no_month, 13).otherwise(F.col("month")).alias("month"),
        F.when(~no_rate, rate).alias("exchange_rate_ars_usd"),
        (F.col("n") * 2 + F.col("repeat")).alias("ord"),
    )


def rates_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_rates(rate_rows(spark, sf_dir), "ord")


def silver_view(spark: SparkSession, sf_dir: str, by_unit: bool = False) -> DataFrame:
    """Silver lines of the typed sales; some have a weekday of no known name, some no day of the month.

    ``by_unit`` gives them by branch and month, for a layer.
    """
    rates = rates_view(spark, sf_dir)
    if by_unit:
        lines = first_lines(unit_first_sales(spark, sf_dir), rates)
    else:
        lines = silver_lines(sales_view(spark, sf_dir), rates, source_order=POSITION)
    ticket = F.col("NUMERO_TICKET")
    return lines.withColumns(
        {
            "DIA_SEMANA": F.when(ticket % 53 == 0, "Feriado").otherwise(F.col("DIA_SEMANA")),
            "DIA_MES": F.when(ticket % 43 != 0, F.col("DIA_MES")),
        }
    )


def _damaged(sales: DataFrame) -> dict[str, Column]:
    ticket = F.col("NUMERO_TICKET")

    def every(n: int) -> Column:
        return ticket % n == 0

    text = {c: F.col(c).cast("string") for c in RAW_REQUIRED}
    article = text["DESC_ARTICULO"]
    return text | {
        "NUMERO_TICKET": F.when(every(97), "nan").otherwise(text["NUMERO_TICKET"]),
        "CANTIDAD_VENDIDA": F.when(every(89), "12.7")
        .when(every(50), (-F.col("CANTIDAD_VENDIDA")).cast("string"))
        .otherwise(text["CANTIDAD_VENDIDA"]),
        "VALOR_ARTICULO": F.when(every(83), "1,234").otherwise(text["VALOR_ARTICULO"]),
        "COSTO_ARTICULO": F.when(every(79), "12d").otherwise(text["COSTO_ARTICULO"]),
        "FECHA": F.when(every(73), "no date")
        .when(every(67), F.date_format("FECHA", "yyyy-MM-dd"))
        .when(every(61), F.date_format("FECHA", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(every(59), F.date_format("FECHA", "yyyyMMdd"))
        .otherwise(text["FECHA"]),
        "DESC_ARTICULO": F.when(every(71), F.concat(F.lit("\t "), article, F.lit(" \t")))
        .when(~every(47), article),
    }


TICKETS_PER_RANGE = 65_536


def _numbered(spark: SparkSession, sf_dir: str, sales: DataFrame) -> DataFrame:
    """Sales lines with ``_number``, the place in their branch and year by ticket, position and article.

    A branch and year grows with the data, so its lines are numbered within ranges of ticket numbers, and
    the lines of the ranges before are added. These counts are staged, so that the planner knows their size.
    """
    span = [*UNIT[:2], "_range"]
    ranged = sales.withColumn("_range", F.floor(F.col("NUMERO_TICKET") / TICKETS_PER_RANGE))
    sizes = ranged.groupBy(*span).agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*span[:2]).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*span, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    order = ["NUMERO_TICKET", *POSITION, F.col("ID_ARTICULO").cast("string")]
    place = F.row_number().over(W.partitionBy(*span).orderBy(*order))
    lines = dealt(ranged, table(spark, sf_dir, "lineitem").count(), *span).withColumn("_place", place)
    named = stage(starts.select(*[F.col(c).alias(f"_of{c}") for c in span], "_before"))
    same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in span]
    return lines.join(named, same).withColumn("_number", F.col("_before") + F.col("_place")).select(*sales.columns, "_number")


FILES_PER_TASK = 16


def _tickets_per_range(spark: SparkSession, sf_dir: str, lines: int) -> int:
    """Width of a range of tickets that holds the lines of one task for an average branch and year."""
    orders = table(spark, sf_dir, "orders")
    years, number = F.year(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey")
    found = orders.agg(F.max(years) - F.min(years) + 1, F.max(number) - F.min(number) + 1).first()
    groups = table(spark, sf_dir, "nation").count() * (found[0] or 1)
    return max(1, (found[1] or 1) * groups * LINES_PER_TASK // max(lines, 1))


def staged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of ``_numbered`` as a stored table, for consumers that keep the text of all columns.

    They are staged by branch and month as the plain columns of the tables, so that their readers need no shuffle to write them as a layer; small files
    bound the lines of a task that reads them. The counts are taken from the staged lines.
    """
    lines = table(spark, sf_dir, "lineitem").count()
    width = _tickets_per_range(spark, sf_dir, lines)
    span = ["n_name", "_year", "_range"]
    date = F.col("o_orderdate").cast("timestamp")
    ranged = _joined_lines(spark, sf_dir).select(
        *LINE_COLUMNS, F.year(date).alias("_year"), F.floor(F.col("l_orderkey") / width).alias("_range")
    )
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", F.col("l_partkey").cast("string")]
    place = F.row_number().over(W.partitionBy(*span).orderBy(*order))
    placed = dealt(ranged, lines, *span).withColumn("_place", place).sortWithinPartitions(*span, F.month(date))
    staged = stage(placed, LINES_PER_TASK // FILES_PER_TASK)
    sizes = staged.groupBy(*span).agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*span[:2]).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"_of{c}") for c in span], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    same = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in span]
    counted = staged.join(stage(starts), same).withColumn("_number", F.col("_before") + F.col("_place"))
    return _sales_columns(counted, "_number")


def dirty_view(spark: SparkSession, sf_dir: str, numbered: bool = False, sales: DataFrame | None = None) -> DataFrame:
    """The sales as damaged text; unit columns and source position stay as they are.

    ``TICKET`` keeps the undamaged ticket number for reference. ``sales`` are those of another layout.
    """
    if sales is None:
        sales = sales_view(spark, sf_dir)
        if numbered:
            sales = _numbered(spark, sf_dir, sales)
    damaged = _damaged(sales)
    return sales.select(
        *[damaged[c].alias(c) for c in RAW_REQUIRED],
        F.col("NUMERO_TICKET").alias("TICKET"),
        *UNIT,
        *POSITION,
        *(["_number"] if numbered else []),
    )


def bronze_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged text with parsed dates: what a bronze table of these sales holds."""
    return valid_dates(coerce_date(dirty_view(spark, sf_dir)))


# Header texts of the raw sheets: every second one in lower case and between blanks.
UNTIDY = [f" {c.lower()} " if i % 2 else c for i, c in enumerate(RAW_REQUIRED)]


def raw_view(spark: SparkSession, sf_dir: str, numbered: bool = False, sales: DataFrame | None = None) -> DataFrame:
    """The damaged sales as rows of workbook sheets, one workbook per branch, a sheet per year.

    Headers and cells are as a reader finds them. Some workbooks break the rules: a missing
    column, an extra column, a file name without a branch, an unreadable file; one sheet has no
    valid date. ``numbered`` gives every row of a sheet a number of its own instead of its ticket
    line's.
    """
    dirty = dirty_view(spark, sf_dir, numbered, sales)
    branch = F.substring_index("SUCURSAL", "_", -1).cast("int")
    path = (
        F.when(branch == 7, "raw/ventas/Ventas.xlsx")
        .when(branch % 2 == 1, F.concat(F.lit("raw/ventas/VENTAS - "), "SUCURSAL", F.lit(".XLSX")))
        .otherwise(F.concat(F.lit("raw/ventas/Ventas_"), "SUCURSAL", F.lit(".xlsx")))
    )
    lacks_cost, has_note, unreadable = branch % 11 == 3, branch % 5 == 1, branch == 9
    undated = (branch == 4) & (F.col("YEAR") == 1996)
    texts = {c: F.col(c) for c in RAW_REQUIRED}
    texts["FECHA"] = F.when(undated, "sin fecha").otherwise(F.col("FECHA"))
    note = F.concat(F.lit(" linea "), F.col("_pos_line"))
    row_no = F.col("_number" if numbered else "_pos_line").cast("bigint") + 1
    width = F.when(lacks_cost, len(texts) - 1).when(has_note, len(texts) + 1).otherwise(len(texts))

    def by_branch(widest: list[Column]) -> Column:
        """One array for all branches, cut to the width of each: a choice of arrays would hold all texts three times."""
        return F.when(~unreadable, F.slice(F.array(*widest), F.lit(1), width))

    return dirty.select(
        path.alias("path"),
        F.when(~unreadable, F.col("YEAR").cast("string")).alias("sheet"),
        F.when(~unreadable, F.col("YEAR") - 1995).alias("sheet_no"),
        F.when(~unreadable, row_no).alias("row_no"),
        F.when(unreadable, "unreadable_workbook: BadZipFile").alias("error"),
        by_branch([F.lit(h) for h in [*UNTIDY, "Obs "]]).alias("header"),
        by_branch([*texts.values(), note]).alias("cells"),
    )
