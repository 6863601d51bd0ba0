"""Column lists, types and partition layout of the layers."""

from pyspark.sql import types as T

# Column names and types of the raw contract and the layer tables.
RAW_REQUIRED = [
    "FECHA",
    "NUMERO_TICKET",
    "CANTIDAD_TICKET",
    "ID_SUCURSAL",
    "DESCRIP_SUCURSAL",
    "ID_ZONA_SUPERVISION",
    "DESC_ZONA_SUPERVICION",
    "ID_ARTICULO",
    "DESC_ARTICULO",
    "FAMILIA",
    "DESC_FAMILIA",
    "DEPARTAMENTO",
    "DESC_DEPARTAMENTO",
    "RUBRO",
    "DESC_RUBRO",
    "SUBRUBRO",
    "DESC_SUBRUBRO",
    "CANTIDAD_VENDIDA",
    "VALOR_ARTICULO",
    "VENTA_BRUTA",
    "MONTO_IMPUESTOS_INTERNOS",
    "MONTO_IVA",
    "COSTO_ARTICULO",
]
INTEGER_COLUMNS = [
    "NUMERO_TICKET",
    "CANTIDAD_TICKET",
    "ID_SUCURSAL",
    "ID_ZONA_SUPERVISION",
    "ID_ARTICULO",
    "FAMILIA",
    "DEPARTAMENTO",
    "RUBRO",
    "SUBRUBRO",
    "CANTIDAD_VENDIDA",
]
DOUBLE_COLUMNS = [
    "VALOR_ARTICULO",
    "VENTA_BRUTA",
    "MONTO_IMPUESTOS_INTERNOS",
    "MONTO_IVA",
    "COSTO_ARTICULO",
]
DERIVED_DOUBLES = [
    "VENTA_ARS",
    "COSTO_ARS",
    "MARGEN_ARS",
    "TIPO_CAMBIO",
    "VENTA_USD",
    "COSTO_USD",
    "MARGEN_USD",
]
GOLD_MEASURES = [
    "CANTIDAD_VENDIDA",
    "VENTA_ARS",
    "COSTO_ARS",
    "MARGEN_ARS",
    "VENTA_USD",
    "COSTO_USD",
    "MARGEN_USD",
]
RATE_COLUMNS = ["year", "month", "exchange_rate_ars_usd"]

# The branch-month: unit of processing, partition of every layer.
UNIT = ["SUCURSAL", "YEAR", "MONTH"]
PARTITION_COLUMNS = ["sucursal", "year", "month"]
PRODUCT_KEYS = [*UNIT, "ID_ARTICULO", "DESC_ARTICULO"]
TICKET_LINE_KEYS = ["FECHA", "NUMERO_TICKET", "ID_ARTICULO"]

# Where a row came from; kept in bronze so that "first row" stays defined after a shuffle.
SOURCE_COLUMNS = ["_src_file", "_src_sheet_no", "_src_row"]
EXTRA = "_extra"  # columns beyond the contract, by name


def _silver_type(column: str) -> T.DataType:
    if column == "FECHA":
        return T.TimestampType()
    if column in INTEGER_COLUMNS:
        return T.LongType()
    if column in DOUBLE_COLUMNS:
        return T.DoubleType()
    return T.StringType()


PARTITION_FIELDS = [
    T.StructField("sucursal", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
]

# Rows of workbook sheets as they are: position, reading error, header and cells by column.
RAW = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("sheet_no", T.IntegerType()),
        T.StructField("row_no", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField(c, T.TimestampType() if c == "FECHA" else T.StringType())
        for c in RAW_REQUIRED
    ]
)

BRONZE_STORED = T.StructType(
    BRONZE.fields
    + [
        T.StructField("_src_file", T.StringType()),
        T.StructField("_src_sheet_no", T.IntegerType()),
        T.StructField("_src_row", T.LongType()),
        T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType())),
    ]
)

SILVER = T.StructType(
    [T.StructField(c, _silver_type(c)) for c in RAW_REQUIRED]
    + [T.StructField(c, T.DoubleType()) for c in DERIVED_DOUBLES]
    + [T.StructField("DIA_MES", T.LongType()), T.StructField("DIA_SEMANA", T.StringType())]
)

SILVER_STORED = T.StructType(
    [*SILVER.fields, T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType()))]
)
# What gold needs of silver, besides the branch-month.
GOLD_INPUT = [
    "ID_ARTICULO",
    "DESC_ARTICULO",
    "CANTIDAD_VENDIDA",
    "VENTA_ARS",
    "COSTO_ARS",
    "MARGEN_ARS",
    "VENTA_USD",
    "COSTO_USD",
    "MARGEN_USD",
    "DIA_MES",
    "DIA_SEMANA",
]

GOLD = T.StructType(
    [
        T.StructField("ID_ARTICULO", T.LongType()),
        T.StructField("DESC_ARTICULO", T.StringType()),
        T.StructField("CANTIDAD_VENDIDA", T.LongType()),
        T.StructField("VENTA_ARS", T.DoubleType()),
        T.StructField("COSTO_ARS", T.DoubleType()),
        T.StructField("MARGEN_ARS", T.DoubleType()),
        T.StructField("VENTA_USD", T.DoubleType()),
        T.StructField("COSTO_USD", T.DoubleType()),
        T.StructField("MARGEN_USD", T.DoubleType()),
        T.StructField("MARGEN_PORC_ARS", T.DoubleType()),
        T.StructField("MARGEN_PORC_USD", T.DoubleType()),
        T.StructField("PRODUCTO_TOP_MARGEN", T.StringType()),
        T.StructField("DIA_MES_TOP_VENTAS", T.IntegerType()),
        T.StructField("DIA_SEMANA_TOP_VENTAS", T.StringType()),
        T.StructField("CUMPLIMIENTO_OBJETIVO", T.StringType()),
        T.StructField("CORRELACION_SEMANAL", T.DoubleType()),
        T.StructField("SIGUE_TENDENCIA_SEMANAL", T.BooleanType()),
        T.StructField("CORRELACION_MENSUAL", T.DoubleType()),
        T.StructField("SIGUE_TENDENCIA_MENSUAL", T.BooleanType()),
        T.StructField("MONTH_NAME", T.StringType()),
    ]
)

RATES = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("exchange_rate_ars_usd", T.DoubleType()),
    ]
)


def with_partitions(schema: T.StructType) -> T.StructType:
    """A layer's schema as a reader sees it: data columns, then typed partition columns."""
    return T.StructType(schema.fields + PARTITION_FIELDS)
