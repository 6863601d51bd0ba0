"""Partitioned Parquet layers: sucursal=…/year=…/month=…"""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.functions.numeric import parse_double, to_int
from saleslake.operators.contract import reject_units
from saleslake.schemas import (
    EXTRA,
    PARTITION_COLUMNS,
    PARTITION_FIELDS,
    SOURCE_COLUMNS,
    UNIT,
    with_partitions,
)
from saleslake.sources.footers import ROW_LABELS, judged_files, layer_footers, unit_contract
from saleslake.sources.staging import write_settings

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def _scan(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    files = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(root)
    return files.withColumnsRenamed(dict(zip(PARTITION_COLUMNS, UNIT, strict=True)))


def read_layer(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All branch-months of a layer of our own, with declared types (branch ``007`` stays text)."""
    return _scan(spark, root, with_partitions(schema))


def read_files(
    spark: SparkSession, root: str, schema: T.StructType, files: DataFrame, report: DataFrame
) -> DataFrame:
    """All accepted branch-months of a layer as ``schema``, whoever wrote the files.

    ``files`` are the judged files of the layer, ``report`` their contract per branch-month; both
    are read more than once. Files of the same layout are one scan: the common layout is read as
    declared, any other one as it is stored and then cast, and its columns beyond the contract
    go to ``_extra`` where the schema has that. A scan leaves out the files of others by their
    paths, so what can't be read is never opened; the driver holds the paths of the smaller
    part only, and Spark's own listing holds all of them anyway.
    """
    accepted = reject_units(files.where(F.col(UNIT[0]).isNotNull()), report.where(F.col("reason").isNotNull()), UNIT)
    layouts = accepted.groupBy("layout").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("example")).collect()
    total = files.count()
    parts = []
    for layout in sorted(layouts, key=lambda r: r.layout):
        mine = F.col("layout") == layout.layout
        scan = _as_stored(spark, root, layout.example) if layout.layout else _scan(spark, root, with_partitions(schema))
        uri = F.col("_metadata.file_path")
        if layout.n == total:
            chosen = scan
        elif 2 * layout.n > total:
            chosen = scan.where(~uri.isin(_uris(files.join(accepted.where(mine).select("uri"), "uri", "left_anti"))))
        else:
            chosen = scan.where(uri.isin(_uris(accepted.where(mine))))
        parts.append(_as_declared(chosen, schema) if layout.layout else _with_source_order(chosen, schema))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, *_unit_fields()]))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def read_any_layer(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """``read_files`` over all files below a folder."""
    files = judged_files(layer_footers(spark, root), schema)
    return read_files(spark, root, schema, files, unit_contract(files))


def _unit_fields() -> list[T.StructField]:
    return [T.StructField(u, f.dataType) for u, f in zip(UNIT, PARTITION_FIELDS, strict=True)]


def _uris(files: DataFrame) -> list[str]:
    return [r.uri for r in files.select("uri").collect()]


def _as_stored(spark: SparkSession, root: str, example: str) -> DataFrame:
    """Scan of a layer in the types of one of its files; timestamps finer than microseconds come as numbers."""
    spark.conf.set(NANOS_AS_LONG, "true")
    inferred = spark.read.parquet(re.sub(r"([\\{}\[\]*?,])", r"\\\1", example)).schema
    own = [f for f in inferred if f.name.lower() not in PARTITION_COLUMNS and not isinstance(f.dataType, T.NullType)]
    return _scan(spark, root, T.StructType([*own, *PARTITION_FIELDS]))


def _with_source_order(layer: DataFrame, schema: T.StructType) -> DataFrame:
    ordered = with_source_order(layer) if set(SOURCE_COLUMNS) <= set(schema.fieldNames()) else layer
    return ordered.select(*schema.fieldNames(), *UNIT)


def _as_declared(layer: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored columns cast to the declared ones; columns beyond them as text in ``_extra``."""
    stored = dict(layer.dtypes)
    columns = {f.name: _cast(f, stored) for f in schema}
    foreign = [c for c in layer.columns if c not in {*schema.fieldNames(), *UNIT} and not re.search(ROW_LABELS, c)]
    if EXTRA in columns and foreign:
        texts = [F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value")) for c in foreign]
        known = F.map_from_entries(F.filter(F.array(*texts), lambda e: e["value"].isNotNull()))
        others = F.map_filter(F.coalesce(columns[EXTRA], F.create_map().cast(schema[EXTRA].dataType)), lambda k, v: ~k.isin(foreign))
        both = F.map_concat(others, known)
        columns[EXTRA] = F.when(F.size(both) > 0, both)
    if set(SOURCE_COLUMNS) <= set(columns):
        columns |= _source_order(*[columns[c] for c in SOURCE_COLUMNS])
    return layer.select(*[c.alias(name) for name, c in columns.items()], *UNIT)


def _cast(field: T.StructField, stored: dict[str, str]) -> Column:
    """A stored column as its declared type. Text is parsed; what is no number is null, as it is in text layers."""
    wanted, kind = field.dataType.simpleString(), stored.get(field.name)
    c = F.col(f"`{field.name}`")
    if kind is None:
        return F.lit(None).cast(field.dataType)
    if wanted == "timestamp" and kind == "bigint":  # nanoseconds
        return F.expr(f"timestamp_micros((`{field.name}` - pmod(`{field.name}`, 1000L)) div 1000L)")
    if kind == "boolean" and wanted != "boolean":
        c = c.cast("int")
    if kind == "string" and wanted in ("bigint", "int"):
        return F.when(parse_double(c).isNotNull(), to_int(c)).try_cast(field.dataType)
    if kind == "string" and wanted == "double":
        return parse_double(c)
    return c.try_cast(field.dataType) if kind != wanted else c


def stored_names(spark: SparkSession, root: str) -> DataFrame:
    """Names of all files of a layer; none if there is no layer yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "name string")
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = listing.option("recursiveFileLookup", "true").load(root)
    return files.select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"))


def _source_order(file: Column, sheet_no: Column, row: Column) -> dict[str, Column]:
    path, position = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    own = (F.coalesce(file, path), F.coalesce(sheet_no, F.lit(0)), F.coalesce(row, position))
    return dict(zip(SOURCE_COLUMNS, own, strict=True))


def with_source_order(layer: DataFrame) -> DataFrame:
    """Fill the source position of rows whose writer did not store it: file and row number."""
    return layer.withColumns(_source_order(*map(F.col, SOURCE_COLUMNS)))


def write_layer(df: DataFrame, root: str, clustered: bool = False) -> None:
    """Replace the branch-months present in ``df``; all others stay as they are.

    ``rebalance`` gives a small branch-month one file and splits a large one over several
    tasks and files, where a plain repartition would send it to a single task. ``clustered`` rows lie by branch-month
    already, as the files of a layer do or lines dealt by branch and month before: a task holds few
    branch-months, so they stay where they are.
    """
    data_columns = [c for c in df.columns if c not in UNIT]
    renamed = df.select(
        *data_columns, *[F.col(u).alias(p) for u, p in zip(UNIT, PARTITION_COLUMNS, strict=True)]
    )
    spread = renamed if clustered else renamed.hint("rebalance", *[F.col(p) for p in PARTITION_COLUMNS])
    with write_settings(df.sparkSession):
        (
            spread.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(*PARTITION_COLUMNS)
            .parquet(root)
        )
