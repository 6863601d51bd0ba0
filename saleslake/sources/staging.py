"""Tables written between the steps of a job, in a folder that the cluster shares."""

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from saleslake.session import SETTINGS

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
Stage = Callable[[DataFrame], DataFrame]


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, or else below the session's warehouse.

    A warehouse in a folder of the driver's machine is no place for them on a cluster, whose
    executors can't see it: there the setting has to be made.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE_DIR).rstrip("/")
    if _is_machine_local(spark, warehouse) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the cluster shares; {warehouse} is on one machine")
    return f"{warehouse}/_staging"


@contextmanager
def write_settings(spark: SparkSession) -> Iterator[None]:
    """Settings of a write.

    Shuffle files go as soon as the write that made them is over, not when the driver happens to collect its garbage.
    The text columns of a layer make methods that the JVM never compiles; with the limit Spark makes small ones instead.
    """
    before = {key: spark.conf.get(key, default) for key, default in ((CLEAN_UP, "false"), (METHOD_LIMIT, "65535"))}
    wanted = {CLEAN_UP: "true", METHOD_LIMIT: SETTINGS[METHOD_LIMIT]}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _is_machine_local(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file"


def delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Delete a folder when the session ends."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)


def stage(df: DataFrame, rows_per_file: int = 0) -> DataFrame:
    """Write a table once and continue from the files.

    Used where a result has several consumers: readers prune columns, lineage ends at the
    files, and the planner knows the real size of what it joins. Every table has a folder of its
    own, since an earlier one may still be read; the session's end deletes them all. Files of at most
    ``rows_per_file`` rows bound the rows of a task that reads them again, as it packs a limited number of files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    staged = _write(df, path, rows_per_file)
    delete_at_exit(spark, path)
    return staged


class Staging:
    """Staged tables of one job, below its target; their folder is removed when the job is over."""

    def __init__(self, spark: SparkSession, target: str | None = None):
        self._spark = spark
        below = f"{target.rstrip('/')}/_staging" if target else f"{shared_dir(spark)}/staged"
        self._root = f"{below}/{uuid.uuid4().hex}"
        self._tables = 0

    def stage(self, df: DataFrame) -> DataFrame:
        self._tables += 1
        return _write(df, f"{self._root}/{self._tables}")

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_) -> None:
        context = self._spark.sparkContext
        root = context._jvm.org.apache.hadoop.fs.Path(self._root)
        root.getFileSystem(context._jsc.hadoopConfiguration()).delete(root, True)


def _write(df: DataFrame, path: str, rows_per_file: int = 0) -> DataFrame:
    with write_settings(df.sparkSession):
        df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
