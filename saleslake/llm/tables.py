"""Tables written between the steps of an operator, in the folder that the cluster shares."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from saleslake.sources.staging import CLEAN_UP, shared_dir, write_settings  # noqa: F401


def scratch(spark: SparkSession) -> str:
    """A new folder, as a full URI; it is deleted when the session ends."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}")
    system = path.getFileSystem(conf)
    system.mkdirs(path)
    system.deleteOnExit(path)
    full = system.makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and full[6] != "/" else full


def stored(df: DataFrame) -> DataFrame:
    """The same rows read back from files: lineage ends there, no step runs twice and its shuffle files go."""
    spark, path = df.sparkSession, scratch(df.sparkSession) + "/table"
    with write_settings(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for new columns: the wanted ones, or where the table has such a column the first free one of name_1, name_2…

    Letter case doesn't make two names different, as in Spark.
    """
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        free, n = name, 0
        while free.lower() in taken:
            n += 1
            free = f"{name}_{n}"
        taken.add(free.lower())
        found.append(free)
    return found


def free_name(df: DataFrame, wanted: str) -> str:
    return free_names(df, wanted)[0]
