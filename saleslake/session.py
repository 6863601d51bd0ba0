"""Session settings of the command line and the benchmark."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # The JVM never compiles methods above 8,000 bytes. The typed columns of a whole layer make
    # a larger one in a single stage; with this limit Spark splits it into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def builder(name: str) -> SparkSession.Builder:
    result = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        result = result.config(key, value)
    return result
