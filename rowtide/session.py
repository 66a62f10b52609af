"""Session settings that suit the library's plans. All can be changed at run time."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM never compiles a method over 8000 bytes of code. Decoding a wide table
# in one generated method would be interpreted; above this limit Spark splits
# the work into methods that are compiled.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    for key, setting in SETTINGS.items():
        spark.conf.set(key, setting)
    return spark
