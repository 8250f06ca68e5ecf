"""Session settings the operators were measured with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # the JVM never compiles a method over 8000 bytes; a wide cleaning projection
    # generates larger ones and runs interpreted unless Spark splits it
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # hot join keys are split, small partitions merged, small sides broadcast by measured size
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stage tables take a few bytes a row on disk and hundreds in a task's hash map, so tasks read little of them
    "spark.sql.files.maxPartitionBytes": "16m",
}

#: input bytes (compressed columns) per shuffle partition before small ones are merged
PARTITION_BYTES = 4_000_000
_SHUFFLES, _PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.shuffle.partitions"


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under a path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def tuned(spark: SparkSession, size: int = 0) -> SparkSession:
    """Apply the settings to a session. All of them can change at run time.

    ``size``, the bytes of the input, decides how many partitions a shuffle begins with, so that what one task sorts
    or aggregates does not grow with the input; adaptive execution merges those that turn out small.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if size:
        spark.conf.set(_SHUFFLES, str(max(int(spark.conf.get(_PARTITIONS)), -(-size // PARTITION_BYTES))))
    return spark
