"""Score request files as they arrive, exactly once, with a checkpoint; with a fixed model or with the served one."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from pricewright.operators.score import score_batch
from pricewright.plans.score_plan import score_requests
from pricewright.sources import artifacts
from pricewright.spec import TableSpec


def request_stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """New parquet files under ``folder``; the cap bounds a micro-batch, not the input."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(folder))


def score_stream(requests: DataFrame, model: PipelineModel, spec: TableSpec, target: str,
                 checkpoint: str) -> StreamingQuery:
    """Score what has arrived since the last run and stop; started again, it goes on from there."""
    return (score_batch(requests, model, spec).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target))


def csv_requests(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """New header CSV files under ``folder`` as text columns, named by the files that are there at the start."""
    names = spark.read.csv(folder, header=True).columns
    return (spark.readStream.schema(StructType([StructField(c, StringType()) for c in names]))
            .option("maxFilesPerTrigger", files_per_trigger).option("enforceSchema", False).csv(folder, header=True))


def follow_stream(requests: DataFrame, spec: TableSpec, root: str, target: str, checkpoint: str) -> StreamingQuery:
    """Price what has arrived with whichever version is served when its micro-batch begins, then stop.

    Batch n goes to ``target/scored/batch=n`` with the version that priced it, its requests without a price to
    ``target/refused/batch=n``. A batch that is run again after a failure replaces its own folders, so it adds no row.
    """
    def price(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version = artifacts.current_version(root, spark)
        scored = score_requests(batch, spec, root, version).withColumn("version", F.lit(version))
        good = F.col("predicted_fare").isNotNull()
        held = scored.persist()
        try:
            held.where(good).drop("missing_inputs").write.mode("overwrite").parquet(f"{target}/scored/batch={number}")
            held.where(~good).write.mode("overwrite").parquet(f"{target}/refused/batch={number}")
        finally:
            held.unpersist()

    return (requests.writeStream.foreachBatch(price).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
