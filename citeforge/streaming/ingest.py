"""Exports arriving as a stream: each file once, each DOI once (survey SRC-04, PIPE-18/19).

The file source's checkpoint is the manifest of files; a batch is reduced to the first record
of each DOI, compared with the DOIs already stored by an anti-join, and appended. A batch that
is run again after a failure writes to the same folder of its number, so nothing doubles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from citeforge.functions.text import strip, text
from citeforge.operators.quality import dedup_by_doi


def ingest(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: StructType, fmt: str = "parquet", order: str = "record_id",
    files_per_batch: int = 1, options: dict[str, str] | None = None,
) -> DataFrame:
    """Take in what is new in ``source`` and give the stored table."""

    def take(batch: DataFrame, number: int) -> None:
        fresh = dedup_by_doi(batch, [order])
        stored = _stored(spark, target, schema, before=number)
        if stored is not None:
            seen = stored.select(strip(text("doi")).alias("__doi")).filter("__doi <> ''").distinct()
            fresh = fresh.withColumn("__doi", strip(text("doi"))).join(seen, "__doi", "left_anti").select(*batch.columns)
        fresh.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.format(fmt).schema(schema).options(**(options or {})).option("maxFilesPerTrigger", files_per_batch).load(source)
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return _stored(spark, target, schema)


def _stored(spark: SparkSession, target: str, schema: StructType, before: int | None = None) -> DataFrame | None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return None if before is not None else spark.createDataFrame([], schema)
    table = spark.read.schema(StructType([*schema.fields, StructField("batch", IntegerType())])).parquet(target)
    table = table.filter(F.col("batch") < before) if before is not None else table
    return table.drop("batch")


def windowed_counts(events: DataFrame, every: str = "1 day", late: str = "7 days") -> DataFrame:
    """Events by type and window of event time with a watermark: late rows within it count."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    counted = timed.groupBy(F.window("at", every), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").alias("window_start"), "event_type", "events", "total")
