"""Incremental batches: what is still to do, what was done, and a stream over arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def unprocessed(dirs: DataFrame, processed: DataFrame, psf_dirs: DataFrame | None = None) -> DataFrame:
    """Directories that are neither processed nor hold point-spread functions."""
    out = dirs.join(processed.select("dir"), "dir", "left_anti")
    return out.join(psf_dirs.select("dir"), "dir", "left_anti") if psf_dirs is not None else out


def missing_outputs(wanted: DataFrame, existing: DataFrame, by: list[str]) -> DataFrame:
    """Outputs that do not exist yet."""
    return wanted.join(existing.select(*by).distinct(), by, "left_anti")


def missing_projections(images: DataFrame, existing: DataFrame, axes: str) -> DataFrame:
    """Images of which a projection is missing: existing has (image_id, axis)."""
    wanted = images.select("image_id").withColumn("axis", F.explode(F.array(*map(F.lit, axes))))
    return missing_outputs(wanted, existing, ["image_id", "axis"]).select("image_id").distinct()


def last_settings(files: DataFrame) -> DataFrame:
    """(dir, name): the last settings file of each directory by name."""
    return files.groupBy("dir").agg(F.max("name").alias("name"))


def upsert(old: DataFrame, new: DataFrame, key: str = "dir") -> DataFrame:
    """old and new, where new rows replace old ones of their key."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    order = Window.partitionBy(key).orderBy(F.desc("_new"))
    return both.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "_new")


def stream_files(spark: SparkSession, folder: str, checkpoint: str, process: Callable[[DataFrame, int], None], glob: str = "*.tif*"):
    """Process the files that have arrived since the last call, once each, and stop. The checkpoint
    is the log of what was done; a batch counts as done only after process() returns."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    query = files.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def acquisition_rate(events: DataFrame, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Files per window of acquisition time; works on a stream, with a watermark, and on a table."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
