"""Volumes, calibration frames, kernels, names and settings made from the driver's tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.types import Grid

#: 25 vectors of 64 elements make a volume of 8 x 8 x 25.
GRID = Grid(8, 8, 25, 0.104, 0.104, 0.4)

SETTINGS = (
    "***** ***** ***** General ***** ***** *****\n"
    "Date :\t3/14/2019 1:05:09 PM\nAcq mode :\tZ stack\nVersion :\tv 4.02893\nPC :\tscope-1\n"
    "***** ***** ***** Notes ***** ***** *****\nMicroscopist :\tA\nCollaborator :\tB\nSample :\tcells\n"
    "***** ***** ***** 3D Tiling ***** ***** *****\n# of tiles X :\t2\n# of tiles Y :\t3\n# of tiles Z :\t1\n# of tiles T :\t4\n"
    "***** ***** ***** Waveform ***** ***** *****\nWaveform type :\tLinear\nCycle lasers :\tper Z\nZ motion :\tSample piezo\n"
    "X Galvo, Interval (um), # of Pixels for Excitation (0) :\t0\t0.1\t51\n"
    "X Stage Offset, Interval (um), # of Pixels for Excitation (0) :\t5\t0.4\t501\n"
    "X Stage Offset, Interval (um), # of Pixels for Excitation (1) :\t5\t0.4\t501\n"
    "X Stage Offset, Interval (um), # of Pixels for Excitation (2) :\t5\t0.5\t401\n"
    "Excitation Filter, Laser, Power (%), Exp(ms) (0) :\tN/A\t488\t10\t10\n"
    "Excitation Filter, Laser, Power (%), Exp(ms), Laser2, Power2 (%), Laser3, Power3 (%) (1) :\tN/A\t560\t10\t20\tOFF\t0.1\tOFF\t0.1\n"
    "Excitation Filter, Laser, Power (%), Exp(ms), Laser2, Power2 (%), Laser3, Power3 (%) (2) :\tN/A\t488\t12\t20\t642\t30\tOFF\t0.1\n"
)


def kernel() -> np.ndarray:
    d = np.arange(-1, 2)
    k = 1 / (1 + d[:, None, None] ** 2 + d[None, :, None] ** 2 + d[None, None, :] ** 2)
    return k / k.sum()


def planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image page for each vector: 16-bit counts."""
    at = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    px = F.transform("embedding", lambda e: F.floor((e.cast("double") + 1) * F.lit(32767.5)).cast("double"))
    return at.select(F.expr("vec_id div 25").alias("image_id"), (F.col("vec_id") % 25).cast("int").alias("z"), F.lit(8).alias("height"), F.lit(8).alias("width"), px.alias("px"))


def dark(spark: SparkSession) -> DataFrame:
    return spark.range(64).select(F.expr("cast(id div 8 as int)").alias("y"), (F.col("id") % 8).cast("int").alias("x"), (F.lit(100.0) + F.col("id") % 7).alias("v"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dir, name) of raw files, from events."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "user_id")
    wave = F.element_at(F.array(*map(F.lit, (405, 488, 560, 642))), (F.length("event_type") % 4 + 1).cast("int"))
    ms = F.unix_millis(F.col("ts").cast("timestamp")) % 10_000_000_000
    name = F.format_string(
        "scan_Iter_%04d_Cam%s_ch%d_CAM1_stack%04d_%dnm_%07dmsec_%010dmsecAbs_%03dx_%03dy_%03dz_%04dt.tif",
        (F.col("event_id") % 3).cast("int"), F.when(F.col("event_id") % 2 == 0, "A").otherwise("B"), (F.col("event_id") % 3).cast("int"), F.expr("cast(event_id div 6 as int)"), wave.cast("int"), (ms % 10_000_000).cast("long"), ms.cast("long"),
        (F.col("user_id") % 3).cast("int"), (F.col("user_id") % 2).cast("int"), F.lit(0), (F.col("event_id") % 10).cast("int"),
    )
    return e.select(F.concat(F.lit("d"), (F.col("event_id") % 5).cast("string")).alias("dir"), "event_id", name.alias("name"))


def settings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"d{k}", SETTINGS) for k in range(5)], "dir string, text string")
