"""Lookup of calibration files: point-spread functions and flat frames by laser, settings by stem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_laser(files: DataFrame, calibration: DataFrame, laser: str = "wavelength_nm") -> DataFrame:
    """files with the calibration path of their laser; calibration (laser, path) comes from the
    configuration, a row for each laser, so it is broadcast. A laser without one gives a null path."""
    table = calibration.select(F.col("laser").alias("l"), F.col("path").alias("calibration"))
    return files.join(F.broadcast(table), F.col(laser) == F.col("l"), "left").drop("l")


def lasers_without(files: DataFrame, calibration: DataFrame, laser: str = "wavelength_nm") -> DataFrame:
    """(laser): lasers in use that have no calibration; a plan that needs it must stop on any."""
    used = files.select(F.col(laser).alias("laser")).distinct()
    return used.join(F.broadcast(calibration.select("laser")), "laser", "left_anti")


def with_settings(stacks: DataFrame, settings: DataFrame) -> DataFrame:
    """Stacks (path) with their own settings file, <stem>_Settings.txt (null if there is none)."""
    stem = F.regexp_replace("path", r"\.[^./]+$", "")
    given = settings.select(F.regexp_replace("path", r"_Settings\.txt$", "").alias("stem"), F.col("path").alias("settings"))
    return stacks.withColumn("stem", stem).join(given, "stem", "left").drop("stem")


def is_skewed(name: str = "path"):
    """Whether a kernel's name says that it has been sheared already; such files are refused as input."""
    return F.lower(F.col(name)).contains("skewed")


def datasets(settings_files: DataFrame) -> DataFrame:
    """(dir, dataset, n_iters): dataset name and numbers of iterations from the settings files' names."""
    name = F.regexp_extract("name", r"^(.*?)(?:_Iter_\d+)?_Settings\.txt$", 1)
    iteration = F.regexp_extract("name", r"_Iter_(\d+)_Settings\.txt$", 1)
    return settings_files.groupBy("dir", name.alias("dataset")).agg(F.count_distinct(F.when(iteration != "", iteration)).alias("n_iters"))
