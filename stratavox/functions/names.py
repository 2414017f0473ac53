"""File names of acquisitions: parsing, tiles, channels, frames, renaming. Expressions and windows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The parts of a raw file's name.
FIELDS = {
    "iter": (r"Iter_(\d+)", "int"),
    "camera": (r"_Cam([A-Z])", "string"),
    "channel": (r"_ch(\d+)", "int"),
    "cam_number": (r"_CAM(\d+)", "int"),
    "stack": (r"_stack(\d+)", "int"),
    "wavelength_nm": (r"_(\d+)nm", "int"),
    "delta_ms": (r"_(\d+)msec_", "long"),
    "abs_ms": (r"_(\d+)msecAbs", "long"),
    "tile_x": (r"_(-?\d+)x_", "int"),
    "tile_y": (r"_(-?\d+)y_", "int"),
    "tile_z": (r"_(-?\d+)z_", "int"),
    "t": (r"_(\d+)t\.", "int"),
}


def after(name: Column, phrase: str) -> Column:
    """What follows the first `phrase`, up to the next underscore; '' without it."""
    return F.regexp_extract(name, f"{phrase}([^_]*)", 1)


def tagged(path: Column, tag: str) -> Column:
    """The path with `tag` before its extension."""
    return F.regexp_replace(path, r"(\.[^./]+)$", f"{tag}$1")


def parse(files: DataFrame, name: str = "name") -> DataFrame:
    """files and the fields of their names; an absent field is null."""
    # '' is no number, so that a number's pattern runs once.
    found = {c: F.regexp_extract(name, p, 1) for c, (p, _) in FIELDS.items()}
    return files.select("*", F.regexp_extract(name, "^([^_]*)_", 1).alias("dataset"), *[(F.nullif(found[c], F.lit("")) if t == "string" else found[c].try_cast(t)).alias(c) for c, (_, t) in FIELDS.items()])


def raw_files(files: DataFrame, prefix: str, name: str = "name") -> DataFrame:
    """The files of a dataset that hold a channel, with it (the last one named)."""
    pattern = f"^{prefix}.*_ch(\\d+).*\\.tif$"
    return files.filter(F.col(name).rlike(pattern)).select("*", F.regexp_extract(name, pattern, 1).cast("int").alias("ch"))


def scan_type(files: DataFrame, dir: str = "dir", name: str = "name") -> DataFrame:
    """(dir, scan_type): bdv before tile before scan."""
    rank = F.when(F.col(name).rlike(r"_tile\d+_t\d+"), 2).when(F.col(name).rlike(r"Iter_\d{4}_"), 1).otherwise(0)
    return files.groupBy(dir).agg(F.max(rank).alias("r")).select(dir, F.element_at(F.array(F.lit("scan"), F.lit("tile"), F.lit("bdv")), F.col("r") + 1).alias("scan_type"))


def tile_indexes(parsed: DataFrame, dir: str = "dir") -> DataFrame:
    """(dir, tile_x, tile_y, tile_z, tile): tiles numbered from 0 in the order of their first file name."""
    firsts = parsed.filter("tile_x is not null").groupBy(dir, "tile_x", "tile_y", "tile_z").agg(F.min("name").alias("first"))
    return firsts.select(dir, "tile_x", "tile_y", "tile_z", (F.row_number().over(Window.partitionBy(dir).orderBy("first")) - 1).alias("tile"))


def with_tile(parsed: DataFrame, tiles: DataFrame, dir: str = "dir") -> DataFrame:
    """A file without tile fields, or of an unknown tile, is of tile 0."""
    return parsed.join(tiles, [dir, "tile_x", "tile_y", "tile_z"], "left").withColumn("tile", F.coalesce("tile", F.lit(0)))


def bdv_name(tiled: DataFrame, cameras: bool = False, tag: str = "") -> DataFrame:
    """tiled with bdv_name: scan_ch{C}_tile{T}_t{NNNN}. With cameras, C has two digits, and camera B
    counts from 10; without, the channel as it is. Time is the iteration of a tiled scan, else the stack."""
    channel = F.lpad(F.when(F.col("camera") == "B", F.col("channel") + 10).otherwise(F.col("channel")).cast("string"), 2, "0") if cameras else F.col("channel").cast("string")
    time = F.lpad(F.coalesce("iter", "stack", F.lit(0)).cast("string"), 4, "0")
    return tiled.withColumn("bdv_name", F.concat(F.lit("scan_ch"), channel, F.lit("_tile"), F.col("tile").cast("string"), F.lit("_t"), time, F.lit(tag + ".tif")))


def highest_channel(parsed: DataFrame, camera: str = "A", by: str = "dir") -> DataFrame:
    """(by, channel): the highest channel number of a camera's files, null without any."""
    return parsed.groupBy(by).agg(F.max(F.when(F.col("camera") == camera, F.col("channel"))).alias("channel"))


def rename_map(named: DataFrame, by: str = "dir") -> DataFrame:
    """(dir, name, bdv_name): old and new names, for a table that is kept beside the files; new names
    that two files of a directory would get are an error of the caller's: see name_clashes()."""
    return named.select(by, "name", "bdv_name")


def name_clashes(named: DataFrame, by: str = "dir") -> DataFrame:
    """(dir, bdv_name, n): new names that several files would get."""
    return named.groupBy(by, "bdv_name").agg(F.count("*").alias("n")).filter("n > 1")


def original_of(files: DataFrame, name: str = "name") -> DataFrame:
    """files with `original`: a processed file's name cut behind its time field, as the raw file had it."""
    return files.withColumn("original", F.concat(F.regexp_extract(name, r"^(.*?_\d+t)", 1), F.lit(".tif")))


def channel_order(parsed: DataFrame, dir: str = "dir") -> DataFrame:
    """(dir, channel, camera, order): channels by number and camera, numbered from 0."""
    order = Window.partitionBy(dir).orderBy("channel", "camera")
    return parsed.select(dir, "channel", "camera").distinct().select("*", (F.row_number().over(order) - 1).alias("order"))


def channel_lasers(order: DataFrame, lasers: DataFrame, dir: str = "dir") -> DataFrame:
    """Channel names with the lasers of their channel (dir, ch, laser_idx, laser): one laser is all
    names' laser; as many lasers as names are paired in order. Other counts give ok = false, laser null."""
    n = Window.partitionBy(dir, "channel")
    names = order.select("*", F.row_number().over(n.orderBy("order")).alias("rn"), F.count("*").over(n).alias("n_names"))
    m = Window.partitionBy(dir, "ch")
    given = lasers.select(F.col(dir).alias("d"), F.col("ch"), "laser", F.row_number().over(m.orderBy("laser_idx")).alias("ln"), F.count("*").over(m).alias("n_lasers"))
    at = names.join(given, (names[dir] == given["d"]) & (names["channel"] == given["ch"]) & ((given["n_lasers"] == 1) | ((given["n_lasers"] == names["n_names"]) & (given["ln"] == names["rn"]))), "left")
    return at.select(dir, "channel", "camera", "order", "laser", F.col("laser").isNotNull().alias("ok"))


def relative_time(parsed: DataFrame, by: str = "dir") -> DataFrame:
    """Milliseconds since the first file by name."""
    first = F.first("abs_ms").over(Window.partitionBy(by).orderBy("name").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return parsed.withColumn("rel_ms", F.col("abs_ms") - first)


def frames(parsed: DataFrame, by: str = "dir") -> DataFrame:
    """(by, n_stacks, n_iters, n_frames) from the highest numbers, which start at 0."""
    s, i = F.coalesce(F.max("stack"), F.lit(0)) + 1, F.coalesce(F.max("iter"), F.lit(0)) + 1
    return parsed.groupBy(by).agg(s.alias("n_stacks"), i.alias("n_iters")).withColumn("n_frames", F.col("n_stacks") * F.col("n_iters"))


def frame_index(parsed: DataFrame, counted: DataFrame, by: str = "dir") -> DataFrame:
    """frame from 1: (stack + 1) + iter * n_stacks."""
    at = parsed.join(counted.select(by, "n_stacks"), by)
    return at.withColumn("frame", F.coalesce("stack", F.lit(0)) + 1 + F.coalesce("iter", F.lit(0)) * F.col("n_stacks"))


def legacy_name(parsed: DataFrame, order: DataFrame, counted: DataFrame, dir: str = "dir") -> DataFrame:
    """{dataset}_c{channel order from 1}_t{frame, four digits}."""
    at = frame_index(parsed, counted, dir).join(order.select(dir, "channel", "camera", "order"), [dir, "channel", "camera"])
    return at.withColumn("legacy_name", F.format_string("%s_c%d_t%04d.tif", "dataset", F.col("order") + 1, "frame"))


def colour(wavelength: Column) -> Column:
    """A colour map's number for an excitation wavelength."""
    return F.when(wavelength < 420, 1).when(wavelength < 500, 2).when(wavelength < 600, 3).when(wavelength < 700, 4).otherwise(5)
