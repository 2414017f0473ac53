"""The data model: volumes as planes or voxels, pixel types, metadata schemas."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One row for each page of a stack; px is row-major, index y * width + x.
PLANE = "image_id long, z int, height int, width int, px array<double>"
VOXEL = "image_id long, z int, y int, x int, v double"

#: Ranges of pixel types; types that are not listed span 0 to 1.
RANGES = {
    "uint8": (0.0, 255.0),
    "int8": (-128.0, 127.0),
    "uint16": (0.0, 65535.0),
    "int16": (-32768.0, 32767.0),
    "uint32": (0.0, 4294967295.0),
    "int32": (-2147483648.0, 2147483647.0),
    "uint64": (0.0, 18446744073709551615.0),
    "int64": (-9223372036854775808.0, 9223372036854775807.0),
}
#: Output pixel type of each bit depth.
DEPTHS = {8: "uint8", 16: "uint16", 32: "float32"}


@dataclass(frozen=True)
class Grid:
    """Size of a volume and its voxel spacing in micrometres. It is metadata: no job reads it."""

    nx: int
    ny: int
    nz: int
    sx: float = 1.0
    sy: float = 1.0
    sz: float = 1.0


def pixel_range(dtype: str) -> tuple[float, float]:
    return RANGES.get(dtype, (0.0, 1.0))


def voxels(planes: DataFrame) -> DataFrame:
    """One row for each pixel; those of a plane without pixels are null."""
    none = F.array_repeat(F.lit(None).cast("double"), F.col("height") * F.col("width"))
    at = planes.select("image_id", "z", "width", F.posexplode(F.coalesce("px", none)).alias("i", "v"))
    return at.select("image_id", "z", F.expr("cast(i div width as int)").alias("y"), (F.col("i") % F.col("width")).cast("int").alias("x"), "v")


def planes_of(voxel: DataFrame, height: int, width: int) -> DataFrame:
    """Voxels gathered to planes; a missing voxel is 0."""
    cells = F.map_from_entries(F.collect_list(F.struct((F.col("y") * width + F.col("x")).alias("k"), "v")))
    at = voxel.groupBy("image_id", "z").agg(cells.alias("m"))
    px = F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0)))
    return at.select("image_id", "z", F.lit(height).alias("height"), F.lit(width).alias("width"), px.alias("px"))


def pages_of(batch: pa.RecordBatch):
    """(row, page as a 2-D array) of the planes of an Arrow batch whose pixels are not null."""
    px = batch.column("px")
    values, ends = np.asarray(px.flatten()), np.cumsum(px.value_lengths().fill_null(0).to_numpy())
    for i, (end, h, w) in enumerate(zip(ends.tolist(), batch.column("height").to_pylist(), batch.column("width").to_pylist(), strict=True)):
        if px[i].is_valid:
            yield i, values[end - h * w : end].reshape(h, w)


def mapped(planes: DataFrame, f, height: Column | str = "height", width: Column | str = "width") -> DataFrame:
    """planes with px replaced by f(px column)."""
    h, w = (F.col(x) if isinstance(x, str) else x for x in (height, width))
    return planes.select("image_id", "z", h.cast("int").alias("height"), w.cast("int").alias("width"), f(F.col("px")).alias("px"))
