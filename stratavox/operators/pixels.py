"""Pixel arithmetic, type conversion, crop and flat-field correction; all narrow on planes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavox.shipping import ship
from stratavox.types import DEPTHS, Grid, mapped, pages_of, pixel_range


def clamp(v: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(v, F.lit(float(lo))), F.lit(float(hi)))


def converted(v: Column, source: str, target: str, scale: bool = True) -> Column:
    """A pixel of type `source` as `target`. Scaled: the source's range is spread over the target's,
    values outside are clamped, integers truncated. Equal types pass through."""
    if source == target:
        return v
    (a, b), (c, d) = pixel_range(source), pixel_range(target)
    out = v
    if scale:
        out = clamp(v, a, b)
        out = (out - F.lit(a)) / F.lit(b - a) if a else out / F.lit(b)
        out = out * F.lit(d - c) + F.lit(c) if c else out * F.lit(d)
    if target.startswith("float"):
        return out.cast("float").cast("double") if target == "float32" else out
    return F.when(out >= 0, F.floor(out)).otherwise(F.ceil(out)).cast("double")


def convert(planes: DataFrame, source: str, target: str, scale: bool = True) -> DataFrame:
    return mapped(planes, lambda px: F.transform(px, lambda v: converted(v, source, target, scale)))


def for_depth(planes: DataFrame, source: str, bits: int, scale: bool = True) -> DataFrame:
    """Pixels for an output of 8, 16 or 32 bits."""
    if bits not in DEPTHS:
        raise ValueError(f"bit depth {bits}: 8, 16 or 32 are possible")
    return convert(planes, source, DEPTHS[bits], scale)


def subtract(planes: DataFrame, constant: float, clamped: bool = False) -> DataFrame:
    """v - constant; clamped: within 0 to 1."""
    return mapped(planes, lambda px: F.transform(px, lambda v: clamp(v - F.lit(constant), 0, 1) if clamped else v - F.lit(constant)))


def lift(slices: DataFrame) -> DataFrame:
    """2-D slices as one-page volumes."""
    return slices.withColumn("z", F.lit(0).cast("int"))


def crop_margins(text: str) -> tuple[int, ...]:
    """'t,b,l,r,f,b' as six integers; a short list ends in zeros, further values do not count."""
    given = [int(x) for x in text.split(",")][:6] if text.strip() else []
    return tuple(given + [0] * (6 - len(given)))


def crop(planes: DataFrame, grid: Grid, top: int = 0, bottom: int = 0, left: int = 0, right: int = 0, front: int = 0, back: int = 0) -> DataFrame:
    """The box without the margins, from index 0. The page filter reaches the scan. Margins that
    leave nothing are an error."""
    h, w, d = grid.ny - top - bottom, grid.nx - left - right, grid.nz - front - back
    if min(h, w, d) <= 0 or min(top, bottom, left, right, front, back) < 0:
        raise ValueError(f"crop margins {(top, bottom, left, right, front, back)} leave nothing of {grid.nx} x {grid.ny} x {grid.nz}")
    kept = planes.filter((F.col("z") >= front) & (F.col("z") < grid.nz - back))
    rows = lambda px: F.flatten(F.transform(F.sequence(F.lit(top), F.lit(top + h - 1)), lambda y: F.slice(px, y * grid.nx + left + 1, F.lit(w))))
    return mapped(kept, rows, F.lit(h), F.lit(w)).withColumn("z", F.col("z") - front)


def crop_between(planes: DataFrame, grid: Grid, y: tuple[int, int] = (0, 0), x: tuple[int, int] = (0, 0), z: tuple[int, int] = (0, 0)) -> tuple[DataFrame, Grid]:
    """Rows, columns and pages from the first to the last number of each pair, both counted from 1; a
    pair whose second number is not above its first cuts nothing."""
    margins = [(lo - 1, n - hi) if hi > lo else (0, 0) for (lo, hi), n in ((y, grid.ny), (x, grid.nx), (z, grid.nz))]
    (top, bottom), (left, right), (front, back) = margins
    out = Grid(grid.nx - left - right, grid.ny - top - bottom, grid.nz - front - back, grid.sx, grid.sy, grid.sz)
    return crop(planes, grid, top, bottom, left, right, front, back), out


def average_slice(planes: DataFrame) -> DataFrame:
    """(y, x, v): the mean of each pixel over all pages of all images. Each batch gives one array of
    sums; these are added up before they move, then one row a pixel. A place that only larger pages
    have is the mean of those."""
    ship(planes.sparkSession)

    def run(batches):
        for batch in batches:
            sums: dict[tuple[int, int], list] = {}
            for _, page in pages_of(batch):
                own = sums.setdefault(page.shape, [0, np.zeros(page.shape)])
                own[0] += 1
                own[1] += page
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()))
            rows = [(w, n, total.ravel()) for (_, w), (n, total) in sums.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["width", "n", "total"])

    at = planes.select("height", "width", "px").mapInArrow(run, "width int, n long, total array<double>").select("width", "n", F.posexplode("total").alias("i", "total"))
    place = at.select(F.expr("cast(i div width as int)").alias("y"), (F.col("i") % F.col("width")).cast("int").alias("x"), "n", "total")
    return place.groupBy("y", "x").agg((F.sum("total") / F.sum("n")).alias("v"))


def normalised_flat(flat: DataFrame, dark: DataFrame) -> DataFrame:
    """(y, x, n): (flat - dark) over its mean. Both are slices (y, x, v) of one camera's size."""
    diff = flat.join(dark.select("y", "x", F.col("v").alias("d")), ["y", "x"]).select("y", "x", (F.col("v") - F.col("d")).alias("v"))
    mean = diff.agg(F.avg("v").alias("m"))
    return diff.join(F.broadcast(mean)).select("y", "x", (F.col("v") / F.col("m")).alias("n"))


def flatfield(planes: DataFrame, dark: DataFrame, norm: DataFrame, on_zero: float = 0.0) -> DataFrame:
    """max(v - dark, 0) / norm for each pixel; a zero norm gives on_zero. dark (y, x, v) and norm
    (y, x, n) are one camera frame each, so they go to the executors as one row of two arrays."""
    both = dark.join(norm, ["y", "x"]).agg(F.sort_array(F.collect_list(F.struct("y", "x", F.col("v").alias("d"), "n"))).alias("c"))
    calibration = both.select(F.transform("c", lambda s: s["d"]).alias("d"), F.transform("c", lambda s: s["n"]).alias("n"))
    at = planes.join(F.broadcast(calibration))
    less = F.zip_with("px", "d", lambda v, d: F.greatest(v - d, F.lit(0.0)))
    out = F.zip_with(less, F.col("n"), lambda v, n: F.when(n == 0, F.lit(on_zero)).otherwise(v / n))
    return at.select("image_id", "z", "height", "width", out.alias("px"))


def extrema(planes: DataFrame) -> DataFrame:
    """(image_id, lo, hi): least and greatest pixel; each page first gives its own."""
    return planes.groupBy("image_id").agg(F.min(F.array_min("px")).alias("lo"), F.max(F.array_max("px")).alias("hi"))
