"""Iterative deconvolution and point-spread functions."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.types import Grid, voxels

from .geometry import deskew, deskew_geometry, held_volumes, paged

#: A smaller denominator gives ratio 0.
LEAST = 1e-5


def padded_kernel(kernel: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """The normalised kernel on a circular grid of that shape, its centre at 0; its transform."""
    k = np.zeros(shape)
    k[tuple(slice(0, n) for n in kernel.shape)] = kernel / kernel.sum()
    return np.fft.rfftn(np.roll(k, [-(n // 2) for n in kernel.shape], (0, 1, 2)))


def richardson_lucy(a: np.ndarray, kernel: np.ndarray, iterations: int, padded: bool = False) -> np.ndarray:
    """estimate *= mirrored kernel * (image / (kernel * estimate)), from the image, on the image
    padded by the kernel's reach with its edge pixels (padded: it is along z); convolutions are circular there."""
    pad = [(0, 0) if padded and k == 0 else (n // 2, n // 2) for k, n in enumerate(kernel.shape)]
    image = np.pad(a, pad, mode="edge")
    k = padded_kernel(kernel, image.shape)
    turn = lambda x, t: np.fft.irfftn(np.fft.rfftn(x) * t, image.shape, axes=(0, 1, 2))
    estimate = image.copy()
    for _ in range(iterations):
        below = turn(estimate, k)
        ratio = np.divide(image, below, out=np.zeros_like(image), where=np.abs(below) >= LEAST)
        estimate *= turn(ratio, k.conj())
    return estimate[tuple(slice(lo, n - hi) for (lo, hi), n in zip(pad, image.shape, strict=True))]


def projected_landweber(a: np.ndarray, kernel: np.ndarray, iterations: int, alpha: float, held: np.ndarray | None = None) -> np.ndarray:
    """estimate = max(estimate + alpha * mirrored kernel * (image - kernel * estimate), 0). Pages that are
    not held have no difference to the image and stay 0."""
    pad = [(n // 2, n // 2) for n in kernel.shape]
    image = np.pad(a, pad, mode="edge")
    there = np.pad(np.ones(len(a), dtype=bool) if held is None else held, pad[0], mode="edge")[:, None, None]
    k = padded_kernel(kernel, image.shape)
    turn = lambda x, t: np.fft.irfftn(np.fft.rfftn(x) * t, image.shape, axes=(0, 1, 2))
    estimate = image.copy()
    for _ in range(iterations):
        estimate = np.maximum(estimate + alpha * turn((image - turn(estimate, k)) * there, k.conj()), 0) * there
    return estimate[tuple(slice(lo, n - hi) for (lo, hi), n in zip(pad, image.shape, strict=True))]


def deconvolve(planes: DataFrame, kernel: np.ndarray, iterations: int, subtract: float = 0.0, nz: int | None = None) -> DataFrame:
    """Richardson-Lucy for each volume of planes scaled to 0..1; first `subtract` counts of 16 bits
    go, clamped to 0..1. The kernel is one small array and travels with the function. With nz, a volume
    has nz pages: those it lacks count as 0 and are not returned."""
    c = subtract / 65535
    return held_volumes(planes, lambda a, held: (richardson_lucy(np.clip(a - c, 0, 1) if c else a, kernel, iterations), held), nz)


def landweber(planes: DataFrame, kernel: np.ndarray, iterations: int, alpha: float, nz: int | None = None) -> DataFrame:
    """Projected Landweber for each volume. With nz, a volume has nz pages: those it lacks count for
    nothing and are not returned."""
    return held_volumes(planes, lambda a, held: (projected_landweber(a, kernel, iterations, alpha, held), held), nz)


def convolve(planes: DataFrame, kernel: np.ndarray, nz: int | None = None) -> DataFrame:
    """One convolution on the padded grid. With nz, a volume has nz pages: those it lacks count as 0, and
    are returned where the kernel reaches them from others."""

    def f(a: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pad = [(n // 2, n // 2) for n in kernel.shape]
        image, there = np.pad(a, pad, mode="edge"), np.pad(held, pad[0], mode="edge")
        out = np.fft.irfftn(np.fft.rfftn(image) * padded_kernel(kernel, image.shape), image.shape, axes=(0, 1, 2))
        r = pad[0][0]
        near = np.any([np.roll(there, k - r) for k in range(kernel.shape[0])], axis=0)
        return out[tuple(slice(lo, n - hi) for (lo, hi), n in zip(pad, image.shape, strict=True))], near[r : len(near) - r]

    return held_volumes(planes, f, nz)


def deconvolve_bricks(planes: DataFrame, grid: Grid, kernel: np.ndarray, iterations: int, pages: int, subtract: float = 0.0) -> DataFrame:
    """deconvolve() in bricks of `pages` pages for volumes that do not fit a worker, with the same
    result. A brick comes with the pages that its result depends on, 2 * iterations kernel reaches on
    either side, of the circle that the padded volume's pages form. Pages that a volume lacks count as 0
    and are not returned."""
    reach = kernel.shape[0] // 2
    halo, around = 2 * iterations * reach, grid.nz + 2 * reach
    if pages + 2 * halo >= around:
        return deconvolve(planes, kernel, iterations, subtract, grid.nz)
    bricks, c = -(-grid.nz // pages), subtract / 65535
    z = F.col("z")
    place = F.sequence(F.when(z == 0, F.lit(0)).otherwise(z + reach), F.when(z == grid.nz - 1, F.lit(around - 1)).otherwise(z + reach))
    every = F.sequence(F.lit(0), F.lit(bricks - 1))
    nth = lambda p, b: F.pmod(p - (b * pages + reach - halo), F.lit(around))
    spots = F.flatten(F.transform(place, lambda p: F.transform(F.filter(every, lambda b: nth(p, b) < F.least(F.lit(pages), grid.nz - b * pages) + 2 * halo), lambda b: F.struct(b.alias("brick"), nth(p, b).alias("z")))))
    at = planes.select("image_id", "height", "width", "px", F.explode(spots).alias("s"))
    cut = at.select((F.col("image_id") * bricks + F.col("s.brick")).alias("image_id"), F.col("s.z").cast("int").alias("z"), "height", "width", "px")
    done = held_volumes(cut, lambda a, held: (richardson_lucy(np.clip(a - c, 0, 1) if c else a, kernel, iterations, padded=True), held), pages + 2 * halo)
    brick = F.pmod(F.col("image_id"), F.lit(bricks))
    inside = (z >= halo) & (z < halo + F.least(F.lit(pages), grid.nz - brick * pages))
    return done.filter(inside).select(F.floor(F.col("image_id") / bricks).alias("image_id"), (z - halo + brick * pages).cast("int").alias("z"), "height", "width", "px")


def psf_peak(planes: DataFrame) -> DataFrame:
    """(image_id, z, y, x, v): the brightest voxel; of equals the first by z, x, y."""
    best = F.max_by(F.struct("z", "y", "x", "v"), F.struct("v", (-F.col("z")).alias("a"), (-F.col("x")).alias("b"), (-F.col("y")).alias("c")))
    return voxels(planes).groupBy("image_id").agg(best.alias("p")).select("image_id", "p.*")


def psf_background(planes: DataFrame, nz: int) -> DataFrame:
    """(image_id, background): mean of the last page; other pages are not read."""
    return voxels(planes.filter(F.col("z") == nz - 1)).groupBy("image_id").agg(F.avg("v").alias("background"))


def psf_normalised(planes: DataFrame) -> DataFrame:
    """Voxels over their image's sum."""
    total = voxels(planes).groupBy("image_id").agg(F.sum("v").alias("t"))
    return voxels(planes).join(total, "image_id").select("image_id", "z", "y", "x", (F.col("v") / F.col("t")).alias("v"))


def psf_centred(planes: DataFrame, nz: int) -> DataFrame:
    """Pages rolled so that the peak's page comes to nz // 2."""
    peak = psf_peak(planes).select("image_id", F.col("z").alias("peak"))
    return planes.join(peak, "image_id").select("image_id", F.pmod(F.col("z") + nz // 2 - F.col("peak"), F.lit(nz)).cast("int").alias("z"), "height", "width", "px")


def psf_cropped(planes: DataFrame, grid: Grid, reach: int) -> DataFrame:
    """Voxels within `reach` of the peak in x and y, from index 0; images whose peak is nearer to the
    border are left out (psf_near_border names them)."""
    peak = psf_peak(planes).select("image_id", F.col("y").alias("py"), F.col("x").alias("px_"))
    inside = peak.filter((F.col("py") >= reach) & (F.col("py") < grid.ny - reach) & (F.col("px_") >= reach) & (F.col("px_") < grid.nx - reach))
    at = voxels(planes).join(inside, "image_id").filter((F.abs(F.col("y") - F.col("py")) <= reach) & (F.abs(F.col("x") - F.col("px_")) <= reach))
    return at.select("image_id", "z", (F.col("y") - F.col("py") + reach).alias("y"), (F.col("x") - F.col("px_") + reach).alias("x"), "v")


def psf_near_border(planes: DataFrame, grid: Grid, reach: int) -> DataFrame:
    peak = psf_peak(planes)
    return peak.filter((F.col("y") < reach) | (F.col("y") >= grid.ny - reach) | (F.col("x") < reach) | (F.col("x") >= grid.nx - reach)).select("image_id")


def psf_skewed(planes: DataFrame, grid: Grid, angle: float, step: float, xy_res: float) -> tuple[DataFrame, Grid]:
    """The function sheared as the raw data are, for deconvolution before the deskew."""
    return deskew(planes, grid, 180 - angle, step, xy_res)


def kernel_resampled(kernel: np.ndarray, spacing: float, wanted: float) -> np.ndarray:
    """Pages of a small kernel at a distance of `wanted` instead of `spacing`, as geometry.resample_spacing does."""
    if spacing == wanted:
        return kernel
    n = int(len(kernel) * spacing / wanted)
    if n < 1:
        raise ValueError("the kernel is thinner than one page of the image")
    at = np.arange(n) * (wanted / spacing)
    lo = np.floor(at).astype(int)
    w = (at - lo)[:, None, None]
    mixed = kernel[np.minimum(lo, len(kernel) - 1)] * (1 - w) + kernel[np.minimum(lo + 1, len(kernel) - 1)] * w
    return np.where(((at <= len(kernel) - 1) & (lo < len(kernel)))[:, None, None], mixed, 0.0)


def kernel_skewed(kernel: np.ndarray, angle: float, step: float, xy_res: float, fill: float = 0.0) -> np.ndarray:
    """psf_skewed() of a small kernel. fill is in 16-bit counts, as a part of 65535."""
    nz, ny, nx = kernel.shape
    shift, out = deskew_geometry(Grid(nx, ny, nz), 180 - angle, step, xy_res)
    offset = np.arange(nz)[:, None] * shift + (out.nx - nx if shift < 0 else 0)
    x = np.arange(out.nx)[None, :] - offset
    f = np.floor(x)
    pixel = lambda k: np.take_along_axis(kernel, np.broadcast_to(np.clip(k, 0, nx - 1).astype(int)[:, None, :], (nz, ny, out.nx)), 2)
    w = (x - f)[:, None, :]
    return np.where(((x >= -0.5) & (x < nx - 0.5))[:, None, :], pixel(f) * (1 - w) + pixel(f + 1) * w, fill / 65535)


def psf_resampled(planes: DataFrame, ratio: float, nz: int | None = None) -> DataFrame:
    """Fewer pages by cutting the spectrum along z: ratio = new page distance / old one (>= 1). With nz, a
    volume has nz pages: those it lacks count as 0, and all pages of the result are returned."""

    def f(a: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, None]:
        n = int(round(len(a) / ratio))
        spectrum = np.fft.fft(a, axis=0)
        half = n // 2
        kept = np.concatenate([spectrum[: n - half], spectrum[len(a) - half :]])
        return np.maximum(np.fft.ifft(kept, axis=0).real * n / len(a), 0), None

    return held_volumes(planes, f, nz)


def psf_scale(psf_step: float, stage_step: float, angle: float) -> float:
    return psf_step / (stage_step * math.sin(math.radians(angle)))


def tapered(planes: DataFrame, grid: Grid, sigma: float = 2.0) -> DataFrame:
    """Each page pulled to its mean towards the border, with Gaussian weights of the distance to it."""
    y, x = (np.minimum(np.arange(n), n - 1 - np.arange(n)) + 0.5 for n in (grid.ny, grid.nx))
    w = 1 - np.exp(-(np.minimum(y[:, None], x[None, :]) ** 2) / (2 * sigma * sigma))
    return paged(planes, lambda page, _: page * w + page.mean() * (1 - w))
