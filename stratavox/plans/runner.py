"""Runs a plan's stages over planes, lazily: nothing is computed that no output needs."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from stratavox.operators import decon, geometry, pixels
from stratavox.plans.config import ConfigError, Plan
from stratavox.types import Grid


@dataclass
class Inputs:
    """Raw counts of one laser and camera, and what its stages need."""

    planes: DataFrame
    grid: Grid
    step: float
    dark: DataFrame | None = None
    norm: DataFrame | None = None
    psf: np.ndarray | None = None
    #: Distance of the kernel's pages; None: that of the image's.
    psf_spacing: float | None = None
    dtype: str = "uint16"


def run(plan: Plan, given: Inputs) -> dict[str, DataFrame]:
    """stage -> planes in 16-bit counts (projections: image_id, axis, a, b, v)."""
    out: dict[str, tuple[DataFrame, Grid]] = {"raw": (given.planes, given.grid)}
    done: dict[str, DataFrame] = {}
    unit = lambda p: pixels.convert(p, given.dtype, "float64")
    counts = lambda p, bits: pixels.for_depth(p, "float64", bits)
    for stage, source in plan.stages():
        planes, grid = out[source]
        if stage == "flatfield":
            if given.dark is None or given.norm is None:
                raise ConfigError("flatfield needs a dark frame and a normalised flat frame")
            result = pixels.convert(pixels.flatfield(planes, given.dark, given.norm), "float64", given.dtype, scale=False), grid
        elif stage == "crop":
            c = plan.crop or {}
            m = [c[f"crop{k}"] for k in ("Top", "Bottom", "Left", "Right", "Front", "Back")]
            result = pixels.crop(planes, grid, *m), Grid(grid.nx - m[2] - m[3], grid.ny - m[0] - m[1], grid.nz - m[4] - m[5], grid.sx, grid.sy, grid.sz)
        elif stage.endswith("deskew"):
            s = (plan.decon_first or {})["deskew"] if stage.startswith("decon_first") else plan.deskew or {}
            moved, new = geometry.deskew(unit(planes), grid, s["angle"], given.step, s["xy-res"], s["fill"])
            result = counts(moved, s["bit-depth"]), new
        elif stage.endswith("decon"):
            s = (plan.decon_first or {})["decon"] if stage.startswith("decon_first") else plan.decon or {}
            if given.psf is None:
                raise ConfigError("decon needs a point-spread function")
            skew = (plan.decon_first or {})["deskew"] if stage.startswith("decon_first") else None
            spacing = z_spacing(given.step, skew["angle"]) if skew else grid.sz
            kernel = given.psf if given.psf_spacing is None else decon.kernel_resampled(given.psf, given.psf_spacing, spacing)
            if skew:  # the kernel as the raw data are
                kernel = decon.kernel_skewed(kernel, skew["angle"], given.step, skew["xy-res"], skew["fill"])
            sharp = decon.deconvolve(unit(planes), kernel, s["n"], s["subtract"], grid.nz)
            result = counts(sharp, s["bit-depth"]), grid
        else:
            even, _ = geometry.isotropic(unit(planes), grid)
            done[f"{stage}@{source}"] = geometry.mips(counts(even, 16), stage.partition(":")[2])
            continue
        out[stage] = result
        done[stage] = result[0]
    return done


def memory_gb(voxels: int) -> float:
    """Estimate for the deconvolution of a volume of so many output voxels."""
    return 7.5e-8 * voxels - 1.39119


def z_spacing(step: float, angle: float) -> float:
    return abs(step * math.sin(math.radians(angle)))
