"""Closed forms, invariants and round trips."""

from __future__ import annotations

import bz2
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratavox.operators import decon, geometry, pixels
from stratavox.plans import fixtures, runner
from stratavox.plans.config import ConfigError, parse_config
from stratavox.sources import tiff
from stratavox.types import PLANE, Grid, voxels

RNG = np.random.default_rng(3)


def planes(spark, a, image=0):
    a = np.asarray(a, float)
    return spark.createDataFrame([(image, z, a.shape[1], a.shape[2], [float(v) for v in p.ravel()]) for z, p in enumerate(a)], PLANE)


def array(df):
    rows = df.orderBy("z").collect()
    return np.array([np.array(r["px"]).reshape(r["height"], r["width"]) for r in rows])


def test_every_uint16_survives_the_round_trip(spark):
    df = planes(spark, np.arange(65536).reshape(1, 256, 256))
    back = pixels.convert(pixels.convert(df, "uint16", "float64"), "float64", "uint16")
    assert (array(back)[0].ravel() == np.arange(65536)).all()


def test_deskew_against_numpy_and_keeps_sums(spark):
    a = RNG.random((5, 3, 7))
    a[:, :, [0, -1]] = 0
    for angle in (31.8, 147.55):
        df, grid = geometry.deskew(planes(spark, a), Grid(7, 3, 5), angle, 0.4, 0.3)
        out = array(df)
        shift, _ = geometry.deskew_geometry(Grid(7, 3, 5), angle, 0.4, 0.3)
        assert out.shape == (5, 3, grid.nx)
        for z in range(5):
            x = np.arange(grid.nx) - shift * z - (grid.nx - 7 if shift < 0 else 0)
            for y in range(3):
                assert np.allclose(out[z, y], np.interp(x, np.arange(7), a[z, y], left=0, right=0))
        assert np.allclose(out.sum(2), a.sum(2))


def test_crops_compose_and_reach_the_scan(spark):
    df = planes(spark, RNG.random((6, 5, 4)))
    once = pixels.crop(df, Grid(4, 5, 6), 2, 1, 1, 1, 2, 1)
    twice = pixels.crop(pixels.crop(df, Grid(4, 5, 6), 1, 0, 1, 0, 1, 1), Grid(3, 4, 4), 1, 1, 0, 1, 1, 0)
    assert np.array_equal(array(once), array(twice))


def test_projections_do_not_exceed_the_maximum(spark):
    a = RNG.random((4, 3, 5))
    df = geometry.mips(planes(spark, a))
    for axis, k in (("x", 2), ("y", 1), ("z", 0)):
        got = {(r["a"], r["b"]): r["v"] for r in df.filter(F.col("axis") == axis).collect()}
        want = a.max(axis=k)
        assert got == {(i, j): want[i, j] for i in range(want.shape[0]) for j in range(want.shape[1])}


def test_delta_kernel_is_identity_and_bricks_agree():
    a = RNG.random((6, 5, 5)) + 0.1
    delta = np.zeros((3, 3, 3))
    delta[1, 1, 1] = 2.0
    assert np.allclose(decon.richardson_lucy(a, delta, 3), a)
    assert np.allclose(decon.projected_landweber(a, delta, 3, 0.5), a)


def test_bricks_equal_the_whole(spark):
    a = RNG.random((24, 5, 5)) + 0.1
    df = planes(spark, a)
    whole = array(decon.deconvolve(df, fixtures.kernel(), 2))
    for pages in (3, 7, 8, 24):
        parts = array(decon.deconvolve_bricks(df, Grid(5, 5, 24), fixtures.kernel(), 2, pages))
        assert parts.shape == whole.shape and np.allclose(whole, parts)


@pytest.mark.parametrize("kind", ["uint8", "uint16", "float32", "int16"])
@pytest.mark.parametrize("big", [False, True])
def test_tiff_round_trip(kind, big):
    a = (RNG.random((3, 4, 5)) * 100).astype(kind)
    data = tiff.encode(a, (0.1, 0.1, 0.4), big)
    pages = tiff.decode(bz2.compress(data))
    assert np.array_equal(np.stack([p["px"] for p in pages]), a)
    assert {p["dtype"] for p in pages} == {kind}
    assert pages[0]["resolution"] == pytest.approx(1 / 0.1)


def test_tiff_files(spark, tmp_path):
    df = planes(spark, RNG.integers(0, 60000, (2, 3, 4)))
    tiff.write_stacks(df, f"file://{tmp_path}")
    with pytest.raises(FileExistsError):
        tiff.write_stacks(df, f"file://{tmp_path}")
    rows = tiff.read_stacks(spark, f"file://{tmp_path}").orderBy("page").collect()
    assert [list(r["px"]) for r in rows] == [list(r["px"]) for r in df.orderBy("z").collect()]
    (tmp_path / "bad.tif").write_bytes(b"no")
    with pytest.raises(Exception, match="bad.tif"):
        tiff.read_stacks(spark, f"file://{tmp_path}").collect()


def test_empty_volumes(spark):
    df = spark.createDataFrame([], PLANE)
    assert geometry.mips(df).count() == 0
    assert geometry.deskew(df, Grid(4, 4, 4), 31.8, 0.4, 0.1)[0].count() == 0
    assert voxels(df).count() == 0
    assert decon.psf_peak(df).count() == 0


@pytest.mark.parametrize(
    ("given", "why"),
    [
        ({"paths": {}}, "root"),
        ({"paths": {"root": "/"}, "deskew": {"angle": 31}}, "angle"),
        ({"paths": {"root": "/"}, "deskew": {"bit-depth": 12}}, "bit-depth"),
        ({"paths": {"root": "/"}, "decon": {}}, "decon.n"),
        ({"paths": {"root": "/"}, "decon": {"n": 3}}, "psf"),
        ({"paths": {"root": "/"}, "flatfield": {}}, "flatfield"),
        ({"paths": {"root": "/"}, "decon-first": {"decon": {"n": 1}}}, "decon-first"),
    ],
)
def test_config_errors(given, why):
    with pytest.raises(ConfigError, match=why):
        parse_config(json.dumps(given))


def test_config_defaults_and_warnings():
    plan = parse_config(json.dumps({"paths": {"root": "/r"}, "deskew": {"typo": 1}, "mip": {"x": True, "z": True}}), "adaptive")
    assert plan.deskew == {"angle": 147.55, "xy-res": 0.108, "fill": 0.0, "bit-depth": 16}
    assert plan.mip == "xz" and plan.overwrite and not plan.bdv_save
    assert plan.warnings == ["deskew.typo is not known and does not count"]
    assert plan.explain() == "raw -> deskew\ndeskew -> mip:xz"


def test_runner_refuses_what_it_cannot_do(spark):
    plan = parse_config(json.dumps({"paths": {"root": "/", "psf": {"laser": {"488": "p.tif"}}}, "decon": {"n": 1}}))
    with pytest.raises(ConfigError, match="point-spread"):
        runner.run(plan, runner.Inputs(planes(spark, RNG.random((2, 2, 2))), Grid(2, 2, 2), 0.4))
    with pytest.raises(ValueError, match="leave nothing"):
        pixels.crop(planes(spark, RNG.random((2, 2, 2))), Grid(2, 2, 2), 1, 1)


def skewed(k, angle, step, res):
    """The kernel sheared at 180 - angle, pixel by pixel."""
    shift = step * np.cos(np.radians(180 - angle)) / res
    nz, ny, nx = k.shape
    width = int(np.ceil(nx + abs(shift) * (nz - 1)))
    out = np.zeros((nz, ny, width))
    for z in range(nz):
        for i in range(width):
            x = i - z * shift - (width - nx if shift < 0 else 0)
            if -0.5 <= x < nx - 0.5:
                f = int(np.floor(x))
                out[z, :, i] = k[z, :, max(f, 0)] * (1 - (x - f)) + k[z, :, min(f + 1, nx - 1)] * (x - f)
    return out


def test_decon_first_query_uses_the_skewed_kernel(spark):
    from stratavox.plans.queries import ANGLE, QUERIES, RES, STEP

    data = "/root/testdata/sf0.001"
    got = {(r["a"], r["b"]): r["v"] for r in QUERIES["pipeline_decon_first"](spark, data).filter("image_id = 0").collect()}
    a = array(fixtures.planes(spark, data).filter("image_id = 0")) / 65535
    sharp = decon.richardson_lucy(a, skewed(fixtures.kernel(), ANGLE, STEP, RES), 2)
    counts = np.trunc(np.clip(sharp, 0, 1) * 65535)
    moved, grid = geometry.deskew(planes(spark, counts / 65535), Grid(8, 8, 25), ANGLE, STEP, RES)
    even, _ = geometry.isotropic(planes(spark, np.trunc(np.clip(array(moved), 0, 1) * 65535) / 65535), grid)
    top = np.trunc(np.clip(array(even), 0, 1) * 65535).max(axis=0)
    assert set(got) == {(y, x) for y in range(top.shape[0]) for x in range(top.shape[1])}
    assert max(abs(got[y, x] - top[y, x]) for y, x in got) <= 2  # truncated three times on the way


def test_a_kernel_of_another_spacing_is_resampled(spark):
    a, k = RNG.random((9, 6, 12)), RNG.random((5, 3, 3))
    angle, step, res = 31.8, 0.4, 0.104
    sz = step * np.sin(np.radians(angle))

    def pages(wanted):
        out = []
        for n in range(int(5 * 0.1 / wanted)):
            p = n * wanted / 0.1
            f = int(np.floor(p))
            out.append(k[f] * (1 - (p - f)) + k[min(f + 1, 4)] * (p - f))
        return np.array(out)

    first = parse_config(json.dumps({"paths": {"root": "/r", "psf": {"laser": {"488": "p.tif"}}}, "decon-first": {"decon": {"n": 2, "bit-depth": 32}, "deskew": {}}}))
    after = parse_config(json.dumps({"paths": {"root": "/r", "psf": {"laser": {"488": "p.tif"}}}, "decon": {"n": 2, "bit-depth": 32}}))
    df, grid = planes(spark, a), Grid(12, 6, 9, res, res, 0.15)
    given = runner.Inputs(df, grid, step, psf=k, psf_spacing=0.1, dtype="float64")
    for plan, stage, kernel in ((first, "decon_first.decon", skewed(pages(sz), angle, step, res)), (after, "decon", pages(0.15))):
        assert np.allclose(array(runner.run(plan, given)[stage]), np.clip(decon.richardson_lucy(a, kernel, 2), 0, 1), atol=1e-5)
