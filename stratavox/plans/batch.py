"""A whole run over a folder of acquisitions: find them, plan, compute, write, and log what was done."""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.functions import calibration, names, settings
from stratavox.operators import decon
from stratavox.plans import runner
from stratavox.plans.config import ConfigError, Plan, parse_config
from stratavox.sources import tiff
from stratavox.streaming import incremental
from stratavox.types import Grid, planes_of

#: The stage device whose step counts, by what moves.
STEP_DEVICES = {"Sample piezo": ("s-piezo", "x-stage-offset"), "Z galvo & piezo": ("z-pzt", "xz-stage-offset")}
#: Kernel and calibration files of this many bytes at most are read whole by the driver.
SMALL_FILE = 64 << 20
LOG = "dir string, time timestamp, stages string, n_files long, settings string"


def processed(spark: SparkSession, root: str) -> DataFrame:
    """The log of earlier runs below root, empty before the first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/processed.json")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LOG).json(f"{root}/processed.json") if there else spark.createDataFrame([], LOG)


def todo(spark: SparkSession, root: str, plan: Plan) -> DataFrame:
    """(dir): acquisitions that are neither processed nor hold calibration files, nor lie below such."""
    apart = sorted({p.rpartition("/")[0] for p in (*plan.psf.values(), *plan.calibration.values())} - {root, plan.root})
    dirs = incremental.unprocessed(tiff.acquisitions(spark, root), processed(spark, root))
    return reduce(lambda d, p: d.filter(~F.col("dir").endswith(p) & ~F.col("dir").contains(f"{p}/")), apart, dirs)


def small_stack(spark: SparkSession, path: str) -> np.ndarray:
    """The pages of one calibration file, whose size is checked first."""
    files = spark.read.format("binaryFile").load(path)
    sizes = [r["length"] for r in files.select("length").collect()]
    if len(sizes) != 1 or sizes[0] > SMALL_FILE:
        raise ConfigError(f"{path}: one file of at most {SMALL_FILE} bytes is expected")
    return np.stack([p["px"].astype(float) for p in tiff.decode(bytes(files.select("content").first()["content"]))])


def slice_of(spark: SparkSession, path: str, value: str = "v") -> DataFrame:
    """(y, x, value) of the first page of a calibration file, unscaled."""
    at = tiff.read_stacks(spark, path).filter("page = 0").select("width", F.posexplode("px").alias("i", value))
    return at.select(F.expr("cast(i div width as int)").alias("y"), (F.col("i") % F.col("width")).cast("int").alias("x"), value)


def kernel_step(spark: SparkSession, path: str, instrument: str) -> float:
    """Page distance of a kernel file by the settings file beside it; sheared kernels are refused."""
    if "skewed" in path.lower():
        raise ConfigError(f"{path}: a kernel that was sheared cannot be used")
    own = path.rpartition(".")[0] + "_Settings.txt"
    docs = settings.documents(spark.read.format("binaryFile").load(own))
    moved = settings.general(docs).first()["z_motion"]
    if moved != "Z galvo & piezo":
        raise ConfigError(f"{own}: the kernel was scanned by {moved!r}")
    found = settings.devices(docs, instrument).filter(F.col("device").isin(*STEP_DEVICES[moved])).orderBy("ch").first()
    if found is None or found["interval"] is None:
        raise ConfigError(f"{own}: no page distance")
    return found["interval"]


def raw_files(spark: SparkSession, dirs: DataFrame) -> DataFrame:
    """Raw stacks that lie in the directories themselves, with the fields of their names. Contents are
    not read: the columns of the listing alone."""
    rows = [r["dir"] for r in dirs.collect()]  # acquisitions, not files
    if not rows:
        return names.parse(spark.createDataFrame([], "path string, dir string, name string"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load([r for r in rows])
    files = files.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"), F.element_at(F.split("path", "/"), -1).alias("name"))
    return names.parse(files).filter("channel is not null")


def planned(spark: SparkSession, root: str, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """(files, last settings) of all that is to do: path, dir, name, laser, step, motion, out (the name
    its outputs are tagged from), and of a stack its pages, height, width and dtype."""
    dirs = todo(spark, root, plan).persist()
    docs = settings.read_settings(spark, root).join(dirs, "dir", "left_semi")
    last = docs.groupBy("dir").agg(F.max_by("text", "path").alias("text"))
    files = raw_files(spark, dirs)
    order = names.channel_lasers(names.channel_order(files), settings.lasers(last))
    general = settings.general(last).select("dir", "z_motion")
    device = F.coalesce(*[F.when(F.col("z_motion") == m, F.array(*map(F.lit, d))) for m, d in STEP_DEVICES.items()])
    steps = settings.devices(last, plan.instrument).join(general, "dir").filter(F.array_contains(device, F.col("device"))).select("dir", F.col("ch").alias("channel"), F.col("interval").alias("step"))
    known = files.join(order.select("dir", "channel", "camera", "laser"), ["dir", "channel", "camera"], "left").join(steps, ["dir", "channel"], "left").join(general, "dir", "left")
    if plan.bdv_save:
        known = names.bdv_name(names.with_tile(known, names.tile_indexes(files)), cameras=True).withColumn("out", F.col("bdv_name"))
    else:
        known = known.withColumn("out", F.col("name"))
    paths = known.select("path", "dir", "name", "laser", "step", "z_motion", "out")
    sizes = tiff.sizes(spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load([r["dir"] for r in dirs.collect()])) if dirs.head(1) else None
    return (paths.join(sizes, "path") if sizes is not None else paths.selectExpr("*", "0 as pages", "0 as height", "0 as width", "'' as dtype")), last


def output_folder(stage: str) -> tuple[str, str]:
    """The folder below an acquisition that a stage writes to, and its files' tag."""
    name, _, source = stage.partition("@")
    if name.startswith("mip"):
        return f"{output_folder(source)[0]}/mip", f"{output_folder(source)[1]}_mip" if source != "raw" else "_mip"
    tag = "_" + name.replace(".", "_")
    return name.replace(".", "_"), tag


def run(spark: SparkSession, config: str, instrument: str = "lattice", dry_run: bool = False, root: str | None = None) -> DataFrame:
    """Process every acquisition below the configuration's root (or `root`) that the log does not hold.

    Files of one acquisition, laser, step and page size share a plan and run as one DataFrame; a stack with
    fewer pages than the longest of them ended early and lacks its last pages. Outputs go
    to <dir>/<stage>/ (projections: <dir>/<stage>/mip/) under the file's tagged name; existing ones are
    an error, or left as they are where the configuration says not to overwrite. An acquisition comes
    into <root>/processed.json when all its outputs are written. Lasers without a kernel or a flat frame,
    and stacks without a step, are errors before anything is written. Returns the new rows of the log;
    with dry_run, (dir, laser, n_files, stages) of what would be done.
    """
    plan = parse_config(config, instrument)
    base = root or plan.root
    files, last = planned(spark, base, plan)
    files = files.persist()
    groups = files.groupBy("dir", "laser", "step", "height", "width", "dtype").agg(F.count("*").alias("n_files"), F.max("pages").alias("pages")).orderBy("dir", "laser").collect()
    missing = [g for g in groups if g["step"] is None] or [g for g in groups if (plan.decon or plan.decon_first) and str(g["laser"]) not in plan.psf] or [g for g in groups if plan.flatfield is not None and str(g["laser"]) not in plan.calibration]
    if missing:
        raise ConfigError(f"{missing[0]['dir']}: no step, kernel or flat frame for laser {missing[0]['laser']}")
    if dry_run:
        return spark.createDataFrame([(g["dir"], g["laser"], g["n_files"], plan.explain()) for g in groups], "dir string, laser int, n_files long, stages string")
    dark = slice_of(spark, plan.calibration["dark"]) if plan.flatfield is not None else None
    for g in groups:
        own = files.filter(F.col("dir") == g["dir"]).filter(F.col("laser").eqNullSafe(F.lit(g["laser"]))).filter((F.col("step") == g["step"]) & (F.col("height") == g["height"]) & (F.col("width") == g["width"]) & (F.col("dtype") == g["dtype"]))
        _process(spark, plan, g, own.select("path", "out", F.xxhash64("path").alias("image_id")), dark)
    now = files.groupBy("dir").agg(F.count("*").alias("n_files")).join(last, "dir").select("dir", F.current_timestamp().alias("time"), F.lit(plan.explain()).alias("stages"), "n_files", F.col("text").alias("settings"))
    done = spark.createDataFrame(now.collect(), LOG)  # a row for each acquisition
    done.write.mode("append").json(f"{base}/processed.json")
    return done


def _process(spark: SparkSession, plan: Plan, group, files: DataFrame, dark: DataFrame | None) -> None:
    laser = str(group["laser"])
    section = plan.deskew or (plan.decon_first or {}).get("deskew") or plan.crop or plan.flatfield or plan.decon or {}
    res = section.get("xy-res", 1.0)
    grid = Grid(group["width"], group["height"], group["pages"], res, res, group["step"])
    read = tiff.read_stacks(spark, group["dir"], "*.tif", below=False)
    planes = read.join(files.select("path", "image_id"), "path").select("image_id", F.col("page").alias("z"), "height", "width", "px")
    psf = small_stack(spark, plan.psf[laser]) if laser in plan.psf else None
    given = runner.Inputs(
        planes, grid, group["step"], dark,
        slice_of(spark, plan.calibration[laser], "n") if plan.flatfield is not None else None,
        psf, kernel_step(spark, plan.psf[laser], plan.instrument) if psf is not None else None, group["dtype"],
    )
    for stage, found in runner.run(plan, given).items():
        folder, tag = output_folder(stage)
        out = f"{group['dir']}/{folder}"
        if stage.startswith("mip"):
            for axis in stage.partition("@")[0].partition(":")[2]:
                one = found.filter(F.col("axis") == axis)
                size = one.agg(F.max("a"), F.max("b")).first()
                flat = planes_of(one.select("image_id", F.lit(0).alias("z"), F.col("a").alias("y"), F.col("b").alias("x"), "v"), size[0] + 1, size[1] + 1)
                _write(plan, flat, files, out, f"{tag}_{axis}", "uint16", res, group["step"])
        else:
            bits = (plan.decon_first or {}).get(stage.rpartition(".")[2], {}).get("bit-depth") if stage.startswith("decon_first") else (getattr(plan, stage) or {}).get("bit-depth")
            kind = {8: "uint8", 32: "float32"}.get(bits, "uint16") if stage not in ("flatfield", "crop") else group["dtype"]
            _write(plan, found, files, out, tag, kind, res, group["step"])


def _write(plan: Plan, planes: DataFrame, files: DataFrame, folder: str, tag: str, dtype: str, res: float, step: float) -> None:
    wanted = files.select("image_id", names.tagged(F.col("out"), tag).alias("file"))
    tiff.write_stacks(planes, folder, names=wanted, overwrite=plan.overwrite, skip=not plan.overwrite, dtype=dtype, spacing=(res, res, step))


def explain(config: str, instrument: str = "lattice") -> str:
    """The stages of a configuration and their parameters, as a command for each."""
    plan, given = parse_config(config, instrument), json.loads(config)
    lines = []
    for stage, source in plan.stages():
        name = stage.partition(":")[0]
        s = (plan.decon_first or {}).get(name.rpartition(".")[2], {}) if name.startswith("decon_first") else given.get("mip", {}) if name == "mip" else getattr(plan, name) or {}
        lines.append(" ".join([name, *(f"--{k}={v}" for k, v in sorted(s.items()) if k != "executable_path"), source]))
    return "\n".join(lines)
