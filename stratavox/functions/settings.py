"""Settings documents of acquisitions, parsed with SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Section header, and the stage devices that each instrument writes.
HEADER = r"\*{5} +\*{5} +\*{5} +([^*]+?) +\*{5} +\*{5} +\*{5}"
DEVICES = {
    "lattice": ("X Galvo", "Z Galvo", "Z PZT", "S Piezo"),
    "adaptive": ("X Galvo", "Z Galvo", "Z PZT", "ISM Offset", "X Stage Offset", "XZ stage Offset"),
}


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """(path, dir, text) of *Settings.txt files below a path, as Latin-1."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*Settings.txt").load(path)
    return documents(files)


def documents(files: DataFrame) -> DataFrame:
    """(path, dir, text) of files (path, content)."""
    return files.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"), F.decode("content", "ISO-8859-1").alias("text"))


def field(text: Column | str, pattern: str, kind: str = "string") -> Column:
    """The first group of a pattern, trimmed and cast; null without a match."""
    found = F.trim(F.regexp_extract(text, pattern, 1))
    return F.nullif(found, F.lit("")) if kind == "string" else found.try_cast(kind)


def sections(documents: DataFrame) -> DataFrame:
    """(dir, section, body) of each headed section."""
    parts = F.split("text", HEADER)
    heads = F.regexp_extract_all("text", F.lit(HEADER), F.lit(1))
    at = documents.select("dir", F.posexplode(heads).alias("i", "section"), parts.alias("p"))
    return at.select("dir", F.trim("section").alias("section"), F.element_at("p", F.col("i") + 2).alias("body"))


def general(documents: DataFrame) -> DataFrame:
    """(dir, date, acq_mode, version, pc, tile_x, ..., waveform_type, cycle_lasers, z_motion, notes ...)."""
    number = r"\s*[:=]\s*(-?\d+)"
    line = r"\s*:[ \t]*([^\r\n]*)"
    return documents.select(
        "dir",
        field("text", r"(?m)^Date" + line).alias("date"),
        field("text", r"(?m)^Acq mode" + line).alias("acq_mode"),
        field("text", r"(?m)^Version" + line).alias("version"),
        field("text", r"(?m)^PC" + line).alias("pc"),
        *[field("text", f"(?m)^{c}" + line).alias(c.lower()) for c in ("Microscopist", "Collaborator", "Sample")],
        *[field("text", rf"(?mi)^# of tiles {c}" + number, "int").alias(f"tiles_{c}") for c in "xyzt"],
        field("text", r"(?m)^Waveform type" + line).alias("waveform_type"),
        field("text", r"(?m)^Cycle lasers" + line).alias("cycle_lasers"),
        field("text", r"(?m)^Z motion" + line).alias("z_motion"),
    )


def devices(documents: DataFrame, instrument: str = "lattice") -> DataFrame:
    """(dir, device, ch, offset, interval, n_pixels): the scan of each device and channel."""
    names = "|".join(DEVICES[instrument])
    pattern = rf"(?m)^(?:{names})[^\t\r\n]*\((\d+)\)\s*:\t[^\r\n]*"
    at = documents.select("dir", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("line"))
    cells = F.split(F.regexp_extract("line", r":\t(.*)$", 1), "\t")
    device = F.regexp_replace(F.lower(F.regexp_extract("line", f"^({names})", 1)), " ", "-")
    return at.select(
        "dir",
        device.alias("device"),
        F.regexp_extract("line", r"\((\d+)\)\s*:", 1).cast("int").alias("ch"),
        F.get(cells, F.lit(0)).try_cast("double").alias("offset"),
        F.get(cells, F.lit(1)).try_cast("double").alias("interval"),
        F.get(cells, F.lit(2)).try_cast("int").alias("n_pixels"),
    )


def lasers(documents: DataFrame) -> DataFrame:
    """(dir, laser_idx, ch, filter, laser, power, exp): one row for each laser that is on. Second and
    third lasers of a line share its channel, filter and exposure."""
    pattern = r"(?m)^Excitation Filter, Laser[^\t\r\n]*\(\d+\)\s*:\t[^\r\n]*"
    at = documents.select("dir", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("line_no", "line"))
    at = at.select("dir", "line_no", F.regexp_extract("line", r"\((\d+)\)\s*:", 1).cast("int").alias("ch"), F.split(F.regexp_extract("line", r":\t(.*)$", 1), "\t").alias("c"))
    one = lambda k, laser, power: F.struct(F.lit(k).alias("k"), F.get("c", F.lit(laser)).alias("laser"), F.get("c", F.lit(power)).try_cast("double").alias("power"))
    more = F.array(one(0, 1, 2), one(1, 4, 5), one(2, 6, 7))
    at = at.select("dir", "line_no", "ch", F.get("c", F.lit(0)).alias("filter"), F.get("c", F.lit(3)).try_cast("double").alias("exp"), F.explode(more).alias("x"))
    on = at.filter(F.col("x.laser").isNotNull() & (F.col("x.laser") != "OFF"))
    return on.select("dir", (F.col("line_no") * 3 + F.col("x.k")).alias("laser_idx"), "ch", "filter", F.col("x.laser").try_cast("int").alias("laser"), F.col("x.power").alias("power"), "exp")


def steps(files: DataFrame, device: DataFrame, name: str = "x-stage-offset") -> DataFrame:
    """files (dir, channel, ...) with the step of their channel; a file without one stays, step null."""
    at = device.filter(F.col("device") == name).select("dir", F.col("ch").alias("channel"), F.col("interval").alias("step"))
    return files.join(at, ["dir", "channel"], "left")


def z_step(step: Column, angle: float, z_motion: Column) -> Column:
    """Distance of pages: the stage's step times the sine of the angle, or the objective's own step."""
    return F.when(z_motion == "Sample piezo", F.abs(step * F.sin(F.radians(F.lit(angle))))).otherwise(step)


def capture_time(text: Column) -> Column:
    return F.to_timestamp(text, "M/d/yyyy h:mm:ss a")
