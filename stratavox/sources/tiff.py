"""TIFF stacks: a codec in numpy, a reader to planes and a writer of one file for each image."""

from __future__ import annotations

import bz2
import struct
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.shipping import ship

#: Stacks of this many bytes or more are written with 64-bit offsets.
BIG = 3 << 30
_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
_CODE = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_KIND = {1: "u", 2: "i", 3: "f"}


def decode(data: bytes) -> list[dict]:
    """Pages of an uncompressed TIFF or BigTIFF: pixels (2-D; 3-D with several samples), dtype, tags.
    Stage positions, where tags 1 to 3 hold them, are pos_x, pos_y, pos_z. A bz2 file is unpacked."""
    if data[:3] == b"BZh":
        data = bz2.decompress(data)
    end = {b"II": "<", b"MM": ">"}.get(data[:2])
    if end is None:
        raise ValueError("not a TIFF file")
    big = struct.unpack(end + "H", data[2:4])[0] == 43
    word, count, entry = ("Q", "Q", 20) if big else ("I", "H", 12)
    width = struct.calcsize(word)
    at = struct.unpack(end + word, data[8:16] if big else data[4:8])[0]
    pages = []
    while at:
        n = struct.unpack_from(end + count, data, at)[0]
        at += struct.calcsize(count)
        tags: dict[int, tuple] = {}
        for k in range(n):
            tag, kind = struct.unpack_from(end + "HH", data, at + entry * k)
            m = struct.unpack_from(end + word, data, at + entry * k + 4)[0]
            place = at + entry * k + 4 + width
            if _SIZE.get(kind, 1) * m > width:
                place = struct.unpack_from(end + word, data, place)[0]
            if kind in (5, 10):
                parts = struct.unpack_from(end + ("I" if kind == 5 else "i") * 2 * m, data, place)
                tags[tag] = tuple(a / b if b else 0.0 for a, b in zip(parts[::2], parts[1::2], strict=True))
            elif kind in _CODE:
                tags[tag] = struct.unpack_from(f"{end}{m}{_CODE[kind]}", data, place)
        if tags.get(259, (1,))[0] != 1:
            raise ValueError("compressed TIFF pages are not supported")
        w, h, samples = tags[256][0], tags[257][0], tags.get(277, (1,))[0]
        bits, form = tags.get(258, (1,))[0], tags.get(339, (1,))[0]
        kind = np.dtype(f"{end}{_KIND.get(form, 'u')}{bits // 8}")
        raw = b"".join(data[o : o + c] for o, c in zip(tags[273], tags[279], strict=True))
        px = np.frombuffer(raw, kind, h * w * samples)
        shape = (h, w) if samples == 1 else (h, w, samples)
        position = {f"pos_{c}": float(tags[t][0]) if t in tags else None for c, t in zip("xyz", (1, 2, 3), strict=True)}
        names = {"u": "uint", "i": "int", "f": "float"}
        pages.append({"px": px.reshape(shape), "dtype": f"{names[kind.kind]}{bits}", "resolution": tags.get(282, (0.0,))[0]} | position)
        at = struct.unpack_from(end + word, data, at + entry * n)[0]
    return pages


def encode(stack: np.ndarray, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0), big: bool | None = None) -> bytes:
    """A greyscale stack (z, y, x) of 8, 16 or 32 bits, a page for each z; the first page carries an
    ImageJ description with the page count and distance. X and Y resolution are 1 / spacing."""
    stack = np.ascontiguousarray(stack if stack.ndim == 3 else stack[None])
    if stack.dtype.kind == "f":
        stack = stack.astype("<f4")
    stack = stack.astype(stack.dtype.newbyteorder("<"))
    nz, h, w = stack.shape
    big = stack.nbytes >= BIG if big is None else big
    word, count, entry = ("<Q", "<Q", 20) if big else ("<I", "<H", 12)
    width, form = struct.calcsize(word), {"u": 1, "i": 2, "f": 3}[stack.dtype.kind]
    out = bytearray(b"II" + struct.pack("<HHHQ", 43, 8, 0, 16) if big else b"II" + struct.pack("<HI", 42, 8))
    note = f"ImageJ=1.53\nimages={nz}\nslices={nz}\nspacing={spacing[2]}\nunit=micron\n\0".encode()
    for z in range(nz):
        page = stack[z].tobytes()
        given = [(256, 4, (w,)), (257, 4, (h,)), (258, 3, (stack.dtype.itemsize * 8,)), (259, 3, (1,)), (262, 3, (1,))]
        if z == 0:
            given.append((270, 2, note))
        given += [(273, 16 if big else 4, None), (277, 3, (1,)), (278, 4, (h,)), (279, 16 if big else 4, (len(page),))]
        given += [(282, 5, spacing[0]), (283, 5, spacing[1]), (284, 3, (1,)), (296, 3, (1,)), (339, 3, (form,))]
        size = struct.calcsize(count) + entry * len(given) + width
        extra, base = bytearray(), len(out) + size
        cells = []
        for tag, kind, value in given:
            if kind == 5:
                body, m = struct.pack("<II", 1_000_000, max(1, round(value * 1_000_000))), 1
            elif kind == 2:
                body, m = value, len(value)
            elif value is None:
                body, m = b"", 1
            else:
                body, m = b"".join(struct.pack("<" + _CODE[kind], v) for v in value), len(value)
            cells.append([tag, kind, m, body])
        for cell in cells:
            if len(cell[3]) > width:
                cell.append(base + len(extra))
                extra += cell[3]
                extra += b"\0" * (len(extra) % 2)
        pixels = base + len(extra)
        after = pixels + len(page) + (len(page) % 2)
        out += struct.pack(count, len(cells))
        for tag, kind, m, body, *place in cells:
            value = struct.pack(word, pixels) if tag == 273 else struct.pack(word, place[0]) if place else body.ljust(width, b"\0")
            out += struct.pack("<HH", tag, kind) + struct.pack(word, m) + value
        out += struct.pack(word, after if z + 1 < nz else 0) + extra + page + b"\0" * (len(page) % 2)
    return bytes(out)


READ = "path string, name string, page int, dtype string, height int, width int, samples int, px array<double>, pos_x double, pos_y double, pos_z double"


def read_stacks(spark: SparkSession, path: str, glob: str = "*.tif*", below: bool = True) -> DataFrame:
    """A row for each page of the TIFF files below a path (or in it alone), read by Spark from any store;
    the pages of a file may differ in size and type. A file that is no TIFF is an error that names it."""
    return pages(spark.read.format("binaryFile").option("recursiveFileLookup", str(below).lower()).option("pathGlobFilter", glob).load(path))


def sizes(files: DataFrame) -> DataFrame:
    """(path, pages, height, width, dtype) of stacks (path, content); of the first page, where they differ."""
    first = F.min(F.struct("page", "height", "width", "dtype"))
    at = pages(files).select("path", "page", "height", "width", "dtype").groupBy("path").agg(F.count("*").alias("pages"), first.alias("x"))
    return at.select("path", F.col("pages").cast("int").alias("pages"), "x.height", "x.width", "x.dtype")


def pages(files: DataFrame) -> DataFrame:
    """The same of files (path, content), a batch of a stream of them too."""
    ship(files.sparkSession)

    def run(batches):
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    pages = decode(bytes(content))
                except (ValueError, KeyError, struct.error) as e:
                    raise ValueError(f"{p}: {e}") from e
                for k, page in enumerate(pages):
                    px = page["px"]
                    row = (p, p.rsplit("/", 1)[-1], k, page["dtype"], px.shape[0], px.shape[1], px.shape[2] if px.ndim == 3 else 1, px.astype(float).ravel(), page["pos_x"], page["pos_y"], page["pos_z"])
                    yield pd.DataFrame([row], columns=[c.split()[0] for c in READ.split(", ")])

    return files.select("path", "content").mapInPandas(run, READ)


#: Pixels are held as doubles: an integer type takes what is rounded to it and saturates.
def _typed(stack: np.ndarray, dtype: str) -> np.ndarray:
    if np.dtype(dtype).kind == "f":
        return stack.astype(dtype)
    most = np.iinfo(dtype)
    return np.clip(np.trunc(np.nan_to_num(stack)), most.min, most.max).astype(dtype)


def encoded(planes: DataFrame, dtype: str = "uint16", spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """(image_id, content): a TIFF stack for each image; integers truncate and saturate."""
    ship(planes.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("z")
        stack = np.stack(pdf["px"].to_numpy()).reshape(-1, int(pdf["height"].iloc[0]), int(pdf["width"].iloc[0]))
        return pd.DataFrame({"image_id": [pdf["image_id"].iloc[0]], "content": [encode(_typed(stack, dtype), spacing)]})

    return planes.groupBy("image_id").applyInPandas(run, "image_id long, content binary")


#: Stores that Arrow writes to itself, and what it calls them.
SCHEMES = {"file": "file", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss", "hdfs": "hdfs", "viewfs": "viewfs"}


def write_stacks(planes: DataFrame, folder: str, name: str = "image_%d.tif", overwrite: bool = False, skip: bool = False, names: DataFrame | None = None, **options) -> DataFrame:
    """Write a file for each image; returns (image_id, path), lazily read from what was done. Files are
    called name % image_id, or as names (image_id, file) says. An existing file is an error unless
    overwrite, or left as it is with skip. Executors write to stores that Arrow knows (file:// must be
    a shared mount), each file under a name of its own that is moved into place, so that a task can run
    twice. Files for other stores are encoded by executors and put by the driver, one at a time, through
    Hadoop's file systems."""
    spark = planes.sparkSession
    ship(spark)
    folder = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    wanted = (planes.select("image_id").distinct().select("image_id", F.format_string(name, "image_id").alias("file")) if names is None else names).select("image_id", "file")
    scheme, _, rest = folder.partition("://")
    if scheme in SCHEMES and scheme != "viewfs":
        place = f"{SCHEMES[scheme]}://{rest}"
        there = _existing(wanted, place)
        if skip:
            wanted = wanted.join(there, "file", "left_anti").select("image_id", "file")
        elif not overwrite and (found := there.head(1)):
            raise FileExistsError(f"{folder}/{found[0]['file']}")
        content = encoded(planes.join(wanted.select("image_id"), "image_id", "left_semi") if skip else planes, **options)
        return _written(content.join(wanted, "image_id"), place, folder)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = []
    for row in encoded(planes, **options).join(wanted, "image_id").toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(folder, row["file"])
        fs = path.getFileSystem(conf)
        if fs.exists(path) and not overwrite:
            if skip:
                continue
            raise FileExistsError(path.toString())
        stream = fs.create(path, overwrite)
        stream.write(bytearray(row["content"]))
        stream.close()
        done.append((row["image_id"], path.toString()))
    return spark.createDataFrame(done, "image_id long, path string")


def _existing(wanted: DataFrame, folder: str) -> DataFrame:
    """(file): files that are there already."""

    def look(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for pdf in batches:
            info = store.get_file_info([f"{base}/{f}" for f in pdf["file"]]) if len(pdf) else []
            yield pd.DataFrame({"file": [x.base_name for x in info if x.type != fs.FileType.NotFound]}, dtype=object)

    return wanted.select("file").mapInPandas(look, "file string")


def _written(files: DataFrame, place: str, folder: str) -> DataFrame:
    run = uuid.uuid4().hex

    def put(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(place)
        store.create_dir(base, recursive=True)
        for pdf in batches:
            for file, content in zip(pdf["file"], pdf["content"], strict=True):
                with store.open_output_stream(f"{base}/.{run}-{file}") as f:
                    f.write(bytes(content))
                store.move(f"{base}/.{run}-{file}", f"{base}/{file}")
            yield pd.DataFrame({"image_id": pdf["image_id"], "path": [f"{folder}/{f}" for f in pdf["file"]]})

    rows = files.mapInPandas(put, "image_id long, path string").collect()  # an id and a path for each image
    return files.sparkSession.createDataFrame(rows, "image_id long, path string")


def acquisitions(spark: SparkSession, root: str, excluded: DataFrame | None = None) -> DataFrame:
    """(dir): directories that hold a *Settings.txt file, without .zarr and .n5 trees and, of those
    in `excluded` (dir), none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*Settings.txt").load(root)
    dirs = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("dir")).distinct().filter(~F.col("dir").rlike(r"\.(zarr|n5)(/|$)"))
    return dirs.join(excluded.select("dir"), "dir", "left_anti") if excluded is not None else dirs
