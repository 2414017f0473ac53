"""What the training-data operators share: input columns, whitespace, checkpoints."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.shipping import shared_folder, ship

#: The six characters that separate words everywhere here: space, tab, \n, \v, \f, \r.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
#: Python workers handle this many bytes of text, and rows, at a time, whatever the Arrow batch holds.
CHUNK_BYTES, CHUNK_ROWS = 1 << 20, 4096


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, binary: bool = False) -> DataFrame:
    """doc_id and whole text alone, so that no other column can clash; a null text is empty."""
    ship(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), (text.cast("binary") if binary else text).alias("text"))


def settle(df: DataFrame) -> DataFrame:
    """Checkpoint df eagerly in the cluster's shared folder (spark.checkpoint.dir).

    Only where that setting is absent and all runs in this process, as in tests, a temporary folder is set.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def array_slices(batch: pa.RecordBatch, most: int = CHUNK_BYTES, rows: int = CHUNK_ROWS):
    """(ids, texts) arrays of a batch with columns doc_id and text, about `most` bytes and `rows` rows at a time."""
    ids, texts = batch.column("doc_id"), batch.column("text")
    ends = [0]
    held = 0
    sizes = pc.binary_length(texts).to_pylist()
    for i, size in enumerate(sizes):
        if i > ends[-1] and (held + size > most or i - ends[-1] >= rows):
            ends.append(i)
            held = 0
        held += size
    ends.append(len(sizes))
    for a, b in zip(ends, ends[1:], strict=False):
        if b > a:
            yield ids.slice(a, b - a), texts.slice(a, b - a)


def slices(batch: pa.RecordBatch, most: int = CHUNK_BYTES, rows: int = CHUNK_ROWS):
    """array_slices() as lists."""
    for ids, texts in array_slices(batch, most, rows):
        yield ids.to_pylist(), texts.to_pylist()


def gather(ids: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs number at[0], at[1] ... of ids, whose runs have these sizes, and the sizes of those."""
    first = np.cumsum(size) - size
    n = size[at]
    ends = np.cumsum(n)
    return ids[np.repeat(first[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], n


def row_slices(batches, rows: int = 512):
    """Slices of the Arrow batches of a task, so that a worker holds the results of a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()


def release() -> None:
    """Give memory that a finished task no longer needs back to the system; the worker lives on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: Bits of a sieve at most (16 MB), and bits in one row on the way to the driver.
SIEVE_BITS, SIEVE_ROW = 1 << 27, 1 << 15


class Sieve:
    """A bitmap of 64-bit keys, of a bounded size, that tells workers which rows cannot have a partner,
    before they are shuffled. Rows that it lets through are joined exactly; when there are more keys
    than it can tell apart, it lets all through."""

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, np.int64(8 * len(table) - 1)

    @classmethod
    def of(cls, keys: DataFrame, column: str) -> Sieve:
        """Of a column of longs. The driver sees the bits alone, at most SIEVE_BITS of them."""
        bits = 1 << min(SIEVE_BITS.bit_length() - 1, max(SIEVE_ROW.bit_length() - 1, (16 * keys.count()).bit_length()))
        at = keys.select(F.pmod(F.col(column), F.lit(bits)).alias("bit")).distinct()

        def pack(some: pa.Table) -> pa.Table:
            row = np.zeros(SIEVE_ROW, np.uint8)
            row[some.column("bit").to_numpy() % SIEVE_ROW] = 1
            return pa.table({"row": some.column("row").slice(0, 1), "bits": pa.array([np.packbits(row, bitorder="little").tobytes()], pa.binary())})

        table = np.zeros((bits // SIEVE_ROW, SIEVE_ROW // 8), np.uint8)
        for r in at.withColumn("row", F.floor(F.col("bit") / SIEVE_ROW)).groupBy("row").applyInArrow(pack, "row long, bits binary").collect():
            table[r["row"]] = np.frombuffer(r["bits"], np.uint8)
        return cls(table.ravel())

    def passes(self, keys: np.ndarray) -> np.ndarray:
        bit = keys & self.mask
        return (self.table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0


class TwoGenerations:
    """A bounded cache: when the young half is full it becomes the old half, and the old half goes."""

    def __init__(self, half: int):
        self.half, self.young, self.old = half, {}, {}

    def get_all(self, keys, make) -> dict:
        """{key: value} for all keys; make(list of missing keys) returns their values in order."""
        keys = list(keys)
        return dict(zip(keys, self.get_list(keys, make), strict=True))

    def get_list(self, keys: list, make) -> list:
        """The values of different keys, in order."""
        young, old = self.young, self.old
        values = list(map(young.get, keys))
        missing = []
        for i, v in enumerate(values):
            if v is None:
                k = keys[i]
                v = old.get(k)
                if v is None:
                    missing.append(i)
                else:
                    young[k] = values[i] = v
        if missing:
            for i, v in zip(missing, make([keys[i] for i in missing]), strict=True):
                young[keys[i]] = values[i] = v
        if len(young) > self.half:
            self.young, self.old = {}, young
        return values
