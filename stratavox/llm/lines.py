"""Reversible line dedup: sharded cuckoo filters before exact reference-count tables."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, release, row_slices, settle, slices

#: Keys in a filter shard, about.
SHARD_KEYS = 100_000
#: Filters of this many bytes together at most go to every executor, so that a line is looked up before
#: it moves; of larger ones a task gets one shard at a time, and the lines of that shard.
FILTER_BYTES = 32 << 20
#: Line occurrences of a shard, about, that one task looks up.
SHARD_ROWS = 1_000_000
BLANK = b" \t\n\v\f\r"


class CuckooFilter:
    """16-bit fingerprints in buckets of four. Keys are pairs of unsigned 64-bit integers."""

    KICKS = 500

    def __init__(self, keys: int = 0, table: np.ndarray | None = None):
        self.table = np.zeros((1 << max(2, int(np.ceil(np.log2(max(keys, 1) / 3.2)))), 4), np.uint16) if table is None else table
        self.mask = len(self.table) - 1

    def _places(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        print_ = (low & np.uint64(0xFFFF)).astype(np.uint16)
        print_[print_ == 0] = 1
        first = (high & np.uint64(self.mask)).astype(np.int64)
        return print_, first, first ^ ((print_.astype(np.int64) * 0x5BD1E995) & self.mask)

    def insert(self, high: np.ndarray, low: np.ndarray) -> bool:
        """Insert different keys; False if the table is too full (build a larger one from the exact table)."""
        for f, a, b in zip(*(x.tolist() for x in self._places(high, low)), strict=True):
            for kick in range(self.KICKS):
                free = np.flatnonzero(self.table[a] == 0) if kick else next((x for x in (np.flatnonzero(self.table[a] == 0), np.flatnonzero(self.table[b] == 0)) if len(x)), [])
                if not kick and len(free) and not (self.table[a] == 0).any():
                    a = b
                if len(free):
                    self.table[a, free[0]] = f
                    break
                slot = kick & 3
                f, self.table[a, slot] = int(self.table[a, slot]), f
                a ^= (f * 0x5BD1E995) & self.mask
            else:
                return False
        return True

    def delete(self, high: np.ndarray, low: np.ndarray) -> None:
        """Delete keys that were inserted."""
        for f, a, b in zip(*(x.tolist() for x in self._places(high, low)), strict=True):
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == f)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        f, a, b = self._places(high, low)
        return (self.table[a] == f[:, None]).any(axis=1) | (self.table[b] == f[:, None]).any(axis=1)

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray) -> CuckooFilter:
        room = max(4, len(high))
        while not (made := cls(room)).insert(high, low):
            room *= 2
        return made


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z lower-cased."""
    return line.strip(BLANK).lower()


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


def digests(text: bytes, least_chars: int) -> set[bytes]:
    """The 128-bit keys of a text's different lines of `least_chars` code points or more."""
    return {_digest(k) for k in set(map(line_key, text.split(b"\n"))) if k and _points(k) >= least_chars}


def document_keys(docs: DataFrame, sign: int = 1, least_chars: int = 1) -> DataFrame:
    """(high, low, n): 128-bit line keys and in how many of the documents (rows) each is, times sign.
    Each worker adds up its own documents before anything moves."""

    def run(batches):
        for batch in batches:
            for _, texts in slices(batch):
                counts: dict[bytes, int] = {}
                for text in texts:
                    for d in digests(text, least_chars):
                        counts[d] = counts.get(d, 0) + sign
                both = np.frombuffer(b"".join(counts), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(list(counts.values()), pa.int64())], names=["high", "low", "n"])
        release()

    return id_text(docs, binary=True).mapInArrow(run, "high long, low long, n long").groupBy("high", "low").agg(F.sum("n").alias("n"))


def _shard(shards: int):
    return F.pmod(F.shiftright("high", 40), F.lit(shards)).cast("int")


class LineIndex:
    """Reference counts of line keys (exact) and, of the keys found in `least_docs` documents or
    more, cuckoo filters by shard. insert() and delete() return the index after them, so a
    document's removal takes back what its insertion did. Rows are documents, repeated ones too;
    null and empty texts have no keys; an empty table changes nothing; to delete what was never
    inserted takes its keys' counts down, and counts of 0 or less are gone."""

    def __init__(self, counts: DataFrame, least_docs: int = 10, least_chars: int = 1, filters: DataFrame | None = None, shards: int = 0):
        self.counts, self.least_docs, self.least_chars = counts, least_docs, least_chars
        self.common = settle(counts.filter(F.col("n") >= least_docs).select("high", "low"))
        self.shards = shards or max(1, -(-self.common.count() // SHARD_KEYS))
        self.filters = settle(filters if filters is not None else self._built())

    @classmethod
    def of(cls, docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> LineIndex:
        return cls(document_keys(docs, 1, least_chars), least_docs, least_chars)

    def _built(self) -> DataFrame:
        def build(keys: pa.Table) -> pa.Table:
            made = CuckooFilter.of(*(keys.column(c).to_numpy().view(np.uint64) for c in ("high", "low")))
            return pa.table({"shard": keys.column("shard").slice(0, 1), "table": pa.array([made.table.tobytes()], pa.binary())})

        return self.common.withColumn("shard", _shard(self.shards)).groupBy("shard").applyInArrow(build, "shard int, table binary")

    def _changed(self, docs: DataFrame, sign: int) -> LineIndex:
        delta = document_keys(docs, sign, self.least_chars)
        old, least = settle(self.counts), self.least_docs
        both = settle(old.select("high", "low", "n", F.lit(0).cast("long").alias("d")).union(delta.select("high", "low", F.lit(0).cast("long"), "n")).groupBy("high", "low").agg(F.sum("n").alias("n"), F.sum("d").alias("d")))
        crossed = both.filter((F.col("n") >= least) != (F.col("n") + F.col("d") >= least)).select("high", "low", (F.col("d") > 0).alias("up"), _shard(self.shards).alias("shard"))
        after = both.select("high", "low", (F.col("n") + F.col("d")).alias("n")).filter("n > 0")

        def change(key: tuple, keys: pa.Table, tables: pa.Table) -> pa.Table:
            kept = CuckooFilter(table=np.frombuffer(tables.column("table")[0].as_py(), np.uint16).reshape(-1, 4).copy()) if tables.num_rows else CuckooFilter(4)
            high, low = (keys.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
            up = keys.column("up").to_numpy().astype(bool)
            kept.delete(high[~up], low[~up])
            full = not kept.insert(high[up], low[up])
            return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "table": pa.array([None if full else kept.table.tobytes()], pa.binary())})

        tables = settle(crossed.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(change, "shard int, table binary"))
        full = bool(tables.filter("table is null").head(1))
        # A filter that is too full is built anew, with more shards, from the exact table.
        return LineIndex(after, least, self.least_chars) if full else LineIndex(after, least, self.least_chars, tables, self.shards)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        return self._changed(docs, -1)

    def _small_filters(self) -> dict[int, bytes] | None:
        held = self.filters.agg(F.sum(F.length("table"))).first()[0] or 0
        return {r["shard"]: bytes(r["table"]) for r in self.filters.collect()} if held <= FILTER_BYTES else None

    def _found(self, docs: DataFrame) -> DataFrame:
        """(doc_id, high, low) of the line keys that the filters let through."""
        tables, shards, least = self._small_filters(), self.shards, self.least_chars

        def keys(batches):
            filters = {s: CuckooFilter(table=np.frombuffer(t, np.uint16).reshape(-1, 4)) for s, t in (tables or {}).items()}
            for batch in batches:
                for doc_ids, texts in slices(batch):
                    own = [digests(text, least) for text in texts]
                    both = np.frombuffer(b"".join([d for some in own for d in some]), "<i8").reshape(-1, 2)
                    ids = pa.array(doc_ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own])))
                    high, low, row = both[:, 0].copy(), both[:, 1].copy(), np.arange(len(both))
                    if tables is not None:
                        shard = (high >> 40) % shards
                        row = np.concatenate([row[:0], *[at[f.contains(high[at].view(np.uint64), low[at].view(np.uint64))] for s, f in filters.items() for at in [np.flatnonzero(shard == s)]]])
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(high[row]), pa.array(low[row])], names=["doc_id", "high", "low"])
            release()

        found = id_text(docs, binary=True).mapInArrow(keys, "doc_id long, high long, low long")
        return found if tables is not None else self._sifted(found)

    def _sifted(self, found: DataFrame) -> DataFrame:
        """The keys that the filter of their shard lets through, by shard. A shard whose lines occur
        often goes to many tasks, each with a copy of its filter and a part of its lines."""
        tasks = settle(self.counts.groupBy(_shard(self.shards).alias("shard")).agg(F.greatest(F.ceil(F.sum("n") / SHARD_ROWS), F.lit(1)).cast("int").alias("tasks")))
        tasks = F.broadcast(tasks)  # one small row for each SHARD_KEYS common lines
        tables = self.filters.join(tasks, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), "table", *[F.lit(None).cast("long").alias(c) for c in ("doc_id", "high", "low")])
        keys = found.withColumn("shard", _shard(self.shards)).join(tasks, "shard").select("shard", F.pmod(F.xxhash64("doc_id"), "tasks").cast("int").alias("task"), F.lit(None).cast("binary").alias("table"), "doc_id", "high", "low")
        dealt = tables.unionByName(keys).repartition("shard", "task").sortWithinPartitions("shard", "task", F.col("table").isNull())

        def run(batches):
            own, held = None, None
            for batch in row_slices(batches, 65536):
                shard, task = (batch.column(c).to_numpy() for c in ("shard", "task"))
                is_table = batch.column("table").is_valid().to_numpy(zero_copy_only=False)
                cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(task) != 0) | is_table[1:] | is_table[:-1]) + 1
                kept = [np.empty(0, np.int64)]
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)], strict=True):
                    if is_table[a]:
                        own, held = (shard[a], task[a]), CuckooFilter(table=np.frombuffer(batch.column("table")[a].as_py(), np.uint16).reshape(-1, 4))
                    elif own == (shard[a], task[a]):
                        high, low = (batch.column(c).slice(a, b - a).to_numpy().view(np.uint64) for c in ("high", "low"))
                        kept.append(a + np.flatnonzero(held.contains(high, low)))
                yield batch.select(["doc_id", "high", "low"]).take(pa.array(np.concatenate(kept)))

        return dealt.mapInArrow(run, "doc_id long, high long, low long")

    def common_lines(self, docs: DataFrame) -> DataFrame:
        """(doc_id, keys): the common line keys of documents that have any; the exact table decides."""
        found = self._found(docs).join(self.common, ["high", "low"])
        return found.groupBy("doc_id").agg(F.collect_set(F.struct("high", "low")).alias("keys"))

    def clean(self, docs: DataFrame) -> DataFrame:
        """docs with the text rid of all common lines, and n_lines and n_dropped; nulls, repeated rows, an
        empty table and clashing names as for drop_common_lines()."""
        return _without(docs, self.common_lines(docs), self.least_chars)


def _without(docs: DataFrame, common: DataFrame, least_chars: int) -> DataFrame:
    added = ("n_lines", "n_dropped")
    others = [docs[f"`{c}`"] for c in docs.columns if c.lower() not in ("text", *added)]
    rows = docs.select(F.struct(*others).alias("carried"), F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"), docs["doc_id"].cast("long").alias("i"))
    at = rows.join(common, rows["i"].eqNullSafe(common["doc_id"]), "left").select("carried", "text", "keys")

    def drop(batches):
        for batch in row_slices(batches):
            lines, dropped, kept = [], [], []
            lists = batch.column("keys")
            flat = lists.flatten()
            gone_all = np.stack([np.asarray(flat.field(k), np.int64) for k in (0, 1)], axis=1).astype("<i8").tobytes()
            ends = 16 * np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
            for raw, a, b in zip(batch.column("text"), [0, *ends.tolist()], ends.tolist(), strict=False):
                parts = raw.as_py().split(b"\n")
                gone = {gone_all[i : i + 16] for i in range(a, b, 16)}
                stay = parts if not gone else [p for p in parts if not ((k := line_key(p)) and _digest(k) in gone)]
                lines.append(len(parts))
                dropped.append(len(parts) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays([batch.column("carried"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=["carried", "text", *added])

    return at.mapInArrow(drop, f"carried {at.schema['carried'].dataType.simpleString()}, text string, n_lines long, n_dropped long").select("carried.*", "text", *added)


def drop_common_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """docs (all columns) rid of every line whose key is in `least_docs` documents or more.

    A key is the line stripped of space, tab, \\n, \\v, \\f, \\r at both ends, A-Z lower-cased, of
    `least_chars` code points or more. A null or empty text is one empty line, which stays; each row
    counts as a document, so repeated rows count as often as they occur; rows that share a doc_id
    lose what any of them has in common; a text of any length is split whole; an empty table gives no rows. Columns n_lines and n_dropped
    are added, in place of columns of that name.
    """
    return LineIndex.of(docs, least_docs, least_chars).clean(docs)


def without_common_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """drop_common_lines() with the columns of docs alone, whatever their names."""
    # Columns by position, so that none of docs' names can clash with an added one.
    places = {("doc_id" if c == "doc_id" else f"c{k}"): c for k, c in enumerate(docs.columns) if c != "text"}
    kept = drop_common_lines(docs.select(*[docs[f"`{c}`"].alias(p) for p, c in places.items()], "text"), least_docs, least_chars)
    by = {c: p for p, c in places.items()}
    return kept.select(*[F.col(by.get(c, "text")).alias(c) for c in docs.columns])
