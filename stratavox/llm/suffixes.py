"""Exact removal of long repeated byte strings by bucket-pointer refinement."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.shipping import ship

from .common import Sieve, release, row_slices, settle

#: A repeated string of LENGTH bytes holds a leading q-gram of GRAM bytes: the least, by hash, of
#: its LENGTH - GRAM + 1 q-grams, the leftmost of equals. Both of its occurrences have the same one.
LENGTH, GRAM = 200, 64
#: Different surroundings of one leading q-gram that a task refines itself; larger buckets are
#: refined by all tasks.
BUCKET = 4096
#: A q-gram that leads more than one in so many shared stretches is known to all tasks by itself, so
#: that its stretches need not meet; there are fewer of these than this.
HOT = 1000
#: Bytes that are hashed together.
BLOCK = 192 << 10
#: Surroundings that are refined together.
TOGETHER = 4096

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES, _OTHER = (np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8, salt=x).digest(), "little") for b in range(256)], np.uint64) for x in (b"", b"other"))


def _paired(ids: np.ndarray, later: int) -> np.ndarray:
    """Bucket identifiers of strings from those of their first part and of the part `later` on."""
    x = ids[: len(ids) - later] * _ODD
    x ^= x >> np.uint64(29)
    x += ids[later:]
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def gram_ids(data: np.ndarray, table: np.ndarray = _BYTES) -> np.ndarray:
    """A 64-bit bucket identifier of the GRAM bytes at each offset, by doubling."""
    ids, n = table[data], 1
    while n < GRAM:
        ids, n = _paired(ids, n), 2 * n
    return ids


def window_ids(data: np.ndarray, table: np.ndarray = _BYTES) -> np.ndarray:
    """A 64-bit bucket identifier of the LENGTH bytes at each offset: the q-gram buckets, refined
    twice by the identifiers of a later offset."""
    ids, n = gram_ids(data, table), GRAM
    while 2 * n <= LENGTH:
        ids, n = _paired(ids, n), 2 * n
    return _paired(ids, LENGTH - n)


def refined_buckets(data: np.ndarray, length: int = LENGTH, first: int = 8) -> np.ndarray:
    """For each offset with `length` bytes after it, the bucket pointer of those bytes: equal for equal
    bytes only, no hashes.

    Offsets are sorted into buckets by their first 8 bytes; an offset's pointer is the place where its
    bucket begins. Each pass sorts the offsets of a bucket by the pointers of the offsets `n` further
    on, which doubles the depth; buckets of one offset are done and keep their pointer, and each pass
    uses the pointers that the last one made.
    """
    if len(data) < length:
        return np.empty(0, np.int64)
    grams = np.lib.stride_tricks.sliding_window_view(data, first).copy().view(">u8").ravel()
    order = np.argsort(grams, kind="stable")
    size, n = len(order), first
    new = np.empty(size, bool)
    new[0], new[1:] = True, grams[order[1:]] != grams[order[:-1]]
    pointer = np.empty(size, np.int64)
    while True:
        begin = np.flatnonzero(new)
        counts = np.diff(np.append(begin, size))
        pointer[order] = np.repeat(begin, counts)
        if n == length:
            return pointer[: len(data) - length + 1]
        later = min(n, length - n)
        active = np.flatnonzero(np.repeat(counts > 1, counts))
        which = order[active]
        key = pointer[which] * size + pointer[np.minimum(which + later, size - 1)]
        sort = np.argsort(key, kind="stable")
        order[active], key = which[sort], key[sort]
        if len(active):
            new[active[1:]] = key[1:] != key[:-1]
        n += later


def leaders(texts: list[bytes]):
    """For each stretch of windows with one leading q-gram: (text number, q-gram's identifier, first
    window, windows, q-gram's offset in the first window), as arrays."""
    out = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK):
            size += len(texts[end])
            end += 1
        out.append(_leaders(texts[at:end], at))
        at = end
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 5


def _leaders(texts: list[bytes], first: int):
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < LENGTH:
        return (np.empty(0, np.int64), np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    bits = max(1, int(len(data)).bit_length())
    low = np.uint64((1 << bits) - 1)
    ids = gram_ids(data)
    # The identifier's upper bits and the offset in one number: the least has the leftmost offset.
    least, n = (ids & ~low) | np.arange(len(ids), dtype=np.uint64), 1
    span = LENGTH - GRAM + 1
    while 2 * n <= span:
        least, n = np.minimum(least[: len(least) - n], least[n:]), 2 * n
    if n < span:
        rest = span - n
        least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least & low).astype(np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    text = np.repeat(np.arange(len(texts)), sizes)[: len(place)]
    inside = np.arange(len(place)) + LENGTH <= ends[text]
    new = np.empty(len(place), bool)
    new[0] = True
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    new &= inside
    begin = np.flatnonzero(new)
    count = np.add.reduceat(inside, begin) if len(begin) else begin
    own = text[begin]
    return own + first, ids[place[begin]], begin - starts[own], count.astype(np.int64), place[begin] - begin


def _name(text: bytes) -> tuple[int, int]:
    """A text's 128-bit name: texts of equal bytes lose equal bytes."""
    d = hashlib.blake2b(text, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


NAMES = ["t1", "t2"]


def _each_text(batches, most: int = 1 << 20):
    for batch in batches:
        texts, size = [], 0
        for x in batch.column("text"):
            texts.append(x.as_py())
            size += len(texts[-1])
            if size > most:
                yield texts
                texts, size = [], 0
        if texts:
            yield texts


def stretches(docs: DataFrame, sieve: Sieve | None = None, hot: dict[int, bool] | None = None) -> DataFrame:
    """(gram, around, t1, t2, first, windows, lead, mixed): each text's stretches of windows that share
    a leading q-gram; around is a hash of all bytes of the stretch and of where the q-gram stands.
    With a sieve, those alone whose q-gram it lets through; mixed is hot[gram], or null."""
    known = sorted((hot or {}).items())
    grams, mixed = (np.array([x[k] for x in known], t) for k, t in ((0, np.int64), (1, bool)))

    def run(batches):
        for texts in _each_text(batches):
            names = [_name(t) for t in texts]
            columns = leaders(texts)
            if sieve is not None:
                at = np.flatnonzero(sieve.passes(columns[1].view(np.int64)))
                columns = [c[at] for c in columns]
            own, ids, first, count, lead = columns
            digest = xxhash.xxh3_64_intdigest
            views = [memoryview(t) for t in texts]
            around = [digest(views[i][a : a + n + LENGTH - 1], o) for i, a, n, o in zip(own.tolist(), first.tolist(), count.tolist(), lead.tolist(), strict=True)]
            both = np.array(names, np.int64).reshape(-1, 2)[own]
            ids = ids.view(np.int64)
            place = np.minimum(np.searchsorted(grams, ids), max(0, len(grams) - 1))
            is_hot = grams[place] == ids if len(grams) else np.zeros(len(ids), bool)
            flag = pa.array(mixed[place] if len(grams) else is_hot, mask=~is_hot)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.array(around, np.uint64).view(np.int64)), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int16)), pa.array(lead.astype(np.int16)), flag],
                names=["gram", "around", *NAMES, "first", "windows", "lead", "mixed"],
            )
        release()

    ship(docs.sparkSession)
    return docs.select(F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text")).mapInArrow(run, "gram long, around long, t1 long, t2 long, first int, windows short, lead short, mixed boolean")


def _rows(docs: DataFrame) -> DataFrame:
    """text as bytes (null: empty) and `carried`, a struct of the row's other columns, if it has any."""
    ship(docs.sparkSession)
    others = [docs[f"`{c}`"] for c in docs.columns if c.lower() != "text"]
    return docs.select(*([F.struct(*others).alias("carried")] if others else []), F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"))


def _carried(at: DataFrame) -> str:
    return f"carried {at.schema['carried'].dataType.simpleString()}, " if "carried" in at.columns else ""


def _named(at: DataFrame, sieve: Sieve) -> DataFrame:
    """(carried, t1, t2, packed) of the rows whose text's name the sieve lets through: the name, and
    the text compressed for the shuffle."""
    carry = ["carried"] if "carried" in at.columns else []

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in row_slices(batches):
            texts = [x.as_py() for x in batch.column("text")]
            both = np.array([_name(t) for t in texts], np.int64).reshape(-1, 2)
            some = np.flatnonzero(sieve.passes(both[:, 0]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(some)) for c in carry], pa.array(both[some, 0]), pa.array(both[some, 1]), pa.array([pack(texts[i]) for i in some.tolist()], pa.binary())], names=[*carry, *NAMES, "packed"])

    return at.mapInArrow(run, _carried(at) + "t1 long, t2 long, packed binary")


def _surroundings(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(gram, around, n, lead, bytes) of the wanted stretches, cut from one copy of their text."""
    wanted = settle(wanted)
    lists = wanted.groupBy(*NAMES).agg(F.collect_list(F.struct("gram", "around", "n", "first", "windows", "lead", "many")).alias("parts"))
    texts = _named(_rows(docs.select("text")), Sieve.of(wanted, "t1")).groupBy(*NAMES).agg(F.first("packed").alias("packed"))
    at = lists.join(texts, NAMES).select("parts", "packed")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in row_slices(batches):
            rows = []
            for parts, packed in zip(batch.column("parts"), batch.column("packed"), strict=True):
                text = unpack(packed.as_py())
                rows += [(p["gram"], p["around"], p["n"], p["lead"], p["many"], text[p["first"] : p["first"] + p["windows"] + LENGTH - 1]) for p in parts.as_py()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["gram", "around", "n", "lead", "many", "bytes"])

    return at.mapInArrow(run, "gram long, around long, n long, lead short, many boolean, bytes binary")


def _window_rows(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the byte strings: the string's number, the window's offset, its place in their
    bytes one after the other; and those."""
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes) - sizes
    counts = sizes - LENGTH + 1
    own = np.repeat(np.arange(len(parts)), counts)
    offset = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return own, offset, starts[own] + offset, np.frombuffer(b"".join(parts), np.uint8)


def _runs(own: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, from, windows) of maximal runs of consecutive windows."""
    if not len(own):
        return own, own, own
    cut = np.flatnonzero((np.diff(own) != 0) | (np.diff(offset) != 1)) + 1
    at = np.concatenate([[0], cut])
    return own[at], offset[at], np.diff(np.concatenate([at, [len(own)]]))


def _refine(batches):
    """Repeated runs of windows in buckets that arrive whole, sorted by gram."""
    names = ["gram", "around", "lo", "hi"]

    def refined(table: pa.Table) -> pa.RecordBatch:
        gram, around, n = (table.column(c).to_numpy() for c in ("gram", "around", "n"))
        own, offset, place, data = _window_rows([b.as_py() for c in table.column("bytes").chunks for b in c])
        bucket = refined_buckets(data)[place]
        again = np.bincount(bucket, weights=n[own])[bucket] > 1
        own, lo, count = _runs(own[again], offset[again])
        return pa.RecordBatch.from_arrays([pa.array(gram[own]), pa.array(around[own]), pa.array(lo.astype(np.int32)), pa.array((lo + count + LENGTH - 1).astype(np.int32))], names=names)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(at, TOGETHER)
            gram = part.column("gram").to_numpy()
            cut = int(np.searchsorted(gram, gram[-1], "left"))
            if held and held[-1].column("gram")[-1].as_py() == gram[0] and cut == 0:
                held.append(part)
                size += part.num_rows
                continue
            held.append(part.slice(0, cut))
            whole = [b for b in held if b.num_rows]
            if whole:
                yield refined(pa.Table.from_batches(whole))
            held, size = [part.slice(cut)], part.num_rows - cut
    whole = [b for b in held if b.num_rows]
    if whole:
        yield refined(pa.Table.from_batches(whole))


def _spread(batches):
    """Windows of large buckets, one row each."""
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(at, TOGETHER)
            gram, around, n = (part.column(c).to_numpy() for c in ("gram", "around", "n"))
            own, offset, place, data = _window_rows([b.as_py() for b in part.column("bytes")])
            ids = [pa.array(window_ids(data, table)[place].view(np.int64)) for table in (_BYTES, _OTHER)]
            yield pa.RecordBatch.from_arrays([pa.array(gram[own]), pa.array(around[own]), pa.array(n[own]), pa.array(offset.astype(np.int32)), *ids], names=["gram", "around", "n", "at", "b1", "b2"])


def _joined(rows: DataFrame) -> DataFrame:
    """Windows (gram, around, at) gathered to runs (gram, around, lo, hi)."""

    def run(batches):
        for batch in batches:
            out = []
            for gram, around, at in zip(*(batch.column(c).to_pylist() for c in ("gram", "around", "at")), strict=True):
                _, lo, count = _runs(np.zeros(len(at), np.int64), np.sort(np.array(at, np.int64)))
                out += [(gram, around, a, a + n + LENGTH - 1) for a, n in zip(lo.tolist(), count.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["gram", "around", "lo", "hi"])

    return rows.groupBy("gram", "around").agg(F.collect_list("at").alias("at")).mapInArrow(run, "gram long, around long, lo int, hi int")


def repeated_spans(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(t1, t2, spans): by text name, the spans array<struct<lo, hi>> that repeats cover, unmerged.

    1. Each text is cut into stretches of windows with one leading q-gram. q-grams that lead once
       only are gone after one count, which workers add up before the shuffle; a sieve of the others
       keeps their stretches from being shuffled again, and the most frequent of the others are known
       to all workers.
    2. Where all stretches of a q-gram are alike (128 bits of two hashes), all their bytes repeat.
    3. Different stretches of a q-gram form a bucket, whose windows are refined by bucket pointers of
       later offsets, byte for byte, one copy of each stretch with its number. A bucket of more than
       `bucket` different stretches is dealt out by window to all tasks, by 128-bit identifiers that
       are refined in the same way.
    """
    found = stretches(docs)
    shared = settle(found.groupBy("gram").agg(F.count("*").alias("c"), F.min("around").alias("a"), F.max("around").alias("b")).filter("c > 1").select("gram", "c", (F.col("a") != F.col("b")).alias("mixed")))
    total = shared.agg(F.sum("c")).first()[0] or 0
    hot = {r["gram"]: r["mixed"] for r in shared.filter(F.col("c") * HOT > total).collect()}
    some = stretches(docs, Sieve.of(shared, "gram"), hot)
    known = shared.select("gram", F.col("mixed").alias("is_mixed"))
    rest = some.filter("mixed is null").join(known, "gram").withColumn("mixed", F.col("is_mixed")).drop("is_mixed")
    again = settle(rest.unionByName(some.filter("mixed is not null")) if hot else rest)
    alike = again.filter("not mixed").select(*NAMES, F.col("first").alias("lo"), (F.col("first") + F.col("windows") + (LENGTH - 1)).alias("hi"))
    mixed = again.filter("mixed")
    kinds = mixed.groupBy("gram", "around").agg(F.count("*").alias("n"), F.min(F.struct(*NAMES, "first", "windows", "lead")).alias("x")).select("gram", "around", "n", "x.*")
    sizes = kinds.groupBy("gram").agg(F.count("*").alias("many")).filter(F.col("many") > bucket)  # few, as a rule none
    parts = settle(_surroundings(kinds.join(sizes, "gram", "left").withColumn("many", F.col("many").isNotNull()), docs))
    near = parts.filter("not many").select("gram", "around", "n", "bytes").repartition("gram").sortWithinPartitions("gram").mapInArrow(_refine, "gram long, around long, lo int, hi int")
    windows = parts.filter("many").select("gram", "around", "n", "bytes").mapInArrow(_spread, "gram long, around long, n long, at int, b1 long, b2 long")
    repeated = windows.groupBy("gram", "b1", "b2").agg(F.sum("n").alias("m")).filter("m > 1")
    far = _joined(windows.join(repeated, ["gram", "b1", "b2"]).select("gram", "around", "at"))
    spans = mixed.join(near.union(far), ["gram", "around"]).select(*NAMES, (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi"))
    return alike.union(spans).groupBy(*NAMES).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def drop_repeats(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """docs (all columns; the text as `kept` bytes) rid of each byte that a LENGTH-byte string covers
    which starts anywhere else too, and n_bytes, n_removed, n_spans.

    Texts are taken as UTF-8; matches stay within a document and are judged on the input. A null or
    empty text keeps nothing; texts below LENGTH bytes are kept; of repeated rows of that length
    nothing is kept; an empty table gives no rows. Columns of the added names are replaced.
    """
    added = ("kept", "n_bytes", "n_removed", "n_spans")
    at = _rows(docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in added]))
    spans = settle(repeated_spans(docs, bucket).select(F.col("t1").alias("s1"), F.col("t2").alias("s2"), "spans"))
    sieve = Sieve.of(spans, "s1")
    named = _named(at, sieve)
    met = named.join(spans, (named["t1"] == spans["s1"]) & (named["t2"] == spans["s2"]), "left").select(*at.columns[:-1], "packed", "spans")
    carry = ["carried"] if "carried" in at.columns else []
    schema = _carried(at) + "kept binary, n_bytes long, n_removed long, n_spans long"

    def drop(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in row_slices(batches):
            out = []
            for packed, spans in zip(batch.column("packed"), batch.column("spans").to_pylist(), strict=True):
                text = unpack(packed.as_py())
                kept, last, n = [], 0, 0
                for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                    if lo > last or not n:
                        kept.append(text[last:lo])
                        n += 1
                    last = max(last, hi)
                kept.append(text[last:])
                kept = b"".join(kept)
                out.append((kept, len(text), len(text) - len(kept), n))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], *[pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]], names=[*carry, *added])

    def whole(batches):
        for batch in row_slices(batches):
            texts = [x.as_py() for x in batch.column("text")]
            rest = np.flatnonzero(~sieve.passes(np.array([_name(t)[0] for t in texts], np.int64)))
            kept, zeros = [texts[i] for i in rest.tolist()], pa.array(np.zeros(len(rest), np.int64))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(rest)) for c in carry], pa.array(kept, pa.binary()), pa.array([len(t) for t in kept], pa.int64()), zeros, zeros], names=[*carry, *added])

    # Texts that surely lose nothing stay where they are.
    out = met.mapInArrow(drop, schema).unionByName(at.mapInArrow(whole, schema))
    return out.select(*[f"{c}.*" for c in carry], *added)


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs, same columns, with texts rid of repeats; a character that was cut in part goes whole.

    A null text becomes an empty one; texts of any length are compared whole; of repeated rows of
    LENGTH bytes or more nothing is kept, but the rows stay, as do null doc_ids; an empty table gives
    no rows; column names are free."""

    def decode(batches):
        for batch in batches:
            text = pa.array([x.as_py().decode("utf-8", "ignore") for x in batch.column("kept")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("carried"), text], names=["carried", "text"])

    # Columns by position, so that none of docs' names can clash with an added one.
    places = {f"c{k}": c for k, c in enumerate(docs.columns) if c != "text"}
    kept = drop_repeats(docs.select(*[docs[f"`{c}`"].alias(p) for p, c in places.items()], "text"))
    at = kept.select(F.struct(*places).alias("carried"), "kept")
    out = at.mapInArrow(decode, f"carried {at.schema['carried'].dataType.simpleString()}, text string").select("carried.*", "text")
    return out.select(*[F.col("text") if c == "text" else F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
