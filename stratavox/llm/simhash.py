"""SimHash near-duplicates: tiles of fingerprints compared exactly by exclusive-or and bit counts."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Sieve, id_text, release, settle, slices
from .components import Forest, components

SEED = 42
#: Fingerprints that one side of a tile comparison holds, about.
TILE = 8192
#: Cells of a comparison that are in memory at a time.
CELLS = 1 << 19
#: Shingles whose bits are counted at a time.
VOTES = 1 << 15
#: Shingle sets, and shingles, that an exact comparison holds at a time, about; sets of a larger group
#: that meet all of it first.
SETS, SET_SHINGLES, PIVOTS = 1024, 1 << 20, 8
#: Bands that propose near copies, and the least hashes in each: the least of a set under a hash
#: function is that of another with their similarity as probability. At 0.8 all bands miss with
#: (1 - 0.8 ** 4) ** 24 = 3e-6, at 0.3 a pair shares a band with 0.18, at 0.1 with 0.002.
BANDS, LEAST = 24, 4
#: Similarity from which texts are near copies, as a fraction of integers.
ALIKE = (4, 5)
#: Bits, of 64 and of 256, within which texts are proposed as near copies. At a similarity of 0.8 a bit
#: differs with probability acos(2 * 0.8 / 1.8) / pi = 0.151: more than NARROW of 64 do with 2.9e-6, more
#: than WIDE of 256 with 3.6e-8. For unions of 20 to 45
#: shingles both together miss 7e-6, below 20 up to 2e-4 (ties of the votes).
NARROW, WIDE = 24, 72


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th further hash of each 64-bit hash (k = 0: itself)."""
    if not k:
        return h
    z = h + np.uint64((0x9E3779B97F4A7C15 * k) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 (seed 42) of each run of `words` words, A-Z lower-cased, joined by spaces; of fewer, of all."""
    found = text.lower().split()
    if not found:
        return []
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(found), SEED)]
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-words]]).tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(line)
    return [digest(view[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]


def majority(hashes: np.ndarray, copies: int) -> list[np.ndarray]:
    """`copies` words of 64 bits: a bit is set where more than half of the hashes have it."""
    out = []
    for k in range(copies):
        votes = np.zeros(64, np.int64)
        for at in range(0, len(hashes), VOTES):
            bits = np.unpackbits(_mixed(hashes[at : at + VOTES], k).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])
    return out


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def distinct_hashes(text: bytes, words: int) -> np.ndarray:
    """The different shingle hashes of a text, in order."""
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def text_mark(text: Column) -> Column:
    """XXH64 (seed 42) of a text, as a signed long; with its doc_id it names a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS keys (signed longs) of each set of hashes, one row a set: mixes of LEAST least hashes each.
    Sets that are empty have zeros."""
    size = np.array([len(x) for x in sets], np.int64)
    out = np.zeros((len(sets), BANDS), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        data = np.concatenate([sets[i] for i in some.tolist()]).astype(np.uint64)
        starts = np.cumsum(size[some]) - size[some]
        for band in range(BANDS):
            key = np.full(len(some), band, np.uint64)
            for k in range(LEAST):
                add, times = (int(_mixed(np.array([2 * (band * LEAST + k) + x], np.uint64), 1)[0]) | 1 for x in (0, 1))
                key = _mixed(key ^ np.minimum.reduceat((data ^ np.uint64(add)) * np.uint64(times), starts), 1)
            out[some, band] = key
    return out.view(np.int64)


def set_prints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, mark (text_mark), f0 to f3 (majority of the different shingles, each with one vote),
    d0, d1 (XXH3 of the set of shingles), size (of that set) and bands (band_keys), of every whole text."""
    names = ["mark", "f0", "f1", "f2", "f3", "d0", "d1", "size"]

    def run(batches):
        for batch in batches:
            for doc_ids, texts in slices(batch):
                sets = [distinct_hashes(t, words) for t in texts]
                rows = []
                for t, found in zip(texts, sets, strict=True):
                    d = xxhash.xxh3_128_intdigest(found.astype("<u8").tobytes())
                    rows.append([_signed(int(x)) for x in (xxhash.xxh64_intdigest(t, SEED), *majority(found, 4), d >> 64, d & (2**64 - 1), len(found))])
                columns = np.array(rows, np.int64).reshape(-1, len(names)).T
                bands = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, pa.array(band_keys(sets).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), *[pa.array(np.ascontiguousarray(c)) for c in columns], bands], names=["doc_id", *names, "bands"])
        release()

    return id_text(docs, binary=True).mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", bands array<long>")


def fingerprints(docs: DataFrame, words: int = 3, copies: int = 1) -> DataFrame:
    """doc_id, f0 ... and mark (text_mark) as signed longs, of every whole text; a text without words has zeros."""
    names = [f"f{k}" for k in range(copies)]

    def run(batches):
        for batch in batches:
            for doc_ids, texts in slices(batch):
                prints = [majority(np.array(shingle_hashes(t, words), np.uint64), copies) for t in texts]
                columns = np.array(prints, np.uint64).view(np.int64).reshape(-1, copies).T
                marks = np.array([xxhash.xxh64_intdigest(t, SEED) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), *[pa.array(np.ascontiguousarray(c)) for c in columns], pa.array(marks)], names=["doc_id", *names, "mark"])
        release()

    return id_text(docs, binary=True).mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", mark long")


def _compare(values: np.ndarray, side: np.ndarray, radius: int, wide: int | None) -> list[tuple[int, int]]:
    """Links that join all fingerprints of a tile pair (rows: fingerprint words) within the radius.

    side: 0 left, 1 right; all 0: the tile against itself. Rows are sorted by their bit count, so
    each block of rows meets only those whose bit counts are within the radius.
    """
    first = values[:, 0]
    weight = np.bitwise_count(first).astype(np.int64)
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(side)),) * 2
    left, right = left[np.argsort(weight[left], kind="stable")], right[np.argsort(weight[right], kind="stable")]
    if not len(left) or not len(right):
        return []
    forest, links = Forest(len(values)), []

    def meet(rows: np.ndarray, others: np.ndarray) -> None:
        block = max(1, CELLS // len(others))
        weights = weight[others]
        for at in range(0, len(rows), block):
            some = rows[at : at + block]
            a, b = np.searchsorted(weights, weight[some[0]] - radius, "left"), np.searchsorted(weights, weight[some[-1]] + radius, "right")
            i, j = np.nonzero(np.bitwise_count(first[some][:, None] ^ first[others[a:b]][None, :]) <= radius)
            i, j = some[i], others[a:b][j]
            keep = (i != j) & (forest.root[i] != forest.root[j])
            i, j = i[keep], j[keep]
            if wide is not None:
                far = np.bitwise_count(values[i] ^ values[j]).sum(axis=1, dtype=np.int64) <= wide
                i, j = i[far], j[far]
            links.extend(forest.add(i, j))

    # A few rows meet all. Then a link between two groups has an end outside the largest of them, so
    # that only the rows outside it need to meet all.
    meet(left[:: max(1, len(left) // 4)], right)
    outside = forest.root != np.bincount(forest.root).argmax()
    meet(left[outside[left]], right)
    if side.any():
        meet(right[outside[right]], left)
    return links


def _tiles(rows: DataFrame, key: list[str], weight: Column, radius: int, tile: int) -> DataFrame:
    """Rows dealt to tile pairs: each key's rows fall into tiles by bit count and hash, of about
    `tile` rows, and a row goes to each pair of its tile with a tile within the radius. Keys of one
    row go. Columns: those of rows, pair (string-free key of the comparison), side."""
    counts = rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1") if key else None
    at = rows.join(counts, key) if key else rows.withColumn("n", F.lit(rows.count()))
    parts = F.ceil(F.col("n") / tile).cast("int")
    # Heavy keys only are cut; in them the tiles are spans of bit counts as wide as the radius. A
    # large radius spans nearly all bit counts, and leaves the skipping to the blocks of a tile.
    span = F.when((parts > 1) & F.lit(radius < 8), F.floor(weight / (radius + 1))).otherwise(0).cast("int")
    at = at.select("*", span.alias("span"), F.when(parts > 1, F.pmod(F.xxhash64("f0", F.lit(7)), parts)).otherwise(0).cast("int").alias("part"), parts.alias("parts"))
    others = F.explode(F.when(F.col("parts") > 1, F.flatten(F.transform(F.array(*[F.col("span") + d for d in ((-1, 0, 1) if radius < 8 else (0,))]), lambda s: F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(s.alias("span"), p.cast("int").alias("part")))))).otherwise(F.array(F.struct(F.col("span").alias("span"), F.col("part").alias("part")))))
    at = at.select("*", F.struct("span", "part").alias("own"), others.alias("other"))
    pair = F.xxhash64(*key, F.least("own", "other"), F.greatest("own", "other"))
    return at.select(*[c for c in rows.columns if c not in key], pair.alias("pair"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).cast("int").alias("side"))


def links(prints: DataFrame, radius: int, wide: int | None = None, bits: int = 64, tile: int = TILE) -> DataFrame:
    """(u, v) links that connect all different fingerprints which are linked at all.

    prints: node long, f0 ... long, one row for each different fingerprint. For a small radius r,
    two fingerprints within it are equal in 3 of r + 3 blocks of bits at least; tiles then hold
    fingerprints that share three blocks. For a large one tiles hold fingerprints that share one of
    their `bands` (array of keys), if there is such a column; without, all tiles meet. Tiles whose bit
    counts are too far apart do not meet.
    """
    names = [c for c in prints.columns if c.startswith("f")]
    weight = F.bit_count("f0")
    if radius <= 4:
        n = radius + 3
        edges = [bits * k // n for k in range(n + 1)]
        masks = [sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in some) for some in combinations(range(n), 3)]
        signed = [m - 2**64 if m >= 2**63 else m for m in masks]
        table = F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.col("f0").bitwiseAND(F.lit(m)).alias("k")) for k, m in enumerate(signed)]))
        rows = prints.select("*", table.alias("x")).select("node", *names, "x.t", "x.k")
        dealt = _tiles(rows, ["t", "k"], weight, radius, tile)
    elif "bands" in prints.columns:
        dealt = _tiles(prints.select("node", *names, F.explode("bands").alias("k")), ["k"], weight, radius, tile)
    else:
        dealt = _tiles(prints, [], weight, radius, tile)
    dealt = dealt.repartition("pair").sortWithinPartitions("pair", "f0")

    def run(batches):
        held: list[pa.RecordBatch] = []
        done = pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=["u", "v"])

        def compare(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows)
            pair, node, side = (table.column(c).to_numpy() for c in ("pair", "node", "side"))
            values = np.stack([table.column(c).to_numpy() for c in names], axis=1).view(np.uint64)
            cuts = np.flatnonzero(np.diff(pair)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(pair)]])
            size = ends - starts
            found: list[tuple[int, int]] = []
            # Short groups together: each row meets the one d rows further on, if in the same group.
            small = np.repeat(size <= 32, size)
            for d in range(1, 1 + int(min(31, size.max(initial=1) - 1))):
                i = np.flatnonzero(small[:-d] & (pair[:-d] == pair[d:]) & ((side[:-d] != side[d:]) | (side[:-d] == 0)))
                i = i[np.bitwise_count(values[i, 0] ^ values[i + d, 0]) <= radius]
                if wide is not None:
                    i = i[np.bitwise_count(values[i] ^ values[i + d]).sum(axis=1, dtype=np.int64) <= wide]
                found += zip(i.tolist(), (i + d).tolist(), strict=True)
            for a, b in zip(starts[size > 32].tolist(), ends[size > 32].tolist(), strict=True):
                found += [(a + i, a + j) for i, j in _compare(values[a:b], side[a:b], radius, wide)]
            u, v = (node[np.array([x[k] for x in found], np.int64)] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        last = None
        for batch in batches:  # a group can go on in the next batch: hold back the last group
            if not batch.num_rows:
                continue
            pair = batch.column("pair").to_numpy()
            cut = int(np.searchsorted(pair, pair[-1], "left"))
            if held and (last != pair[-1] or cut > 0):
                held.append(batch.slice(0, cut))
                yield compare([b for b in held if b.num_rows])
                held = [batch.slice(cut)]
            elif held:
                held.append(batch)
            else:
                if cut:
                    yield compare([batch.slice(0, cut)])
                held = [batch.slice(cut)]
            last = pair[-1]
        yield compare(held) if held else done

    return dealt.mapInArrow(run, "u long, v long")


def similar_pairs(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join all sets (different values each) that a chain of similarities of 0.8 or more joins."""
    n, size = len(sets), np.array([len(x) for x in sets], np.int64)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if ALIKE[1] * both >= ALIKE[0] * (size.sum() - both) else []
    owner = np.repeat(np.arange(n), size)
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(at, kind="stable")
    holders, ends = owner[order], np.cumsum(np.bincount(at, minlength=len(values)))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    firsts = np.concatenate([[0], np.cumsum(size)])
    forest, found, met = Forest(n), [], np.zeros(n, bool)
    while True:
        # A link between two groups has an end outside the largest: only those sets need to meet all.
        left = np.flatnonzero(~met & (forest.root != np.bincount(forest.root).argmax()))
        if not len(left):
            return found
        i = int(left[0])
        met[i] = True
        mine = at[firsts[i] : firsts[i + 1]]
        both = np.zeros(n, np.int64)
        if len(mine):
            both = np.bincount(np.concatenate([holders[starts[k] : ends[k]] for k in mine.tolist()]), minlength=n)
        j = np.flatnonzero(ALIKE[1] * both >= ALIKE[0] * (size[i] + size - both))
        j = j[j != i]
        found += forest.add(np.full(len(j), i), j)


def exact_links(docs: DataFrame, kinds: DataFrame, groups: DataFrame, words: int, tile: int = SETS) -> DataFrame:
    """(u, v) links by the exact similarity of shingle sets, 0.8 or more, that connect all nodes of a
    group which such links connect at all.

    kinds: node, size and first (doc_id and mark of one of its texts); groups: node, component, within
    which links are looked for. Groups over `tile` nodes (or SET_SHINGLES shingles) are dealt to parts;
    a part is compared with itself and some PIVOTS sets of all parts. A link that is still missing has
    an end outside the largest class of its group: the sets outside it then meet all of the group.
    """
    light = settle(kinds.join(groups, "node").select("component", "node", "size", F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark")))
    sieve = Sieve.of(light, "_mark")

    def shingled(batches):
        for batch in batches:
            for ids, found in slices(batch):
                marks = np.array([xxhash.xxh64_intdigest(t, SEED) for t in found], np.uint64).view(np.int64)
                some = np.flatnonzero(sieve.passes(marks))
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in some.tolist()], pa.int64()), pa.array(marks[some]), pa.array([distinct_hashes(found[i], words).tobytes() for i in some.tolist()], pa.binary())], names=["own_id", "own_mark", "hashes"])
        release()

    whole = id_text(docs, binary=True).mapInArrow(shingled, "own_id long, own_mark long, hashes binary")
    sets = whole.join(light, (whole["own_id"] == light["_id"]) & (whole["own_mark"] == light["_mark"])).groupBy("node").agg(F.first("hashes").alias("hashes"))
    n, held = F.count("*"), F.sum("size")
    sizes = light.groupBy("component").agg(n.alias("n"), F.ceil(F.greatest(n / tile, held / SET_SHINGLES)).cast("int").alias("parts"))
    large = settle(sizes.filter("parts > 1"))
    if not large.head(1):
        return _similar(light.select("node", F.xxhash64("component").alias("pair")), sets)
    sets = settle(sets)
    at = light.select("component", "node").join(large, "component", "left")
    at = settle(at.select("component", "node", F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("parts", F.lit(1)).alias("parts"), F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    own = at.select("node", F.xxhash64("component", "part").alias("pair"))
    pivots = at.filter("parts > 1").filter(F.pmod(F.xxhash64("node", F.lit(3)), F.col("n")) < PIVOTS).select("node", "component", "part", every.alias("other")).filter("other <> part")
    found = settle(_similar(own.union(pivots.select("node", F.xxhash64("component", "other"))), sets))
    big = at.filter("parts > 1")
    classes = components(found)
    classed = big.join(classes.withColumnRenamed("component", "class"), "node", "left").withColumn("class", F.coalesce("class", "node"))
    largest = classed.groupBy("component", "class").agg(F.count("*").alias("m")).groupBy("component").agg(F.max_by("class", F.struct("m", "class")).alias("most"))
    outside = settle(classed.join(largest, "component").filter(F.col("class") != F.col("most")).select("component", "node", "parts"))
    cuts = outside.groupBy("component").agg(F.ceil(F.count("*") / tile).cast("int").alias("cuts"))
    few = outside.join(cuts, "component").select("component", "node", F.pmod(F.xxhash64("node", F.lit(5)), "cuts").cast("int").alias("cut"), every.alias("part"))
    all_ = big.join(cuts, "component").select("component", "node", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"), "part")
    again = few.select("component", "node", "cut", "part").union(all_.select("component", "node", "cut", "part")).distinct()
    return found.union(_similar(again.select("node", F.xxhash64("component", "cut", "part").alias("pair")), sets))


def _similar(dealt: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v) links of similar_pairs() within each pair of dealt (node, pair); sets: node, hashes."""

    def run(batches):
        pair, nodes, held = None, [], []

        def compare() -> pa.RecordBatch:
            found = similar_pairs(held) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[x[k]] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            for p, node, hashes in zip(*(batch.column(c) for c in ("pair", "node", "hashes")), strict=True):
                if p.as_py() != pair:
                    if len(held) > 1:
                        yield compare()
                    pair, nodes, held = p.as_py(), [], []
                nodes.append(node.as_py())
                held.append(np.frombuffer(hashes.as_py(), np.uint64))
        yield compare()
        release()

    return dealt.join(sets, "node").repartition("pair").sortWithinPartitions("pair").mapInArrow(run, "u long, v long")


def similar_classes(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """(rows, kinds): set_prints() of every row, and of each different set of shingles f0 ... d1, the
    first (doc_id, mark) and its class. SimHash only proposes; exact_links() decides."""
    names = [f"f{k}" for k in range(4)]
    prints = settle(set_prints(docs, words))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))
    kinds = prints.groupBy(*names, "d0", "d1").agg(F.min(named).alias("first"), F.max("size").alias("size"), F.max("bands").alias("bands")).filter("first is not null")
    kinds = settle(kinds.withColumn("node", F.monotonically_increasing_id()))
    proposed = components(links(kinds.filter("size > 0").select("node", *names, "bands"), NARROW, WIDE))
    classes = components(exact_links(docs, kinds, proposed, words))
    return prints, kinds.join(classes, "node", "left").select(*names, "d0", "d1", "first", F.coalesce("component", "node").alias("class"))


def print_classes(docs: DataFrame, words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """(rows, kinds): fingerprints() of every row, and of each f0 the first (doc_id, mark) and its class."""
    prints = settle(fingerprints(docs, words))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))
    kinds = prints.groupBy("f0").agg(F.min(named).alias("first")).filter("first is not null")
    # Different texts can share a doc_id: a node is the number of a kind.
    kinds = settle(kinds.withColumn("node", F.monotonically_increasing_id()))
    classes = components(links(kinds.select("node", "f0"), radius))
    return prints, kinds.join(classes, "node", "left").select("f0", "first", F.coalesce("component", "node").alias("class"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, similar: bool = False) -> DataFrame:
    """doc_id, f0 and component_id (the smallest doc_id reachable by links) of every document.

    similar=False: fingerprints link at `radius` differing bits or fewer. similar=True: texts link
    at a similarity of 0.8 or more of their sets of shingles, compared exactly where the fingerprints
    (one vote for each different shingle) are within NARROW of 64 bits and WIDE of 256 and one of
    BANDS bands of least hashes is shared. A null or
    empty text has fingerprint zero and links like any other. Documents of equal fingerprints (equal
    sets, if similar) are compared once. A null doc_id names no class: such a row gets the class of
    its fingerprint, null if no other row has it. Repeated rows stay; a text of any length gives all
    its shingles; an empty table gives no rows.
    """
    if similar:
        prints, kinds = similar_classes(docs, words)
        least = kinds.groupBy("class").agg(F.min("first.doc_id").alias("component_id"))
        key = ["f0", "f1", "f2", "f3", "d0", "d1"]
        return prints.join(kinds.join(least, "class").select(*key, "component_id"), key, "left").select("doc_id", "f0", "component_id")
    prints, kinds = print_classes(docs, words, radius)
    least = kinds.groupBy("class").agg(F.min("first.doc_id").alias("component_id"))
    return prints.join(kinds.join(least, "class").select("f0", "component_id"), ["f0"], "left").select("doc_id", "f0", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, similar: bool = True, radius: int = 2) -> DataFrame:
    """The rows of docs, all columns, with one document (the least doc_id, and of its texts the least
    text_mark) of each class of near_duplicates(). Different texts of one doc_id are told apart; of
    repeated rows one stays; rows without a doc_id all stay; a null text is an empty one; column names
    are free; an empty table gives no rows."""
    kinds = (similar_classes(docs, words) if similar else print_classes(docs, words, radius))[1]
    found = kinds.groupBy("class").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_kept_id"), F.col("first.mark").alias("_kept_mark"))
    # Columns by position, so that none of docs' names can clash with an added one.
    places = {f"c{k}": c for k, c in enumerate(docs.columns)}
    rows = docs.select(*[docs[f"`{c}`"].alias(p) for p, c in places.items()])
    own_id, text = (next(p for p, c in places.items() if c == name) for name in ("doc_id", "text"))
    named = rows.filter(F.col(own_id).isNotNull()).withColumn("_text_mark", text_mark(F.col(text)))
    kept = named.join(found, (named[own_id] == found["_kept_id"]) & (named["_text_mark"] == found["_kept_mark"]), "left_semi").dropDuplicates([own_id, "_text_mark"]).drop("_text_mark")
    return kept.unionByName(rows.filter(F.col(own_id).isNull())).select(*[F.col(p).alias(c) for p, c in places.items()])
