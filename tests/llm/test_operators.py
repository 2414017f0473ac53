"""The ten operators against brute force on a small fixture of odd rows, and on empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratavox.llm import bpe, chat, components, fingerprints, licenses, lines, packing, quality, simhash, suffixes, toxicity

RANKS, WORDS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
#: Clashing names: those that the operators use inside.
EXTRA = ("piece", "length", "nth", "row", "range", "keys", "kept", "n_lines", "component_id", "sketch", "fence", "lo", "_text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéü") for _ in range(r.randint(2, 8))) for _ in range(n))


def odd_texts() -> list[tuple[int | None, str | None]]:
    long = words(3000, 1)
    near = words(300, 2)
    passage = words(60, 3)
    out: list[tuple[int | None, str | None]] = [
        (1, None), (2, ""), (3, "  \t\n "), (4, "one"), (5, "two words"), (6, long), (7, long), (8, near), (9, near.replace(near.split()[100], "other", 1)),
        (10, words(80, 4) + " " + passage + " " + words(50, 5)), (11, words(30, 6) + " " + passage + "\n" + words(70, 7)), (11, words(40, 8)), (12, words(40, 9)), (12, words(40, 9)),
        (None, words(30, 10)), (None, None), (13, "x" * 5000), (14, "é漢字🎉 ½²  a\r\nb\x1cb \x85" * 30), (15, "ab" * 700), (16, "A B c\na b C\n\nA b c"), (17, "don't  stop \n\n  now " * 9),
        (18, "Licensed under the Apache License, Version 2.0."), (19, "RELEASED under the  mit licence"), (20, words(90, 11) + "\nCopyright (c) 2020 X\nReleased under the MIT License.\n"),
    ]
    return out + [(100 + k, f"  Shared LINE é\n{words(12, 50 + k)}\nshared line é\t") for k in range(12)]


@pytest.fixture(scope="module")
def rows():
    return odd_texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, *EXTRA) for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def same(found, wanted) -> None:
    assert Counter(map(repr, found)) == Counter(map(repr, wanted))


def test_byte_bpe(docs, rows, empty):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    ids = [(i, known.encode_ordinary(t or ""), t or "") for i, t in rows]
    got = bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    same([tuple(r) for r in got], [(i, len(x), sha(np.array(x, "<u4").tobytes()), sha(t.encode())) for i, x, t in ids])
    assert bpe.encode_digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    r = random.Random(5)
    for _ in range(3000):
        t = "".join(r.choice("aabc  \n\t'sé1²Ⅷ漢🎉_.,\x1c\x85　lythe") for _ in range(r.randint(0, 40)))
        out = codec.encode_batch(pa.array([t]))[0]
        assert np.frombuffer(out, "<u4").tolist() == known.encode_ordinary(t)
        assert codec.decode(out).decode() == t


def test_packing(docs, rows, empty):
    t = Tokenizer.from_file(WORDS)
    wanted = []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        wanted += [(i, k, at, len(ids[at : at + 64]), zlib.crc32(np.array(ids[at : at + 64], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 64))]
    got = packing.pack(docs, WORDS, capacity=64).collect()
    same([tuple(r)[:5] for r in got], wanted)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] and sum(n for _, n in s) <= 64
    assert len(sequences) <= sum(r["length"] for r in got) / 64 * 1.1 + 1
    assert packing.pack(empty, WORDS).count() == 0


def test_words_like_the_tokenizer():
    """Added tokens anywhere, control characters, all Latin letters, other scripts, and a text of 600,000 characters."""
    t, codec, r = Tokenizer.from_file(WORDS), packing.word_codec(WORDS), random.Random(7)
    parts = ["a", "B", "é", "İ", "ß", "\u0301", "\x1c", "\x85", " ", " ", " ", "\n", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", "'s", "'LL", "12", "½", "中文", "ﬁ", "!!", "don't", "Ω", "K", "\u3000", "...", '"', *map(chr, range(0x21, 0x260))]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(4000)]
    texts += ["", " ", "a <|endoftext|> b", "in<|endoftext|>side", "".join(r.choice(parts) for _ in range(300_000))]
    got = codec.encode_batch(pa.array(texts, pa.string()))
    assert got == [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert len(codec.encode_batch(pa.array(["a <|endoftext|> b"]))[0]) == 12


def test_packing_plans():
    r = random.Random(1)
    for _ in range(200):
        cap = r.choice([10, 50, 100])
        counts = {r.randint(1, cap): r.randint(1, 30) for _ in range(r.randint(1, 20))}
        bins, seen = defaultdict(list), defaultdict(set)
        for n, first, many, each, sequence, offset in packing.plan(counts, cap):
            for j in range(many):
                for e in range(each):
                    bins[sequence + j].append((offset + e * n, n))
                    seen[n].add(first + j * each + e)
        assert {n: len(s) for n, s in seen.items()} == counts and all(s == set(range(counts[n])) for n, s in seen.items())
        for b in bins.values():
            b.sort()
            assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= cap
            assert sum(3 * n > cap for _, n in b) <= 2


def test_fingerprints(docs, rows, empty, spark):
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    texts = [t or "" for _, t in order]
    got = fingerprints.edited_fingerprints(docs).collect()
    wanted = []
    for k, (i, _) in enumerate(order):
        t, n = texts[k], texts[(k + 1) % len(texts)]
        cut = len(t) // 4
        wanted.append((i, len(t), sha((t[: len(t) - cut] + n[:cut]).encode())))
    same([tuple(r)[:3] for r in got], wanted)
    of = defaultdict(set)
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        of[r["doc_id"]].add(r["fingerprint"])
    assert of[6] == of[7] and len(of[12]) == 1 and of[8] != of[9]
    assert next(r for r in got if r["doc_id"] == 6)["near_next"] == 1
    assert next(r for r in got if r["doc_id"] == 8)["near_next"] > 0.8
    assert fingerprints.edited_fingerprints(empty).count() == 0
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1


def plain_sketches(spark, texts: list[str]) -> list[set[int]]:
    """All hashes of 5-word shingles, each from Spark's hash of a literal row, below a quarter of 2^64."""
    parts = [(w := [x for x in re.split("[\x20\x09-\x0d]+", t.lower()) if x], [tuple(w[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [(" ".join(w),)] if w else [])[1] for t in texts]
    five = sorted({p for own in parts for p in own if len(p) == 5})
    less = sorted({p for own in parts for p in own if len(p) == 1})
    hashed = dict(zip(five, (r[0] for r in spark.createDataFrame(five, "a string, b string, c string, d string, e string").select(F.xxhash64("*")).collect()), strict=True))
    hashed |= dict(zip(less, (r[0] for r in spark.createDataFrame(less, "a string").select(F.xxhash64("a")).collect()), strict=True))
    return [{hashed[p] for p in own if 0 <= hashed[p] < 2**62} for own in parts]


def test_fingerprint_values(docs, rows, spark):
    """Sketches, likenesses and containments against brute force over every shingle."""
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    texts = [t or "" for _, t in order]
    nexts = texts[1:] + texts[:1]
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, nexts, strict=True)]
    sketches = plain_sketches(spark, texts + edited)
    own, changed = sketches[: len(texts)], sketches[len(texts) :]
    shown = lambda s: "".join(f"{h:016x}" for h in sorted(s))
    gap = lambda t: re.split("[\x20\x09-\x0d]+", t.lower().strip(" \t\n\v\f\r"))
    like = lambda a, b, t, u: len(a & b) / len(a | b) if a | b else float(gap(t) == gap(u))
    part = lambda a, b: len(a & b) / len(a) if a else 1.0
    wanted = []
    for k, (i, t) in enumerate(zip([i for i, _ in order], texts, strict=True)):
        a, e, n = own[k], changed[k], own[(k + 1) % len(own)]
        wanted.append((i, shown(a), shown(e), like(a, e, t, edited[k]), like(a, n, t, nexts[k]), part(a, e), part(a, n)))
    got = fingerprints.edited_fingerprints(docs).select("doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "contained_edited", "contained_next").collect()
    same([tuple(r) for r in got], wanted)
    assert any(not x and t for x, t in zip(own, texts, strict=True))


def test_merged_sketches_are_sketches_of_the_union(spark):
    pairs = [(words(3 + k % 4, 20 + k), words(60 + k, 40 + k)) for k in range(30)]
    frame = spark.createDataFrame(pairs, "a string, b string")
    for c in "ab":
        frame = frame.withColumn(c, fingerprints.words_of(F.col(c))).withColumn(c, fingerprints.hashes_of(c))
    frame = frame.withColumn("both", F.concat("a", "b"))
    for r in frame.select(fingerprints.merged(fingerprints.sketch_of("a"), fingerprints.sketch_of("b")).alias("m"), fingerprints.sketch_of("both").alias("s")).collect():
        assert r["m"] == r["s"]


def test_fingerprint_likeness_is_near_the_truth(spark):
    """On texts of 300 words, the likeness is within 0.1 of the Jaccard likeness of all shingles, on average 0.03."""
    r, pairs = random.Random(12), []
    for k in range(120):
        a = words(300, 6000 + k).split()
        b = [w if r.random() > k / 1000 else f"new{i}" for i, w in enumerate(a)]
        pairs.append((a, b))
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    truth = [len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for a, b in pairs]
    frame = spark.createDataFrame([(k, " ".join(a), " ".join(b)) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    for c in "ab":
        frame = frame.withColumn(c, fingerprints.words_of(F.col(c))).withColumn(c, fingerprints.hashes_of(c)).withColumn(c, fingerprints.sketch_of(c))
    found = [x["n"] for x in frame.orderBy("k").select(fingerprints.likeness("a", "b", F.lit(False)).alias("n")).collect()]
    off = [abs(x - y) for x, y in zip(found, truth, strict=True)]
    assert sum(off) / len(off) < 0.035 and sorted(off)[int(0.95 * len(off))] < 0.1


def repeated(rows):
    """Brute force over all strings of 200 bytes."""
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + 200] for _, b in data for k in range(len(b) - 199))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), len(b) - len(kept), sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])), kept))
    return out


@pytest.mark.parametrize("bucket", [suffixes.BUCKET, 1])
def test_suffixes(docs, rows, empty, bucket):
    got = suffixes.drop_repeats(docs, bucket).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    same([(*tuple(r)[:4], bytes(r["kept"])) for r in got], repeated(rows))
    assert suffixes.drop_repeats(empty, bucket).count() == 0


def test_suffix_texts_stay_text(spark):
    t = "é" * 150
    df = spark.createDataFrame([(1, "a" + t, "l"), (2, "bc" + t, "l")], "doc_id long, text string, lang string")
    out = suffixes.without_repeats(df)
    assert out.columns == df.columns and [r["text"] for r in out.orderBy("doc_id").collect()] == ["a", "bc"]


def key(line: str) -> bytes:
    return line.encode().strip(b" \t\n\v\f\r").lower()


@pytest.mark.parametrize("small", [True, False])
def test_lines(docs, rows, empty, monkeypatch, small):
    if not small:  # the filters go to tasks by shard, heavy shards to several
        monkeypatch.setattr(lines, "FILTER_BYTES", 0)
        monkeypatch.setattr(lines, "SHARD_ROWS", 10)
        monkeypatch.setattr(lines, "SHARD_KEYS", 1)
    texts = [(i, t or "") for i, t in rows]
    count = Counter(k for _, t in texts for k in set(map(key, t.split("\n"))) if k)
    wanted = []
    for i, t in texts:
        parts = t.split("\n")
        stay = [p for p in parts if not key(p) or count[key(p)] < 10]
        wanted.append((i, len(parts), len(parts) - len(stay), "\n".join(stay)))
    got = lines.drop_common_lines(docs, 10).select("doc_id", "n_lines", "n_dropped", "text").collect()
    same([tuple(r) for r in got], wanted)
    assert sum(r["n_dropped"] for r in got) == 24
    assert lines.drop_common_lines(empty).count() == 0


def test_line_index_is_reversible(docs):
    half, rest = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    index = lines.LineIndex.of(half, 8)
    text = lambda x: sorted(r["text"] for r in x.clean(docs).collect())
    before = text(index)
    grown = index.insert(rest)
    assert text(grown) == text(lines.LineIndex.of(docs.filter("doc_id is not null"), 8)) != before
    assert text(grown.delete(rest)) == before


def test_cuckoo_filter():
    r = np.random.default_rng(0)
    high, low = r.integers(0, 2**63, (2, 5000)).astype(np.uint64)
    f = lines.CuckooFilter.of(high, low)
    assert f.contains(high, low).all()
    assert f.contains(*r.integers(0, 2**63, (2, 5000)).astype(np.uint64)).mean() < 0.01
    f.delete(high[:2000], low[:2000])
    assert f.contains(high[2000:], low[2000:]).all() and f.contains(high[:2000], low[:2000]).mean() < 0.01
    assert not f.table.any() or f.insert(high[:2000], low[:2000])


def simple_print(text: str, n: int) -> int:
    w = text.encode().lower().split()
    parts = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in near:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash(docs, rows, empty):
    known = [(i, simple_print(t or "", 3)) for i, t in rows]
    named = [(i, f) for i, f in known if i is not None]
    near = [(a, b) for a, f in named for b, g in named if (f ^ g).bit_count() <= 2]
    wanted = classes({i for i, _ in named}, near)
    got = simhash.near_duplicates(docs).collect()
    same([(r["doc_id"], r["f0"] & (2**64 - 1)) for r in got], known)
    assert all(r["component_id"] == wanted[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert simhash.near_duplicates(empty).count() == 0
    three = docs.sparkSession.createDataFrame([(1, words(90, 70)), (1, words(90, 71)), (2, words(90, 72)), (2, words(90, 72))], "doc_id long, text string")
    for similar in (True, False):
        assert sorted(r["doc_id"] for r in simhash.one_of_each(three, similar=similar).collect()) == [1, 1, 2]
    kept = {r["doc_id"] for r in simhash.one_of_each(docs).collect()}
    assert 6 in kept and 7 not in kept and 8 in kept and 9 not in kept and {10, 11, 12, 13} <= kept


@pytest.mark.parametrize("few", [0, components.FEW])
def test_components(spark, few):
    r = random.Random(4)
    near = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 540)] + [(7, 7)]
    found = components.components(spark.createDataFrame([*near, *near[:20], (None, 3)], "u long, v long"), few).collect()
    linked = {x for e in near if e[0] != e[1] for x in e}
    assert {r["node"]: r["component"] for r in found} == classes(linked, [e for e in near if e[0] != e[1]]) and len(found) == len(linked)
    assert components.components(spark.createDataFrame([], "u long, v long"), few).count() == 0


def test_bucket_pointers():
    r = np.random.default_rng(3)
    for size, letters in ((0, 2), (199, 2), (200, 1), (700, 1), (3000, 2), (5000, 200)):
        data = r.integers(0, letters, size).astype(np.uint8)
        data[size // 2 : size // 2 + 300] = data[:300][: len(data[size // 2 : size // 2 + 300])]
        found = suffixes.refined_buckets(data).tolist()
        windows = [data[i : i + 200].tobytes() for i in range(max(0, size - 199))]
        assert len(found) == len(windows) and len(set(zip(found, windows, strict=True))) == len(set(windows)) == len(set(found))


@pytest.mark.parametrize("tile", [8, simhash.TILE])
def test_links_in_tiles(spark, tile):
    r = random.Random(2)
    prints = {r.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:60]:
        for _ in range(4):
            prints.add(p ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    prints = sorted(prints)
    for radius in (2, 17):
        found = simhash.links(spark.createDataFrame([(i, p - 2**64 if p >= 2**63 else p) for i, p in enumerate(prints)], "node long, f0 long"), radius, tile=tile)
        near = [(i, j) for i, p in enumerate(prints) for j in range(i) if (p ^ prints[j]).bit_count() <= radius]
        assert classes(range(len(prints)), [tuple(x) for x in found.collect()]) == classes(range(len(prints)), near)


def test_quality(docs, rows, empty):
    w = re.compile("[^\x20\x09-\x0d]+")
    got = {}
    for r in quality.verdicts(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        t = t or ""
        ws = w.findall(t)
        times = Counter(zip(ws, ws[1:], ws[2:], strict=False))
        cover = {k + d for k in range(len(ws) - 2) if times[tuple(ws[k : k + 3])] > 1 for d in range(3)}
        ls = [x for x in t.split("\n") if w.search(x)]
        want = (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), len(cover))
        own = [r for r in got[i] if tuple(r)[1:6] == want]
        assert own and own[0]["base_failed"] == (len(ws) < 50 or 2 * len(cover) > len(ws)) and not (own[0]["kept"] and own[0]["base_failed"])
    assert quality.verdicts(empty).count() == 0
    book = quality.ledger(docs)
    table = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality.ablations(book, "strict-1").collect()}
    masks = [r["failed"] for r in book.collect()]
    assert table == {r.name: (sum(m >> r.bit & 1 for m in masks), sum(m == 1 << r.bit for m in masks)) for r in quality.RULES}
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and kept.count() == sum(m == 0 for m in masks)


def test_licenses(docs, rows, empty):
    got = defaultdict(list)
    for r in licenses.scan(docs).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert [r["text_license"] for r in got[18] + got[19]] == ["Apache-2.0", "MIT"]
    assert got[20][0]["text_license"] is None and got[20][0]["line_licenses"] == "MIT" and got[20][0]["n_license_lines"] == 1
    assert got[1][0]["digest"] == got[3][0]["digest"] == sha(b"") and got[1][0]["text_license"] is None
    assert licenses.scan(empty).count() == 0
    shuffled = licenses.scan(docs, broadcast_rows=0).collect()
    same([tuple(r) for r in shuffled], [tuple(r) for x in got.values() for r in x])


CHAT = "conv_id long, turn int, role string, text string, block string, part string, cut string"


def plain_viterbi(model, scores) -> list[int]:
    best, back = [int(model.start[s] + scores[0, s]) for s in range(6)], []
    for e in scores[1:].tolist():
        from_ = [max(range(6), key=lambda a, b=b: best[a] + int(model.step[a, b])) for b in range(6)]
        back.append(from_)
        best = [best[from_[b]] + int(model.step[from_[b], b]) + e[b] for b in range(6)]
    path = [max(range(6), key=lambda s: best[s])]
    for from_ in back[::-1]:
        path.append(from_[path[-1]])
    return path[::-1]


def plain_turns(model, conv, rows) -> list[tuple]:
    """(row, turn, role, rendered, rows that begin in it) of the turns that one uncut path gives."""
    t = chat.Transcript.of(conv, [{"turn": n, "role": r, "text": x} for n, r, x in rows])
    out, before = [], None
    for i, (line, state) in enumerate(zip(t.lines, plain_viterbi(model, model.scores(t)), strict=True)):
        role = chat.ROLES[state // 2]
        if state % 2 == 0 or role != before:
            out.append([int(t.rows[i]), rows[t.rows[i]][0], role, [chat.mark(line)[1]], 0])
        else:
            out[-1][3].append(line)
        out[-1][4] += int(i == 0 or t.rows[i] != t.rows[i - 1])
        before = role
    return [(row, turn, role, f"<|{role}|>\n" + "\n".join(x).strip(" \t\n\x0b\f\r") + "\n<|end|>\n", n) for row, turn, role, x, n in out]


@pytest.fixture(scope="module")
def talks():
    r = random.Random(8)
    text = lambda c, t: words(r.randint(3, 14), c * 100_003 + t) + ("?" if t % 2 == 0 else "") + ("\n\n" + words(5, t) if r.random() < 0.2 else "")
    rows = [(c, t, ("system", "user", "assistant")[0 if t == 0 and c % 4 == 0 else 1 + t % 2], text(c, t)) for c in range(60) for t in range(8)]
    rows += [(1000, t, ("user", "assistant")[t % 2], text(1000, t)) for t in range(10_000)]
    return rows + [(1001, t, None if t % 3 else "user", "x\n" * (30_000 if t == 2 else 1)) for t in range(40)]


@pytest.mark.parametrize("block_rows", [97, chat.BLOCK_ROWS])
def test_chat_is_one_path(spark, talks, block_rows):
    df = spark.createDataFrame([(*x, "b", "p", "c") for x in talks], CHAT).repartition(3)
    models = chat.fit(chat.blocks_of(df, block_rows))
    wanted = defaultdict(list)
    for c, *x in talks:
        wanted[c].append(tuple(x))
    wanted = {c: plain_turns(models[chat.fold_of(c)], c, x) for c, x in wanted.items()}
    got = chat.format_conversations(df, block_rows).collect()
    same([(r["conv_id"], r["row"], r["turn"], r["role"], r["rendered"], r["n_rows"]) for r in got], [(c, *x) for c, rows in wanted.items() for x in rows])
    assert any(x[4] > 1 for x in wanted[1001])
    known = [r for r in got if r["conv_id"] != 1001]
    assert sum(r["n_agree"] for r in known) > 0.95 * 10_480


def test_chat_models_do_not_depend_on_blocks(spark, talks):
    df = spark.createDataFrame([(*x, "b", "p", "c") for x in talks], CHAT)
    for a, b in zip(chat.fit(chat.blocks_of(df.repartition(5), 7)), chat.fit(chat.blocks_of(df.coalesce(1), 1000)), strict=True):
        assert all(np.array_equal(getattr(a, x), getattr(b, x)) for x in ("start", "step", "emit"))


def test_chat_odd_rows(spark):
    odd = [(None, None, None, None, "", "", ""), (1, 0, "user", "", "", "", ""), (1, 0, "user", "", "", "", ""), (1, 200, "nobody", "a\n\nb", "", "", "")] + [(2, 3, "user", f"t{k}", "", "", "") for k in range(1200)]
    got = chat.format_conversations(spark.createDataFrame(odd, CHAT)).collect()
    assert sum(r["n_rows"] for r in got) == len(odd) and {r["conv_id"] for r in got} == {None, 1, 2}
    assert chat.format_conversations(spark.createDataFrame([], CHAT)).count() == 0


def test_toxicity(spark, docs, empty):
    r = random.Random(7)
    texts = [(k, words(60, 1000 + k) + (" glurbo" + "".join(r.choice("abc") for _ in range(3))) * (4 if k % 4 == 0 else 0), int(k % 4 == 0)) for k in range(400)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    out = toxicity.score(frame.select("doc_id", "text"), frame.select("doc_id", "toxic")).join(frame, "doc_id").collect()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.97 * len(held)
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1), (999, 1)], "doc_id long, toxic int")
    odd = toxicity.score(docs, labels)
    assert odd.count() == docs.count() and odd.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(empty, labels.limit(0)).count() == 0


def test_whole_licences(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    mit, isc = ([t for name, t in licenses.KNOWN if name == n and len(t) > 500][0] for n in ("MIT", "ISC"))
    wrapped = isc.replace("provided that the above ", "provided that the above\n").replace("in all copies.", "in all\ncopies.")
    assert "\ncopyright notice and this permission" in wrapped
    given = [("MIT", f"MIT License\n\nCopyright (c) 2020 Some One\n\n{mit}"), ("MIT", mit), ("ISC", f"ISC License\n\nCopyright 2019 Some One\n\n{wrapped}"), ("ISC", isc)]
    given += [(p.stem, p.read_text()) for p in sorted(folder.glob("*.txt"))]
    apache = (folder / "Apache-2.0.txt").read_text()
    given += [("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2021 Some One")), ("Apache-2.0", apache[: apache.index("APPENDIX")]), ("Apache-2.0", " ".join(apache[: apache.index("APPENDIX")].split()))]
    given += [("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n" + (folder / "BSD-3-Clause.txt").read_text())]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(given)], "doc_id long, text string")
    assert {r["doc_id"]: r["text_license"] for r in licenses.scan(docs).collect()} == {k: name for k, (name, _) in enumerate(given)}


def test_very_long_texts(spark):
    """A text of two million characters among short ones, against the plain computation of each operator."""
    r = random.Random(21)
    word = ["".join(r.choice("abcdeéü") for _ in range(r.randint(2, 8))) for _ in range(50_000)]
    long = " ".join(r.choice(word) for _ in range(330_000))
    assert len(long) > 1_800_000
    rows = [(1, long), (2, "short"), (3, long[500_000:500_900]), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {i: t or "" for i, t in rows}
    one = lambda df: {x["doc_id"]: x for x in df.collect()}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    ids = known.encode_ordinary(long)
    assert one(bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN))[1]["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
    plain = [*Tokenizer.from_file(WORDS).encode(long, add_special_tokens=False).ids, 0]
    packed = sorted((x["piece"], x["ids_crc32"]) for x in packing.pack(docs, WORDS).collect() if x["doc_id"] == 1)
    assert packed == [(k, zlib.crc32(np.array(plain[at : at + 2048], "<u4").tobytes())) for k, at in enumerate(range(0, len(plain), 2048))]
    sketch = next(iter(plain_sketches(spark, [long])))
    assert set(one(fingerprints.fingerprints(docs))[1]["sketch"]) == sketch
    removed = one(suffixes.drop_repeats(docs))
    b, part = long.encode(), texts[3].encode()
    at = b.index(part)
    assert bytes(removed[1]["kept"]) == b[:at] + b[at + len(part) :] and not removed[3]["kept"]
    assert one(lines.drop_common_lines(docs))[1]["text"] == long
    assert one(simhash.fingerprints(docs))[1]["f0"] & (2**64 - 1) == simple_print(long, 3)
    assert one(quality.measure(docs))[1]["n_words"] == 330_000
    assert one(licenses.scan(docs))[1]["digest"] == sha(long.lower().encode())


def test_variants_of_whole_licences(spark):
    """Upper case, other wrapping, quotes, spelling and a statement on top make no difference; a word does."""
    texts = [(p.stem, p.read_text()) for p in sorted((Path(licenses.__file__).parent / "license_texts").glob("*.txt"))]
    assert len(texts) >= 24
    given = []
    for name, t in texts:
        given += [(name, t.upper()), (name, "Copyright (c) 1999-2024 Some One <one@example.org>\n\n" + t), (name, t.replace('"', "“").replace("license", "licence").replace("License", "Licence"))]
        given += [(name, "\r\n".join(line + "  " for line in t.split("\n")))]
        if not re.search(r"(?im)^\W*(copyright|\(c\)|all rights)", t):
            given.append((name, " ".join(t.split())))
        given.append((None, t + "\nAnd more."))
        given.append((None, re.sub(r"\b(the|of|to)\b", "thing", t, flags=re.IGNORECASE)))
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(given)], "doc_id long, text string")
    found = {r["doc_id"]: r["text_license"] for r in licenses.scan(docs).collect()}
    assert {k: (found[k], name) for k, (name, _) in enumerate(given) if found[k] != name} == {}
    twice = licenses.known_licenses(spark, (("A", "one text"),)).union(licenses.known_licenses(spark, (("B", "One text."),)))
    got = licenses.scan(spark.createDataFrame([(1, "one text\n\none  TEXT")], "doc_id long, text string"), twice).collect()
    assert [(r["line_licenses"], r["n_license_lines"]) for r in got] == [("A", 2)]
