"""The pipeline's stages, each against brute force on its own input."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

from .test_operators import key, repeated, words

GAP = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(1)
    texts = [words(r.randint(60, 200), 500 + k) for k in range(60)]
    passage = words(60, 9)
    texts += [texts[0], texts[0], texts[1].replace(texts[1].split()[30], "changed", 1), None, "", "too short", "x *** y ### " * 60]
    texts += [f"{words(70, 900 + k)}\nAll of us share this.\n{words(20, 950 + k)}" for k in range(12)]
    texts += [f"{words(70, 700 + k)} {passage} {words(60, 750 + k)}" for k in range(3)]
    rows = [(k, t, "en", None if k % 5 else "s", len(t or "")) for k, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def shingles(text: str) -> set:
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, states = docs.columns, [{r["doc_id"]: r["text"] or "" for r in docs.collect()}]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
            rows = docs.collect()
            states.append({r["doc_id"]: r["text"] or "" for r in rows})
            assert len(rows) == len(states[-1]) and (not k or all(r["n_chars"] == len(r["text"] or "") for r in rows))
    given, good, lined, single, final = states

    def passes(t):
        w = GAP.findall(t)
        return len(w) >= 50 and 10 * sum(c in "#*$%&|<>" for c in t) <= len(w)

    assert set(good) == {i for i, t in given.items() if passes(t)}
    count = Counter(x for t in good.values() for x in set(map(key, t.split("\n"))) if x)
    assert lined == {i: "\n".join(x for x in t.split("\n") if count[key(x)] < 10) for i, t in good.items()}
    assert len(lined[70]) < len(good[70])
    prints = {i: shingles(t) for i, t in lined.items()}
    for i, s in prints.items():
        like = max((len(s & t) / len(s | t) for j, t in prints.items() if j < i), default=0)
        assert i not in single if like >= 0.9 else i in single if like < 0.5 else True
    assert all(single[i] == lined[i] for i in single)
    assert final == {i: kept.decode("utf-8", "ignore") for i, _, _, _, kept in repeated(single.items())}
    assert sum(map(len, final.values())) < sum(map(len, single.values()))
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = Counter()
    for r in docs.collect():
        tokens[r["doc_id"]] += r["length"]
    assert tokens == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in final.items()}


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


NAMES = ("_text_mark", "_kept_id", "c0", "node", "carried", "kept", "spans", "n_lines", "keys", "row", "fence", "words")


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_each_stage_with_odd_rows(spark, folder, name, stage):
    """Nulls, empty, repeated and long texts, clashing names and an empty table, given to each stage itself."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    long = words(60_000, 31)
    texts = [(None, None), (None, words(70, 32)), (1, None), (2, ""), (2, ""), (3, " \n\t"), (4, long), (5, words(80, 33)), (5, words(80, 33)), (5, words(80, 34)), (6, "é" * 300)]
    docs = spark.createDataFrame([(i, t, None, None, None, *NAMES) for i, t in texts], schema)
    out = stage(spark, docs, folder).collect()
    ids = Counter(r["doc_id"] for r in out)
    if name == "best_fit_packing":
        assert set(ids) == {None, 1, 2, 3, 4, 5, 6} and max(r["length"] for r in out) <= 2048 and ids[4] > 20
    else:
        assert out[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", *NAMES}
        assert all(r[n] == n for r in out for n in NAMES)
        assert ids == {
            "quality_rules": Counter({None: 1, 4: 1, 5: 3}), "line_dedup": Counter(i for i, _ in texts),
            "simhash_dedup": Counter({None: 2, 1: 1, 4: 1, 5: 2, 6: 1}), "suffix_dedup": Counter(i for i, _ in texts),
        }[name]
        if name != "suffix_dedup":
            assert next(r["text"] for r in out if r["doc_id"] == 4) == long
    assert stage(spark, docs.limit(0), folder).count() == 0


def kept_ids(spark, rows) -> list:
    from stratavox.llm import simhash

    return sorted(r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), words=5, similar=True).collect())


def test_a_repeated_phrase_makes_no_copies(spark):
    rows = []
    for k in range(20):
        phrase = words(10, 3000 + k)
        rows += [(2 * k + i, " ".join([phrase] * 10) + " " + words(120, 4000 + 2 * k + i)) for i in (0, 1)]
    assert kept_ids(spark, rows) == list(range(40))


def test_links_are_exact(spark):
    from stratavox.llm import simhash

    r = random.Random(3)
    sets = []
    for _ in range(12):
        base = r.sample(range(10_000), 40)
        for _ in range(r.randint(1, 9)):
            base = sorted(set(r.sample(base, len(base) - r.randint(0, 5))) | set(r.sample(range(10_000), r.randint(0, 5))))
            sets.append(tuple(base))
    sets = list(dict.fromkeys(sets))

    def classes(pairs):
        at = list(range(len(sets)))
        for i, j in pairs:
            at = [at[i] if x == at[j] else x for x in at]
        return {frozenset(k for k, x in enumerate(at) if x == a) for a in at}

    near = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 5 * len(set(a) & set(b)) >= 4 * len(set(a) | set(b))]
    assert near and classes(simhash.similar_pairs([np.array(x, np.uint64) for x in sets])) == classes(near)


def test_exact_links_in_tiles(spark):
    from pyspark.sql import functions as F

    from stratavox.llm import simhash

    base = words(300, 77).split()
    texts = [" ".join(base)]
    for k in range(40):  # a chain: each text differs from the one before in one place
        base[7 * k + 3] = f"new{k}"
        texts.append(" ".join(base))
    texts += [words(300, 900 + k) for k in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = docs.select(F.col("doc_id").alias("node"), F.xxhash64("text", F.lit(1)).alias("f0"), F.struct("doc_id", simhash.text_mark(F.col("text")).alias("mark")).alias("first"), F.lit(296).alias("size"))
    groups = docs.select(F.col("doc_id").alias("node"), F.lit(0).cast("long").alias("component"))
    for tile in (3, 6, simhash.SETS):
        found = [(r["u"], r["v"]) for r in simhash.exact_links(docs, kinds, groups, 5, tile).collect()]
        prints = [shingles(t) for t in texts]
        assert all(len(prints[u] & prints[v]) >= 0.8 * len(prints[u] | prints[v]) for u, v in found)
        at = list(range(len(texts)))
        for u, v in found:
            at = [at[u] if x == at[v] else x for x in at]
        assert len(set(at)) == 6 and len(set(at[:41])) == 1


@pytest.mark.parametrize(("n", "alike"), [(308, True), (247, False)])
def test_similarity_just_above_and_below(spark, n, alike):
    """30 of n - 4 shingles changed: 0.82 for 308 words, 0.78 for 247."""
    rows = []
    for k in range(40):
        text = words(n, 5000 + k).split()
        other = [f"new{i}" if i % 20 == 10 and i < 120 else w for i, w in enumerate(text)]
        a, b = shingles(" ".join(text)), shingles(" ".join(other))
        assert abs(len(a & b) / len(a | b) - (0.82 if alike else 0.78)) < 0.005
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
    assert kept_ids(spark, rows) == (list(range(0, 80, 2)) if alike else list(range(80)))


def test_texts_that_share_a_doc_id(spark):
    a, b, c = words(100, 61), words(100, 62), words(100, 63)
    assert kept_ids(spark, [(11, a), (11, b), (11, b), (12, c)]) == [11, 11, 12]
    assert kept_ids(spark, [(5, a), (11, a), (11, b), (12, c)]) == [5, 11, 12]
