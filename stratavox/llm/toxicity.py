"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, slices

#: Labelled rows that are learned from at most, of each class, and rows whose labels are not looked at:
#: those with the least hash of doc_id.
TOXIC_ROWS, OTHER_ROWS, PLAIN_ROWS = 3000, 6000, 6000
#: Correlated voters: the least mutual information, given the class, that ties a voter to another.
TIED = 0.003
#: Features that the classifier weighs at most beside the indicators, and numbers of words and beginnings in all.
WEIGHTED, NUMBERS = 2048, 1 << 24
#: A word or beginning is a feature for each of these that it reaches: occurrences, and occurrences
#: (two at least) in a thousand words.
OFTEN, DENSE = (1, 2, 4), (5, 10, 20)
LEVELS = len(OFTEN) + len(DENSE)
#: Beginnings of a word that are features beside the whole word.
BEGINNINGS = (4, 5, 6)
#: Mined indicators, the voters they are dealt to, and the rounds in which they are mined.
INDICATORS, VOTERS, MINED = 480, 24, 6
#: Everyday insults, by language.
INSULTS = {
    "en": (
        "idiot", "moron", "stupid", "loser", "pathetic", "scum", "worthless", "trash", "clown", "disgusting",
        "dumb", "fool", "garbage", "filth", "vermin", "imbecile", "jerk", "coward", "freak", "liar",
    ),
    "de": (
        "idiot", "dumm", "dummkopf", "trottel", "depp", "blödmann", "abschaum", "versager", "wertlos", "widerlich",
        "ekelhaft", "feigling", "lügner", "arschloch", "schwachkopf", "vollidiot", "drecksack", "mistkerl", "gesindel", "erbärmlich",
    ),
    "fr": (
        "idiot", "imbécile", "crétin", "abruti", "débile", "connard", "salaud", "ordure", "minable", "pathétique",
        "dégoûtant", "répugnant", "lâche", "menteur", "vermine", "raclure", "bouffon", "nul", "pitoyable", "stupide",
    ),
    "es": (
        "idiota", "imbécil", "estúpido", "tonto", "cretino", "escoria", "basura", "asqueroso", "patético", "inútil",
        "cobarde", "mentiroso", "payaso", "perdedor", "miserable", "gusano", "despreciable", "cabrón", "bastardo", "repugnante",
    ),
}

WORD = re.compile(r"[^\W\d_]+")


def is_held_out(doc_id: Column) -> Column:
    """True for the third of the rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_keys(word: str) -> tuple[int, ...]:
    """Numbers of the whole word and of its beginnings."""
    return tuple(zlib.crc32(x.encode()) % NUMBERS for x in (word + "\n", *(f"{n}{word[:n]}" for n in BEGINNINGS if len(word) >= n)))


def features(text: str, known: dict[str, tuple[int, ...]], wanted: set[int] | None = None) -> list[int]:
    """Numbers of the features of a text, key * LEVELS + level, of all keys or the wanted ones."""
    words = Counter(WORD.findall(text.lower()))
    n, found = sum(words.values()), {}
    for w, times in words.items():
        own = known.get(w)
        if own is None:
            if len(known) > 300_000:
                known.clear()
            own = known[w] = word_keys(w) if wanted is None else tuple(k for k in word_keys(w) if k in wanted)
        for k in own:
            found[k] = found.get(k, 0) + times
    out = []
    for k, times in found.items():
        out += [k * LEVELS + i for i, x in enumerate(OFTEN) if times >= x]
        if times > 1:
            out += [k * LEVELS + len(OFTEN) + i for i, x in enumerate(DENSE) if 1000 * times >= x * n]
    return out


def patterns(text: str) -> list[int]:
    """Votes of the pattern voters: 1 toxic, 0 not, -1 none."""
    words = len(text) / 6 + 1
    shouted = sum(1 for _ in re.finditer(r"[A-ZÀ-Þ]{3,}", text))
    return [1 if shouted > 0.2 * words else -1, 1 if text.count("!") > 0.2 * words else -1, 1 if re.search(r"\b(you|your|du|tu|eres)\b", text, re.IGNORECASE) else -1]


@dataclass
class LabelModel:
    """Votes (-1 none, 0 not toxic, 1 toxic) given an unseen class, fitted by EM. Labels are no votes:
    the posterior of a row comes from its votes alone, whether its class is known or not.

    Correlations are a tree over the voters: each vote depends on the class and on the vote of the
    voter that it is tied to most, if it is tied to any (mutual information given the class). So two
    voters that say the same count as little more than one. The accuracies are in the tables.
    """

    parent: np.ndarray  # of each voter, the voter it is tied to, or -1
    table: np.ndarray  # voter, class, parent's vote, vote (-1, 0, 1 as 0, 1, 2)
    prior: float

    @classmethod
    def fit(cls, votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> LabelModel:
        """start: P(toxic) of the first rows, whose classes are known; the others' classes are estimated."""
        m, given, all_votes = votes.shape[1], len(start), votes
        votes = votes[:given]
        hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).reshape(given, 3 * m).astype(float)
        post, parent = start.astype(float), np.full(m, -1)
        for k in range(rounds):
            joint = np.stack([hot.T @ (w[:, None] * hot) for w in (1 - post, post)]).reshape(2, m, 3, m, 3).transpose(1, 3, 0, 2, 4)
            if k in (0, 2, 5):
                parent = cls._tree(joint)
            table = np.stack([joint[p, i] if p >= 0 else np.repeat(np.einsum("caa->ca", joint[i, i])[:, None, :], 3, axis=1) for i, p in enumerate(parent)]) + 0.5
            table /= table.sum(axis=3, keepdims=True)
            model = cls(parent, table, float(np.clip(post.mean(), 1e-3, 1 - 1e-3)))
            if not k:
                votes = all_votes
                hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).reshape(len(votes), 3 * m).astype(float)
            new = np.concatenate([start, model.posterior(votes[given:])])
            if k > 5 and np.abs(new - post).max() < 1e-4:
                break
            post = new
        return model

    @staticmethod
    def _tree(joint: np.ndarray) -> np.ndarray:
        """The parent of each voter in the heaviest forest of ties of TIED or more."""
        m = len(joint)
        p = joint + 1e-9
        p = p / p.sum(axis=(2, 3, 4), keepdims=True)
        given = p / p.sum(axis=(3, 4), keepdims=True)
        info = (p * np.log(given / (given.sum(axis=4, keepdims=True) * given.sum(axis=3, keepdims=True)))).sum(axis=(2, 3, 4))
        np.fill_diagonal(info, -1)
        parent, inside, best, of = np.full(m, -1), np.zeros(m, bool), np.full(m, -1.0), np.full(m, -1)
        for _ in range(m):
            i = int(np.where(inside, -2, best).argmax())
            inside[i] = True
            parent[i] = of[i] if best[i] >= TIED else -1
            nearer = ~inside & (info[i] > best)
            best[nearer], of[nearer] = info[i][nearer], i
        return parent

    def accuracies(self) -> np.ndarray:
        """Of each voter, P(vote toxic | toxic) and P(vote toxic | not), for the likeliest vote it depends on (none)."""
        return self.table[:, ::-1, 0, 2]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        above = np.where(self.parent >= 0, votes[:, self.parent], -1) + 1
        odds = np.log(self.table[:, 1] / self.table[:, 0])[np.arange(votes.shape[1]), above, votes + 1]
        total = np.log(self.prior / (1 - self.prior)) + odds.sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


@dataclass
class Model:
    """A linear classifier over feature numbers."""

    weights: dict[int, float]
    bias: float
    label_model: LabelModel | None = None

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id and score (0 to 1) of every whole text, empty ones too."""
        weights, bias = self.weights, self.bias
        wanted = {f // LEVELS for f in weights}

        def run(batches):
            known: dict[str, tuple[int, ...]] = {}
            for batch in batches:
                for doc_ids, texts in slices(batch):
                    scores = [bias + sum(weights.get(f, 0.0) for f in features(text, known, wanted)) for text in texts]
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(np.array(scores, float), -30, 30))))], names=["doc_id", "score"])

        return id_text(docs).mapInArrow(run, "doc_id long, score double")


def _least(ids: DataFrame, n: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _sample(labels: DataFrame) -> DataFrame:
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic")).filter("toxic is not null and doc_id is not null")
    known = known.filter(~is_held_out(F.col("doc_id")))
    some = [_least(known.filter(F.col("toxic") == c), n) for c, n in ((1, TOXIC_ROWS), (0, OTHER_ROWS))]
    return some[0].union(some[1]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _features(docs: DataFrame, sample: DataFrame) -> list:
    """Of each sampled row: label, sorted feature numbers (bytes), pattern votes."""

    def run(batches):
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            rows = []
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows.append((toxic, np.sort(np.array(features(text, known), "<u4")).tobytes(), bytes(v + 1 for v in patterns(text))))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["toxic", "features", "votes"])

    # The sample is bounded by TOXIC_ROWS + OTHER_ROWS rows of two numbers.
    return id_text(docs).join(F.broadcast(sample), "doc_id").select("toxic", "text").mapInArrow(run, "toxic int, features binary, votes binary").collect()


def _plain(docs: DataFrame, columns: np.ndarray) -> list:
    """Of PLAIN_ROWS rows at most, whatever their labels: the columns they have (as bits), pattern votes."""
    wanted = {int(c) // LEVELS for c in columns}

    def run(batches):
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                own = np.sort(np.array(features(text, known, wanted), np.uint32))
                rows.append((np.packbits(_presence([own], columns)[0]).tobytes(), bytes(v + 1 for v in patterns(text))))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], names=["bits", "votes"])

    ids = id_text(docs).select("doc_id").filter(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).distinct()
    some = F.broadcast(_least(ids, PLAIN_ROWS))  # PLAIN_ROWS numbers
    return id_text(docs).join(some, "doc_id", "left_semi").select("text").mapInArrow(run, "bits binary, votes binary").limit(2 * PLAIN_ROWS).collect()


def _presence(rows: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Which of the columns each row has."""
    out = np.zeros((len(rows), len(columns)), bool)
    for i, r in enumerate(rows if len(columns) else ()):
        at = np.searchsorted(columns, r)
        at[at == len(columns)] = 0
        out[i, at[columns[at] == r]] = True
    return out


def _logistic(x: np.ndarray, target: np.ndarray, rounds: int = 300, decay: float = 1e-3, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Adam on the mean cross-entropy with soft targets."""
    x = x.astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g, gb = x.T @ (p - target).astype(np.float32) / len(x) + decay * w / 10, float((p - target).mean())
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w = w - rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (vb / c2 + 1e-16) ** 0.5
    return w, b


def _association(c1: np.ndarray, c0: np.ndarray, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of features in c1 of n1 and c0 of n0 rows, and their association as the signed root of
    the likelihood ratio, so that chance finds of rare features rank low."""
    odds = np.log((c1 + 0.5) / (n1 + 1)) - np.log((c0 + 0.5) / (n0 + 1))
    part = (c1 + c0) / (n1 + n0)
    ratio = sum(c * np.log(np.maximum(c, 1) / np.maximum(n * part, 1e-9)) for c, n in ((c1, n1), (c0, n0)))
    return odds, np.sign(odds) * np.sqrt(2 * np.maximum(ratio, 0))


def _mine(toxic_rows: list[np.ndarray], every: np.ndarray, odds: np.ndarray, c0: np.ndarray, n0: int) -> list[np.ndarray]:
    """Sets of indicators. Each round takes those that are most typical of the toxic rows in which the
    rounds before found fewer than two, so that rare languages get theirs too; all have high odds over
    all toxic rows, as the words of a language as such do not."""
    left, out = np.ones(len(toxic_rows), bool), []
    for _ in range(MINED):
        rows = [f for f, x in zip(toxic_rows, left, strict=True) if x]
        if not rows:
            break
        u, n = np.unique(np.concatenate(rows), return_counts=True)
        c1 = np.zeros(len(every), int)
        at = np.searchsorted(every, u)
        at[at == len(every)] = 0
        known = every[at] == u
        c1[at[known]] = n[known]
        _, sure = _association(c1, c0, len(rows), n0)
        ranked = np.flatnonzero((odds > 2.5) & (sure > 4))
        best = every[ranked[np.argsort(-sure[ranked], kind="stable")][: INDICATORS // MINED]].astype(np.int64)
        if not len(best):
            break
        each = VOTERS // MINED
        out += [best[k::each] for k in range(each)]
        left &= _presence(toxic_rows, np.sort(best)).sum(axis=1) < 2
    return out


def _votes(has, indicators: list[np.ndarray], pattern: np.ndarray) -> np.ndarray:
    """Each row's votes; has(columns) tells which of the features the rows have.

    A voter for each half of a language's insults and for each of VOTERS sets of mined indicators votes
    toxic or not at all; so do those for words of two insult lexicons and of two sets, and three patterns
    of spelling. One voter votes not toxic where no lexicon has a word of the text.
    """
    halves = [has(np.array(sorted({word_keys(w)[0] * LEVELS for w in some[k::2]}))) for some in INSULTS.values() for k in (0, 1)]
    sets = [has(np.sort(some)) for some in indicators if len(some)]
    two = lambda some: sum((h.any(axis=1).astype(int) for h in some), np.zeros(len(pattern), int)) > 1
    hit = [h.any(axis=1) for h in halves + sets]
    many = [two(halves), two(sets)]
    none = np.where(np.any(hit, axis=0), -1, 0)
    return np.stack([*[np.where(h, 1, -1) for h in hit + many], *pattern.T, none], axis=1)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from TOXIC_ROWS + OTHER_ROWS labelled rows and PLAIN_ROWS others at most, none held out.

    Labels serve to mine indicators (words and beginnings of words), to choose the classifier's features
    and, with the classes that EM gives the other rows, to estimate the voters' accuracies and ties. The
    classifier is fitted to the posteriors of the votes of all these rows, not to labels. Without labelled
    rows of both classes, or if no feature tells them apart, the insults alone decide. Null texts are
    empty, null doc_ids are not learned from, repeated rows count each, an empty table gives the
    insults; texts are read whole.
    """
    rows = _features(docs, _sample(labels))
    toxic = np.array([r["toxic"] for r in rows], int)
    insults_alone = Model({word_keys(w)[0] * LEVELS: 5.0 for some in INSULTS.values() for w in some}, -3.0)
    if not 0 < toxic.sum() < len(toxic):
        return insults_alone
    found = [np.frombuffer(r["features"], "<u4") for r in rows]
    pattern = np.array([list(r["votes"]) for r in rows], int) - 1
    del rows
    n1, n0 = int(toxic.sum()), int((toxic == 0).sum())
    of = [np.unique(np.concatenate([f for f, t in zip(found, toxic, strict=True) if t == k]), return_counts=True) for k in (0, 1)]
    every = np.union1d(of[0][0], of[1][0])
    c0, c1 = np.zeros(len(every), int), np.zeros(len(every), int)
    for c, (u, n) in ((c0, of[0]), (c1, of[1])):
        c[np.searchsorted(every, u)] = n
    some = c0 + c1 >= 4
    every, c0, c1 = every[some], c0[some], c1[some]
    odds, sure = _association(c1, c0, n1, n0)
    indicators = _mine([f for f, t in zip(found, toxic, strict=True) if t], every, odds, c0, n0)
    usable = np.flatnonzero(np.abs(sure) > 3)
    columns = every[usable[np.argsort(-np.abs(sure[usable]), kind="stable")][:WEIGHTED]].astype(np.int64)
    columns = np.unique(np.concatenate([columns, *indicators]))
    if not len(columns):
        return insults_alone
    insults = [word_keys(w)[0] * LEVELS for words in INSULTS.values() for w in words]
    looked = np.unique(np.concatenate([columns, insults]))
    plain = _plain(docs, looked)
    bits = np.unpackbits(np.array([list(r["bits"]) for r in plain], np.uint8).reshape(len(plain), -1), axis=1)[:, : len(looked)].astype(bool)
    pattern = np.concatenate([pattern, np.array([list(r["votes"]) for r in plain], int).reshape(len(plain), pattern.shape[1]) - 1])
    has = lambda x: np.concatenate([_presence(found, x), bits[:, np.searchsorted(looked, x)]])
    votes = _votes(has, indicators, pattern)
    label_model = LabelModel.fit(votes, toxic)
    w, b = _logistic(has(columns), label_model.posterior(votes))
    return Model({int(c): float(x) for c, x in zip(columns, w, strict=True) if abs(x) > 1e-3}, b, label_model)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from `threshold` on) of every document.

    A null text is empty and gets the score of no words; a null doc_id is scored and not held out;
    repeated rows are scored each; labels of doc_ids that are not in docs do not matter, and of
    repeated labels the higher counts.
    """
    scored = fit(docs, labels).score(docs)
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
