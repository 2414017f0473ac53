"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyspark
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.shipping import ship

from .common import release, row_slices, settle

ROLES = ("system", "user", "assistant")
#: Rows of a conversation, and bytes of text, that a block holds; no path depends on where blocks end.
BLOCK_ROWS, BLOCK_BYTES = 256, 1 << 20
#: Words that mark a speaker, by role.
MARKERS = {
    "system": "system|sys|instructions?|context",
    "user": "user|human|customer|question|prompt|me|q",
    "assistant": "assistant|ai|bot|model|agent|answer|a",
}
_MARK = [re.compile(rf"^[#<\[*\s]*(?:{MARKERS[r]})\s*(?:[:>\]*]+\s*|$)", re.IGNORECASE) for r in ROLES]
#: Headers of the styles that transcripts are written in, by role, and what follows them.
STYLES = (
    (("System", "User", "Assistant"), ": "),
    (("### Instructions", "### Human", "### AI"), "\n"),
    (("Context", "Q", "A"), ": "),
    (("[system]", "[user]", "[bot]"), " "),
)
#: States are role * 2 + (0: a turn's first line, 1: a later one); marks are 0 (none) or 1 + role.
STATES, SHAPES = 2 * len(ROLES), 4 * 2 * 2 * 3
#: Scores are integers, log-probabilities in units of 2^-24, so that sums do not depend on their order;
#: lines add up to NOISE - 1 to each state by a hash, which decides between equally likely paths.
UNIT, NOISE = 1 << 24, 1 << 10
LEAST = np.int64(-(1 << 60))
#: Cells (blocks x lines) that are worked on together.
CELLS = 1 << 17


def mark(line: str) -> tuple[int, str]:
    """The speaker mark of a line, and the line without it."""
    for k, pattern in enumerate(_MARK):
        if m := pattern.match(line):
            return 1 + k, line[m.end() :]
    return 0, line


def shapes(lines: list[str]) -> list[int]:
    """One number of each line's features: mark, blank line before (or none), question, length."""
    out, blank = [], True
    for line in lines:
        size = 0 if not line.strip() else 1 if len(line) < 40 else 2
        out.append(((mark(line)[0] * 2 + blank) * 2 + line.rstrip().endswith("?")) * 3 + size)
        blank = not size
    return out


def _seed(conv_id: int | None) -> int:
    return xxhash.xxh64_intdigest(str(conv_id).encode())


def fold_of(conv_id: int | None) -> int:
    """Conversations of one fold are parsed by a model of the other."""
    return _seed(conv_id) >> 8 & 1


@dataclass
class Transcript:
    """Rows of a conversation as raw lines: each turn's lines in one of STYLES, then an empty line. A
    tenth of the turns, by hash, have no mark, nor have those of unknown roles."""

    lines: list[str]
    rows: np.ndarray  # of each line, the row it came from
    states: np.ndarray  # true states, -1: role unknown
    noise: np.ndarray  # line, state
    marked: list[bool]  # of each row

    @classmethod
    def of(cls, conv_id: int | None, turns: list[dict]) -> Transcript:
        seed = _seed(conv_id)
        names, gap = STYLES[seed % len(STYLES)]
        lines, rows, states, hashes, marked = [], [], [], [], []
        for nth, t in enumerate(turns):
            known, text = ROLES.index(t["role"]) if t["role"] in ROLES else -1, t["text"] or ""
            h = xxhash.xxh64_intdigest(f"{t['turn']}\n{t['role']}\n{text}".encode(), seed)
            marked.append(known >= 0 and h % 10 > 0)
            own = [*((names[known] + gap if marked[-1] else "") + text).split("\n"), ""]
            lines += own
            rows += [nth] * len(own)
            states += [-1 if known < 0 else 2 * known + (k > 0) for k in range(len(own))]
            hashes.append((np.arange(1, len(own) + 1, dtype=np.uint64) * np.uint64(h | 1)) ^ np.uint64(h >> 1))
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        noise = (h[:, None] >> (4 + 10 * np.arange(STATES, dtype=np.uint64))).astype(np.int64) & (NOISE - 1)
        return cls(lines, np.array(rows, np.int64), np.array(states, np.int64), noise, marked)


@dataclass
class RoleModel:
    """Integer scores of the first state, of transitions, and of shapes in a state."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    @classmethod
    def of(cls, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> RoleModel:
        score = lambda x: np.rint(UNIT * np.log((x + 0.1) / (x + 0.1).sum(axis=-1, keepdims=True))).astype(np.int64)
        return cls(score(start), score(step), score(emit))

    def scores(self, t: Transcript) -> np.ndarray:
        """(line, state): what a state of a line adds to its path."""
        return self.emit.T[shapes(t.lines)] + t.noise

    def between(self, blocks: list[np.ndarray]) -> np.ndarray:
        """(block, first state, last state): the best path from a block's first line to its last."""
        out = np.empty((len(blocks), STATES, STATES), np.int64)
        for some in _together(blocks):
            size = [len(blocks[i]) for i in some]
            best = np.full((len(some), STATES, STATES), LEAST)
            best[:, range(STATES), range(STATES)] = np.stack([blocks[i][0] for i in some])
            for k in range(1, size[0]):
                n = sum(x > k for x in size)  # sorted by length: those that go on come first
                best[:n] = (best[:n, :, :, None] + self.step).max(axis=2) + np.stack([blocks[i][k] for i in some[:n]])[:, None, :]
            out[some] = best
        return out

    def paths(self, blocks: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        """The best states of each block's lines, from state first[i] to state last[i]."""
        out: list = [None] * len(blocks)
        for some in _together(blocks):
            size = [len(blocks[i]) for i in some]
            best = np.full((len(some), STATES), LEAST)
            best[range(len(some)), first[some]] = [blocks[i][0][f] for i, f in zip(some, first[some].tolist(), strict=True)]
            back = np.zeros((size[0], len(some), STATES), np.int8)
            for k in range(1, size[0]):
                n = sum(x > k for x in size)
                all_ = best[:n, :, None] + self.step
                back[k, :n] = all_.argmax(axis=1)
                best[:n] = all_.max(axis=1) + np.stack([blocks[i][k] for i in some[:n]])
            state, path = last[some].copy(), np.zeros((size[0], len(some)), np.int8)
            for k in range(size[0] - 1, -1, -1):
                n = sum(x > k for x in size)
                path[k, :n] = state[:n]
                if k:
                    state[:n] = back[k, range(n), state[:n]]
            for j, i in enumerate(some):
                out[i] = path[: size[j], j].astype(np.int64)
        return out


def _together(blocks: list[np.ndarray]):
    """Numbers of blocks, longest first, in runs of about CELLS cells."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    at = 0
    while at < len(order):
        n = max(1, CELLS // len(blocks[order[at]]))
        yield order[at : at + n]
        at += n


def blocks_of(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, part, k, turns), checkpointed: consecutive rows of a conversation, at most block_rows;
    its blocks are in order of part, k. All rows are dealt out by range, a conversation of any length
    over as many tasks as it needs. Rows are in order of turn (nulls first), role and a hash of the
    text; equal rows stay, next to each other."""
    ship(conversations.sparkSession)
    keys = ["conv_id", "turn", "role", "mark", "tie"]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = settle(rows.select("*", F.xxhash64("text").alias("mark"), F.xxhash64(F.monotonically_increasing_id()).alias("tie")))

    def cut(batches):
        part, k, conv, held, size = pyspark.TaskContext.get().partitionId(), 0, None, [], 0

        def done():
            nonlocal k, held, size
            k, turns, held, size = k + 1, held, [], 0
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([turns], pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])))], names=["conv_id", "part", "k", "turns"])

        for batch in row_slices(batches):
            for r in batch.select(["conv_id", "turn", "role", "text"]).to_pylist():
                if held and (r["conv_id"] != conv or len(held) >= block_rows or size > BLOCK_BYTES):
                    yield done()
                conv = r.pop("conv_id")
                held.append(r)
                size += len(r["text"] or "")
        if held:
            yield done()

    sorted_rows = settle(rows.repartitionByRange(*keys).sortWithinPartitions(*keys))
    return settle(sorted_rows.mapInArrow(cut, "conv_id long, part int, k int, turns array<struct<turn: long, role: string, text: string>>"))


def _each(batches):
    """(conv_id, part, k, transcript, turns) of some blocks at a time."""
    for batch in row_slices(batches, 256):
        rows = batch.to_pylist()
        yield rows, [Transcript.of(r["conv_id"], r["turns"]) for r in rows]


#: Numbers that are counted: first states, transitions and shapes, of each fold.
_COUNTS = STATES + STATES**2 + STATES * SHAPES


def fit(blocks: DataFrame) -> list[RoleModel]:
    """For each fold, the model of the other one: first states, transitions and shapes counted over all
    its conversations (of a single fold, over that). Each worker adds up its own; the driver gets the
    counts and, of each part, its first and last row."""

    def run(batches):
        counts, border, before = np.zeros((2, _COUNTS)), [], (False, None, -1)
        for rows, transcripts in _each(batches):
            for r, t in zip(rows, transcripts, strict=True):
                s, mine = t.states, counts[fold_of(r["conv_id"])]
                joined = before[0] and before[1] == r["conv_id"]
                if not before[0]:
                    border.append((r["part"], 0, r["conv_id"], int(s[0])))
                elif not joined and s[0] >= 0:
                    mine[s[0]] += 1
                if joined:
                    s = np.concatenate([[before[2]], s])
                both = (s[:-1] >= 0) & (s[1:] >= 0)
                np.add.at(mine, STATES + s[:-1][both] * STATES + s[1:][both], 1)
                known = t.states >= 0
                np.add.at(mine, STATES + STATES**2 + t.states[known] * SHAPES + np.array(shapes(t.lines))[known], 1)
                before = (True, r["conv_id"], int(t.states[-1]))
                last = (r["part"], 1, r["conv_id"], before[2])
        if before[0]:
            border.append(last)
        every = counts.ravel()
        some = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(every[some]), *[pa.array(np.full(len(some), -1))] * 2, pa.array([None] * len(some), pa.int64()), pa.array(np.full(len(some), -1))], names=["k", "n", "part", "end", "conv_id", "state"])
        none = pa.array([-1] * len(border), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(np.zeros(len(border))), *[pa.array([b[i] for b in border], pa.int64()) for i in range(4)]], names=["k", "n", "part", "end", "conv_id", "state"])

    found = blocks.mapInArrow(run, "k long, n double, part long, end long, conv_id long, state long")
    counts, ends = np.zeros(2 * _COUNTS), []
    for r in found.groupBy("k", "part", "end", "conv_id", "state").agg(F.sum("n").alias("n")).collect():
        if r["k"] >= 0:
            counts[r["k"]] = r["n"]
        else:
            ends.append((r["part"], r["end"], r["conv_id"], r["state"]))
    counts, before = counts.reshape(2, -1), None
    for _, end, conv, state in sorted(ends, key=lambda e: e[:2]):  # rows that other parts go on from
        if end:
            before = (conv, state)
        elif before is None or before[0] != conv:
            counts[fold_of(conv)][state] += state >= 0
        elif state >= 0 and before[1] >= 0:
            counts[fold_of(conv)][STATES + before[1] * STATES + state] += 1
    models = []
    for fold in (0, 1):
        c = counts[1 - fold] if counts[1 - fold].any() else counts[fold]
        start, step, emit = np.split(c, [STATES, STATES + STATES**2])
        models.append(RoleModel.of(start, step.reshape(STATES, STATES), emit.reshape(STATES, SHAPES)))
    return models


def _by_fold(rows: list[dict]) -> list[tuple[int, list[int]]]:
    folds = [fold_of(r["conv_id"]) for r in rows]
    return [(f, [i for i, x in enumerate(folds) if x == f]) for f in (0, 1)]


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.array([np.frombuffer(x.as_py(), np.int64) for x in batch.column(name)])


def block_ends(blocks: DataFrame, models: list[RoleModel]) -> DataFrame:
    """(part, k, first, last, before, at, goes_on): for each block, the states of its first and last
    lines on the best path through the whole conversation, the state before it (-1: none), the rows
    before it, and whether its last turn may go on in the next block.

    A block gives the scores of the best paths between each first and last state. Two sorted runs
    over these carry the best scores forward and the chosen states backward, a block at a time.
    """

    def summarise(batches):
        for rows, transcripts in _each(batches):
            found = np.empty((len(rows), STATES, STATES), np.int64)
            for f, some in _by_fold(rows):
                if some:
                    found[some] = models[f].between([models[f].scores(transcripts[i]) for i in some])
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in (("conv_id", pa.int64()), ("part", pa.int32()), ("k", pa.int32()))] + [pa.array([len(r["turns"]) for r in rows], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())], names=["conv_id", "part", "k", "rows", "between"])
        release()

    def forward(batches):
        conv, best, at = None, None, 0
        for batch in batches:
            into, places = [], []
            for c, n, between in zip(batch.column("conv_id").to_pylist(), batch.column("rows").to_pylist(), _longs(batch, "between").reshape(-1, STATES, STATES), strict=True):
                model = models[fold_of(c)]
                if best is None or c != conv:
                    conv, at, come = c, 0, model.start
                else:
                    come = (best[:, None] + model.step).max(axis=0)
                best = (come[:, None] + between).max(axis=0)
                into.append(come.tobytes())
                places.append(at)
                at += n
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "part", "k", "between")], pa.array(places, pa.int64()), pa.array(into, pa.binary())], names=["conv_id", "part", "k", "between", "at", "into"])

    def backward(batches):
        held = None  # the block after, whose state before is still to be chosen

        def out(rows: list[list]) -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array([r[1 + i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

        for batch in batches:
            rows = []
            for c, part, k, at, into, between in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "part", "k", "at")), _longs(batch, "into"), _longs(batch, "between").reshape(-1, STATES, STATES), strict=True):
                best, follows = (into[:, None] + between).max(axis=0), held is not None and held[0] == c
                last = int((best + models[fold_of(c)].step[:, held[3]]).argmax() if follows else best.argmax())
                goes_on = follows and held[3] % 2 == 1 and held[3] // 2 == last // 2
                if held is not None:
                    held[5] = last if follows else -1
                    rows.append(held)
                held = [c, part, k, int((into + between[:, last]).argmax()), last, -1, at, goes_on]
            yield out(rows)
        if held is not None:
            yield out([held])

    names = ["part", "k", "first", "last", "before", "at", "goes_on"]
    order = [F.col(c) for c in ("conv_id", "part", "k")]
    found = blocks.mapInArrow(summarise, "conv_id long, part int, k int, rows long, between binary")
    ahead = found.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(forward, "conv_id long, part int, k int, between binary, at long, into binary")
    behind = ahead.repartition("conv_id").sortWithinPartitions(*[c.desc() for c in order])
    return behind.mapInArrow(backward, "part int, k int, first int, last int, before int, at long, goes_on boolean")


def format_conversations(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Write each conversation as a raw transcript, recover its turns from the lines alone, and render them.

    One Viterbi path runs through a whole conversation of any length, by a model that was fitted to
    other conversations. A row for each recovered turn: conv_id, row (number in the conversation, from
    0, of the row that its first line came from), turn (that row's number, null if it has none), role,
    marked (that row has a speaker mark), agrees (with that row's role), n_rows (rows that begin in the
    turn), n_agree (of these, rows of its role) and rendered. Null texts are empty; rows of null or
    unknown roles have no mark and teach nothing; null conv_ids are one conversation; equal rows stay,
    as neighbours; ties of turn numbers are ordered by role and a hash of the text; other columns are
    ignored; an empty table gives none.
    """
    blocks = blocks_of(conversations, block_rows)
    models = fit(blocks)
    names = ["conv_id", "part", "k", "nth", "opens", "whole", "row", "turn", "role", "marked", "agrees", "n_rows", "n_agree", "text"]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string())

    def decode(batches):
        for rows, transcripts in _each(batches):
            paths: list = [None] * len(rows)
            first, last = (np.array([r[c] for r in rows], np.int64) for c in ("first", "last"))
            for f, some in _by_fold(rows):
                for i, path in zip(some, models[f].paths([models[f].scores(transcripts[i]) for i in some], first[some], last[some]) if some else (), strict=True):
                    paths[i] = path
            out = []
            for r, t, path in zip(rows, transcripts, paths, strict=True):
                role = path // 2
                opens = (path % 2 == 0) | (np.concatenate([[r["before"] // 2], role[:-1]]) != role)  # -1 // 2 is no role
                begin = np.flatnonzero(opens) if opens[0] else np.concatenate([[0], np.flatnonzero(opens)])
                starts = np.flatnonzero(np.diff(t.rows, prepend=-1))  # the first line of each row
                for nth, (a, b) in enumerate(zip(begin.tolist(), [*begin[1:].tolist(), len(path)], strict=True)):
                    own = starts[(starts >= a) & (starts < b)]
                    lines = [mark(t.lines[a])[1], *t.lines[a + 1 : b]] if opens[a] else t.lines[a:b]
                    of = int(t.rows[a])
                    is_whole = bool(opens[a]) and not (b == len(path) and r["goes_on"])
                    true = int(t.states[a])
                    out.append((r["conv_id"], r["part"], r["k"], nth, bool(opens[a]), is_whole, r["at"] + of, r["turns"][of]["turn"], ROLES[role[a]], t.marked[of], true >= 0 and true // 2 == role[a], len(own), int((t.states[own] // 2 == role[a]).sum()), "\n".join(lines)))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=names)
        release()

    def joined(batches):
        """Turns that blocks cut, put together in order."""
        held, texts = None, []

        def done() -> dict:
            return {**held, "text": "\n".join(texts)}

        for batch in row_slices(batches):
            out = []
            for r in batch.to_pylist():
                if r["opens"] or held is None:
                    if held is not None:
                        out.append(done())
                    held, texts = r, [r["text"]]
                else:
                    texts.append(r["text"])
                    held["n_rows"] += r["n_rows"]
                    held["n_agree"] += r["n_agree"]
            yield pa.RecordBatch.from_pylist(out, batch.schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([done()], pa.schema(list(zip(names, kinds, strict=True))))

    schema = "conv_id long, part int, k int, nth int, opens boolean, whole boolean, row long, turn long, role string, marked boolean, agrees boolean, n_rows long, n_agree long, text string"
    found = settle(blocks.join(block_ends(blocks, models), ["part", "k"]).mapInArrow(decode, schema))
    cut = found.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "k", "nth").mapInArrow(joined, schema)
    turns = found.filter("whole").unionByName(cut)
    rendered = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.btrim(F.col("text"), F.lit(" \t\n\x0b\f\r")), F.lit("\n<|end|>\n"))
    return turns.select("conv_id", "row", "turn", "role", "marked", "agrees", "n_rows", "n_agree", rendered.alias("rendered"))
