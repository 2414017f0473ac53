"""Packing token pieces into fixed-length sequences: large-item matching, then best fit."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import TwoGenerations, array_slices, gather, id_text, release, settle

#: Pieces of words whose ids a worker keeps, in each of two generations.
CACHED_PIECES = 100_000
#: Bytes of text that a worker handles at a time, and of new pieces in one call of the tokenizer,
#: whose own records of a text take some hundred times its bytes.
SLICE_BYTES, CALL_BYTES = 2 << 20, 1 << 14
#: The tokenizer's pieces of a lower-cased word; words that C++ lower-cases just as it does; and marks
#: that make one piece after letters.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
LATIN = r"^[\x21-\x{12F}\x{131}-\x{24F}]+$"
MARKS = ".,;:!?()-\""
#: str.split() takes these for white space too; the tokenizer does not.
NOT_SPACE = re.compile(r"[\x1c-\x1f]")
SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class WordCodec:
    """Whole-text ids of a tokenizer that normalises and splits at white space and never across it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For pieces that are cut and lower-cased already: the same merges alone.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.cache = TwoGenerations(CACHED_PIECES)
        self.final = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.final[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        # Added tokens are one id wherever they stand, inside words too.
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else re.compile("(?!)")
        self.unusual = "|".join([NOT_SPACE.pattern, *map(re.escape, self.added)])

    def _calls(self, texts: list[str]):
        """Runs of texts of about CALL_BYTES."""
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and held < CALL_BYTES:
                held += len(texts[end]) + 8
                end += 1
            yield texts[at:end]
            at = end

    def _encode_each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for some in self._calls(words) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Pieces of a call as one text; each ends at a token with the end-of-word mark. Whole words,
        marked by a space, are encoded one by one."""
        out: dict[str, bytes] = {}
        for some in self._calls([p for p in parts if p and p[0] != " "]):
            ids = np.array(self.merges.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.final[ids]) + 1)).tolist()
            data = ids.tobytes()
            out.update(zip(some, [data[a:b] for a, b in zip([0, *ends], ends, strict=False)] if len(ends) == len(some) else self._encode_each(some), strict=True))
        whole = [p for p in parts if p and p[0] == " "]
        out.update(zip(whole, self._encode_each(whole), strict=True))
        return [out[p] if p else b"" for p in parts]

    def _encode_words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids, one after the other, and how many each has.

        Latin words of letters, with marks behind them or not, are cut by Arrow; other Latin words by
        the pattern; words of other scripts are one part, marked by a space.
        """
        low = pc.utf8_lower(words)
        core = pc.utf8_rtrim(low, MARKS)
        latin = pc.match_substring_regex(words, LATIN)
        letters = pc.and_(pc.utf8_is_alpha(core), latin)
        marked = pc.and_(letters, pc.not_equal(core, low)).to_numpy(zero_copy_only=False)
        coded = pc.if_else(letters, core, None).dictionary_encode()
        parts, letters = coded.dictionary.to_pylist(), letters.to_numpy(zero_copy_only=False)
        first, count = coded.indices.fill_null(0).to_numpy(), 1 + marked.astype(np.int64)
        # One mark is that byte; only more of them need to be cut out.
        size = pc.binary_length(low).to_numpy(zero_copy_only=False)
        tail = size - pc.binary_length(core).to_numpy(zero_copy_only=False)
        one, more_marks = marked & (tail == 1), np.flatnonzero(marked & (tail > 1))
        last = np.frombuffer(low.buffers()[2] or b"", np.uint8)[(np.cumsum(size) - 1)[one]]
        tails = [w[-n:] for w, n in zip(low.take(pa.array(more_marks)).to_pylist(), tail[more_marks].tolist(), strict=True)]
        others = np.flatnonzero(~letters)
        is_latin = latin.to_numpy(zero_copy_only=False)[others].tolist()
        cut = [PIECE.findall(w.lower()) if x else [" " + w] for w, x in zip(words.take(pa.array(others)).to_pylist(), is_latin, strict=True)]
        count[others] = np.fromiter(map(len, cut), np.int64, len(cut))
        ends = np.cumsum(count)
        at = np.empty(ends[-1] if len(ends) else 0, np.int64)
        at[(ends - count)[letters]] = first[letters]
        more = dict.fromkeys([p for own in cut for p in own] + tails + list(MARKS))
        more = dict(zip(more, range(len(parts), len(parts) + len(more)), strict=True))
        marks = np.zeros(128, np.int64)
        marks[list(map(ord, MARKS))] = [more[m] for m in MARKS]
        at[ends[one] - 1] = marks[last]
        at[ends[more_marks] - 1] = [more[t] for t in tails]
        at[np.repeat(~letters, count)] = [more[p] for own in cut for p in own]
        parts += more
        own = self.cache.get_list(parts, self._encode_parts)
        ids, size = gather(np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), np.int64, len(own)) >> 2, at)
        return ids, np.diff(np.concatenate([[0], np.cumsum(size)])[ends], prepend=0)

    def _encode_text(self, text: str) -> bytes:
        """A text with added tokens, or with characters that are no white space to the tokenizer alone."""
        out = []
        for part in self.cut.split(text):
            if part in self.added:
                out.append(self.added[part])
            else:
                out.append(self._encode_words(pa.array([w for w in SPACE.split(part) if w], pa.string()))[0].tobytes())
        return b"".join(out)

    def encode_batch(self, texts: pa.StringArray) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit bytes."""
        odd = pc.match_substring_regex(texts, self.unusual).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(~odd), texts, "") if odd.any() else texts
        split = pc.utf8_split_whitespace(plain)
        words = split.flatten().dictionary_encode()
        ids, size = gather(*self._encode_words(words.dictionary), words.indices.to_numpy())
        borders = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        borders = (4 * np.concatenate([[0], np.cumsum(size)])[borders]).tolist()
        data = ids.tobytes()
        return [self._encode_text(texts[i].as_py()) if o else data[a:b] for i, (o, a, b) in enumerate(zip(odd.tolist(), borders, borders[1:], strict=False))]


@lru_cache(2)
def word_codec(path: str) -> WordCodec:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordCodec(path)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Pack counts[length] pieces of each length into sequences of `capacity` tokens.

    Lengths above a third of the capacity fit at most twice: from the longest on, each is matched
    with the longest other large one that fits. Then the smaller ones, from the longest on, go each
    to the tightest gap that holds them; what fits nowhere opens a sequence. Pieces of one length
    are alike, so this runs over the histogram: its size depends on the capacity, not on the data.
    Returns runs (length, first, sequences, each, sequence, offset): pieces number first ... of that
    length fill `sequences` sequences from `sequence` on, `each` in each, from `offset` on.
    """
    runs, left, taken = [], {n: c for n, c in counts.items() if c}, dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    keys: list[int] = []
    opened = 0

    def put(length: int, sequences: int, each: int, sequence: int, offset: int) -> None:
        runs.append((length, taken[length], sequences, each, sequence, offset))
        taken[length] += sequences * each
        left[length] -= sequences * each

    def gap(size: int, sequence: int, sequences: int) -> None:
        if size not in gaps:
            gaps[size] = []
            insort(keys, size)
        gaps[size].append((sequence, sequences))

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):
        while left[n]:
            fits = [m for m in large if m <= capacity - n and left[m] > (m == n)]
            if not fits:
                k = left[n]
                put(n, k, 1, opened, 0)
                gap(capacity - n, opened, k)
            elif (m := fits[-1]) == n:
                k = left[n] // 2
                put(n, k, 2, opened, 0)
                gap(capacity - 2 * n, opened, k)
            else:
                k = min(left[n], left[m])
                put(n, k, 1, opened, 0)
                put(m, k, 1, opened, n)
                gap(capacity - n - m, opened, k)
            opened += k
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(keys, n)
            if at == len(keys):
                k = -(-left[n] // (capacity // n))
                gap(capacity, opened, k)
                opened += k
                continue
            size = keys[at]
            sequence, sequences = gaps[size].pop()
            each = min(size // n, left[n])
            k = min(sequences, left[n] // each)
            put(n, k, each, sequence, capacity - size)
            gap(size - n * each, sequence, k)
            if k < sequences:
                gaps[size].append((sequence + k, sequences - k))
            if not gaps[size]:
                del gaps[size]
                keys.remove(size)
    return runs


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack whole documents into sequences of at most `capacity` tokens; one row per piece.

    A document is its ids, as the tokenizer's encode(text, add_special_tokens=False) gives them
    (added tokens that stand in a text are their one id), and then end_id; a null or empty text is
    end_id alone. Only documents longer than the capacity are cut, at its multiples, however long
    they are; a text of any length is encoded whole, some words at a time. Repeated rows and null doc_ids are packed
    like any other row; an empty table gives no rows; other columns are ignored.
    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Tokenizing is one narrow stage whose small rows are checkpointed. The driver sees a histogram of
    at most `capacity` lengths; every row then finds its place by its number within its length.
    """

    def cut(batches):
        codec, seen = word_codec(path), {}
        part = pyspark.TaskContext.get().partitionId()
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for doc_ids, texts in array_slices(batch, SLICE_BYTES):
                rows = []
                for doc_id, ids in zip(doc_ids.to_pylist(), codec.encode_batch(texts), strict=True):
                    ids += last
                    for at in range(0, len(ids), 4 * capacity):
                        data = ids[at : at + 4 * capacity]
                        n = len(data) // 4
                        k = seen[n] = seen.get(n, -1) + 1
                        rows.append((doc_id, at // (4 * capacity), at // 4, n, zlib.crc32(data), part, k))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
        release()

    pieces = settle(id_text(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"))
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(sorted(plan(totals, capacity)), np.int64).reshape(-1, 6)

    def place(batches):
        key = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            _, first, _, each, sequence, offset = runs[np.searchsorted(key, (length << 44) + nth, "right") - 1].T
            row, at = np.divmod(nth - first, each)
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence + row), pa.array(offset + at * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = pieces.join(bases, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("nth"))
    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
