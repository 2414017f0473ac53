"""Byte-level BPE encoding and decoding by corpus-level merge replay."""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import TwoGenerations, array_slices, gather, id_text, release

#: Chunks of text whose ids a worker keeps, in each of two generations.
CACHED = 600_000
#: Bytes of text that are looked up together.
SLICE_BYTES = 4 << 20
#: Bytes of different pieces that one replay takes at most, or one piece.
REPLAY_BYTES = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class MergeReplay:
    """Encodes many pieces together.

    An inverted index leads from a mergeable token pair (by the rank of its merge) to the positions
    where it stands in any of the pieces. Merges are applied in rank order over all pieces; each
    updates its two neighbours only. A pair that arises with a rank not above the current one goes
    first, so each piece sees the order "lowest rank, then leftmost".
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {r: t for t, r in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs: dict[int, int] = {}

    def rank(self, pair: int) -> int:
        """The rank of the merge of two tokens, packed as left << 32 | right, or -1."""
        r = self.pairs[pair] = self.ranks.get(self.tokens[pair >> 32] + self.tokens[pair & 0xFFFFFFFF], -1)
        return r

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """For each piece, its ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        rest, held = [], 0
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif piece:
                rest.append(i)
                held += len(piece)
                if held > REPLAY_BYTES:
                    self._replay(pieces, rest, out)
                    rest, held = [], 0
        if rest:
            self._replay(pieces, rest, out)
        return out

    def _replay(self, pieces: list[bytes], which: list[int], out: list[bytes]) -> None:
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        data = np.frombuffer(b"".join([pieces[i] for i in which]), np.uint8)
        symbols = self.single[data]
        starts = np.concatenate([[0], np.cumsum([len(pieces[i]) for i in which])])
        n = len(symbols)
        # -1 as right neighbour: the piece ends; as left neighbour: it begins; right == -2: merged away.
        rights, lefts = np.arange(1, n + 1), np.arange(-1, n - 1)
        lefts[starts[:-1]] = -1
        rights[starts[1:] - 1] = -1
        known, rank = self.pairs.get, self.rank
        pairs = (symbols[:-1] << 32) | symbols[1:]
        pairs[starts[1:-1] - 1] = -1
        kinds, inverse = np.unique(pairs, return_inverse=True)
        of_kind = np.array([-1 if k < 0 else rank(k) for k in kinds.tolist()], np.int64)
        ranks_at = of_kind[inverse] if n > 1 else np.empty(0, np.int64)
        order = np.argsort(ranks_at, kind="stable")
        order = order[np.searchsorted(ranks_at[order], 0) :]
        cuts = np.flatnonzero(np.diff(ranks_at[order])) + 1
        where = {int(ranks_at[x[0]]): x.tolist() for x in np.split(order, cuts) if len(x)}
        symbol, right, left = symbols.tolist(), rights.tolist(), lefts.tolist()
        heap = list(where)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            places = where.pop(r, None)
            if places is None:
                continue
            places.sort()
            for k, p in enumerate(places):
                q = right[p]
                if q < 0:
                    continue
                if known(symbol[p] << 32 | symbol[q]) != r:
                    continue
                symbol[p] = r
                after, before = right[q], left[p]
                right[p], right[q] = after, -2
                least = r + 1
                if after >= 0:
                    left[after] = p
                    pair = r << 32 | symbol[after]
                    new = known(pair)
                    if new is None:
                        new = rank(pair)
                    if new >= 0:
                        if new < least:
                            least = new
                        if new in where:
                            where[new].append(p)
                        else:
                            where[new] = [p]
                            heapq.heappush(heap, new)
                if before >= 0:
                    pair = symbol[before] << 32 | r
                    new = known(pair)
                    if new is None:
                        new = rank(pair)
                    if new >= 0:
                        if new < least:
                            least = new
                        if new in where:
                            where[new].append(before)
                        else:
                            where[new] = [before]
                            heapq.heappush(heap, new)
                if least <= r:  # the new pair comes before what is left of this list
                    where.setdefault(r, []).extend(places[k + 1 :])
                    heapq.heappush(heap, r)
                    break
        ids, alive = np.array(symbol, dtype="<u4"), np.array(right, dtype=np.int64) != -2
        ends = np.cumsum(alive)
        kept, data = ids[alive].tobytes(), 0
        for j, i in enumerate(which):
            end = int(ends[starts[j + 1] - 1]) * 4
            out[i] = kept[data:end]
            data = end


class Codec:
    """Encodes and decodes whole texts as tiktoken's encode_ordinary does with the same ranks and pattern."""

    def __init__(self, path: str, pattern: str):
        self.replay = MergeReplay(load_ranks(path))
        self.find = regex.compile(pattern).findall
        self.cache, self.pieces = TwoGenerations(CACHED), TwoGenerations(CACHED // 2)

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        split = [self.find(c) for c in chunks]
        known = self.pieces.get_all({p for parts in split for p in parts}, lambda new: self.replay.encode([p.encode() for p in new]))
        return [b"".join([known[p] for p in parts]) for parts in split]

    def encode_batch(self, texts: pa.StringArray) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit bytes. A single space starts a new chunk, which the
        pattern always splits alike; texts with runs or ends of spaces go through the pattern whole."""
        odd = pc.match_substring_regex(texts, r" {2}| \z").to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(~odd), texts, ""), " ")
        borders = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        chunks = split.flatten()
        begins = np.zeros(len(chunks), bool)
        begins[borders[:-1]] = True
        chunks = pc.if_else(pa.array(begins), chunks, pc.binary_join_element_wise(" ", chunks, "")).dictionary_encode()
        own = self.cache.get_list(chunks.dictionary.to_pylist(), self._chunk_ids)
        ids, size = gather(np.frombuffer(b"".join(own), "<u4"), np.fromiter(map(len, own), np.int64, len(own)) >> 2, chunks.indices.to_numpy())
        data, ends = ids.tobytes(), (4 * np.concatenate([[0], np.cumsum(size)])[borders]).tolist()
        whole = iter(self._chunk_ids([texts[i].as_py() for i in np.flatnonzero(odd).tolist()]))
        return [next(whole) if o else data[a:b] for o, a, b in zip(odd.tolist(), ends, ends[1:], strict=False)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.replay.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids binary (little-endian unsigned 32-bit) and decoded binary of every whole text.

    One narrow stage. A null or empty text has no ids; a null doc_id stays null; repeated rows are
    encoded each; other columns are ignored.
    """

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for doc_ids, texts in array_slices(batch, SLICE_BYTES, batch.num_rows):
                ids = c.encode_batch(texts)
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(ids, pa.binary()), pa.array([c.decode(x) for x in ids], pa.binary())], names=["doc_id", "ids", "decoded"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids binary, decoded binary")


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode()'s rows, digested before they leave the worker."""

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for doc_ids, texts in array_slices(batch, SLICE_BYTES, batch.num_rows):
                ids = c.encode_batch(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in ids]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        release()

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
