"""Byte-level BPE by merge replay over the words of a shard of the corpus.

A text is cut into words by the tokenizer's pattern. Each task replays the merges once for the distinct words of a shard
(some MB of text), not for every occurrence: an inverted index holds, for each merge, the places where its pair stands in any
word; merges are applied in rank order, and only the two neighbours of a merged place are looked up and
indexed anew. Documents then gather the ids of their words. Shards are parts of a map stage: nothing is shuffled, no vocabulary
of the corpus is ever held, and a lost executor costs its own shards only.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from keyharbor.llm.common import cuts, pieces

#: Bytes of text of a shard.
SHARD = 4 << 20
#: Decoded bytes of a batch, about: one text may have more.
DECODED = 4 << 20
#: Words of more bytes are merged one by one, through a heap of their own.
LONG = 256


class Merges:
    """The merges of a rank file: pairs of token ids by their key, and the id (rank) that each becomes."""

    def __init__(self, rank_lines: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_lines.splitlines() if line)}
        found = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    found[a << 32 | b] = rank
        self.pairs = found
        self.keys = np.array(sorted(found), np.int64)
        self.becomes = np.array([found[k] for k in self.keys.tolist()], np.int32)
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_len = np.array([len(t) for t in tokens], np.int64)
        self.token_at = np.concatenate(([0], np.cumsum(self.token_len)[:-1]))
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.by_bytes = self.look_up(np.repeat(self.of_byte, 256), np.tile(self.of_byte, 256))

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ids that pairs become, or -1."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.becomes[at], -1)


@lru_cache(maxsize=4)
def _merges(rank_lines: bytes) -> Merges:
    return Merges(rank_lines)


def merge_one(word: bytes, m: Merges) -> list[int]:
    """The ids of one (long) word: linked places, and a heap of (rank, place)."""
    sym = [int(m.of_byte[x]) for x in word]
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = [m.pairs.get(sym[i] << 32 | sym[i + 1], -1) for i in range(n - 1)] + [-1]
    heap = [(r, i) for i, r in enumerate(rank) if r >= 0]
    heapify(heap)
    while heap:
        r, i = heappop(heap)
        if rank[i] != r:
            continue
        j = after[i]
        sym[i], after[i], rank[j] = r, after[j], -1
        sym[j] = -1
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0:
                rank[k] = m.pairs.get(sym[k] << 32 | sym[after[k]], -1) if after[k] < n else -1
                if rank[k] >= 0:
                    heappush(heap, (rank[k], k))
    return [s for s in sym if s >= 0]


def replay(words: list[bytes], m: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words one after another, and how many each has.

    The least rank in a word always comes first, its leftmost place before others: of a merge's places, one of each
    word is taken at a time, and the rest wait, for its neighbours may now hold a lower rank.
    """
    whole = [m.ranks.get(w) for w in words]
    short = [i for i, w in enumerate(words) if whole[i] is None and len(w) <= LONG]
    size = np.array([len(words[i]) for i in short], np.int64)
    n = int(size.sum())
    raw = np.frombuffer(b"".join(words[i] for i in short), np.uint8)
    # Place n stands for "none": its pair is never known.
    sym = np.append(m.of_byte[raw], -1).astype(np.int32)
    word = np.repeat(np.arange(len(short), dtype=np.int32), size)
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    ends = np.cumsum(size)
    after[ends - 1], before[ends - size] = n, n
    rank = np.full(n + 1, -1, np.int32)
    inner = np.flatnonzero(after[:-1] < n)
    rank[inner] = m.by_bytes[raw[inner].astype(np.int32) * 256 + raw[inner + 1]]
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def add(places: np.ndarray) -> None:
        r = rank[places]
        places, r = places[r >= 0], r[r >= 0]
        if not len(places):
            return
        order = np.argsort(r, kind="stable")
        places, r = places[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(r)], strict=True):
            put = index.get(k := int(r[a]))
            if put is None:
                index[k] = [places[a:z]]
                heappush(heap, k)
            else:
                put.append(places[a:z])

    add(inner)
    while heap:
        r = heappop(heap)
        held = index.pop(r)
        at = held[0] if len(held) == 1 else np.concatenate(held)
        at = at[rank[at] == r]
        if len(at) > 1:
            at = np.unique(at)
            w = word[at]
            first = np.append(True, w[1:] != w[:-1])
            if not first.all():
                index[r] = [at[~first]]
                heappush(heap, r)
                at = at[first]
        if not len(at):
            continue
        gone, left = after[at], before[at]
        sym[at] = r
        right = after[gone]
        after[at], before[right] = right, at
        sym[gone], rank[gone] = -1, -1
        rank[at] = m.look_up(sym[at], sym[right])
        rank[left] = m.look_up(sym[left], sym[at])
        rank[n] = -1
        add(np.concatenate((at, left[left < n])))
    alive = sym[:-1] >= 0
    counts = np.bincount(word[alive], minlength=len(short))
    merged, starts = sym[:-1][alive], np.concatenate(([0], np.cumsum(counts)))
    if len(short) == len(words):
        return merged, counts
    each: list[np.ndarray] = [np.array([w], np.int32) if w is not None else merged[:0] for w in whole]
    for k, i in enumerate(short):
        each[i] = merged[starts[k] : starts[k + 1]]
    for i, w in enumerate(words):
        if whole[i] is None and len(w) > LONG:
            each[i] = np.array(merge_one(w, m), np.int32)
    return np.concatenate([*each, merged[:0]]), np.array([len(x) for x in each], np.int64)


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + sizes[i]] for every i, one after another."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row's whole text, as tiktoken's encode_ordinary gives them. No special tokens.

    Null and empty texts have no ids (an empty list). Row ids may be null or repeat; other columns are ignored. rank_file: a rank file
    in tiktoken's format (about 1 MB, of fixed size), read by the driver and sent as a broadcast variable.
    """
    with open(rank_file, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, m = regex.compile(pattern).findall, _merges(ranks.value)
        for batch in pieces(batches, 1, SHARD):
            codes: dict[str, int] = {}
            rows, n_words = [], []
            for text in pc.fill_null(batch.column(1), "").to_pylist():
                found = split(text)
                rows.append(np.array([codes.setdefault(w, len(codes)) for w in found], np.int32))
                n_words.append(len(found))
            flat = np.concatenate(rows)
            ids, counts = replay([w.encode() for w in codes], m)
            starts = np.cumsum(counts) - counts
            sizes = counts[flat] if len(flat) else np.zeros(0, np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(n_words)))]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(gather(ids, starts[flat], sizes) if len(flat) else ids[:0], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(shards, StructType([docs.schema[id_col], StructField("ids", ArrayType(IntegerType()))]))


def decode(encoded: DataFrame, rank_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of the table and the bytes that its ids stand for. A null list gives null, an empty one no bytes; an unknown id is an error."""
    with open(rank_file, "rb") as f:
        ranks = encoded.sparkSession.sparkContext.broadcast(f.read())
    names = encoded.columns
    if out_col in names:
        raise ValueError(f"the table has a column {out_col!r} already")
    at = names.index(ids_col)

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _merges(ranks.value)
        for whole in batches:
            lists = whole.column(at)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(m.token_len) or not m.token_len[ids].all()):
                raise ValueError("an id that the rank file doesn't hold")
            n_ids = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            id_ends = np.concatenate(([0], np.cumsum(n_ids, dtype=np.int64)))
            byte_ends = np.concatenate(([0], np.cumsum(m.token_len[ids])))[id_ends]
            for begin, end in cuts(np.diff(byte_ends), DECODED):
                mine = ids[id_ends[begin] : id_ends[end]]
                data = gather(m.token_bytes, m.token_at[mine], m.token_len[mine])
                offsets = (byte_ends[begin : end + 1] - byte_ends[begin]).astype(np.int32)
                out = pa.Array.from_buffers(pa.binary(), end - begin, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                batch = whole.slice(begin, end - begin)
                if batch.column(at).null_count:
                    out = pc.if_else(pc.is_valid(batch.column(at)), out, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*names, out_col])

    return encoded.mapInArrow(spelled, StructType([*encoded.schema.fields, StructField(out_col, BinaryType())]))
