"""Exact substring dedup: shards of candidate text, each with a suffix array by induced sorting.

A string of `least` bytes goes if it also starts in a document of a smaller id. Whole corpora have no suffix array in one
task, so text is routed to shards by content:

1. Documents are packed into blocks, a table bucketed by block, so that later joins with it move no text.
2. Every window of `least` bytes has an anchor: the least hash of the GRAM-byte strings in it. Equal windows have equal anchors,
   wherever they stand. Neighbouring windows of one anchor form a stretch. A block asks, for each of its stretches, who
   else has the anchor; questions are dealt by anchor, a row for each group of blocks and bucket.
3. The answer tells which anchors stand in several documents, and which stretches another document has as a whole: stretches are named by a
   BLAKE2b digest of their bytes beside their anchor (112 bits or more in all), and within a block those of one name are held against each other byte by byte. Only stretches whose
   anchor has several versions need more; one copy of each version goes to the anchor's shard.
4. A shard sorts its suffixes by induced sorting and takes the permuted common prefixes: suffixes that share `least` bytes are neighbours, and
   all but those of the smallest id among them are found again.
5. Blocks take what was found, at every place of their documents that has the version sent, and cut them.

A very common string is one version for each block that holds it, however many documents do. An anchor with
very many versions is dealt by a second anchor, of longer strings, so that its stretches fall into a few pieces each; where that one has very many texts too,
by whole windows. So no shard depends on one anchor. Shards are as many as the text asks for.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from keyharbor.llm.common import parts_for, pieces, run_dir, written
from keyharbor.llm.suffix_array import permuted_prefixes, suffix_array, words64
from keyharbor.sources.scratch import deleted

#: Bytes of text of a block.
BLOCK = 1 << 19
#: Bytes of an anchor.
GRAM = 20
#: Windows of a stretch, at most.
LONGEST = 64
#: Versions of an anchor beyond which it is dealt by second anchors.
MANY = 2000
#: Texts of a second anchor beyond which it is dealt by windows.
HOT = 20_000
#: Questions of a group of blocks, about.
ASKED = 1 << 20
#: Bytes of text of a shard, about: that is what one suffix array is built over.
SORTED = 1 << 20
#: Null ids: later than any other.
NO_ID = np.iinfo(np.int64).max

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0xD1342543DE82EF95


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x ^= x >> np.uint64(27)
    x *= _MIX[2]
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Stretches:
    """Stretches of a block: start, count (windows), doc (its place in the block), h (anchor), g (hash of the bytes)."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, least: int):
        n, self.least = len(data), least
        none = np.zeros(0, np.int64)
        self.start, self.count, self.doc, self.h, self.g = none, none, none, none.astype(np.uint64), none.astype(np.uint64)
        if n < least:
            return
        w = self.words = words64(data)
        m = n - GRAM + 1
        grams = _mixed(w[:m] * _MIX[0] ^ _mixed(w[8 : m + 8]) + w[GRAM - 8 : m + GRAM - 8])
        span = least - GRAM + 1  # grams of a window
        low, width = grams, 1
        while width * 2 <= span:
            low, width = np.minimum(low[:-width], low[width:]), width * 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        docs = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(np.concatenate(([0], ends))))
        valid = docs[: n - least + 1] == docs[least - 1 :]
        fresh = np.append(True, (low[1:] != low[:-1]) | (docs[1 : len(low)] != docs[: len(low) - 1]) | ~valid[:-1]) & valid
        start = np.flatnonzero(fresh)
        count = np.bincount(np.cumsum(fresh)[valid] - 1, minlength=len(start))
        parts = -(-count // LONGEST)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        self.start = np.repeat(start, parts) + LONGEST * within
        self.count = np.minimum(LONGEST, np.repeat(count, parts) - LONGEST * within)
        self.doc, self.h = docs[self.start], _mixed(low[self.start])  # mixed anew: the least of many hashes are small numbers
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(grams * _powers(BLOCK + 2 if m <= BLOCK else m + 2)[0][:m], dtype=np.uint64)))
        self.span = span
        self.g = self.hash_of(self.start, self.count)

    def hash_of(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Hashes of the bytes of some windows in a row: alike wherever they stand."""
        end = start + count + self.span - 1
        m = len(self.sums) - 1
        down = _powers(BLOCK + 2 if m <= BLOCK else m + 2)[1]
        return _mixed((self.sums[end] - self.sums[start]) * down[start] + count.astype(np.uint64))

    def second(self) -> np.ndarray:
        """The second anchor of each window of the block: the least hash of the strings in it that are longer than a first anchor's."""
        k = (self.span + 1) // 2  # grams of such a string
        start = np.arange(len(self.sums) - k)
        low = _mixed((self.sums[start + k] - self.sums[start]) * _powers(BLOCK + 2 if len(self.sums) - 1 <= BLOCK else len(self.sums) + 1)[1][start])
        span, width = self.span - k + 1, 1
        while width * 2 <= span:
            low, width = np.minimum(low[:-width], low[width:]), width * 2
        return np.minimum(low[: len(low) - (span - width)], low[span - width :]) if width < span else low

    def versions(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the stretch of each distinct (h, bytes) that stands in the least id, in order of h and g; for each stretch, which of those is its own)."""
        order = np.lexsort((ids[self.doc], self.g, self.h))
        h, g = self.h[order], self.g[order]
        first = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])) if len(order) else np.zeros(0, bool)
        own = np.empty(len(order), np.int64)
        own[order] = np.cumsum(first) - 1
        v = order[first]
        # Hashes only bring stretches together; bytes decide. One that differs all the same is a version of its own.
        other = np.flatnonzero(~self.alike(self.start, self.start[v[own]], self.count + self.least - 1))
        own[other] = len(v) + np.arange(len(other))
        return np.concatenate((v, other)), own

    def alike(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether `size` bytes from a on and from b on are the same."""
        out, at, o = np.ones(len(a), bool), np.flatnonzero(a != b), 0
        while len(at):
            whole = size[at] >= o + 8
            step = np.where(whole, o, np.maximum(size[at] - 8, 0))  # the last eight bytes; sizes are over eight
            good = self.words[a[at] + step] == self.words[b[at] + step]
            out[at[~good]] = False
            at, o = at[good & (size[at] > o + 8)], o + 8
        return out


def _digests(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Names of byte strings: 64 bits of BLAKE2b each, beside 48 bits and a bucket of their anchors, which are hashes of what they hold too."""
    named = hashlib.blake2b
    return np.frombuffer(b"".join([named(data[a : a + n], digest_size=8).digest() for a, n in zip(start.tolist(), size.tolist(), strict=True)]), "<u8")


def _packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _opened(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _pack(*arrays: np.ndarray) -> bytes:
    return _packed(b"".join(a.tobytes() for a in arrays))


def _unpack(packed: bytes, *types: str) -> list[np.ndarray]:
    raw = _opened(packed)
    n = len(raw) // sum(np.dtype(t).itemsize for t in types)
    out, at = [], 0
    for t in types:
        out.append(np.frombuffer(raw, t, count=n, offset=at))
        at += n * np.dtype(t).itemsize
    return out


def _ids(block_ids: list[int | None]) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in block_ids], np.int64)


@dataclass
class Blocks:
    """rows: (block, ids, ends, data), documents packed into blocks (data: their bytes, packed); a catalog table of that name and path, bucketed by block, for as long as joins need it."""

    rows: DataFrame
    table: str
    path: str


def blocks(docs: DataFrame, id_col: str, text_col: str) -> Blocks:
    """The blocks of the documents; as many buckets as partitions or more, so that one holds some blocks only."""
    spark = docs.sparkSession
    schema = StructType([StructField("block", LongType()), StructField("ids", ArrayType(LongType())), StructField("ends", ArrayType(IntegerType())), StructField("data", BinaryType())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, 1, BLOCK):
            texts = pc.fill_null(batch.column(1), "").cast(pa.binary())
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            row = [[block], [batch.column(0).to_pylist()], [ends.tolist()], [_packed(b"".join(texts.to_pylist()))]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()), strict=True)], names=schema.names)
            block += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(packed, schema)
    # As many buckets as Spark cuts the input into, which goes by its bytes; this reads no text.
    name, splits = f"keyharbor_blocks_{uuid.uuid4().hex}", docs.select(F.spark_partition_id().alias("p")).distinct().count()
    parts = min(max(parts_for(spark), splits), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    path = f"{run_dir(spark)}/{name}"
    rows.repartition(parts, "block").write.bucketBy(parts, "block").option("compression", "none").option("path", path).saveAsTable(name)
    return Blocks(spark.table(name), name, path)


def _questions(packed: DataFrame, least: int, buckets: int) -> DataFrame:
    """(bucket, group, asked, blocks): for each group of blocks, the distinct (anchor, version) that its blocks have of each bucket and the least id that has it there. blocks: in one row of a group, what it holds."""
    schema = StructType([StructField("bucket", IntegerType()), StructField("group", LongType()), StructField("asked", BinaryType()), StructField("blocks", ArrayType(LongType()))])

    def dealt(group: int, held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, d, g = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
        of = np.repeat(np.arange(len(held)), [len(x[1]) for x in held])
        order = np.argsort(h, kind="stable")  # a block's own ones stay in its order
        h, d, g, of = h[order], d[order], g[order], of[order]
        bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        some = np.flatnonzero(np.bincount(bucket, minlength=buckets))
        begins, ends = np.searchsorted(bucket, some), np.searchsorted(bucket, some, side="right")
        # 48 bits of the anchor beside its bucket, 64 of the version.
        asked = [_pack(*(x.astype(t) for x, t in ((h[a:z], "<u4"), (h[a:z] >> np.uint64(32) & np.uint64(0xFFFF), "<u2"), (g[a:z], "<u8"), (d[a:z], "<u4"), (d[a:z] >> 32, "<i4"), (of[a:z], "<u2")))) for a, z in zip(begins, ends, strict=True)]
        blocks = [[x[0] for x in held] if k == 0 else None for k in range(len(some))]
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(np.full(len(some), group), pa.int64()), pa.array(asked, pa.binary()), pa.array(blocks, pa.list_(pa.int64()))], names=schema.names)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows are as many as groups times buckets: blocks ask together, so that there are few, and long ones.
        held, n, group = [], 0, TaskContext.get().partitionId() << 32
        for batch in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            ((block, ids, ends, data),) = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ids, data = _ids(ids), _opened(data)
            s = Stretches(np.frombuffer(data, np.uint8), np.array(ends), least)
            v, _ = s.versions(ids)
            order = np.argsort(s.h[v], kind="stable")  # versions come by h, but for those that bytes told apart
            v = v[order]
            if len(v):
                held.append((block, s.h[v], ids[s.doc[v]], _digests(data, s.start[v], s.count[v] + least - 1)))
                n += len(v)
            if n >= ASKED or len(held) == 1 << 16:
                yield dealt(group, held)
                held, n, group = [], 0, group + 1
        if held:
            yield dealt(group, held)

    return packed.select("block", "ids", "ends", "data").mapInArrow(ask, schema)


#: Answers: nothing more to do; every stretch goes; it may hold other versions' windows; the same, and its anchor has many versions.
NOTHING, GOES, COMPARE, SPREAD = range(4)


def _answers(questions: DataFrame) -> DataFrame:
    """(block, told): an answer for each (anchor, version) that a block asked, in the order of its questions."""
    schema = StructType([StructField("bucket", IntegerType()), StructField("group", LongType()), StructField("told", BinaryType()), StructField("blocks", ArrayType(LongType()))])

    def tell(group: pa.Table) -> pa.Table:
        asked = [_unpack(x, "<u4", "<u2", "<u8", "<u4", "<i4", "<u2") for x in group["asked"].to_pylist()]
        sizes = [len(x[0]) for x in asked]
        h0, h1, g, d0, d1 = (np.concatenate([x[k] for x in asked]) for k in range(5))
        h, d = h1.astype(np.int64) << 32 | h0, d1.astype(np.int64) << 32 | d0
        order = np.lexsort((d, g, h))
        h, g, d = h[order], g[order], d[order]
        new_h = np.append(True, h[1:] != h[:-1])
        new_v = new_h | np.append(True, g[1:] != g[:-1])
        at = np.flatnonzero(new_v)
        least = d[at]  # of each version
        anchors = np.flatnonzero(new_h[at])
        several = np.maximum.reduceat(least, anchors) > np.minimum.reduceat(least, anchors)
        many = np.diff(np.append(anchors, len(at))) > MANY
        more = np.where(several, np.where(many, SPREAD, COMPARE), NOTHING)[np.cumsum(new_h) - 1]
        code = np.empty(len(order), np.uint8)
        code[order] = np.where(d > least[np.cumsum(new_v) - 1], GOES, more)
        cuts = np.cumsum([0, *sizes])
        told = [_pack(code[a:z], x[5]) for a, z, x in zip(cuts[:-1], cuts[1:], asked, strict=True)]
        return pa.Table.from_arrays([group["bucket"], group["group"], pa.array(told, pa.binary()), group["blocks"]], names=schema.names)

    def dealt(group: pa.Table) -> pa.Table:
        group = group.sort_by("bucket")
        (blocks,) = [x for x in group["blocks"].to_pylist() if x is not None]
        code, of = (np.concatenate(x) for x in zip(*(_unpack(x, "u1", "<u2") for x in group["told"].to_pylist()), strict=True))
        code = code[np.argsort(of, kind="stable")]
        cuts = np.cumsum([0, *np.bincount(of, minlength=len(blocks))])
        return pa.Table.from_arrays([pa.array(blocks, pa.int64()), pa.array([_pack(code[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], names=["block", "told"])

    told = questions.groupBy("bucket").applyInArrow(tell, schema)
    return told.groupBy("group").applyInArrow(dealt, StructType([StructField("block", LongType()), StructField("told", BinaryType())]))


def _covered(n: int, start: np.ndarray, count: np.ndarray, least: int) -> np.ndarray:
    """Edges (start, end, start, end ...) of the bytes of a block of n bytes that windows cover: `count` of them from each start."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, start, 1)
    np.add.at(depth, start + count + least - 1, -1)
    return np.flatnonzero(np.diff((np.cumsum(depth)[:-1] > 0).astype(np.int8), prepend=0, append=0))


def _everywhere(start: np.ndarray, count: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (start, count), and the same windows of each further place. places: rows (start of a stretch sent, start of one alike, windows of either), in order; windows lie within stretches sent."""
    sent, alike = places[:, 0], places[:, 1]
    if not len(sent):
        return start, count
    at = np.searchsorted(sent, start, side="right") - 1  # the last stretch with a further place that begins by then
    lies = (at >= 0) & (start < sent[at] + places[at, 2])
    first = np.searchsorted(sent, sent[at])
    n = np.where(lies, at + 1 - first, 0)
    row = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    more = np.repeat(start, n) + alike[row] - sent[row]
    return np.concatenate((start, more)), np.concatenate((count, np.repeat(count, n)))


SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])


def _picked(known: DataFrame, least: int) -> DataFrame:
    """For each block a row with `gone`, edges of the bytes that go by its answers, and `places`, where its documents have what is sent once (key null); and (key, block, start, id, text) of what shards
    sort: versions of an anchor, or, of those that are spread, their pieces by second anchors."""
    schema = StructType([StructField("key", LongType()), StructField("block", LongType()), StructField("start", IntegerType()), StructField("id", LongType()), StructField("text", BinaryType()), StructField("gone", ArrayType(IntegerType())), StructField("places", ArrayType(IntegerType()))])
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    row = lambda *columns: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            ((block, ids, ends, data, told),) = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ids, data = _ids(ids), _opened(data)
            s = Stretches(np.frombuffer(data, np.uint8), np.array(ends), least)
            v, own = s.versions(ids)
            codes = np.zeros(len(v), np.uint8)
            codes[np.argsort(s.h[v], kind="stable")] = _unpack(told, "u1")[0] if told else 0
            goes = (codes[own] == GOES) | (ids[s.doc] > ids[s.doc[v]][own])
            a, b = v[codes == COMPARE], v[codes == SPREAD]
            # The least id may have a version again: what is found for the stretch sent holds there too.
            again = np.flatnonzero((codes[own] >= COMPARE) & ~goes & (v[own] != np.arange(len(own))))
            places = np.stack((s.start[v[own[again]]], s.start[again], s.count[again]), axis=1)
            places = places[np.argsort(places[:, 0], kind="stable")]
            gone = _covered(len(data), s.start[goes], s.count[goes], least)
            yield row([None], [block], [None], [None], [None], [gone], [places.ravel()])
            # Spread versions go in pieces of one second anchor: equal windows have equal ones, whatever their anchor's other versions are.
            reps = s.count[b]
            start = np.repeat(s.start[b], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            second = s.second()[start] if len(b) else start.astype(np.uint64)
            new = np.append(True, (second[1:] != second[:-1]) | (np.diff(np.repeat(np.arange(len(b)), reps)) > 0))[: len(start)]
            heads = np.flatnonzero(new)
            who = np.repeat(ids[s.doc[b]], reps)[heads]
            key = np.concatenate((s.h[a], second[heads])).view(np.int64)
            starts = np.concatenate((s.start[a], start[heads]))
            size = np.concatenate((s.count[a], np.diff(np.append(heads, len(start))))) + least - 1
            owner = np.concatenate((ids[s.doc[a]], who))
            for i in range(0, len(key), 20_000):
                z = slice(i, i + 20_000)
                texts = [data[x : x + n] for x, n in zip(starts[z].tolist(), size[z].tolist(), strict=True)]
                yield row(key[z], np.full(len(texts), block), starts[z].astype(np.int32), owner[z], texts, [None] * len(texts), [None] * len(texts))

    return known.select("block", "ids", "ends", "data", "told").mapInArrow(pick, schema)


def _company(texts: list[bytes], ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, windows): runs of windows whose hash a text of another id has: of the others, whose hashes differ, none is found."""
    sizes = np.array([len(t) for t in texts], np.int64)
    w = words64(np.frombuffer(b"".join(texts), np.uint8))
    text = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(np.arange(len(text)) + least <= np.cumsum(sizes)[text])
    h = np.zeros(len(at), np.uint64)
    for o in [*range(0, least - 7, 8), max(0, least - 8)]:
        h = _mixed(h ^ w[at + o] * _MIX[0])
    order = np.argsort(h)
    h, who = h[order], ids[text[at[order]]]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
    mixed = np.minimum.reduceat(who, first) != np.maximum.reduceat(who, first) if len(first) else np.zeros(0, bool)
    at = np.sort(at[order[np.repeat(mixed, np.diff(np.append(first, len(h))))]])
    heads = np.flatnonzero(np.append(True, (np.diff(at) > 1) | (np.diff(text[at]) > 0))[: len(at)])
    of = text[at[heads]]
    return of, at[heads] - (np.cumsum(sizes) - sizes)[of], np.diff(np.append(heads, len(at)))


def repeated(texts: list[bytes], ids: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(text, start, windows): runs of windows of `least` bytes that a text of a smaller id holds too, by one suffix array over all that texts can share."""
    of, start, count = _company(texts, ids, least)
    if not len(of):
        return []
    parts = [texts[k][a : a + n + least - 1] for k, a, n in zip(of.tolist(), start.tolist(), count.tolist(), strict=True)]
    return [(int(of[k]), int(start[k]) + a, n) for k, a, n in _shared(parts, ids[of], least)]


def _shared(texts: list[bytes], ids: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    begins = np.cumsum(sizes + 1) - sizes - 1
    t = joined.astype(np.int32) + 2
    t[begins + sizes] = 1  # between texts
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1)
    valid = np.arange(len(t)) + least <= (begins + sizes)[text]
    sa = suffix_array(np.append(t, 0))[1:]
    same = permuted_prefixes(joined, sa, (begins + sizes)[text] - np.arange(len(t)), least) >= least
    rows = sa[valid[sa]]
    heads = np.flatnonzero(~same[rows])
    lowest = np.minimum.reduceat(ids[text[rows]], heads)
    found = np.zeros(len(t) + 1, bool)
    found[rows] = ids[text[rows]] > np.repeat(lowest, np.diff(np.append(heads, len(rows))))
    edges = np.flatnonzero(found[1:] != found[:-1]) + 1
    edges = np.concatenate(([0], edges)) if found[0] else edges
    return [(int(text[a]), int(a - begins[text[a]]), int(z - a)) for a, z in zip(edges[::2], edges[1::2], strict=True)]


def _by_windows(hot: DataFrame, least: int) -> DataFrame:
    """The candidates, window by window: equal ones of a block are one row, of its least id. also: where that id has it; later: where others do (joined by commas: text is cheaper than arrays on the way to Python)."""
    at = F.sequence(F.lit(0), F.length("text") - least)
    each = hot.select("block", "start", "id", "text", F.explode(at).alias("o")).select("block", "id", (F.col("start") + F.col("o")).alias("start"), F.substring("text", F.col("o") + 1, F.lit(least)).alias("text"))
    rows = each.groupBy("block", "text").agg(F.min("id").alias("id"), F.collect_list(F.struct("id", "start")).alias("places"))
    starts = lambda mine: F.array_join(F.transform(F.filter("places", lambda p: mine(p["id"])), lambda p: p["start"]), ",")
    return rows.select(F.xxhash64("text").alias("key"), "block", F.lit(None).cast("int").alias("start"), "id", "text", starts(lambda i: i == F.col("id")).alias("also"), starts(lambda i: i > F.col("id")).alias("later"))


def _sorted_shards(candidates: DataFrame, least: int) -> DataFrame:
    """(block, start, count): windows of the candidates that a smaller id has."""
    schema = StructType([StructField("block", LongType()), StructField("start", IntegerType()), StructField("count", IntegerType())])

    def sort(group: pa.Table) -> pa.Table:
        block, ids = (group[c].to_numpy() for c in ("block", "id"))
        start, (also, later) = group["start"].to_pylist(), ([[int(p) for p in x.split(",")] if x else [] for x in group[c].to_pylist()] if c in group.column_names else [[]] * group.num_rows for c in ("also", "later"))
        found = repeated(group["text"].to_pylist(), ids, least) if group.num_rows > 1 else []
        out = [(int(block[k]), at + a, n) for k, a, n in found for at in (also[k] or [start[k]])]
        out += [(int(b), at, 1) for b, places in zip(block, later, strict=True) for at in places]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=schema.names)

    keys = candidates.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select(F.col("key").alias("_key"))
    keys = written(keys, "hot")
    rows = candidates
    if not keys.isEmpty():
        of = F.col("key") == F.col("_key")
        rows = rows.join(keys, of, "left_anti").unionByName(_by_windows(rows.join(keys, of, "left_semi"), least), allowMissingColumns=True)
    # As many shards as the text asks for: none grows with it. Texts of one key meet in one shard.
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    return rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(1 + size // SORTED))).groupBy("shard").applyInArrow(sort, schema)


def _cut(found: DataFrame, least: int) -> DataFrame:
    """(id, kept, removed): each document without the bytes of its found windows."""
    schema = StructType([StructField("id", LongType()), StructField("kept", BinaryType()), StructField("removed", ArrayType(SPAN))])
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            ((ids, ends, data, gone, places, windows),) = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            data = _opened(data)
            raw, mask, begin, kept, removed = np.frombuffer(data, np.uint8), np.zeros(len(data), bool), 0, [], []
            found = (np.array([w[c] for w in windows or []], np.int64) for c in ("start", "count"))
            more = _covered(len(data), *_everywhere(*found, np.array(places or [], np.int64).reshape(-1, 3)), least)
            for edges in (gone or [], more.tolist()):
                for a, z in zip(edges[::2], edges[1::2], strict=True):
                    mask[a:z] = True
            for end in ends:
                mine = mask[begin:end]
                edges = np.flatnonzero(np.diff(mine.view(np.int8), prepend=0, append=0)).tolist()
                kept.append(raw[begin:end][~mine].tobytes() if edges else data[begin:end])
                removed.append([{"start": a, "end": z} for a, z in zip(edges[::2], edges[1::2], strict=True)])
                begin = end
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, span_type)], names=schema.names)

    return found.select("ids", "ends", "data", "gone", "places", "windows").mapInArrow(cut, schema)


def dedup_substrings(docs: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id long, kept binary, removed array<struct<start, end>>) of every row: its UTF-8 bytes without those of found strings, and their spans.

    A byte goes if a string of `least` bytes (over GRAM) that covers it also starts in a row of a smaller id; the input decides, not what is
    left of it. Null texts count as empty. Ids are integers; a null id is later than any other; rows of one id don't cut
    each other. Other columns are ignored. An empty table gives no rows.
    """
    if least <= GRAM:
        raise ValueError(f"least is over {GRAM}")
    packed = blocks(docs, id_col, text_col)
    spark, name = docs.sparkSession, packed.table
    try:
        out = written(_cut(_found(packed.rows, least), least), "cut")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        deleted(spark, packed.path)
    return out.withColumnRenamed("id", id_col)


def _found(packed: DataFrame, least: int) -> DataFrame:
    """packed, with what is to be cut from each block."""
    # A bucket's questions are held by one task: their number follows the text, whatever the number of partitions is.
    told = _answers(_questions(packed, least, max(2 * parts_for(packed.sparkSession), packed.count() // 32))).withColumnRenamed("block", "_block")
    picked = written(_picked(packed.join(told, packed["block"] == told["_block"], "left"), least), "picked")
    gone = picked.where("key IS NULL").select(F.col("block").alias("_gone_of"), "gone", "places")
    windows = written(_sorted_shards(picked.where("key IS NOT NULL").drop("gone", "places"), least), "windows")
    windows = windows.groupBy("block").agg(F.collect_list(F.struct("start", "count")).alias("windows")).withColumnRenamed("block", "_of")
    return packed.join(gone, packed["block"] == gone["_gone_of"]).join(windows, packed["block"] == windows["_of"], "left")
