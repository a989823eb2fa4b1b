"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint becomes the vector of the bit counts of its segments. The Manhattan distance of two such vectors
is at most the Hamming distance of the fingerprints, so pairs within the radius lie within it here too. The segments
are dealt into bands. A distance of at most r changes at most r bands, so the vectors of a pair agree exactly in some
`bands - r` of them: the grid's cells are the choices of bands with their counts, and a range join needs only
rows of the same cell. In a cell the Manhattan bound is checked first, then the exact Hamming distance.

Equal fingerprints are one row throughout. A cell yields only links that join what it hasn't yet joined (a spanning forest),
never all pairs. Cells of many rows are cut into blocks; each pair of blocks is a task's own unit of work.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from keyharbor.llm.common import parts_for, pieces, written
from keyharbor.llm.components import components

#: Seed of XXH64 for a shingle.
SEED = 42
#: Rows of a block of a cell.
BLOCK = 512
#: Numbers of fingerprints beyond which cells get one band more.
FULL = (30_000_000, 1_000_000_000)


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle of `words` words, repeats included; a text of fewer words is one, none has none."""
    import xxhash

    found = text.lower().split()  # of bytes: ASCII letters and blanks only
    if not found:
        return np.zeros(0, "<u8")
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) > words:
        pairs = zip(starts[: 1 - words].tolist() if words > 1 else starts.tolist(), ends[words - 1 :].tolist(), strict=True)
    else:
        pairs = [(0, len(line))]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:z], SEED) for a, z in pairs], dtype="<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; 0 of none."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long): the 64-bit SimHash of every row's whole text, over shingles of `words` words with repeats.

    A-Z are lower-cased; a text of fewer words is one shingle; none (or a null text) gives 0. Other columns are ignored.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, 8 << 20):
            texts = pc.fill_null(batch.column(1), "").cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(shingle_hashes(t, words)) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(hashed, StructType([docs.schema[id_col], StructField("fp", LongType())]))


def embedding(fp: str, segment_bits: int):
    """The bit counts of a fingerprint's segments, as an array of bytes."""
    mask = (1 << segment_bits) - 1
    return F.array(*(F.bit_count(F.shiftrightunsigned(fp, i).bitwiseAND(F.lit(mask).cast("long"))).cast("byte") for i in range(0, 64, segment_bits)))


def _vectors(fp: np.ndarray, segment_bits: int) -> np.ndarray:
    """embedding() of many fingerprints: a row of bit counts each."""
    at = np.arange(0, 64, segment_bits, dtype=np.uint64)
    return np.bitwise_count(fp.view(np.uint64)[:, None] >> at & np.uint64((1 << segment_bits) - 1)).astype(np.int8)


def _forest(a: np.ndarray, b: np.ndarray, radius: int, segment_bits: int) -> list[tuple[int, int]]:
    """Links within the radius between a and b that suffice to join what they join (b is a: within a)."""
    parent = {x: x for x in (*a.tolist(), *b.tolist())}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    va, vb = _vectors(a, segment_bits), _vectors(b, segment_bits)
    ua, ub = a.view(np.uint64), b.view(np.uint64)
    out = []
    for i in range(len(a)):
        close = np.flatnonzero(np.abs(va[i] - vb).sum(axis=1) <= radius)  # the lower bound
        for j in close[np.bitwise_count(ua[i] ^ ub[close]) <= radius].tolist():
            x, y = root(int(a[i])), root(int(b[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((int(a[i]), int(b[j])))
    return out


def near_links(distinct: DataFrame, radius: int = 4, segment_bits: int = 2, bands: int | None = None) -> DataFrame:
    """(a, b): links between fingerprints (column fp, distinct) that join all those within the radius, however many agree in a cell.

    bands: over the radius; more make cells smaller and rows more (one for each choice of bands - radius), and results stay the same.
    If not given, the number of fingerprints decides: radius + 2, and one more for each of the FULL that it passes.
    """
    bands = bands or radius + 2 + sum(distinct.count() > n for n in FULL)
    chosen = list(combinations(range(bands), bands - radius))
    edges = [round(i * (64 // segment_bits) / bands) for i in range(bands + 1)]
    cells = [F.xxhash64(F.lit(k), *(F.slice("_vector", edges[b] + 1, edges[b + 1] - edges[b]) for b in c)) for k, c in enumerate(chosen)]
    rows = distinct.withColumn("_vector", embedding("fp", segment_bits)).select("fp", F.explode(F.array(*cells)).alias("cell"))
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("cell", "_cell")
    # Rows of cells with company; a large cell gets blocks, and each row goes to every pair of blocks that it belongs to.
    shared = rows.join(sizes, F.col("cell") == F.col("_cell")).select("fp", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    shared = shared.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least("own", other).alias("i"), F.greatest("own", other).alias("j")))
    units = shared.select("fp", "cell", "own", F.explode(pairs).alias("p")).select("fp", F.xxhash64("cell", "p.i", "p.j").alias("unit"), (F.col("own") == F.col("p.i")).alias("first"), (F.col("p.i") == F.col("p.j")).alias("single"))
    units = units.repartition(parts_for(distinct.sparkSession), "unit").sortWithinPartitions("unit")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(fp: np.ndarray, unit: np.ndarray, first: np.ndarray, single: np.ndarray) -> pa.RecordBatch:
            out: list[tuple[int, int]] = []
            cuts = np.concatenate(([0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]))
            size = np.diff(cuts)
            two = cuts[:-1][size == 2]  # most cells hold two rows: all at once
            if len(two):
                ok = np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= radius
                out += zip(fp[two[ok]].tolist(), fp[two[ok] + 1].tolist(), strict=True)
            for k in np.flatnonzero(size > 2).tolist():
                x, f = fp[cuts[k] : cuts[k + 1]], first[cuts[k] : cuts[k + 1]]
                out += _forest(x, x, radius, segment_bits) if single[cuts[k]] else _forest(x[f], x[~f], radius, segment_bits)
            pairs = np.array(out, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            now = [np.concatenate((h, x)) for h, x in zip(held, now, strict=True)] if held else now
            cut = int(np.searchsorted(now[1], now[1][-1]))  # the last unit may go on in the next batch
            if cut:
                yield links(*(x[:cut] for x in (now[0], now[1], now[2], now[3])))
            held = [x[cut:] for x in now]
        if held:
            yield links(*held)

    return units.mapInArrow(linked, StructType([StructField("a", LongType()), StructField("b", LongType())]))


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, segment_bits: int = 2, bands: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint string of 16 hex digits, component_id): the least id reachable over fingerprints that differ in `radius` bits or fewer.

    Null ids take part and are never a component_id unless no other id is there. Repeated rows stay. Empty and null
    texts have fingerprint zero and link like any other. An empty table gives no rows.
    """
    marked = written(fingerprints(docs, words, id_col, text_col).withColumnRenamed(id_col, "id"), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct")
    parts = components(near_links(distinct.select("fp"), radius, segment_bits, bands), "a", "b")
    joined = distinct.join(parts, distinct["fp"] == parts["node"], "left").select("fp", "least_id", F.coalesce("component", "fp").alias("class"))
    least = joined.groupBy("class").agg(F.min("least_id").alias("component_id"))
    classes = joined.join(least, "class").select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(classes, F.col("fp") == F.col("_fp")).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
