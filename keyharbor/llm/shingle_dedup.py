"""Near-duplicates by SimHash and by shared word shingles, each link held against the exact Jaccard similarity.

SimHash comes first: fingerprints of the same shingles, linked within a few bits by segment popcounts (simhash_dedup). Each text is compared
with the first one of the least fingerprint that its own is linked with. Texts of a similarity of 0.8 may differ in more bits than any grid of popcounts prunes by, so bands complete it: further
candidates share a cell, a band of ROWS minima of the shingles' hashes under ROWS permutations. A pair of similarity s shares
one of BANDS with 1 - (1 - s ** ROWS) ** BANDS: over 0.99999 at 0.8. Texts of equal words are one row throughout; what SimHash has joined isn't compared again.
Every cell's rows are compared with one of its rows first, another one in each band; then, in cells that aren't joined as a whole, with the one that the most of these resemble, which in a group of near
copies is what they are copies of. So a large group costs a few comparisons for each of its rows. Until then a row's class is the most resembled row among
itself and those it is linked with, which takes no rounds; connected components are found once, before blocks, and then of the few classes that blocks join. In cells that are still not joined, every pair is compared: cells are cut into blocks, a pair of blocks is a unit of work, and a unit yields only
links that join what it hasn't yet joined, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from keyharbor.llm.common import pieces, written
from keyharbor.llm.components import components
from keyharbor.llm.simhash_dedup import fingerprint, near_links, shingle_hashes

BANDS, ROWS = 24, 4
#: Rows of a block of a cell.
BLOCK = 256
_ODD = np.random.default_rng(3).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _line(text: bytes) -> bytes:
    return b" ".join(text.lower().split())  # of bytes: ASCII letters and blanks only


def _node(line: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(line)).view(np.int64))


def shingles(line: bytes, words: int) -> np.ndarray:
    """Distinct hashes of the runs of `words` words of a line, in order; a line of fewer words is one."""
    return np.unique(shingle_hashes(line, words))


def cells(found: np.ndarray) -> np.ndarray:
    """The cell of each band."""
    if not len(found):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 4096):
        x = found[i : i + 4096, None] * _ODD[0]
        x ^= x >> np.uint64(32)
        least = np.minimum(least, (x * _ODD[1]).min(axis=0))
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def _lines(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in pieces(batches, column, 8 << 20):
        yield batch, [_line(t) for t in pc.fill_null(batch.column(column), "").cast(pa.binary()).to_pylist()]


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets (node, found) have a Jaccard similarity of `least` or more."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("found").alias(f"found_{c}"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                enough = min(len(x), len(y)) >= least * max(len(x), len(y))
                both = len(np.intersect1d(x, y, assume_unique=True)) if enough else 0
                near.append(enough and both >= least * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    whole = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "found_a", "found_b")
    return whole.mapInArrow(compared, StructType([StructField("a", LongType()), StructField("b", LongType())]))


def _forest(rest: DataFrame, sets: DataFrame, cells_of: DataFrame, least: float) -> DataFrame:
    """(a, b): classes of rows of one cell (node, cell, class) that are alike, as many as join all such. cells_of: (node, cells)."""
    sizes = rest.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).withColumnRenamed("cell", "_cell")
    rows = rest.join(sizes, F.col("cell") == F.col("_cell")).withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    units = rows.select("node", "cell", "class", "own", F.explode(pairs).alias("p")).select("node", "cell", "class", "own", "p.i", "p.j")
    held = sets.join(cells_of.select(F.col("node").alias("_of"), "cells"), F.col("node") == F.col("_of")).select(F.col("node").alias("_node"), "found", "cells")
    units = units.join(held, F.col("node") == F.col("_node")).select("node", "cell", "class", "own", "i", "j", "found", "cells")
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def compare(unit: pa.Table) -> pa.Table:
        own, at_class = unit["own"].to_numpy(), unit["class"].to_pylist()
        at = unit["cells"].combine_chunks().flatten().to_numpy().reshape(len(own), BANDS)
        here, first, second = unit["cell"][0].as_py(), unit["i"][0].as_py(), unit["j"][0].as_py()
        band = int(np.flatnonzero(at[0] == here)[0])
        found = [np.frombuffer(x, "<u8") for x in unit["found"].to_pylist()]
        size = np.array([len(x) for x in found])
        parent = {c: c for c in at_class}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        left = np.flatnonzero(own == first)
        for k in left.tolist():
            others = np.flatnonzero(own == second)
            others = others[others > k] if first == second else others
            # Pairs that share an earlier band's cell are that cell's; sizes must allow the similarity.
            others = others[~(at[others, :band] == at[k, :band]).any(axis=1) & (np.minimum(size[others], size[k]) >= least * np.maximum(size[others], size[k]))]
            for o in others.tolist():
                x, y = root(at_class[k]), root(at_class[o])
                if x != y:
                    both = len(np.intersect1d(found[k], found[o], assume_unique=True))
                    if both >= least * (size[k] + size[o] - both):
                        parent[x] = y
                        out.append((at_class[k], at_class[o]))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ([], []))], names=["a", "b"])

    return units.groupBy("cell", "i", "j").applyInArrow(compare, schema)


def near_duplicates(docs: DataFrame, words: int = 5, least: float = 0.8, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component_id, th, kept) of every row: the least id reachable over texts whose shingles have a Jaccard similarity of `least` or more.

    radius: bits in which fingerprints differ that SimHash links. It decides what bands are left with, not what is found.

    A-Z are lower-cased. Texts without a word, null ones too, are alike. Null ids take part and are never a component_id unless
    no other id is there. th: hash of the row's text. kept: of its group, the row has the least id (nulls last) and, of that id's texts, the least th. Repeated rows stay. An empty table gives no rows.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lines in _lines(batches, 1):
            hashes = [shingle_hashes(x, words) for x in lines]
            at, fp = [cells(np.unique(x)) for x in hashes], np.array([fingerprint(x) for x in hashes], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([_node(x) for x in lines], pa.int64()), pa.array(fp), pa.array(at, pa.list_(pa.int64()))], names=["id", "th", "node", "fp", "cells"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lines in _lines(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array([_node(x) for x in lines], pa.int64()), batch.column(0)], names=["node", "text"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lines in _lines(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(x, words).tobytes() for x in lines], pa.binary())], names=["node", "found"])

    node = StructField("node", LongType())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    marked = written(rows.mapInArrow(placed, StructType([rows.schema["id"], StructField("th", LongType()), node, StructField("fp", LongType()), StructField("cells", ArrayType(LongType()))])), "shingled")
    distinct = written(marked.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("least"), F.first("fp").alias("fp"), F.first("cells").alias("cells")), "distinct")
    # SimHash: texts beside the first one of the least fingerprint that theirs is linked with, or else of their own.
    linked = near_links(distinct.select("fp").distinct(), radius).groupBy(F.greatest("a", "b").alias("_fp")).agg(F.min(F.least("a", "b")).alias("to"))
    grouped = distinct.join(linked, F.col("fp") == F.col("_fp"), "left").select("node", F.coalesce("to", "fp").alias("group"))
    head = distinct.groupBy(F.col("fp").alias("_group")).agg(F.min("node").alias("a"))
    marks = written(grouped.join(head, F.col("group") == F.col("_group")).where("node <> a").select("a", F.col("node").alias("b")), "marks")
    held = distinct.select("node", F.explode("cells").alias("cell"))
    order = F.xxhash64("node", "cell")  # another row leads in each band
    first = held.groupBy("cell").agg(F.min_by("node", F.struct(order, "node")).alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("cell").alias("_cell"), "a")
    shared = written(held.join(first, F.col("cell") == F.col("_cell")).select("node", "cell", "a"), "shared")
    some = shared.select(F.col("node").alias("_node")).union(marks.select(F.explode(F.array("a", "b")))).distinct()
    texts = rows.select("text").mapInArrow(named, StructType([node, rows.schema["text"]]))
    texts = texts.join(some, texts["node"] == some["_node"], "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    sets = written(texts.mapInArrow(found, StructType([node, StructField("found", BinaryType())])), "sets")
    near = written(_alike(marks, sets, least), "near")
    # What SimHash has joined: texts that resemble the same one.
    of = lambda c: near.select(F.col("b").alias(f"_{c}"), F.col("a").alias(f"of_{c}"))
    left = shared.where("node <> a").select("a", F.col("node").alias("b")).distinct().join(of("a"), F.col("a") == F.col("_a"), "left").join(of("b"), F.col("b") == F.col("_b"), "left")
    left = left.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    links = written(near.unionByName(_alike(left, sets, least)), "links")

    def apart(classes: DataFrame) -> DataFrame:
        """(node, cell, class, n) of the cells whose rows aren't all of one class (_node, component, n)."""
        rows = shared.join(classes, shared["node"] == classes["_node"], "left").select("node", "cell", F.coalesce("component", "node").alias("class"), F.coalesce("n", F.lit(0)).alias("n"))
        mixed = rows.groupBy("cell").agg(F.min("class").alias("l"), F.max("class").alias("m")).where("l <> m").select(F.col("cell").alias("_cell"))
        return written(rows.join(mixed, F.col("cell") == F.col("_cell"), "left_semi"), "rest")

    # n: links of a row. Rows that are linked with the same one are joined, so the one with the most links will do for a class.
    alike = links.select(F.explode(F.array("a", "b")).alias("_like")).groupBy("_like").agg(F.count(F.lit(1)).alias("n"))
    pair = lambda x, y: F.struct(F.col(x).alias("node"), F.col(y).alias("_other"))
    beside = links.select(F.explode(F.array(pair("a", "b"), pair("b", "a"), pair("a", "a"), pair("b", "b"))).alias("p")).select("p.*").join(alike, F.col("_other") == F.col("_like"))
    most = beside.groupBy(F.col("node").alias("_node")).agg(F.max(F.struct("n", "_other")).alias("top"), F.max(F.when(F.col("node") == F.col("_other"), F.col("n"))).alias("n"))
    rest = apart(most.select("_node", F.col("top._other").alias("component"), "n"))
    # The row that the most leaders resemble leads now.
    hub = rest.groupBy("cell").agg(F.max(F.struct("n", "node", "class")).alias("hub")).select(F.col("cell").alias("_cell"), F.col("hub.node").alias("a"), F.col("hub.class").alias("_class"))
    again = rest.join(hub, F.col("cell") == F.col("_cell")).where("class <> _class").select("a", F.col("node").alias("b")).distinct()
    parts = components(links.unionByName(_alike(again, sets, least)), "a", "b").withColumnRenamed("node", "_node")
    forest = _forest(apart(parts.withColumn("n", F.lit(0))), sets, distinct, least)
    wider = components(forest, "a", "b").select(F.col("node").alias("_part"), F.col("component").alias("whole"))
    joined = distinct.join(parts, F.col("node") == F.col("_node"), "left").select("node", "least", F.coalesce("component", "node").alias("part"))
    joined = joined.join(wider, F.col("part") == F.col("_part"), "left").select("node", "least", F.coalesce("whole", "part").alias("class"))
    of_class = joined.groupBy("class").agg(F.min("least").alias("first"))
    known = joined.join(of_class, "class").select(F.col("node").alias("_node"), "first")
    kept = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th"))
    return marked.join(known, F.col("node") == F.col("_node")).select(F.col("id").alias(id_col), F.col("first.id").alias("component_id"), "th", kept.alias("kept"))
