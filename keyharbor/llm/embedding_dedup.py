"""Near-duplicate embeddings through an inverted multi-index.

Two codebooks, one for each half of a vector, form a product grid; the index holds every vector in the cell of its two
nearest codewords. A query visits cells in the order of its summed distances to their codewords (the multi-sequence
order), as many as a calibration on the sample shows to be enough for the target recall. What it meets there is
verified by the exact cosine. Equal vectors of a label are one row throughout, with their number, so that copies cost nothing.

Work is dealt by cell and block: an index cell of many rows is cut into blocks, and so are the queries that
visit it, so that no group of near-identical vectors lands in one task. A task counts links and returns those that
join what it hasn't yet joined, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from keyharbor.llm.common import written
from keyharbor.llm.components import components

#: Rows of a block of an index cell, and of the queries that visit it.
BLOCK = 512
#: Vectors of a cell, about, by which the grid grows.
FILL = 200
#: Bytes of vectors that a task works on at once.
PIECE = 4 << 20
#: Parts that a cell's rows are dealt in before they are cut into blocks.
SALTS = 16


@dataclass(frozen=True)
class Settings:
    """sample_rows: different vectors that codebooks and calibration are fitted on, at most (the index holds every vector).

    words: codewords of a half; the grid has words ** 2 cells. If not given, as many as give cells of FILL vectors, from least_words on to as many
    as a tenth of the sample. recall: share of partners at the widest angle that a query alone finds (either of a pair may find the other, so pairs are missed more rarely).
    A query visits as many cells as that takes, all of them if need be.
    """

    least_cosine: float = 0.93
    sample_rows: int = 6000
    words: int | None = None
    least_words: int = 16
    recall: float = 0.98
    rounds: int = 12
    seed: int = 3


@dataclass
class Index:
    """Codebooks of the halves, the number of cells that a query visits, and the share of the sample's moved vectors that this finds."""

    first: np.ndarray
    second: np.ndarray
    visits: int
    recall: float = 1.0

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def _distances(self, x: np.ndarray) -> list[np.ndarray]:
        h = self.first.shape[1]
        return [(part**2).sum(1)[:, None] - 2 * part @ c.T + (c**2).sum(1) for part, c in ((x[:, :h], self.first), (x[:, h:], self.second))]

    def home(self, x: np.ndarray) -> np.ndarray:
        a, b = self._distances(x)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)

    def rank(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How many cells each row visits before, or as soon as, that cell."""
        out = []
        for i in range(0, len(x), max(1, (1 << 22) // self.cells)):
            z = slice(i, i + max(1, (1 << 22) // self.cells))
            a, b = self._distances(x[z])
            k = np.arange(len(a))
            at = a[k, cell[z] // len(self.second)] + b[k, cell[z] % len(self.second)]
            out.append((a[:, :, None] + b[:, None, :] <= at[:, None, None]).sum(axis=(1, 2)))
        return np.concatenate(out)

    def order(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest cells of each row, nearest first: the multi-sequence order over sums of two sorted lists of distances."""
        near = self._distances(x)
        ranks = [np.argsort(d, axis=1, kind="stable") for d in near]
        best = [np.take_along_axis(d, r, 1) for d, r in zip(near, ranks, strict=True)]
        # The n least sums are among the places (i, j) with (i + 1)(j + 1) <= n of the two sorted lists.
        i, j = np.nonzero((np.arange(best[0].shape[1])[:, None] + 1) * (np.arange(best[1].shape[1]) + 1) <= n)
        sums = best[0][:, i] + best[1][:, j]
        rows = np.arange(len(x))[:, None]
        take = np.argpartition(sums, n - 1, axis=1)[:, :n] if n < sums.shape[1] else np.tile(np.arange(sums.shape[1]), (len(x), 1))
        take = np.take_along_axis(take, np.argsort(np.take_along_axis(sums, take, 1), axis=1, kind="stable"), 1)
        return ranks[0][rows, i[take]] * len(self.second) + ranks[1][rows, j[take]]


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n == 0, 1, n)


def _codebook(x: np.ndarray, words: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), min(words, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((c**2).sum(1) - 2 * x @ c.T, axis=1)
        for k in range(len(c)):
            if (mine := near == k).any():
                c[k] = x[mine].mean(axis=0)
    return c


def fit_index(vectors: DataFrame, settings: Settings = Settings()) -> Index:
    """Codebooks and visits from the sample (column v, all different): the vectors of the least hashes, sample_rows at most.

    visits is the least number of cells within which that share of the sample's vectors moved by the widest angle allowed, in random
    directions, is found again: partners at exactly the least cosine are the hardest to find. Real partners of the sample (those within the angle) count too.
    """
    s = settings
    rng = np.random.default_rng(s.seed)
    rows = vectors.select("v").orderBy(F.xxhash64("v"), "v").limit(s.sample_rows).collect()
    x = _unit(np.array([r["v"] for r in rows], float))
    words = s.words or int(np.clip(round((vectors.count() / FILL) ** 0.5), s.least_words, max(s.least_words, len(x) // 10)))
    h = x.shape[1] // 2
    index = Index(_codebook(x[:, :h], words, s.rounds, rng), _codebook(x[:, h:], words, s.rounds, rng), 1)
    side = rng.normal(size=x.shape)
    side = _unit(side - (side * x).sum(1, keepdims=True) * x)
    moved = index.rank(x, index.home(s.least_cosine * x + np.sqrt(1 - s.least_cosine**2) * side))
    a, b = np.nonzero(np.triu(x @ x.T >= s.least_cosine, 1))
    real = index.rank(x[a], index.home(x[b])) if len(a) else moved[:0]
    index.visits = max(int(np.sort(r)[int(np.ceil(s.recall * len(r))) - 1]) for r in (moved, real) if len(r))
    index.recall = float((moved <= index.visits).mean())
    return index


def usable(vector_col: str, label_col: str) -> Column:
    """Whether a row can link. Null, zero, null or non-finite components, or a null label: it can't."""
    v = F.col(vector_col)  # floats stay floats while they are moved; tasks compute in double precision
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.col(label_col).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows, in double precision."""
    flat = pa.chunked_array([c.flatten() for c in (lists.chunks if isinstance(lists, pa.ChunkedArray) else [lists])]) if len(lists) else pa.array([])
    return np.asarray(flat.to_numpy(), float).reshape(len(lists), -1)


def links(vectors: DataFrame, index: Index, settings: Settings = Settings()) -> DataFrame:
    """(node, partner, n): for each node, numbers n of linked vectors by task, and links (partner) that join all that are linked.

    vectors: (node long unique, group, m, v): m equal vectors. Each pair found is counted once for either side.
    """
    s, cells = settings, index.cells
    schema = StructType([vectors.schema[c] for c in ("node", "group", "m", "v")] + [StructField("visits", ArrayType(IntegerType()))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if not whole.num_rows:
                continue
            # As many rows at once as the places that are sorted for them take.
            step = max(1, PIECE // (8 * max(index.visits * 8, 64)))
            for batch in (whole.slice(i, step) for i in range(0, whole.num_rows, step)):
                visits = index.order(_unit(_matrix(batch.column(3))), index.visits).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(visits) + 1) * visits.shape[1], pa.int32()), pa.array(visits.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=schema.names)

    placed = written(vectors.select("node", "group", "m", "v").mapInArrow(place, schema), "placed")
    home = F.get("visits", F.lit(0))
    members = placed.select("node", "group", home.alias("cell"), "m", "v", "visits")
    visitors = placed.select("node", "group", F.explode("visits").alias("cell"), "m", "v", home.alias("home"))
    # Sizes of cells and of their visitors: one row for each cell that anyone is in.
    sizes = members.groupBy("group", "cell").agg(F.count(F.lit(1)).alias("inside"))
    sizes = sizes.join(visitors.groupBy("group", "cell").agg(F.count(F.lit(1)).alias("q")), ["group", "cell"])
    sizes = sizes.select("group", "cell", F.ceil(F.col("inside") / BLOCK).cast("int").alias("mb"), F.ceil(F.col("q") / BLOCK).cast("int").alias("qb"))
    # Rows meet their cell's size under a salt, so that a cell of very many rows isn't dealt to one task before it is cut.
    salt = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(SALTS)).cast("int").alias("salt")
    sizes = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    block = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = members.select("*", salt).join(sizes, ["group", "cell", "salt"]).select("node", "group", "cell", F.col("m"), "v", "visits", block(F.col("mb")).alias("i"), every("qb").alias("j"))
    right = visitors.select("*", salt).join(sizes, ["group", "cell", "salt"]).select("node", "group", "cell", F.col("m"), "v", "home", block(F.col("qb")).alias("j"), every("mb").alias("i"))
    right = right.select(*(F.col(c).alias(f"_{c}") for c in right.columns)).toDF(*right.columns)  # columns of its own, though it comes from the same table
    keys = ["group", "cell", "i", "j"]
    out = pa.schema([("node", pa.int64()), ("partner", pa.int64()), ("n", pa.int64())])

    def compare(inside: pa.Table, visiting: pa.Table) -> pa.Table:
        if not inside.num_rows or not visiting.num_rows:
            return out.empty_table()
        a, b = inside["node"].to_numpy(), visiting["node"].to_numpy()
        x, y = (_unit(_matrix(t["v"])) for t in (inside, visiting))
        near = (y @ x.T >= s.least_cosine) & (b[:, None] != a)
        j, k = np.nonzero(near)
        if not len(j):
            return out.empty_table()
        # A member that visits its visitor's cell meets it there too, and counts it there.
        visits = _matrix(inside["visits"]).astype(np.int64)
        known = np.sort((np.arange(len(a))[:, None] * cells + visits).ravel())
        asked = k * cells + visiting["home"].to_numpy().astype(np.int64)[j]
        alone = known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] != asked
        m, q = inside["m"].to_numpy(), visiting["m"].to_numpy()
        counts = [(b, np.bincount(j, m[k], len(b))), (a, np.bincount(k[alone], q[j[alone]], len(a)))]
        parent = {n: n for n in (*a.tolist(), *b.tolist())}

        def root(n: int) -> int:
            while parent[n] != n:
                parent[n] = n = parent[parent[n]]
            return n

        joins = []
        for u, v in zip(b[j].tolist(), a[k].tolist(), strict=True):
            p, o = root(u), root(v)
            if p != o:
                parent[max(p, o)] = min(p, o)
                joins.append((u, v, 0))
        rows = [(n, None, int(c)) for who, many in counts for n, c in zip(who.tolist(), many.tolist(), strict=True) if c] + joins
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=out)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, StructType([StructField(n, LongType()) for n in out.names]))


def near_duplicates(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row: vectors of equal label with a cosine of least_cosine or more link.

    n_links: other rows linked directly. component_id: least id reachable, the row's own included. kept: the id is that one. Rows that
    can't link (usable()) stand alone; vectors link with those of their own length. Rows of one id (repeats) are linked by their own vectors each; a null id never is a component_id
    unless alone. An empty table gives no rows.
    """
    numbered = written(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label")), "vectors")
    # Equal vectors of a label are one node, with the least id and their number.
    same = numbered.where(usable("v", "label")).groupBy("label", "v").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("least_id"))
    nodes = written(same.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = None
    for r in sorted(nodes.select(F.size("v").alias("n")).distinct().collect()):  # lengths of vectors: one, as a rule
        sized = nodes.where(F.size("v") == r["n"]).select("node", F.col("label").alias("group"), "m", "v")
        these = links(sized, fit_index(sized, settings), settings)
        found = these if found is None else found.unionByName(these)
    if found is None:
        return numbered.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = written(found, "links")
    counts = found.where("partner IS NULL").groupBy(F.col("node").alias("_of")).agg(F.sum("n").alias("n"))
    parts = components(found.where("partner IS NOT NULL"), "node", "partner").withColumnRenamed("node", "_node")
    known = nodes.join(counts, F.col("node") == F.col("_of"), "left").join(parts, F.col("node") == F.col("_node"), "left")
    known = known.select("label", "v", "least_id", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "node").alias("part"))
    least = known.groupBy("part").agg(F.min("least_id").alias("component_id"))
    known = known.join(least, "part").select(F.col("label").alias("_label"), F.col("v").alias("_v"), "n_links", "component_id")
    joined = numbered.join(known, (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v")), "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
