"""Toxicity by a factorization machine over hashed terms.

A text is the set of the 32-bit hashes of its words and of the beginnings of its words. The score is a logistic function of
a weight for each term and of an inner product for each pair of terms, so that two terms together (an insult and the mention of a
group) can count for more or less than both alone. Terms are chosen by partial aggregates over the labelled sample; the machine is fitted
on that bounded sample and scores every text in one map stage.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from keyharbor.llm.common import pieces

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that are terms of their own.
STARTS = (4, 5, 6)


@dataclass(frozen=True)
class Settings:
    """most_rows: labelled rows of each class that are learned from, at most. most_terms: terms of the machine, at most.

    surprise: a term is taken if its G passes 2 ln(terms looked at) by this much, so that hardly any of very many terms is taken by chance.
    """

    most_rows: int = 6000
    most_terms: int = 4096
    least_docs: int = 3
    surprise: float = 0.0
    factors: int = 8
    epochs: int = 40
    batch: int = 256
    rate: float = 0.05
    decay: float = 0.02
    factor_decay: float = 0.2
    seed: int = 5


@dataclass
class Machine:
    """bias, and for each term (hashes ascending) a weight and a vector of factors."""

    bias: float
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))

    def logit(self, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """rows: places of terms, for one text after another; ends: where each text ends."""
        if not len(rows):
            return np.full(len(ends), self.bias)
        sums = np.zeros((len(ends), self.factors.shape[1]))
        of = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
        v = self.factors[rows]
        np.add.at(sums, of, v)
        squares = np.bincount(of, (v * v).sum(axis=1), len(ends))
        return self.bias + np.bincount(of, self.weights[rows], len(ends)) + 0.5 * ((sums * sums).sum(axis=1) - squares)


def word_terms(word: str) -> list[int]:
    """Hashes of a lower-case word and of its beginnings."""
    return [zlib.crc32(word.encode()), *(zlib.crc32(b"^" + word[:n].encode()) for n in STARTS if len(word) >= n)]


def terms_of(text: str) -> list[int]:
    return sorted({t for w in set(WORD.findall(text.lower())) for t in word_terms(w)})


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, most_rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, y, terms) of at most most_rows labelled rows of each class (those whose ids have the least hashes), near copies once."""
    some = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)").groupBy("_id").agg(F.max("y").alias("y"))
    take = lambda y: some.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most_rows)
    chosen = take(0).unionByName(take(1))  # 2 * most_rows small rows at most: safe to broadcast
    texts = docs.select(F.col(id_col).alias("_of"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    joined = texts.join(F.broadcast(chosen), F.col("_of") == F.col("_id")).select("_id", "y", "t")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2, 4 << 20):
            found = [terms_of(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["id", "y", "terms"])

    schema = StructType([StructField("id", chosen.schema["_id"].dataType), StructField("y", IntegerType()), StructField("terms", ArrayType(LongType()))])
    # Copies of a text would make all of its words look telling: of texts that agree in their least terms, one (of the least id) stays.
    rows = joined.mapInArrow(read, schema)
    return rows.groupBy("y", F.slice("terms", 1, 4).alias("k")).agg(F.min(F.struct("id", "terms")).alias("r")).select("r.id", "y", "r.terms")


def _informative(sample: DataFrame, n_pos: int, n_neg: int, s: Settings) -> np.ndarray:
    """The terms that tell the classes apart best, by G (log likelihood ratio) of documents that hold them; partial aggregates."""
    counts = sample.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b"))
    n = n_pos + n_neg
    a, b = F.col("a"), F.col("b")
    part = lambda seen, of_class, with_term: F.when(seen > 0, seen * F.log(seen * n / (of_class * with_term))).otherwise(0.0)
    g = 2 * (part(a, F.lit(n_pos), a + b) + part(b, F.lit(n_neg), a + b) + part(n_pos - a, F.lit(n_pos), n - a - b) + part(n_neg - b, F.lit(n_neg), n - a - b))
    seen = counts.where(a + b >= s.least_docs).select("term", g.alias("g"))
    least = 2 * math.log(max(seen.count(), 1)) + s.surprise
    best = seen.where(F.col("g") >= least).orderBy(F.desc("g"), "term").limit(s.most_terms)
    return np.sort(np.array([r["term"] for r in best.collect()], np.int64))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """A machine from the labelled rows (label 0 or 1; others are ignored). If a class has no rows, its bias alone says so."""
    s = settings
    sample = labelled_sample(docs, labels, label_col, s.most_rows, id_col, text_col).persist()
    try:
        sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
        if not n_pos or not n_neg:
            return Machine(8.0 if n_pos else -8.0)
        terms = _informative(sample, n_pos, n_neg, s)
        wanted = sample.sparkSession.createDataFrame([(int(t), i) for i, t in enumerate(terms.tolist())], "term long, place int")  # most_terms rows at most
        # An id may have several texts: each keeps terms of its own.
        texts = sample.select("id", "y", F.xxhash64("terms").alias("th"), "terms")
        held = texts.select("id", "th", F.explode("terms").alias("term")).join(F.broadcast(wanted), "term").groupBy("id", "th").agg(F.sort_array(F.collect_list("place")).alias("places"))
        found = texts.select("id", "th", "y").join(held, ["id", "th"], "left").collect()
        data = [(r["id"], r["y"], r["places"] or []) for r in sorted(found, key=lambda r: (r["id"], r["y"], r["th"]))]
    finally:
        sample.unpersist()
    prior = _prior(labels, label_col)
    return _trained(data, terms, n_pos, n_neg, prior, s)


def _prior(labels: DataFrame, label_col: str) -> float:
    share = labels.where(F.col(label_col).isin(0, 1)).agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    return min(max(share, 1e-4), 1 - 1e-4)


def _trained(data: list[tuple], terms: np.ndarray, n_pos: int, n_neg: int, prior: float, s: Settings) -> Machine:
    """Adam on the log loss, classes weighted to the prior that the labels have.

    Weights and factors shrink at every step by themselves (not through the gradient, which Adam would scale up again): terms of few
    texts stay small, and many of them in one long text don't add up to a verdict.
    """
    rng = np.random.default_rng(s.seed)
    m = Machine(float(np.log(prior / (1 - prior))), terms, np.zeros(len(terms)), rng.normal(0, 0.01, (len(terms), s.factors)))
    if not len(terms):
        return m
    y = np.array([r[1] for r in data], float)
    weight = np.where(y == 1, prior / n_pos, (1 - prior) / n_neg) * len(y)
    # Rare positives count as much as half the negatives at least, or they would hardly move the machine.
    weight[y == 1] *= max(1.0, 0.5 * (1 - prior) / prior)
    sizes = np.array([len(r[2]) for r in data])
    flat = np.array([p for r in data for p in r[2]], np.int64)
    starts = np.cumsum(sizes) - sizes
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (np.zeros(1), m.weights, m.factors)]
    step = 0
    for _ in range(s.epochs):
        order = rng.permutation(len(y))
        for lot in (order[i : i + s.batch] for i in range(0, len(y), s.batch)):
            rows = np.concatenate([flat[starts[i] : starts[i] + sizes[i]] for i in lot])
            of = np.repeat(np.arange(len(lot)), sizes[lot])
            p = 1 / (1 + np.exp(-np.clip(m.logit(rows, np.cumsum(sizes[lot])), -30, 30)))
            d = (p - y[lot]) * weight[lot] / len(lot)
            v = m.factors[rows]
            sums = np.zeros((len(lot), s.factors))
            np.add.at(sums, of, v)
            grads = [np.array([d.sum()]), np.bincount(rows, d[of], len(terms)), np.zeros_like(m.factors)]
            np.add.at(grads[2], rows, d[of, None] * (sums[of] - v))
            step += 1
            moves = []
            for g, mom in zip(grads, moments, strict=True):
                mom[0][:] = 0.9 * mom[0] + 0.1 * g
                mom[1][:] = 0.999 * mom[1] + 0.001 * g * g
                moves.append(s.rate * (mom[0] / (1 - 0.9**step)) / (np.sqrt(mom[1] / (1 - 0.999**step)) + 1e-8))
            m.bias -= float(moves[0][0])
            m.weights -= moves[1] + s.rate * s.decay * m.weights
            m.factors -= moves[2] + s.rate * s.factor_decay * m.factors
    return m


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """(id, score) of every row's whole text, 0 to 1. Null and empty texts get what the bias says; ids may be null or repeat; other columns are ignored."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {int(t): i for i, t in enumerate(machine.terms)}
        seen: dict[str, tuple[int, ...]] = {}
        for batch in pieces(batches, 1, 4 << 20):
            rows, ends = [], []
            for text in pc.fill_null(batch.column(1), "").to_pylist():
                held: set[int] = set()
                for w in set(WORD.findall(text.lower())):
                    if (found := seen.get(w)) is None:
                        if len(seen) > 200_000:
                            seen.clear()
                        found = seen[w] = tuple(place[t] for t in word_terms(w) if t in place)
                    if found:
                        held.update(found)
                rows += sorted(held)
                ends.append(len(rows))
            logit = machine.logit(np.array(rows, np.int64), np.array(ends, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], names=[id_col, score_col])

    return docs.select(id_col, text_col).mapInArrow(scored, StructType([docs.schema[id_col], StructField(score_col, DoubleType())]))
