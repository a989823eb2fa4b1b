"""Mixing sources to target weights by soft membership.

A softmax classifier, fitted on a bounded sample of a labelled table, gives each document a posterior over domains. A
document then counts for every domain by that share of its tokens. Nonnegative rates (expected copies) are fitted by
projected-gradient least squares so that the domains' expected token totals match the targets while rates stay near 1.
Each round is one distributed sum of as many numbers as there are domains; a document's rate follows from its own posterior
and the rounds' residuals, so rounds move no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from keyharbor.llm.common import pieces, whole_row, written

#: Places of a text's features: hashed shapes of words, then hashed words.
SHAPES, WORDS = 1 << 10, 1 << 16
#: Classes of bytes in a shape: capitals A, other letters a (with all bytes beyond ASCII), digits 0.
_CLASSES = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUNS = re.compile(rb"([Aa0])\1+")


@dataclass(frozen=True)
class Settings:
    """most_rows: labelled documents of each domain that are learned from, at most. pull: weight of staying near rate 1.

    rounds: of the projected gradient, at most; it ends sooner once no target is missed by more than `close` (a share of all tokens)
    beyond what the pull holds back, that is once the residual moves by less than a tenth of it.
    """

    most_rows: int = 2000
    epochs: int = 12
    batch: int = 128
    rate: float = 0.02
    pull: float = 0.01
    most_rate: float = 8.0
    rounds: int = 60
    close: float = 1e-4
    seed: int = 11


@dataclass
class Softmax:
    domains: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, places: np.ndarray, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        of = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
        z = np.tile(self.bias, (len(ends), 1))
        for d in range(len(self.domains)):
            z[:, d] += np.bincount(of, self.weights[places, d] * values, len(ends))
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def features(text: bytes) -> tuple[int, list[int], np.ndarray]:
    """Words of a text, and its features: shares of the shapes of words (THE!! is A!!), and its words, of length 1 as a vector."""
    words = Counter(text.lower().split())
    n = sum(words.values())
    if not n:
        return 0, [], np.zeros(0, np.float32)
    shapes = Counter(_RUNS.sub(rb"\1", text.translate(_CLASSES)).split())
    places = [zlib.crc32(s) % SHAPES for s in shapes] + [SHAPES + zlib.crc32(w) % WORDS for w in words]
    share = np.fromiter(shapes.values(), np.float32, len(shapes)) / n
    logs = 1 + np.log(np.fromiter(words.values(), np.float32, len(words)))
    return n, places, np.concatenate((share, logs / np.sqrt((logs * logs).sum())))


def by_place(places: list[int], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features with each place once: values of one place are added up."""
    at, back = np.unique(np.array(places, np.int64), return_inverse=True)
    return at, np.bincount(back, values, len(at)).astype(np.float32)


def fit_domains(docs: DataFrame, labelled: DataFrame, domain: Column, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> Softmax:
    """A classifier of the domains that `domain` names over the labelled table (null: not labelled). Without labelled documents: one domain "all".

    Of an id with several texts, that of the least hash is learned from. What comes to the driver has a bound: most_rows documents a domain, each with
    SHAPES + WORDS places at most, however long its text is.
    """
    s = settings
    some = labelled.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), domain.alias("domain")).where("domain IS NOT NULL").groupBy("_id").agg(F.min("domain").alias("domain"))
    names = tuple(sorted(r["domain"] for r in some.select("domain").distinct().collect()))  # as many rows as domains
    if not names:
        return Softmax(("all",), np.zeros((SHAPES + WORDS, 1)), np.zeros(1))
    chosen = None
    for name in names:
        few = some.where(F.col("domain") == name).orderBy(F.xxhash64("_id"), "_id").limit(s.most_rows)
        chosen = few if chosen is None else chosen.unionByName(few)
    # most_rows rows of each domain at most: safe to broadcast.
    texts = docs.select(F.col(id_col).alias("_of"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    joined = texts.join(F.broadcast(chosen), F.col("_of") == F.col("_id")).select("_id", "domain", F.xxhash64("t").alias("th"), "t")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 3, 4 << 20):
            found = [by_place(*features(t)[1:]) for t in batch.column(3).cast(pa.binary()).to_pylist()]
            arrays = [batch.column(0), batch.column(2), pa.array([names.index(d) for d in batch.column(1).to_pylist()], pa.int32()), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "th", "y", "places", "parts"])

    schema = StructType([StructField("id", chosen.schema["_id"].dataType), StructField("th", LongType()), StructField("y", IntegerType()), StructField("places", ArrayType(IntegerType())), StructField("parts", ArrayType(FloatType()))])
    one = joined.mapInArrow(read, schema).groupBy("id").agg(F.min(F.struct("th", "y", "places", "parts")).alias("r"))
    data = one.select("id", "r.y", "r.places", "r.parts").toArrow().sort_by("id").combine_chunks()
    return _softmax(names, data, s)


def _softmax(names: tuple[str, ...], data: pa.Table, s: Settings) -> Softmax:
    rng = np.random.default_rng(s.seed)
    model = Softmax(names, np.zeros((SHAPES + WORDS, len(names))), np.zeros(len(names)))
    y = data["y"].to_numpy()
    if not len(y):
        return model
    sizes = pc.list_value_length(data["places"]).to_numpy()
    starts = np.cumsum(sizes) - sizes
    places, values = (pc.list_flatten(data[c]).to_numpy() for c in ("places", "parts"))
    weight = len(y) / (len(names) * np.maximum(np.bincount(y, minlength=len(names)), 1))[y]
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.weights, model.bias)]
    step = 0
    for _ in range(s.epochs):
        order = rng.permutation(len(y))
        for lot in (order[i : i + s.batch] for i in range(0, len(y), s.batch)):
            at = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in lot])
            of = np.repeat(np.arange(len(lot)), sizes[lot])
            d = model.posteriors(places[at], values[at], np.cumsum(sizes[lot]))
            d[np.arange(len(lot)), y[lot]] -= 1
            d *= (weight[lot] / len(lot))[:, None]
            grads = [np.stack([np.bincount(places[at], d[of, k] * values[at], SHAPES + WORDS) for k in range(len(names))], axis=1), d.sum(axis=0)]
            step += 1
            for x, g, mom in zip((model.weights, model.bias), grads, moments, strict=True):
                mom[0][:] = 0.9 * mom[0] + 0.1 * g
                mom[1][:] = 0.999 * mom[1] + 0.001 * g * g
                x -= s.rate * (mom[0] / (1 - 0.9**step)) / (np.sqrt(mom[1] / (1 - 0.999**step)) + 1e-8)
    return model


def memberships(docs: DataFrame, model: Softmax, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, tokens, posterior array<double>) of every row's whole text. tokens: its words; th: hash of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: (SHAPES + WORDS) x domains
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("th", LongType()), StructField("tokens", LongType()), StructField("posterior", ArrayType(DoubleType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2, 4 << 20):
            found = [features(t) for t in pc.fill_null(batch.column(2), "").cast(pa.binary()).to_pylist()]
            places = np.array([p for f in found for p in f[1]], np.int64)
            p = shared.value.posteriors(places, np.concatenate([f[2] for f in found]), np.cumsum([len(f[1]) for f in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.int64()), pa.array(list(p), pa.list_(pa.float64()))], names=schema.names)

    return docs.select(F.col(id_col), F.xxhash64(text_col).alias("th"), F.col(text_col)).mapInArrow(read, schema)


def _folded(p: np.ndarray, rounds: list[tuple[np.ndarray, float]], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(rates, and the rates looked ahead to) of rows with posteriors p after these rounds: each is (residual, momentum of the next look)."""
    step = 1 / (1 + s.pull)
    rate, ahead = np.ones(len(p)), np.ones(len(p))
    for residual, momentum in rounds:
        new = np.clip(ahead - step * (p @ residual + s.pull * (ahead - 1)), 0, s.most_rate)
        ahead, rate = new + momentum * (new - rate), new
    return rate, ahead


def _rows(batch: pa.RecordBatch, at: int) -> np.ndarray:
    lists = batch.column(at)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def rates(members: DataFrame, targets: dict[str, float], domains: tuple[str, ...], settings: Settings = Settings()) -> DataFrame:
    """members and `rate`: nonnegative, so that the sum of rate x tokens x posterior of each domain nears its target share of all tokens.

    targets: weights of domains (they are scaled to sum to 1; a domain without one gets 0; all zero: an error).
    """
    s = settings
    goal = np.array([float(targets.get(d, 0.0)) for d in domains])
    if (goal < 0).any() or not goal.sum() > 0:
        raise ValueError("targets are nonnegative and some domain has one")
    goal /= goal.sum()
    total = float(members.agg(F.sum("tokens")).first()[0] or 0)
    sums = StructType([StructField("k", IntegerType()), StructField("x", DoubleType())])
    rounds: list[tuple[np.ndarray, float]] = []
    t, last = 1.0, None

    def moved(past: list[tuple[np.ndarray, float]]):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(len(goal))
            for batch in batches:
                if batch.num_rows:
                    p = _rows(batch, 1)
                    held += (_folded(p, past, s)[1] * batch.column(0).to_numpy()) @ p
            yield pa.RecordBatch.from_arrays([pa.array(range(len(held)), pa.int32()), pa.array(held)], names=["k", "x"])

        return add

    while total and len(rounds) < s.rounds:
        found = members.select("tokens", "posterior").mapInArrow(moved(list(rounds)), sums).groupBy("k").agg(F.sum("x").alias("x")).collect()  # a row for each domain
        residual = np.zeros(len(goal))
        for r in found:
            residual[r["k"]] = r["x"] / total
        residual -= goal
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if last is not None and residual @ residual > last @ last:
            after = 1.0  # momentum went too far: it starts again
        rounds.append((residual, (t - 1) / after if after > 1 else 0.0))
        t = after
        if last is not None and np.abs(residual - last).max() < s.close / 10:
            break
        last = residual

    names = [*members.columns, "rate"]

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_folded(_rows(batch, 3), rounds, s)[0])], names=names)

    return members.select("id", "th", "tokens", "posterior").mapInArrow(rated, StructType([*members.schema.fields, StructField("rate", DoubleType())]))


def mixture(docs: DataFrame, labelled: DataFrame, domain: Column, targets: dict[str, float], settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, tuple[str, ...]]:
    """((id, th, tokens, posterior, rate) of every row, domains). Null and empty texts hold no tokens and take the bias's posterior.

    Ids may be null or repeat; other columns are ignored. A domain that has a target and no labelled document is an error; with no labelled documents at
    all, there is one domain "all" and every rate is 1. An empty table gives no rows. totals() says what the rates reach.
    """
    model = fit_domains(docs, labelled, domain, settings, id_col, text_col)
    missing = [d for d, w in targets.items() if w > 0 and d not in model.domains]
    if missing and model.domains != ("all",):
        raise ValueError(f"no labelled document is of {', '.join(sorted(missing))}; labels know {', '.join(model.domains)}")
    members = written(memberships(docs, model, id_col, text_col), "members")
    known = {"all": 1.0} if model.domains == ("all",) else targets
    return rates(members, known, model.domains, settings), model.domains


def totals(rated: DataFrame, domains: tuple[str, ...], targets: dict[str, float]) -> DataFrame:
    """(domain, tokens, share, target) of each domain: the expected tokens at the rates, their share of all, and the share that was asked for."""
    whole = sum(targets.get(d, 0.0) for d in domains) or 1.0
    each = rated.select(*((F.col("rate") * F.col("tokens") * F.get("posterior", F.lit(k))).alias(f"t{k}") for k in range(len(domains))))
    sums = each.agg(*(F.coalesce(F.sum(f"t{k}"), F.lit(0.0)).alias(f"t{k}") for k in range(len(domains))))
    rows = F.array(*(F.struct(F.lit(d).alias("domain"), F.col(f"t{k}").alias("tokens"), F.lit(targets.get(d, 0.0) / whole).alias("target")) for k, d in enumerate(domains)))
    all_of = sum((F.col(f"t{k}") for k in range(len(domains))), F.lit(0.0))
    return sums.select(all_of.alias("whole"), F.explode(rows).alias("r")).select("r.domain", "r.tokens", F.when(F.col("whole") > 0, F.col("r.tokens") / F.col("whole")).otherwise(0.0).alias("share"), "r.target")


def resampled(docs: DataFrame, rated: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """docs, each row as often as its rate says: the whole part, and once more with the rest as its probability (by a hash of its id and text).

    Rows take the rate of their id and text; null ids and null texts are values like others, repeated rows share their rate, and a row that isn't rated goes. All columns
    stay, whatever their names are. An empty table gives no rows.
    """
    by_text = rated.groupBy("id", "th").agg(F.max("rate").alias("rate"))
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("of_id"), F.xxhash64(text_col).alias("of_th"), F.xxhash64(id_col, text_col, F.lit(seed)).alias("chance"))
    joined = rows.join(by_text, F.col("of_id").eqNullSafe(F.col("id")) & (F.col("of_th") == F.col("th")))
    chance = F.shiftrightunsigned("chance", 11).cast("double") / float(1 << 53)
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), F.floor(F.col("rate") + chance).cast("int"))).alias("copy")).select("row.*")
