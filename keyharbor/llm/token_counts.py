"""Token counts by an exact histogram of encoded lengths.

Each document is encoded once and only its length leaves the task; the histogram is a partial aggregate, so its
shuffle carries a row for each distinct length and task, and it is written (a row for each length) before anything is made of it. Suffix sums over it answer, for every context limit at
once, how many documents reach it, how many tokens they hold and what is left when texts are cut there.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from keyharbor.llm.common import pieces, written

#: Lengths of one bucket of the two-level suffix sums: a window never holds more rows than this.
BUCKET = 64


@lru_cache(maxsize=4)
def _encoding(rank_lines: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_lines.splitlines() if line)}
    return tiktoken.Encoding("from_ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every row. Null and empty texts have no tokens; ids may be null or repeat; other columns are ignored.

    rank_file: a tiktoken rank file (about 1 MB, of fixed size), read by the driver and sent as a broadcast variable.
    """
    with open(rank_file, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks.value, pattern).encode_ordinary
        for batch in pieces(batches, 1, 8 << 20):
            texts = pc.fill_null(batch.column(1), "").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(encode(t)) for t in texts], pa.int64())], names=[id_col, "n_tokens"])

    schema = StructType([docs.schema[id_col], StructField("n_tokens", LongType())])
    return docs.select(id_col, text_col).mapInArrow(count, schema)


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """A row for each length L that occurs: n_tokens, n_docs, docs_at_least, tokens_at_least, truncated_total, quantile.

    docs_at_least and tokens_at_least sum documents of L tokens or more; truncated_total is what remains in all when
    every text is cut to L tokens; quantile is the share of documents of at most L. An empty table gives no rows.
    """
    counts = lengths.where(F.col(length_col).isNotNull()).groupBy(F.col(length_col).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))
    counts = written(counts.withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET)), "lengths")  # used twice below: texts are encoded for it once
    totals = counts.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)  # over buckets: longest text / BUCKET rows
    all_of = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("bucket", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in "dt"), *(F.sum(c).over(all_of).alias(f"{c}_all") for c in "dt"))
    within = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counts.join(totals, "bucket").select("n_tokens", "n_docs", "d_all", "t_all", (F.col("d_above") + F.sum("n_docs").over(within)).alias("docs_at_least"), (F.col("t_above") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(within)).alias("tokens_at_least"))
    return sums.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("t_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("d_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("d_all")).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, total, truncated_total, n_truncated) for any limits, whether or not a text has that length."""
    each = histogram.select("n_tokens", "n_docs", F.explode(F.array(*(F.lit(int(x)).cast("long") for x in limits))).alias("context_limit"))
    return each.groupBy("context_limit").agg(
        F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total"),
        F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("truncated_total"),
        F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("n_truncated"),
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least this share of the documents does not exceed; exact."""
    each = histogram.select("n_tokens", "quantile", F.explode(F.array(*(F.lit(float(x)) for x in shares))).alias("share"))
    return each.where("quantile >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
