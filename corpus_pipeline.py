"""From raw documents to encoded ones, in stages; each is written as Parquet and read again for the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyharbor.llm import bpe, line_dedup, mixing, quality_rules, shingle_dedup
from keyharbor.llm.common import run_dir, table, whole_row
from keyharbor.llm.queries import DOMAIN, RANK_FILE, TARGETS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the adaptive rules keep."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs, of 4 lines or 50 words; n_chars follows the text, and documents left without a word go."""
    found = line_dedup.dedup_lines(docs, removed_col="_removed")
    lost = F.size("_removed") > 0
    n_chars = F.when(lost, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.where(~lost | F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).withColumn("n_chars", n_chars).drop("_removed")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, by SimHash, then by bands for what lies beyond its radius, all held to a similarity of 0.8 of five-word shingles: that of the least id (nulls last); of rows repeated as a whole, or with the same id and text, one."""
    found = shingle_dedup.near_duplicates(docs).where("kept").select("doc_id", "th").distinct()
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"))
    return rows.join(found, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_th") == F.col("th")), "left_semi").dropDuplicates(["_id", "_th"]).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say, for the target shares of tokens; repeats of one document are repeated rows."""
    rated, _ = mixing.mixture(docs, table(spark, sf_dir, "labels"), F.expr(DOMAIN), TARGETS)
    return mixing.resampled(docs, rated)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens, decodes) of every row: the ids of its text (none for a null one), and whether they decode to it."""
    import public_tokenizers

    ranks = public_tokenizers.path(RANK_FILE)
    texts = docs.select(F.struct("doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")).alias("key"), "text")
    ids = bpe.decode(bpe.encode(texts, ranks, public_tokenizers.PATTERN, id_col="key"), ranks)
    return ids.select("key.doc_id", "key.lang", "key.source", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.sha2("decoded", 256) == F.col("key.sha")).alias("decodes"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_dedup", near_duplicates),
    ("mixing", mix),
    ("bpe", encode),
]

#: The stages hold sketches, hashes and fitted rates, which SQL can't express; the tests hold each against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{run_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
    return docs
