"""The queries opN_<name>: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyharbor.llm.common import table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: Domains of the labelled table, and the shares of tokens that they should have.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'poor' END"
TARGETS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.llm.mixing import mixture

    rated, domains = mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.expr(DOMAIN), TARGETS)
    return rated.select(F.col("id").alias("doc_id"), "tokens", *(F.get("posterior", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(domains)), "rate")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.llm.simhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from keyharbor.llm.bpe import decode, encode

    ranks = public_tokenizers.path(RANK_FILE)
    both = decode(encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.llm.toxicity import fit, score

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    machine = fit(docs, labels.where(fifth != 0))
    held_out = F.coalesce(fifth == 0, F.lit(True))
    return score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.llm.line_dedup import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents"))
    begins = F.filter(F.transform("removed_lines", lambda x, i: (i == 0) | (F.get("removed_lines", i - 1) < x - 1)), lambda b: b)
    return kept.select(
        "doc_id",
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.size(begins).cast("long").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.llm.suffix_dedup import dedup_substrings

    found = dedup_substrings(table(spark, sf_dir, "documents"), least=50)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        (F.length("kept") + n_removed).cast("long").alias("n_bytes"),
        n_removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from keyharbor.llm.token_counts import encoded_lengths, length_histogram

    return length_histogram(encoded_lengths(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.llm.quality_rules import judged

    return judged(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from keyharbor.llm.secret_scan import BASE_RULES, find_secrets

    found = find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in BASE_RULES]
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(line(of(*base)), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_embedding_dedup, op2_mixing, op3_simhash_dedup, op4_bpe_round_trip, op5_toxicity, op6_line_dedup, op7_suffix_dedup, op8_token_counts, op9_quality_rules, op10_secret_scan)}

#: DuckDB SQL, for the queries that SQL can express. op6: a longer run than four lines is covered by its stretches of four, a shorter one is a stretch of one to three lines.
ORACLE_SQL: dict[str, str] = {
    "op1_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), pairs AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
        ), reach AS (
            SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x
        )
        SELECT v.vec_id, (SELECT count(*) FROM pairs WHERE pairs.x = v.vec_id) AS n_links, min(y) AS component_id, v.vec_id = min(y) AS kept
        FROM v JOIN reach ON reach.x = v.vec_id GROUP BY v.vec_id""",
    "op6_line_dedup": """
        WITH lines AS (
            SELECT doc_id, unnest(range(len(s))) AS i, unnest(s) AS line
            FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)
        ), l1 AS (
            SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w FROM lines
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
        ), l2 AS (
            SELECT *, [line, lead(line, 1) OVER d] AS two, [line, lead(line, 1) OVER d, lead(line, 2) OVER d] AS three, [line, lead(line, 1) OVER d, lead(line, 2) OVER d, lead(line, 3) OVER d] AS four,
                sum(w) OVER (d ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS w2, sum(w) OVER (d ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS w3, lead(i, 1) OVER d AS e2, lead(i, 2) OVER d AS e3, lead(i, 3) OVER d AS e4
            FROM l1 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), starts AS (
            SELECT doc_id, i,
                (w >= 50 AND row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1) AS s1,
                (e2 IS NOT NULL AND w2 >= 50 AND row_number() OVER (PARTITION BY two ORDER BY doc_id, i) > 1) AS s2,
                (e3 IS NOT NULL AND w3 >= 50 AND row_number() OVER (PARTITION BY three ORDER BY doc_id, i) > 1) AS s3,
                (e4 IS NOT NULL AND row_number() OVER (PARTITION BY four ORDER BY doc_id, i) > 1) AS s4
            FROM l2
        ), gone AS (
            SELECT doc_id, i, s1 OR max(s2) OVER (d ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) OR max(s3) OVER (d ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) OR max(s4) OVER (d ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS g
            FROM starts WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ), rest AS (
            SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE NOT coalesce(g, false)) AS kept,
                count(*) FILTER (WHERE coalesce(g, false)) AS n_removed,
                list(l.i ORDER BY l.i) FILTER (WHERE coalesce(g, false)) AS places
            FROM lines l LEFT JOIN gone USING (doc_id, i) GROUP BY l.doc_id
        )
        SELECT doc_id, n_removed, coalesce(len(list_filter(places, lambda x: NOT list_contains(places, x - 1))), 0) AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
        FROM rest""",
}
