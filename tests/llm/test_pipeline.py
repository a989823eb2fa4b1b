"""The pipeline's stages, each against a plain version of its rule on what came before; and on a table of odd rows."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import brute_kept, brute_removed, words

import corpus_pipeline
from keyharbor.llm import line_dedup, mixing, quality_rules
from keyharbor.llm.queries import DOMAIN, TARGETS

CLASHES = ["_copy", "row", "th", "kept", "id", "rate", "lines", "component_id", "by0", "removed", "_id", "_th"]
SENTENCE = "several words of a document that is long enough to be kept by the rules number {}"


@pytest.fixture(scope="module")
def stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], data).cache())
    return out


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long texts, repeated rows, two texts of one id, columns of clashing names."""
    rows = [(None, SENTENCE.format("nought"), "en", "a"), (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t", "en", None), (4, "word " * 40_000, "en", "a"), (5, SENTENCE.format("five"), "en", "a"), (5, SENTENCE.format("five"), "en", "a")]
    rows += [(6, SENTENCE.format("six and more of it"), "en", "a"), (6, "quite another text of this id, with words of its own and no word too many", "de", "a"), (7, SENTENCE.format("five"), "en", "b")]
    rows += [(20 + k, "\n".join([f"own line {k}", *(f"line {n} of a passage of five lines that all of these share" for n in range(5))]), "en", "a") for k in range(4)]
    df = spark.createDataFrame([(*r, 0 if r[1] is None else len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.repartition(3).select("*", *(F.lit("extra").alias(c) for c in CLASHES)).cache()


def rows_of(df):
    return Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect())


def texts_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def quality_right(before, after):
    kept = brute_kept(texts_of(before), quality_rules.Fences())
    assert rows_of(after) == Counter(r for r in texts_of(before) if kept[r])


def lines_right(before, after):
    gone = brute_removed([r[:2] for r in texts_of(before)], line_dedup.Runs())
    expected = Counter()
    for i, t, lang, source in texts_of(before):
        lost = gone[(i, t)]
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost) if lost else t
        if not lost or words(left):
            expected[(i, left, lang, source)] += 1
    assert rows_of(after) == expected


def shingles(t):
    said = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in words(t)]
    return frozenset(tuple(said[k : k + 5]) for k in range(max(1, len(said) - 4))) if said else frozenset()


def one_of_each_right(before, after):
    held = {}
    for r in texts_of(before):
        held.setdefault(shingles(r[1]), []).append(r)
    sets = list(held)
    group = list(range(len(sets)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                group[root(a)] = root(b)
    members = {}
    for k, s in enumerate(sets):
        members.setdefault(root(k), []).extend(held[s])
    left = texts_of(after)
    assert len(left) == len(members)
    least = lambda rows: min((r[0] is None, r[0] or 0) for r in rows)
    for rows in members.values():
        (mine,) = [r for r in left if r in rows]
        assert (mine[0] is None, mine[0] or 0) == least(rows)


def test_quality(stages):
    quality_right(stages[0], stages[1])


def test_lines(stages):
    lines_right(stages[1], stages[2])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_of_each_group(stages):
    one_of_each_right(stages[2], stages[3])


def test_mix_reaches_the_targets(spark, stages, data):
    held = rows_of(stages[3])
    mixed = rows_of(stages[4])
    assert set(mixed) <= set(held) and sum(mixed.values()) > 0
    rated, domains = mixing.mixture(stages[3], spark.read.parquet(f"{data}/labels.parquet"), F.expr(DOMAIN), TARGETS)
    found = {(r["id"], r["tokens"]): r for r in rated.collect()}
    assert all(abs(r["share"] - r["target"]) < 0.1 for r in mixing.totals(rated, domains, TARGETS).collect())
    for r, n in held.items():
        rate = found[(r[0], len((r[1] or "").encode().lower().split()))]["rate"]
        assert n * int(rate) <= mixed[r] <= n * (int(rate) + 1)


def encoded_right(before, after):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert Counter((r["doc_id"], r["lang"], r["source"], tuple(r["ids"]), r["n_tokens"], r["decodes"]) for r in after.collect()) == Counter((i, lang, source, tuple(ids), len(ids), True) for i, t, lang, source in texts_of(before) for ids in [own.encode_ordinary(t or "")])


def test_encoded(stages):
    encoded_right(stages[4], stages[5])


def test_run(spark, data, stages):
    assert corpus_pipeline.run(spark, data).count() == stages[5].count()


def test_stages_on_odd_rows(spark, data, odd):
    quality_right(odd, corpus_pipeline.quality(spark, odd, data))
    lines_right(odd, corpus_pipeline.lines(spark, odd, data))
    one_of_each_right(odd, corpus_pipeline.near_duplicates(spark, odd, data))
    mixed = corpus_pipeline.mix(spark, odd, data)
    assert set(rows_of(mixed)) <= set(rows_of(odd)) and mixed.columns == odd.columns
    encoded_right(odd, corpus_pipeline.encode(spark, odd, data))
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, odd.where("false"), data)
        assert none.count() == 0, name
        if name != "bpe":
            assert none.columns == odd.columns


def test_stage_of_lines_keeps_empty_texts_that_lost_nothing(spark, odd, data):
    left = rows_of(corpus_pipeline.lines(spark, odd, data))
    assert left[(1, None, "en", "a")] == left[(2, "", None, "a")] == left[(3, " \n\t", "en", None)] == 1
