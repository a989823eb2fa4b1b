"""Each operator against a plain version, on texts that are meant to break it: null, empty, very long, repeated, with null and repeated ids, and with columns of clashing names."""

import base64
import hashlib
import math
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from keyharbor.llm import bpe, components, embedding_dedup, line_dedup, mixing, quality_rules, secret_scan, shingle_dedup, simhash_dedup, suffix_dedup, token_counts, toxicity

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CLASHES = ["id", "fp", "node", "component", "th", "rank", "removed", "score", "ids", "n_tokens", "spans", "a", "b", "y", "terms", "block", "key", "bucket", "lines", "n", "v", "group", "rate", "tokens", "n_words", "kept", "_id", "_th", "_key", "line_no", "label", "_copy", "_rate", "row", "copy", "chance", "of_id", "left", "rest", "signal", "i", "m", "__at"]

LONG = "x" * 60_000
PASSAGE = "A passage of the common kind stands in many documents and is long enough to be found by any of them"
LINES = [f"line number {k} of a run that repeats with words enough" for k in range(12)]


def texts() -> list[tuple[int | None, str | None]]:
    rows: list[tuple[int | None, str | None]] = [
        (10, "The quick brown fox jumps over the lazy dog and runs far away into the dark wood"), (11, "The quick brown fox jumps over the lazy dog and runs far away into the dark wood"),
        (12, "THE QUICK brown fox jumps over the lazy dog and runs far away into the dark wood"), (13, None), (14, ""), (15, " \t\r\n  "), (16, LONG), (17, LONG + "y"), (None, "a text without an id"), (None, None),
        (18, "repeated row"), (18, "repeated row"), (19, "same id"), (19, "another text of the same id"), (20, "naïve café   ünïcödé \U0001f600   中文字符 test"),
        (21, "one"), (22, "a b c d e a b c d e a b c d e"), (23, "\n".join(LINES)), (24, "head\n\n" + "\n".join(LINES[2:9]) + "\ntail"), (25, "\n".join(LINES[:3])), (26, "password = hunter2secret and TOKEN: 'abcdef' AKIA" + "Z" * 20 + " " + "ab12" * 8),
        (27, "secret=abc secret=abcdef\napi_key: x1y2z3q9"), (28, "\0 control \x1f bytes"), (29, "ſecret=longenough Kassword"),
    ]
    rows += [(100 + k, f"start {k} {PASSAGE} end {k * 7}") for k in range(30)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = texts()
    df = spark.createDataFrame([(i, t, "en" if (i or 0) % 2 else None, "src0", 0 if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.repartition(3).select("*", *(F.lit(-1).alias(c) for c in CLASHES))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def words(t: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def by(rows, *names):
    return Counter(tuple(r[n] for n in names) for r in rows)


# 3


def brute_fingerprint(t: str | None) -> int:
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    found = simhash_dedup.near_duplicates(docs).collect()
    fps = [(i, brute_fingerprint(t)) for i, t in texts()]
    values = sorted({f for _, f in fps})
    root = {f: f for f in values}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in values:
        for b in values:
            if a < b and bin(a ^ b).count("1") <= 4 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(list)
    for i, f in fps:
        least[find(f)] += [i] * (i is not None)
    assert by(found, "doc_id", "fingerprint", "component_id") == Counter((i, f"{f:016x}", min(least[find(f)], default=None)) for i, f in fps)
    assert simhash_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("bands", [6, 7])
def test_near_links_join_all_within_the_radius(spark, bands, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "BLOCK", 16)  # so that cells have many blocks
    rng = np.random.default_rng(0)
    base = rng.integers(-(2**63), 2**63, 40)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(0, 5), replace=False)) for b in base for _ in range(15)]
    near += [int(base[0]) ^ (1 << a) ^ (1 << c) for a in range(30) for c in range(30) if a != c]  # a dense group
    values = np.unique(np.array([int(b) for b in base] + near, np.int64))
    df = spark.createDataFrame([(int(v),) for v in values], "fp long")
    parts = {r["node"]: r["component"] for r in components.components(simhash_dedup.near_links(df, bands=bands), "a", "b").collect()}
    u = values.view(np.uint64)
    label = np.arange(len(u))
    while True:
        new = np.array([label[np.bitwise_count(u[i] ^ u) <= 4].min() for i in range(len(u))])
        if (new == label).all():
            break
        label = new
    groups = defaultdict(set)
    for v, k in zip(values.tolist(), label.tolist(), strict=True):
        groups[k].add(v)
    got = defaultdict(set)
    for v in values.tolist():
        got[parts.get(v, v)].add(v)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in got.values()}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 500), (None, 3), (7, 6)], "a long, b long")
    assert {(r["node"], r["component"]) for r in components.components(links, "a", "b").collect()} == {(k, 0) for k in range(201)}


def brute_groups(rows, words=5, least=0.8):
    """(id, least id of the group) of each row."""
    said = [(t or "").encode().lower().split() for _, t in rows]
    sets = [{b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} for w in said]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    return Counter((i, min((k for (k, _), y in zip(rows, label, strict=True) if y == x and k is not None), default=None)) for (i, _), x in zip(rows, label, strict=True))


def test_shingle_groups_hold_the_similarity(spark, docs, empty):
    rng = np.random.default_rng(6)
    rows = texts()
    for g in range(25):
        base = [f"w{k}" for k in rng.integers(0, 5000, 60 + 12 * g)]
        rows += [(1000 + 10 * g, " ".join(base))]
        for k in range(1, 7):
            changed = list(base)
            for p in rng.choice(len(base), max(1, len(base) * k // 150), replace=False):
                changed[p] = f"x{rng.integers(10**6)}"
            rows.append((1000 + 10 * g + k, " ".join(changed)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_groups(rows)
    assert by(shingle_dedup.near_duplicates(df).collect(), "doc_id", "component_id") == expected
    assert 30 < len({c for i, c in expected if (i or 0) >= 1000}) < 160
    assert shingle_dedup.near_duplicates(empty).count() == 0


def test_the_stage_takes_near_copies_at_a_similarity_of_eight_tenths(spark):
    import corpus_pipeline

    base = [f"word{k}" for k in range(200)]
    near = ["other" if k in (40, 90, 140) else w for k, w in enumerate(base)]
    far = ["other" if k % 20 == 0 else w for k, w in enumerate(base)]
    rows = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, rows, "").collect()} == {1, 3}


def test_near_copies_take_few_rounds(spark, monkeypatch):
    """Components are found twice, of all links and of the classes that blocks join; of what are stars, without a round."""
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 60):
        changed = list(base)
        for p in rng.choice(len(base), 2 + k % 3, replace=False):
            changed[p] = f"x{k}y{p}"
        rows.append((k, " ".join(changed)))
    names, calls = [], []
    written, found = components.written, shingle_dedup.components
    monkeypatch.setattr(components, "written", lambda df, name: names.append(name) or written(df, name))
    monkeypatch.setattr(shingle_dedup, "components", lambda *a: calls.append(1) or found(*a))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by(shingle_dedup.near_duplicates(df).collect(), "doc_id", "component_id") == brute_groups(rows)
    assert len(calls) == 2
    names.clear()
    star = spark.range(1, 50).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    assert {r["component"] for r in components.components(star, "a", "b").collect()} == {0}
    assert names == ["links"]


# 4, 8


@pytest.fixture(scope="module")
def tokenizer():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(docs, empty, tokenizer):
    found = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS).collect()
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in found) == Counter((i, tuple(tokenizer.encode_ordinary(t or "")), (t or "").encode()) for i, t in texts())
    assert bpe.encode(empty, RANKS, PATTERN).count() == 0


def test_replay_follows_the_least_rank(tokenizer):
    m = bpe.Merges(open(RANKS, "rb").read())
    rng = np.random.default_rng(4)
    parts = ["a", "b", "e", "th", "é", "中", "😀", " ", "-", "=", "0", "er", "in", "ß", "ing", "the"]
    some = sorted({"".join(rng.choice(parts, rng.integers(1, 50))).encode() for _ in range(800)} | {b"a" * k for k in range(1, 600, 41)} | {b"-" * 255, b"ab" * 200})
    ids, counts = bpe.replay(some, m)
    at = np.concatenate(([0], np.cumsum(counts)))
    assert [ids[at[k] : at[k + 1]].tolist() for k in range(len(some))] == [tokenizer._core_bpe.encode_single_piece(w) for w in some]


def test_decode_rejects_unknown_ids(spark):
    with pytest.raises(Exception, match="rank file"):
        bpe.decode(spark.createDataFrame([([60000],)], "ids array<int>"), RANKS).collect()
    assert bpe.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), RANKS).where("decoded IS NULL").count() == 1


def test_token_counts(docs, empty, tokenizer):
    lengths = np.array([len(tokenizer.encode_ordinary(t or "")) for _, t in texts()])
    histogram = token_counts.length_histogram(token_counts.encoded_lengths(docs, RANKS, PATTERN))
    rows = histogram.collect()
    assert {r["n_tokens"]: r["n_docs"] for r in rows} == dict(Counter(lengths.tolist()))
    for r in rows:
        n = r["n_tokens"]
        assert (r["docs_at_least"], r["tokens_at_least"], r["truncated_total"]) == ((lengths >= n).sum(), lengths[lengths >= n].sum(), np.minimum(lengths, n).sum())
        assert r["quantile"] == pytest.approx((lengths <= n).mean())
    for r in token_counts.at_limits(histogram, [0, 5, 64, 10**6]).collect():
        assert (r["total"], r["truncated_total"], r["n_truncated"]) == (lengths.sum(), np.minimum(lengths, r["context_limit"]).sum(), (lengths > r["context_limit"]).sum())
    for r in token_counts.quantiles(histogram, [0.1, 0.5, 1.0]).collect():
        assert r["n_tokens"] == np.sort(lengths)[int(np.ceil(r["share"] * len(lengths))) - 1]
    assert token_counts.length_histogram(token_counts.encoded_lengths(empty, RANKS, PATTERN)).count() == 0


# 6


def brute_removed(rows, runs):
    """By (id, text): numbers of lines within later copies."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, xxhash_of(r[1])))
    sequences = [(r, [(k, x) for k, x in enumerate((r[1] or "").split("\n")) if words(x)]) for r in order]
    out = defaultdict(set)
    for n in range(1, 1 + max(len(s) for _, s in sequences)):
        seen = set()
        for r, s in sequences:
            for p in range(len(s) - n + 1):
                window = tuple(x for _, x in s[p : p + n])
                if window in seen and (n >= runs.min_lines or sum(len(words(x)) for x in window) >= runs.min_words):
                    out[r] |= {k for k, _ in s[p : p + n]}
                seen.add(window)
    return out


def xxhash_of(t: str | None) -> int:
    h = xxhash.xxh64_intdigest(t.encode(), 42) if t is not None else 42
    return h - (1 << 64) if h >= 1 << 63 else h


@pytest.mark.parametrize("runs", [line_dedup.Runs(), line_dedup.Runs(min_lines=2, min_words=8), line_dedup.Runs(min_lines=1), line_dedup.Runs(min_lines=3, min_words=100)])
def test_line_dedup(docs, empty, runs):
    found = line_dedup.dedup_lines(docs, runs).collect()
    gone = brute_removed(texts(), runs)
    expected = Counter()
    for i, t in texts():
        lost = gone[(i, t)]
        kept = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost) if lost else t
        expected[(i, kept, tuple(sorted(lost)))] += 1
    assert Counter((r["doc_id"], r["text"], tuple(r["removed_lines"])) for r in found) == expected
    assert set(found[0].asDict()) == {*docs.columns, "removed_lines"}
    assert line_dedup.dedup_lines(empty, runs).count() == 0


@pytest.mark.parametrize("runs", [line_dedup.Runs(), line_dedup.Runs(min_lines=8, min_words=50)])
def test_whole_runs_of_any_number_of_lines_go(spark, runs):
    lines = [" ".join(f"w{k}x{j}" for j in range(11 + k)) for k in range(9)]
    rows = [(1, "\n".join(["head", *lines, "tail"]))] + [(10 * a + n, "\n".join([f"before {a} {n}", *lines[a : a + n], "", f"after {a} {n}"])) for a in range(1, 7) for n in range(1, 4)]
    found = {r["doc_id"]: tuple(r["removed_lines"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), runs).collect()}
    expected = {}
    for i, t in rows:
        a, n = divmod(i, 10)
        expected[i] = tuple(range(1, n + 1)) if i > 1 and (n >= runs.min_lines or sum(len(x.split()) for x in lines[a : a + n]) >= 50) else ()
    assert found == expected and any(len(x) == 3 for x in found.values())
    gone = brute_removed(rows, runs)
    assert all(tuple(sorted(gone[r])) == found[r[0]] for r in rows)


def test_the_stage_of_lines_takes_three_lines_of_twenty_words(spark):
    import corpus_pipeline

    run = "\n".join(" ".join(f"w{k}x{j}" for j in range(20)) for k in range(3))
    rows = spark.createDataFrame([(k, f"own {k}\n{run}\nlast {k}", 0) for k in (1, 2)], "doc_id long, text string, n_chars long")
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, rows, "").collect()} == {1: f"own 1\n{run}\nlast 1", 2: "own 2\nlast 2"}


def test_near_copies_are_linked_by_simhash(spark, monkeypatch):
    """Texts that share no band's cell are linked by their fingerprints, if their similarity allows it."""
    monkeypatch.setattr(shingle_dedup, "cells", lambda found: np.full(24, found.sum()).view(np.int64))
    rng = np.random.default_rng(8)
    said = [" ".join(map(str, rng.integers(0, 10**6, 300))) for _ in range(4)]
    rows = [(k, t) for k, t in enumerate(said)] + [(10 + k, t + " another end") for k, t in enumerate(said)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fp = {r["doc_id"]: r["fp"] for r in simhash_dedup.fingerprints(df, 5).collect()}
    assert all((fp[k] ^ fp[10 + k]).bit_count() <= 4 for k in range(4))
    assert {r["doc_id"]: r["component_id"] for r in shingle_dedup.near_duplicates(df).collect()} == {i: i % 10 for i, _ in rows}
    # Equal fingerprints alone link nothing.
    monkeypatch.setattr(shingle_dedup, "fingerprint", lambda hashes: 1)
    apart = spark.createDataFrame(rows[:4], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in shingle_dedup.near_duplicates(apart).collect()} == {k: k for k in range(4)}


def test_suffix_ranks_order_suffixes(docs):
    """Each level's ranks are shared by the suffixes of equal first lines, and levels go on until none is shared."""
    lines = line_dedup.line_sequences(docs, "doc_id", "text").select("id", "th", F.posexplode("lines").alias("i", "l")).select("id", "th", "i", "l.a", "l.b").cache()
    held = {(r["id"], r["th"], r["i"]): r["a"] for r in lines.collect()}
    levels = line_dedup.suffix_ranks(lines)
    prefix = lambda r, n: tuple(held.get((r["id"], r["th"], r["i"] + k)) for k in range(n))
    for t, level in enumerate(levels):
        rows, n = level.collect(), 1 << t
        assert len({(r["rank"], prefix(r, n)) for r in rows}) == len({r["rank"] for r in rows}) == len({prefix(r, n) for r in rows})
        every = Counter(p for p in (prefix({"id": k[0], "th": k[1], "i": k[2]}, n) for k in held) if None not in p)
        assert len(rows) == sum(c for c in every.values() if c > 1)
    assert not [p for p, c in Counter(prefix({"id": k[0], "th": k[1], "i": k[2]}, 1 << len(levels)) for k in held).items() if c > 1 and None not in p]


# 7


def brute_cut(rows, least):
    where = defaultdict(list)
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - least + 1):
            where[b[p : p + least]].append(suffix_dedup.NO_ID if i is None else i)
    first = {w: min(x) for w, x in where.items()}
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - least + 1):
            if first[b[p : p + least]] < (suffix_dedup.NO_ID if i is None else i):
                gone[p : p + least] = b"\1" * least
        spans = tuple((m.start(), m.end()) for m in re.finditer(rb"\x01+", bytes(gone)))
        out.append((i, bytes(x for x, g in zip(b, gone, strict=True) if not g), spans))
    return Counter(out)


@pytest.mark.parametrize("many, block", [(64, 2 << 20), (1, 700)])
def test_suffix_dedup(spark, docs, empty, many, block, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    for least in (50, 30):
        found = suffix_dedup.dedup_substrings(docs, least).collect()
        got = Counter((r["doc_id"], bytes(r["kept"]), tuple((s["start"], s["end"]) for s in r["removed"])) for r in found)
        assert got == brute_cut(texts(), least)
    assert suffix_dedup.dedup_substrings(empty).count() == 0


@pytest.mark.parametrize("many", [64, 1])
def test_suffix_dedup_cuts_every_place_of_a_repeated_passage(spark, many, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    rng = np.random.default_rng(11)
    said = lambda n: "".join(rng.choice(list("abcdefghij klmnop"), n))
    rows = []
    for k in range(12):
        passage, x, y = said(90 + 7 * k), said(80), said(80)
        rows += [(10 * k, said(70) + passage + said(70)), (10 * k + 1, x + passage + y + x + passage + y)]
        rows += [(10 * k + 2, x[:40] + passage + y[:40])] * 2  # rows of one id
        rows += [(10 * k + 3, (said(30) + passage) * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = Counter((r["doc_id"], bytes(r["kept"]), tuple((s["start"], s["end"]) for s in r["removed"])) for r in suffix_dedup.dedup_substrings(df, 50).collect())
    assert got == brute_cut(rows, 50)


def common_anchors(spark):
    """Texts of one phrase in ever other surroundings, some of which return."""
    rng = np.random.default_rng(5)
    said = lambda n: "".join(rng.choice(list("abcdefghij klmnop"), n))
    around = [(said(45), said(45)) for _ in range(60)]
    rows = []
    for k in range(240):
        (x, y), (z, _) = around[k % 60 if k % 3 else 0], around[rng.integers(60)]
        rows.append((k // 2, said(60) + x + "one phrase that all of the texts have" + y + z + "one phrase that all of the texts have" + said(30)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)


@pytest.mark.parametrize("hot", [3, 40, 20_000])
def test_suffix_dedup_of_anchors_with_many_versions(spark, hot, monkeypatch):
    for name, n in (("MANY", 2), ("HOT", hot), ("BLOCK", 3000), ("ASKED", 500)):
        monkeypatch.setattr(suffix_dedup, name, n)
    rows, df = common_anchors(spark)
    got = Counter((r["doc_id"], bytes(r["kept"]), tuple((s["start"], s["end"]) for s in r["removed"])) for r in suffix_dedup.dedup_substrings(df, 50).collect())
    assert got == brute_cut(rows, 50)


def test_suffix_dedup_asks_and_sends_in_proportion(spark, monkeypatch):
    """Rows of questions aren't blocks times buckets, and what shards sort is a few times the text at most, however many versions anchors have."""
    monkeypatch.setattr(suffix_dedup, "MANY", 1)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    sent, kept = {}, suffix_dedup.written

    def written(df, name):
        sent[name] = kept(df, name)
        return sent[name]

    monkeypatch.setattr(suffix_dedup, "written", written)
    rows, df = common_anchors(spark)
    suffix_dedup.dedup_substrings(df, 50)
    assert sent["picked"].agg(F.sum(F.length("text"))).first()[0] < 4 * sum(len(t) for _, t in rows)
    packed = suffix_dedup.blocks(df, "doc_id", "text").rows
    assert suffix_dedup._questions(packed, 50, 64).count() <= 64 * packed.rdd.getNumPartitions() < 16 * packed.count()


def test_suffix_array_orders_all_suffixes():
    from keyharbor.llm.suffix_array import suffix_array

    rng = np.random.default_rng(7)
    for _ in range(150):
        t = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 80)), 0).astype(np.int32)
        assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


# 9


def test_quality_rules(docs, empty):
    found = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in quality_rules.judged(docs).collect()}
    for i, t in texts():
        w = words(t)
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = found[(i, len(w), sum(map(len, w)))]
        assert (r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.judged(docs).count() == len(texts()) and quality_rules.judged(empty).count() == 0


def test_thresholds_follow_the_group(spark):
    rng = np.random.default_rng(2)
    plain = [(k, "plain words of a clean source go on and on here", "en", "news") for k in range(200)]
    marked = [(1000 + k, " ".join(f"item{rng.integers(9)}#" for _ in range(12)) + f" {k}", "en", "tables") for k in range(200)]
    odd = [(5000, "these #### words #### of a ## clean $$$ source %%%% go &&& on and on", "en", "news")]
    rows = spark.createDataFrame(plain + marked + odd, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judged(rows).collect() if not r["base_failed"]}
    assert not kept[5000] and all(v for k, v in kept.items() if k < 5000)
    sketch = quality_rules.sketches(quality_rules.signals(rows, keep=("lang", "source")))
    found = {r["source"]: r for r in quality_rules.thresholds(sketch).collect()}
    assert found["tables"]["high_symbol_share"] > found["news"]["high_symbol_share"]
    again = {r["source"]: r for r in quality_rules.thresholds(quality_rules.sketches(quality_rules.signals(rows.repartition(7), keep=("lang", "source")))).collect()}
    assert again == found  # whatever the partitions are


def brute_kept(rows, fences):
    """By (id, text, lang, source): whether the rules keep it. Quartiles are bucket values of the ordered signals."""
    base = (1 + fences.error) / (1 - fences.error)
    rough = lambda x: 0.0 if x <= 0 else 2 * base ** math.ceil(math.log(x) / math.log(base)) / (base + 1)
    measured = {}
    for i, t, lang, source in rows:
        w = words(t)
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = len({k + j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(5)})
        lines, chars = [x for x in (t or "").split("\n") if words(x)], sum(map(len, w))
        share = lambda a, b: a / b if b else 0.0
        values = [share(chars, len(w)), share(sum(c in "#*$%&|<>" for c in t or ""), chars), share(sum(unicodedata.category(c) == "Lu" for c in t or ""), chars), share(len(lines) - len(set(lines)), len(lines)), share(again, len(w))]
        measured[(i, t, lang, source)] = values, [None, *(share(n, d) for n, d in ((1, chars), (1, chars), (1, len(lines)), (10, len(w))))], len(w), len(w) < 10 or 100 * again > 20 * len(w)
    groups = defaultdict(list)
    for key in rows:
        if not measured[key][3]:
            for g in (key[2:], "all"):
                groups[g].append(measured[key][0])
    out = {}
    for key, (values, steps, n, failed) in measured.items():
        group = groups[key[2:]] if len(groups[key[2:]]) >= fences.least_rows else groups["all"]
        good = not failed
        for k in range(5) if good else ():
            ordered = sorted(x[k] for x in group)
            low, high = (rough(ordered[math.ceil(q * len(ordered)) - 1]) for q in (0.25, 0.75))
            room = fences.reach * max(high - low, steps[k] if k else 2 * high / n)
            good = good and low - room <= values[k] <= high + room
        out[key] = good
    return out


def test_kept_against_a_plain_version(spark, data):
    table = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in table.collect()] + [(1, None, "en", "src0"), (None, "", None, None)]
    df = spark.createDataFrame(rows, table.schema)
    for fences in (quality_rules.Fences(), quality_rules.Fences(least_rows=10, reach=1.0)):
        expected = brute_kept(rows, fences)
        found = {(r["doc_id"], r["text"], r["lang"], r["source"]) for r in quality_rules.kept_documents(df, fences=fences).collect()}
        assert found == {k for k, good in expected.items() if good} and 0 < len(found) < len(rows)


# 10


def test_secrets(docs, empty):
    found = secret_scan.find_secrets(docs).collect()
    base = {"assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6), "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile("[0-9a-f]+"), 0, 24)}
    expected = Counter()
    for i, t in texts():
        spans = [(m.start(), list(base).index(k), k, m.end()) for k, (p, g, n) in base.items() for m in p.finditer(t or "") if len(m[g]) >= n]
        expected[(i, tuple((k, a, z) for a, _, k, z in sorted(spans)))] += 1
    assert Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in base)) for r in found) == expected
    assert sum(map(len, (k[1] for k in expected))) >= 5
    assert secret_scan.find_secrets(empty).count() == 0


def test_trigram_queries():
    q = secret_scan.trigram_query
    assert q("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert q("[0-9a-f]+") is True and q("a?b?c?") is True
    assert q("(foo|barn)x") == ("or", (("and", ("arn", "bar", "rnx")), ("and", ("foo", "oox"))))
    assert q("abc.*def") == ("and", ("abc", "def"))


def test_every_rule_is_found_through_the_index(spark):
    rules = secret_scan.BASE_RULES + secret_scan.MORE_RULES
    said = ["-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "ghp_" + "a1B2" * 10, "xoxb-1234567890-abc", "AIza" + "Ab3_" * 9, "sk_live_" + "x9" * 10, "API_KEY='zzzzzz'", "AKIA" + "A1" * 10, "0123456789abcdef01234567"]
    rows = spark.createDataFrame([(k, f"before {s[:-1]}{s[-1]} after") for k, s in enumerate(said)], "doc_id long, text string")
    kinds = {r["doc_id"]: {s["kind"] for s in r["spans"]} for r in secret_scan.find_secrets(rows).collect()}
    assert set().union(*kinds.values()) == {r.kind for r in rules}


# 5, 2


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(9)
    plain = ["q" + "".join(chr(97 + int(d)) for d in str(k)) for k in range(300)]
    rows, labels = [], []
    for i in range(1200):
        said = list(rng.choice(plain, rng.integers(5, 40)))
        toxic = i % 6 == 0
        insult, group = i % 6 in (0, 1), i % 6 in (0, 2)  # an insult alone, or a group alone, is not toxic
        said += ["blorg"] * insult + ["zanians"] * group
        rng.shuffle(said)
        text = " ".join(said) if i % 5 else " ".join(f"{w}###" for w in said)
        rows.append((i, text, "en", "s"))
        labels.append((i, int(i % 5 != 0), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_pairs(labelled, docs, empty, spark):
    rows, labels = labelled
    machine = toxicity.fit(rows, labels.where("doc_id % 4 <> 0"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(rows, machine).collect()}
    held = [i for i in scores if i % 4 == 0]
    right = np.mean([(scores[i] >= 0.5) == (i % 6 == 0) for i in held])
    assert right > 0.97  # an additive score can't: the two words alone are common among clean texts
    some = toxicity.score(docs, machine).collect()
    assert len(some) == len(texts()) and all(0 <= r["score"] <= 1 for r in some)
    assert toxicity.score(empty, machine).count() == 0
    assert toxicity.fit(rows, labels.where("false")).bias < 0 and len(toxicity.fit(rows, labels.where("toxic = 0")).terms) == 0


def test_logit_is_the_sum_over_terms_and_pairs():
    rng = np.random.default_rng(4)
    m = toxicity.Machine(-0.5, np.arange(30), rng.normal(size=30), rng.normal(size=(30, 3)))
    held = [sorted(rng.choice(30, rng.integers(0, 9), replace=False).tolist()) for _ in range(20)]
    got = m.logit(np.array([k for h in held for k in h], np.int64), np.cumsum([len(h) for h in held]))
    for h, x in zip(held, got, strict=True):
        pairs = sum(m.factors[a] @ m.factors[b] for n, a in enumerate(h) for b in h[n + 1 :])
        assert x == pytest.approx(-0.5 + m.weights[h].sum() + pairs)


DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'poor' END"


def test_mixing_meets_targets(labelled, docs, empty):
    rows, labels = labelled
    targets = {"good": 0.7, "poor": 0.3, "toxic": 0.0}
    rated, domains = mixing.mixture(rows, labels, F.expr(DOMAIN), targets)
    got = rated.collect()
    p, t, rate = np.array([r["posterior"] for r in got]), np.array([r["tokens"] for r in got], float), np.array([r["rate"] for r in got])
    goal = np.array([targets[d] for d in domains])
    assert (rate >= 0).all() and np.abs((rate * t) @ p / t.sum() - goal).max() < 0.1 < np.abs(t @ p / t.sum() - goal).max()  # posteriors are soft: a target of zero is out of reach
    reached = {r["domain"]: r for r in mixing.totals(rated, domains, targets).collect()}
    assert all(reached[d]["tokens"] == pytest.approx(((rate * t) @ p)[k]) and reached[d]["target"] == targets[d] and reached[d]["share"] == pytest.approx(((rate * t) @ p / (rate * t).sum())[k]) for k, d in enumerate(domains))
    with pytest.raises(ValueError, match="godo"):
        mixing.mixture(rows, labels, F.expr(DOMAIN), {"godo": 1.0})
    # The same problem, solved plainly.
    r, s = np.ones(len(t)), t / t.sum()
    for _ in range(4000):
        r = np.clip(r - (p @ ((r * s) @ p - goal) + 0.01 * (r - 1)) / 1.01, 0, 8)
    assert np.abs((r * s) @ p - (rate * s) @ p).max() < 2e-3
    copies = mixing.resampled(rows, rated)
    counts = Counter(x["doc_id"] for x in copies.collect())
    assert all(int(x["rate"]) <= counts[x["id"]] <= int(x["rate"]) + 1 for x in got) and copies.columns == rows.columns
    extra = rows.select("*", F.lit("kept").alias("_copy"), F.lit(1).alias("rate"))
    assert mixing.resampled(extra, rated).where("_copy = 'kept'").count() == copies.count()
    some, _ = mixing.mixture(docs, labels, F.expr(DOMAIN), targets)
    assert some.count() == len(texts()) and mixing.mixture(empty, labels, F.expr(DOMAIN), targets)[0].count() == 0
    assert mixing.mixture(docs, labels.where("false"), F.expr(DOMAIN), targets)[1] == ("all",)


# 1


def test_embedding_dedup(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 16))
    near = base[rng.integers(0, 20, 300)] + 0.03 * rng.normal(size=(300, 16))
    dense = base[0] + 0.02 * rng.normal(size=(700, 16))
    x = np.concatenate((base, near, dense, base[:10] * 3))
    labels = [None if k % 50 == 49 else k % 2 for k in range(len(x))]
    rows = [(k, v.tolist(), y) for k, (v, y) in enumerate(zip(x, labels, strict=True))]
    rows += [(9100, [1.0, 2.0, 3.0], 0), (9101, [1.0, 2.0, 3.1], 0), (9102, [2.0], 0), (9103, [3.0], 0), (9104, [], 0)]
    rows += [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0), (9003, [1.0, None] + [0.0] * 14, 0), (9004, [float("inf")] * 16, 1)]
    df = spark.createDataFrame([(*r, -1, -2) for r in rows], "vec_id long, embedding array<double>, label int, node int, n_links int")
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([-1 if v is None else v for v in labels])
    link = (unit @ unit.T >= 0.93) & (y[:, None] == y) & (y[:, None] >= 0)
    np.fill_diagonal(link, False)
    got = sum(r["n_links"] for k, r in found.items() if k < len(x))
    assert 0.9 * link.sum() <= got <= link.sum() and got > 0
    assert all(found[k]["n_links"] <= link[k].sum() for k in range(len(x)))
    assert all(found[k]["n_links"] == 0 and found[k]["component_id"] == k and found[k]["kept"] for k in range(9000, 9005))
    assert [(found[k]["n_links"], found[k]["component_id"]) for k in range(9100, 9105)] == [(1, 9100), (1, 9100), (1, 9102), (1, 9102), (0, 9104)]
    label = np.arange(len(x))
    while True:
        new = np.array([min(label[k], label[link[k]].min(initial=len(x))) for k in range(len(x))])
        if (new == label).all():
            break
        label = new
    assert np.mean([found[k]["component_id"] == label[k] for k in range(len(x))]) > 0.97
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0
    assert embedding_dedup.near_duplicates(df.where("vec_id BETWEEN 9000 AND 9050")).count() == 5


def test_equal_vectors_are_one_row(spark):
    rng = np.random.default_rng(8)
    rows = [(k, [1.0, 2.0, 3.0, 4.0], 1) for k in range(5000)] + [(10_000 + k, rng.normal(size=4).tolist(), 1) for k in range(3)] + [(None, [1.0, 2.0, 3.0, 4.0], 1), (7, [1.0, 2.0, 3.0, 4.0], 2), (7, [1.0, 2.0, 3.0, 4.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = embedding_dedup.near_duplicates(df).collect()
    assert Counter((r["n_links"], r["component_id"]) for r in found if r["vec_id"] is None or r["vec_id"] < 10_000) == {(5000, 0): 5001, (1, 7): 2} and len(found) == len(rows)


def test_multi_sequence_order_is_by_summed_distance():
    rng = np.random.default_rng(1)
    index = embedding_dedup.Index(rng.normal(size=(7, 4)), rng.normal(size=(6, 4)), 10)
    x = rng.normal(size=(25, 8))
    order = index.order(x, 12)
    for row, cells in zip(x, order, strict=True):
        d = ((row[:4] - index.first) ** 2).sum(1)[:, None] + ((row[4:] - index.second) ** 2).sum(1)
        assert np.allclose(np.sort(d.ravel())[:12], d.ravel()[cells])


# Queries


#: The contract's kinds of secrets: pattern, group that is measured, least length.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24),
]


def test_digests_of_the_queries(spark, data):
    from keyharbor.llm.queries import QUERIES

    n = spark.read.parquet(f"{data}/documents.parquet").count()
    rows = QUERIES["op4_bpe_round_trip"](spark, data).collect()
    sha = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == n and all(r["decoded_sha256"] == sha[r["doc_id"]] for r in rows)
    said = tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in (line.split() for line in open(RANKS, "rb").read().splitlines() if line)}, special_tokens={})
    texts_of = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    ids = {i: said.encode_ordinary(t) for i, t in texts_of.items()}
    assert all(r["n_tokens"] == len(ids[r["doc_id"]]) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids[r["doc_id"]])).encode()).hexdigest() for r in rows)
    cut = {r["doc_id"]: r for r in QUERIES["op7_suffix_dedup"](spark, data).collect()}
    for (i, kept, spans), n in brute_cut(list(texts_of.items()), 50).items():
        r = cut[i]
        assert n == 1 and (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(texts_of[i].encode()), sum(z - a for a, z in spans), len(spans)) and r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    for r in QUERIES["op10_secret_scan"](spark, data).collect():
        text, base = texts_of[r["doc_id"]], []
        for order, (kind, pattern, group, least) in enumerate(BASE):
            base += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, re.A) if len(m.group(group)) >= least]
        said_base = ",".join(x[2] for x in sorted(base))
        assert r["base_sha256"] == hashlib.sha256(said_base.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind, *_ in BASE] == [sum(x[2].startswith(f"{kind}:") for x in base) for kind, *_ in BASE]
        assert set(filter(None, said_base.split(","))) <= set(r["spans"].split(","))
    held = QUERIES["op5_toxicity"](spark, data).collect()
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for r in held)
