"""Quality rules with thresholds that each language and source sets for itself (DataFrame functions only).

One pass measures every document. Per (lang, source) a mergeable quantile sketch of each signal gives its
quartiles; a document goes when a signal lies outside the fences that its own group sets, so that a
source of short or symbol-rich texts isn't judged by the habits of another. The thresholds are joined back to the
measured rows.

A sketch counts values by buckets whose bounds grow by a constant factor, so that a quantile is off by a fixed share of its value at most. Counts add up: sketches merge in
partial aggregates, whatever the partitions are, and the same table always gives the same thresholds. A source with a third of all rows costs no task more than others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyharbor.llm.common import BLANKS, whole_row, written

#: Words of a window whose repetition counts.
WINDOW = 5
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Fences:
    """error: of the sketches, as a share of a quantile's value. least_rows: smaller groups take the thresholds of all rows.

    reach: how far beyond its group's quartiles a document may lie: so many interquartile ranges, or so many of its own smallest steps where those are more (one symbol or capital
    letter, one repeated line, one repeated window, one word of thrice the usual length), for ranges can be zero and short texts have large steps.
    """

    error: float = 0.002
    least_rows: int = 50
    reach: float = 8.0


#: Signals, and the smallest step that a document can make in each.
SIGNALS = {
    "mean_word": lambda: F.try_divide(2 * F.col("high_mean_word"), F.col("n_words")),
    "symbol_share": lambda: F.try_divide(F.lit(1.0), F.col("word_chars")),
    "upper_share": lambda: F.try_divide(F.lit(1.0), F.col("word_chars")),
    "dup_line_share": lambda: F.try_divide(F.lit(1.0), F.col("n_lines")),
    "repeat_share": lambda: F.try_divide(F.lit(2.0 * WINDOW), F.col("n_words")),
}


def _over(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper) of every row's whole text.

    Words are runs of anything but ASCII blanks, lines are those with a word. n_dup_lines: equal to an earlier line.
    n_repeat_words: words in windows of 5 words that stand in the text twice or more, first included.
    Null texts count as empty: all signals are 0. Ids may be null or repeat; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(F.regexp_replace(text, f"[{BLANKS}]", " "), " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(f"[^{BLANKS}]")))
    n = F.size("_words")
    grams = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW))))
    measured = docs.select(F.col(id_col), *keep, text.alias("_text"), words.alias("_words"), lines.alias("_lines")).select(
        F.col(id_col), *keep, n.cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"), F.length(F.regexp_replace("_text", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.when(n >= WINDOW, grams).alias("_grams"),
    )
    # Most texts repeat no window; their hashes tell so, and nothing is sorted. Else equal hashes are neighbours once sorted.
    again = F.col("_grams").isNotNull() & (F.size(F.array_distinct("_grams")) < F.size("_grams"))
    ranked = F.when(again, F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    beside = lambda i, step: F.coalesce(F.get("_ranked", i + step)["g"] == F.get("_ranked", i)["g"], F.lit(False))
    twice = F.transform("_ranked", lambda x, i: F.when(((i > 0) & beside(i, -1)) | beside(i, 1), x["i"]))
    places = F.sort_array(F.filter(twice, lambda p: p.isNotNull()))
    covered = F.aggregate(
        "_places", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"],
    )
    return (
        measured.withColumn("_ranked", ranked)
        .withColumn("_places", F.when(F.col("_ranked").isNotNull(), places))
        .withColumn("n_repeat_words", F.when(F.col("_places").isNotNull(), covered).otherwise(0).cast("long"))
        .select(F.col(id_col), *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
    )


def _shares(measured: DataFrame) -> DataFrame:
    return measured.withColumns(
        {
            "mean_word": _over(F.col("word_chars"), F.col("n_words")),
            "symbol_share": _over(F.col("n_symbols"), F.col("word_chars")),
            "upper_share": _over(F.col("n_upper"), F.col("word_chars")),
            "dup_line_share": _over(F.col("n_dup_lines"), F.col("n_lines")),
            "repeat_share": _over(F.col("n_repeat_words"), F.col("n_words")),
        }
    )


def sketches(measured: DataFrame, by: tuple[str, ...] = ("lang", "source"), fences: Fences = Fences()) -> DataFrame:
    """(*by, signal, bucket, n): for each group and signal, the documents by buckets of its value. Bucket k holds values from base^(k-1), exclusive, to base^k; null is zero."""
    base = math.log((1 + fences.error) / (1 - fences.error))
    bucket = lambda x: F.when(F.col(x) > 0, F.ceil(F.log(F.col(x)) / base)).cast("int")
    each = F.array(*(F.struct(F.lit(x).alias("signal"), bucket(x).alias("bucket")) for x in SIGNALS))
    return _shares(measured).select(*by, F.explode(each).alias("s")).groupBy(*by, "s.signal", "s.bucket").agg(F.count(F.lit(1)).alias("n"))


def thresholds(sketch: DataFrame, by: tuple[str, ...] = ("lang", "source"), fences: Fences = Fences()) -> DataFrame:
    """(*by, n_rows, low_<signal>, high_<signal>): the first and third quartile of each signal in each group of the sketches; other groupings of the same sketches are their sums."""
    base = (1 + fences.error) / (1 - fences.error)
    merged = sketch.groupBy(*by, "signal", "bucket").agg(F.sum("n").alias("n"))
    of = Window.partitionBy(*by, "signal")  # a row for each bucket
    ranked = merged.withColumn("upto", F.sum("n").over(of.orderBy(F.asc_nulls_first("bucket")))).withColumn("all", F.sum("n").over(of))
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(2 * F.pow(F.lit(base), F.col("bucket")) / (base + 1))
    at = lambda share: F.min(F.when(F.col("upto") >= F.ceil(share * F.col("all")), value))
    found = ranked.groupBy(*by, "signal").agg(F.max("all").alias("all"), at(0.25).alias("low"), at(0.75).alias("high"))
    of_signal = lambda x, c: F.max(F.when(F.col("signal") == x, F.col(c)))
    return found.groupBy(*by).agg(F.max("all").alias("n_rows"), *(of_signal(x, c).alias(f"{c}_{x}") for x in SIGNALS for c in ("low", "high")))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source"), fences: Fences = Fences(), keep: tuple[str, ...] = ()) -> DataFrame:
    """signals() and base_failed, kept of every row (with the columns `keep` of docs, whose names are none of a signal's).

    base_failed: fewer than 10 words, or over 20 % of them repeat. kept: not base_failed, and no signal outside the fences
    of the row's group; a null lang or source is a group of its own; a group of few rows takes the fences of all rows. Documents that fail the base rule set no fences.
    An empty table gives no rows.
    """
    measured = written(signals(docs, id_col, text_col, (*by, *keep)), "signals")
    clean = measured.where((F.col("n_words") >= 10) & (100 * F.col("n_repeat_words") <= 20 * F.col("n_words")))
    sketch = written(sketches(clean, by, fences), "sketches")
    names = [f"{c}_{x}" for x in SIGNALS for c in ("low", "high")]
    # groups is small where sources are few: Spark then broadcasts it by its measured size; else the join is a plain one, and skew is split.
    groups = thresholds(sketch, by, fences).where(F.col("n_rows") >= fences.least_rows).select(*(F.col(b).alias(f"_{b}") for b in by), *(F.col(x).alias(f"own_{x}") for x in names))
    common = thresholds(sketch, (), fences).select(*(F.col(x).alias(f"all_{x}") for x in names))  # one row
    same = [measured[b].eqNullSafe(groups[f"_{b}"]) for b in by]
    joined = _shares(measured).join(groups, same, "left").join(F.broadcast(common), how="left")
    joined = joined.withColumns({x: F.coalesce(f"own_{x}", f"all_{x}") for x in names})
    outside = F.lit(False)
    for x, step in SIGNALS.items():
        low, high = F.col(f"low_{x}"), F.col(f"high_{x}")
        room = fences.reach * F.greatest(high - low, F.coalesce(step(), F.lit(0.0)))
        outside = outside | (F.col(x) > high + room) | (F.col(x) < low - room)
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return joined.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))).select(*measured.columns, "base_failed", "kept")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source"), fences: Fences = Fences()) -> DataFrame:
    """The rows of docs that judged() keeps, all columns as they are: rows of one id are told apart by their text, and of one text by their group."""
    th = (F.xxhash64(text_col), F.xxhash64(F.lit(1), F.col(text_col)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(b).alias(f"by{k}") for k, b in enumerate(by)), th[0].alias("th"), th[1].alias("th2"))
    names = tuple(f"by{k}" for k in range(len(by)))
    good = judged(rows, "id", "text", names, fences, ("th", "th2")).where("kept").select("id", "th", "th2", *names).distinct()
    all_of = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("_id"), th[0].alias("_th"), th[1].alias("_th2"), *(F.col(b).alias(f"_{n}") for b, n in zip(by, names, strict=True)))
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_th") == F.col("th")) & (F.col("_th2") == F.col("th2"))
    for n in names:
        same = same & F.col(f"_{n}").eqNullSafe(F.col(n))
    return all_of.join(good, same, "left_semi").select("row.*")
