"""Line dedup by a suffix array over line-ID sequences (DataFrame functions only).

Each document is its sequence of lines; documents of equal text are one sequence, that of the least id.

1. Suffixes are ranked by distributed prefix doubling. First ranks order lines by their 128-bit hash; a further round ranks the pair (rank here,
   rank 2^t lines on), which orders suffixes by twice as many lines. A round groups equal pairs by a partial aggregate, sorts the
   distinct ones over all tasks, numbers them and joins the numbers back. A suffix whose rank nobody shares is in place and leaves; rounds end
   when none is left. The ranks of each round are kept.
2. Suffixes that share their first lines are an interval of the suffix array, and intervals nest. From the longest prefixes to the shortest, the kept ranks split each interval in halves by length: within
   one, all but its earliest member have an earlier copy as long as the common prefix, and only the earliest goes on to the
   shorter prefix, for all. So each suffix gets the length of the longest run of lines that stands at an earlier place too (its longest common
   prefix with an earlier suffix), with as many rounds as the doubling had.
3. Runs that are long enough go, with all their lines.

A very common line or passage is one distinct pair; the join of its rank is split where it is skewed. No interval is ever gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyharbor.llm.common import BLANKS, whole_row, written


@dataclass(frozen=True)
class Runs:
    """A run of lines that stands at an earlier place too goes if it has min_lines lines, or min_words words in any number of lines."""

    min_lines: int = 4
    min_words: int = 50


PLACE = ("id", "th", "i")


def _same_place(on: Column | int = 0) -> Column:
    """A place, so many lines on, is the other side's (_id, _th, _i)."""
    return F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")) & (F.col("i") + on == F.col("_i"))


def _words(line: Column) -> Column:
    return F.size(F.filter(F.split(F.regexp_replace(line, f"[{BLANKS}]", " "), " "), lambda w: w != ""))


def text_hashes(text: str) -> tuple[Column, Column]:
    """128 bits that stand for a text: two hashes of different seeds."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), F.col(text))


def line_sequences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(th, th2, id, lines array<struct<line_no, a, b, n_words>>): a row for each text, with the least id that has it and the lines that hold a word.

    line_no counts all lines from 0; a, b are the line's hash; th, th2 the text's. Null ids are less than others.
    """
    # The seeds differ from the start: a hash of a hash would tell no more lines apart than the first.
    lines = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda x, i: F.struct(i.alias("line_no"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), _words(x).cast("long").alias("n_words")))
    th, th2 = text_hashes(text_col)
    each = docs.select(th.alias("th"), th2.alias("th2"), F.struct(F.col(id_col).alias("id")).alias("id"), F.filter(lines, lambda x: x["n_words"] > 0).alias("lines"))
    return each.groupBy("th", "th2").agg(F.min("id").alias("id"), F.first("lines").alias("lines")).select("th", "th2", "id.id", "lines")


def _ranked(places: DataFrame, name: str) -> DataFrame:
    """(*PLACE, rank) of the places whose pair (a, b) another place has too; ranks order the pairs."""
    pairs = places.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # After a global sort the numbers rise with the pairs; the table fixes them.
    ranks = written(pairs.orderBy("a", "b").select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.monotonically_increasing_id().alias("rank")), f"{name}-pairs")
    return written(places.join(ranks, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).drop("_a", "_b", "a", "b"), name)


def suffix_ranks(lines: DataFrame) -> list[DataFrame]:
    """Ranks by the first 1, 2, 4 ... lines: for each, (*PLACE, rank) of the suffixes that share theirs with others, until none does.

    lines: (*PLACE, a, b, ...) with the places of a document counted from 0; other columns stay with the first ranks.
    """
    now, out = _ranked(lines, "ranks"), []
    while not now.isEmpty():
        out.append(now)
        ahead = 1 << (len(out) - 1)
        here = now.select(*PLACE, F.col("rank").alias("a"))
        on = now.select(F.col("id").alias("_id"), F.col("th").alias("_th"), (F.col("i") - ahead).alias("_i"), F.col("rank").alias("b"))
        both = here.join(on, _same_place())
        now = _ranked(both.select(*PLACE, "a", "b"), f"ranks{2 * ahead}")
    return out


def longest_earlier(levels: list[DataFrame]) -> DataFrame | None:
    """(*PLACE, n_lines): for each suffix that has one, the longest common prefix with a suffix at an earlier place, by (id, th, i). None without levels.

    A member of an interval is (*PLACE, node, n_lines): the interval, and the lines that its members share. Members that `ask` belong to nowhere else; the earliest
    of an interval is in there for the others only, and asks in the interval around it. All suffixes are in the outermost one, which shares nothing and is not written out.
    """
    place = F.struct(*PLACE)
    members: DataFrame | None = None
    for t in reversed(range(len(levels))):
        ranks = levels[t].select(*PLACE, "rank")
        outer = ranks.select(*PLACE, F.lit(None).cast("long").alias("node"), F.lit(0).alias("n_lines"), F.lit(True).alias("asks"), "rank")
        if members is not None:
            gone = members.where("asks").select(*(F.col(c).alias(f"_{c}") for c in PLACE))
            outer = outer.join(gone, _same_place(), "left_anti")
            at = ranks.select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("i").alias("_i"), "rank")
            inner = members.join(at, _same_place(F.col("n_lines")), "left").select(*outer.columns)
            now = outer.unionByName(inner)
        else:
            now = outer
        now = written(now, f"members{t}")
        # Halves that several members share: their earliest one, and a number of their own.
        halves = now.where("rank IS NOT NULL").groupBy("node", "rank").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
        halves = written(halves.select(F.col("node").alias("_node"), F.col("rank").alias("_rank"), "first", F.monotonically_increasing_id().alias("half")), f"halves{t}")
        joined = now.join(halves, F.col("node").eqNullSafe(F.col("_node")) & (F.col("rank") == F.col("_rank")), "left")
        deeper, earliest = F.col("half").isNotNull(), place == F.col("first")
        # The earliest stays where it asks, and is a silent member of the half; the others move there. Numbers of one level and of the next are told apart by the shift.
        half = (F.col("half") * 64 + t).alias("node")
        stay = F.struct("node", "n_lines", "asks")
        move = lambda asks: F.struct(half, (F.col("n_lines") + (1 << t)).alias("n_lines"), F.lit(asks).alias("asks"))
        into = F.when(~deeper, F.array(stay)).when(earliest, F.array(stay, move(False))).otherwise(F.array(F.struct(half, (F.col("n_lines") + (1 << t)).alias("n_lines"), F.col("asks").alias("asks"))))
        members = written(joined.select(*PLACE, F.explode(into).alias("m")).select(*PLACE, "m.*").where("node IS NOT NULL"), f"intervals{t}")
    return None if members is None else members.where("asks").select(*PLACE, "n_lines")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(sequences, lines, runs): line_sequences(), their repeated lines (*PLACE, line_no, n_words, upto), and at each place the longest run (*PLACE, n_lines, n_words) that stands at an earlier place too.

    upto: words of the document up to and with this line. Runs of one text's other copies aren't in here: they are that text's. runs is None if no line repeats.
    """
    sequences = written(line_sequences(docs, id_col, text_col), "sequences")
    each = sequences.select("id", "th", F.posexplode("lines").alias("i", "l")).select("id", "th", "i", "l.*")
    levels = suffix_ranks(each)
    if not levels:
        return sequences, each, None
    # All lines of a run repeat, so these have its first and its last one. Words add up over them alone.
    lines = levels[0].withColumn("upto", F.sum("n_words").over(Window.partitionBy("id", "th").orderBy("i"))).select(*PLACE, "line_no", "n_words", "upto")
    lines = written(lines, "lines")
    found = longest_earlier(levels)
    begins = lines.join(found.select(*(F.col(c).alias(f"_{c}") for c in PLACE), "n_lines"), _same_place()).select(*PLACE, "n_lines", (F.col("upto") - F.col("n_words")).alias("before"))
    ends = lines.select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("i").alias("_i"), "upto")
    runs = begins.join(ends, _same_place(F.col("n_lines") - 1))
    return sequences, lines, runs.select(*PLACE, "n_lines", (F.col("upto") - F.col("before")).alias("n_words"))


def later_copies(docs: DataFrame, runs: Runs = Runs(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, th2, removed array<int>): for each text of an id that has some, the numbers of its lines within later copies of runs."""
    sequences, lines, found = repeated_runs(docs, id_col, text_col)
    if found is None:
        gone = sequences.limit(0).select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.array().cast("array<int>").alias("removed"))
    else:
        long = found.where((F.col("n_lines") >= runs.min_lines) | (F.col("n_words") >= runs.min_words)).select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("i").alias("_i"), (F.col("i") + F.col("n_lines")).alias("past"))
        placed = lines.join(long, _same_place(), "left")
        inside = F.max("past").over(Window.partitionBy("id", "th").orderBy("i")) > F.col("i")
        gone = placed.select("id", "th", "i", "line_no", inside.alias("inside")).where("inside").groupBy("id", "th").agg(F.sort_array(F.collect_list("line_no")).alias("removed")).withColumnsRenamed({"id": "_id", "th": "_th"})
    # A later copy of a whole text is one run: of all its lines.
    n_words = F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + x["n_words"])
    copied = sequences.withColumn("goes", (F.size("lines") >= runs.min_lines) | ((n_words >= runs.min_words) & (F.size("lines") > 0)))
    th, th2 = text_hashes(text_col)
    texts = docs.select(F.col(id_col).alias("id"), th.alias("th"), th2.alias("th2")).distinct()
    first = sequences.select("id", "th", "th2").join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("id", "th", "th2", "removed")
    known = copied.where("goes").select(F.col("id").alias("_id"), F.col("th").alias("_th"), F.col("th2").alias("_th2"), F.transform("lines", lambda x: x["line_no"]).alias("removed"))
    later = texts.join(known, (F.col("th") == F.col("_th")) & (F.col("th2") == F.col("_th2")) & ~F.col("id").eqNullSafe(F.col("_id"))).select("id", "th", "th2", "removed")
    return first.unionByName(later)


def dedup_lines(docs: DataFrame, runs: Runs = Runs(), id_col: str = "doc_id", text_col: str = "text", removed_col: str = "removed_lines") -> DataFrame:
    """All columns of every row, its text without the lines of later copies, and removed_col (array<int>, numbers of those lines).

    A line goes if it lies in a run of lines that also stands at an earlier place, by (id, hash of the text, line), and that is long enough; runs may overlap, also with their own
    copy. Lines without a word never count or go. A text that loses nothing stays as it is, null included; one that loses all lines is
    empty. Repeated rows (same id, same text) are one document: none is a copy of the other. Null ids are an id of their own,
    earlier than others. An empty table gives no rows. Extra columns stay, whatever their names are.
    """
    if removed_col in docs.columns:
        raise ValueError(f"the table has a column {removed_col!r} already")
    gone = later_copies(docs, runs, id_col, text_col)
    th, th2 = text_hashes(text_col)
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("_id"), th.alias("_th"), th2.alias("_th2"))
    joined = rows.join(gone, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_th") == F.col("th")) & (F.col("_th2") == F.col("th2")), "left")
    text = F.col(f"row.`{text_col}`")
    lines = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "removed")
    kept = joined.select("row", "removed", lines.alias("lines"), left.alias("left")).select("row", "removed", F.when(F.col("removed").isNull(), text).otherwise(F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n")).alias("rest"))
    columns = [F.col("rest").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return kept.select(*columns, F.coalesce("removed", F.array().cast("array<int>")).alias(removed_col))
