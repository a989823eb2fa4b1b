"""Full-text predicates over tokens, as Column expressions: no UDF, so that filters stay in generated code."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A token is a run of letters and digits, lower-cased.
TOKEN = r"[\p{L}\p{N}]+"
#: Public list of very common English words, for no_stopwords=False.
STOPWORDS = ("a", "is", "the", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "it", "no", "not", "of", "on", "or", "such", "that", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with")


def tokens(text: Column) -> Column:
    """Tokens of a text in order; null gives null."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def words_of(query: str) -> list[str]:
    return re.findall(r"[^\W_]+", query.lower())


def has_term(text: Column, term: str) -> Column:
    """Every word of the term is a token of the text."""
    out = F.lit(True)
    for word in words_of(term):
        out = out & F.array_contains(tokens(text), word)
    return out


def has_prefix(text: Column, start: str) -> Column:
    return F.exists(tokens(text), lambda t: t.startswith(start.lower()))


def has_suffix(text: Column, end: str) -> Column:
    return F.exists(tokens(text), lambda t: t.endswith(end.lower()))


def has_infix(text: Column, part: str) -> Column:
    return F.exists(tokens(text), lambda t: t.contains(part.lower()))


def glob_pattern(glob: str, anchored: bool = True) -> str:
    r"""A regular expression for a glob of * ? [a-z] [^x] and \x."""
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out.append(re.escape(glob[i]))
        elif c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[" and (end := glob.find("]", i + 2)) > 0:
            body = glob[i + 1 : end]
            negated = body[0] in "^!"
            out.append(f"[{'^' if negated else ''}{body[negated:].replace(chr(92), chr(92) * 2).replace('[', chr(92) + '[')}]")
            i = end
        else:
            out.append(re.escape(c))
        i += 1
    return f"(?s)^{''.join(out)}$" if anchored else "".join(out)


def matches_glob(text: Column, glob: str) -> Column:
    """Glob match of the whole text. Globs that are a prefix become startswith(), which Parquet can push down."""
    if re.fullmatch(r"[^*?\[\]\\]*\*", glob):
        return F.lit(True) & text.isNotNull() if glob == "*" else text.startswith(glob[:-1])
    if re.fullmatch(r"[^*?\[\]\\]*", glob):
        return text == glob
    return text.rlike(glob_pattern(glob))


def matches_token(text: Column, glob: str) -> Column:
    return F.exists(tokens(text), lambda t: t.rlike(glob_pattern(glob.lower())))


def is_fuzzy(text: Column, term: str, distance: int) -> Column:
    """Some token lies within the edit distance of the term."""
    return F.exists(tokens(text), lambda t: F.levenshtein(t, F.lit(term.lower()), distance) >= 0)


def _is(word: str) -> Callable[[Column], Column]:
    return lambda t: t == word


def has_phrase(text: Column, words: list[str], slop: int | None = None, in_order: bool | None = None) -> Column:
    """The words stand together: with at most `slop` other tokens among them (none if not given), in order unless in_order is False.

    The slop is for all gaps together. A word that is said twice has to stand twice. Texts that lack one of the words aren't cut into tokens.
    """
    wanted = [w for word in words for w in words_of(word)]
    if not wanted:
        return F.lit(True)
    room, low = slop or 0, F.lower(text)
    held = F.lit(True)
    for w in sorted(set(wanted)):
        held = held & low.contains(w)

    def reached(t: Column, i: Column) -> Column:
        """The place of the last word if the others follow the first one, at i, each as soon as it can; -1 if one doesn't."""
        rest = F.array(*(F.lit(w) for w in wanted[1:]))
        within = lambda p, w: F.array_position(F.slice(t, p + 2, room + 1), w).cast("int")
        return F.aggregate(rest, i, lambda p, w: F.when((p < 0) | (within(p, w) == 0), F.lit(-1)).otherwise(p + within(p, w)))

    def ordered(t: Column, i: Column) -> Column:
        last = reached(t, i) if len(wanted) > 1 else i
        return (F.get(t, i) == wanted[0]) & (last - i <= len(wanted) - 1 + room) & (last >= 0)

    def unordered(t: Column, i: Column) -> Column:
        window, out = F.slice(t, i + 1, len(wanted) + room), F.get(t, i).isin(*set(wanted))
        for w in sorted(set(wanted)):
            out = out & (F.size(F.filter(window, _is(w))) >= wanted.count(w))
        return out

    at = unordered if in_order is False else ordered
    # The array of one element names the tokens, so that they are made once.
    found = F.exists(F.array(tokens(text)), lambda t: F.exists(F.sequence(F.lit(0), F.greatest(F.size(t) - 1, F.lit(0))), lambda i: F.coalesce(at(t, i), F.lit(False))))
    return F.when(held, found).otherwise(F.when(text.isNotNull(), F.lit(False)))


def tag_values(field: Column, separator: str = ",", case_sensitive: bool = False) -> Column:
    """The tags of a field: its parts, trimmed; lower-cased unless case matters."""
    parts = F.transform(F.split(field, re.escape(separator)), lambda t: F.trim(t))
    return parts if case_sensitive else F.transform(parts, F.lower)


def similarity(text: Column, other: str) -> Column:
    """1 less the edit distance over the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(text), F.lit(len(other)))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(text, F.lit(other)) / longest)


def highlighted(text: Column, terms: list[str], open_tag: str = "<b>", close_tag: str = "</b>") -> Column:
    """The text with every whole-word occurrence of the terms between the tags."""
    words = sorted({w for t in terms for w in words_of(t)})
    if not words:
        return text
    dollar = lambda tag: tag.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, rf"(?iu)(?<![\p{{L}}\p{{N}}])({'|'.join(map(re.escape, words))})(?![\p{{L}}\p{{N}}])", f"{dollar(open_tag)}$1{dollar(close_tag)}")


def summarized(text: Column, terms: list[str], frags: int = 3, length: int = 20, separator: str = "...") -> Column:
    """Up to `frags` fragments of `length` words, each beginning a few words before a hit that no earlier fragment shows; without a hit: the beginning."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    wanted = [w for t in terms for w in words_of(t)]
    hit = lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}]+", "")).isin(*wanted)
    hits = F.filter(F.transform(words, lambda w, i: F.when(hit(w), i)), lambda i: i.isNotNull()) if wanted else F.array().cast("array<int>")
    lead = length // 4
    starts = F.aggregate(hits, F.array().cast("array<int>"), lambda a, i: F.when((F.size(a) < frags) & ((F.size(a) == 0) | (i >= F.element_at(a, -1) + length)), F.concat(a, F.array(F.greatest(i - lead, F.lit(0))))).otherwise(a))
    chosen = F.when(F.size(starts) > 0, starts).otherwise(F.array(F.lit(0)))
    return F.array_join(F.transform(chosen, lambda s: F.array_join(F.slice(words, s + 1, length), " ")), separator)
