"""Secret scans by a trigram index.

A Boolean query over trigrams is derived from each rule's pattern: every match must hold those strings. Each
Arrow batch is a shard: it gets an inverted index from trigram to postings (rows of the shard), the query of a
rule intersects and unites postings, and the pattern itself runs only on the rows that remain. A rule
from which no mandatory trigram follows runs on every row. Shards need no shuffle, so the scan is one map stage.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from keyharbor.llm.common import pieces


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern; kept if `group` has `least` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern[str]:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: Fixed by the contract, in this order.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
#: Public formats of keys, beyond the base.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
)

#: Most literal strings followed at once while a query is derived; beyond it the strings so far become a clause.
MOST_STRINGS = 64

# A query is True (any text), a trigram, or ("and" | "or", parts).
Query = bool | str | tuple


def _both(kind: str, parts: list[Query]) -> Query:
    if kind == "and":
        parts = [p for p in parts if p is not True]
        return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))
    return True if any(p is True for p in parts) or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _clause(strings: set[str]) -> Query:
    """Some of the strings must occur: each demands all of its trigrams."""
    return _both("or", [_both("and", sorted({s[i : i + 3] for i in range(len(s) - 2)})) for s in sorted(strings)])


def _options(op, arg) -> set[str] | None:
    if op is sre.LITERAL:
        return {chr(arg).lower()}
    if op is sre.IN and all(k in (sre.LITERAL, sre.RANGE) for k, _ in arg):
        found = {chr(c).lower() for k, v in arg for c in ([v] if k is sre.LITERAL else range(v[0], v[1] + 1))}
        return found if len(found) <= 6 else None
    return None


def _walk(sequence) -> tuple[set[str] | None, Query]:
    """The strings that the sequence can be, if they are few, and a query that any match satisfies."""
    now, clauses, whole = {""}, [], True

    def add(found: set[str]) -> None:
        nonlocal now, whole
        joined = {a + b for a in now for b in found}
        if len(joined) > MOST_STRINGS:
            clauses.append(_clause(now))
            joined, whole = set(found), False
        now = joined

    def gap(query: Query = True) -> None:
        nonlocal now, whole
        clauses.extend([_clause(now), query])
        now, whole = {""}, False

    for op, arg in sequence:
        if op is sre.AT:
            continue
        if (found := _options(op, arg)) is not None:
            add(found)
        elif op is sre.SUBPATTERN:
            exact, query = _walk(arg[3])
            add(exact) if exact is not None else gap(query)
        elif op is sre.BRANCH:
            ways = [_walk(x) for x in arg[1]]
            if all(e is not None for e, _ in ways) and sum(len(e) for e, _ in ways) <= MOST_STRINGS:
                add(set().union(*(e for e, _ in ways)))
            else:
                gap(_both("or", [q for _, q in ways]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            exact, query = _walk(body)
            if exact is not None and (low, high) == (0, 1):
                add(exact | {""})
            elif exact is not None and low == high and low <= 8:
                for _ in range(low):
                    add(exact)
            else:
                gap(query if low else True)
        else:
            gap()
    return (now if whole else None), _both("and", [*clauses, _clause(now)])


def trigram_query(pattern: str) -> Query:
    """What any match of the pattern must hold, over lower-cased trigrams; True: nothing follows, scan all."""
    return _walk(parser.parse(pattern))[1]


def _trigrams(query: Query) -> set[str]:
    return {query} if isinstance(query, str) else set() if query is True else set().union(*map(_trigrams, query[1]))


class ShardIndex:
    """Postings (row numbers, ascending) of the wanted trigrams of a few texts."""

    def __init__(self, texts: list[bytes], wanted: list[str], slots: np.ndarray):
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        b = np.frombuffer(b"\0".join(texts), np.uint8).astype(np.uint32)
        low = np.where((b >= 65) & (b <= 90), b + 32, b)
        codes = low[:-2] << 16 | low[1:-1] << 8 | low[2:] if len(low) > 2 else np.empty(0, np.uint32)
        slot = slots[codes]
        at = np.flatnonzero(slot)
        pairs = np.unique(slot[at].astype(np.int64) * len(texts) + np.searchsorted(starts, at, side="right") - 1)
        cuts = np.searchsorted(pairs, np.arange(1, len(wanted) + 2) * len(texts))
        self.rows = np.arange(len(texts))
        self.postings = {w: pairs[cuts[i] : cuts[i + 1]] - (i + 1) * len(texts) for i, w in enumerate(wanted)}

    def find(self, query: Query) -> np.ndarray:
        if query is True:
            return self.rows
        if isinstance(query, str):
            return self.postings[query]
        found = [self.find(q) for q in query[1]]
        out = found[0]
        for x in found[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
        return out


SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): spans of every row's whole text in code points, end exclusive, by start, then by the order of the rules.

    Null and empty texts have no spans (an empty list); ids may be null or repeat; other columns are ignored.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(_trigrams, queries)))
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << 24, np.uint16)
        for i, w in enumerate(wanted):
            slots[int.from_bytes(w.encode(), "big")] = i + 1
        patterns = [r.compiled() for r in rules]
        for batch in pieces(batches, 1, 4 << 20):
            texts = pc.fill_null(batch.column(1), "").to_pylist()
            index = ShardIndex([t.encode() for t in texts], wanted, slots)
            spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for k, (rule, query, pattern) in enumerate(zip(rules, queries, patterns, strict=True)):
                for row in index.find(query).tolist():
                    for m in pattern.finditer(texts[row]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            spans[row].append((m.start(), k, m.end()))
            out = [[{"kind": rules[k].kind, "start": a, "end": z} for a, k, z in sorted(s)] for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind_type)], names=[id_col, "spans"])

    return docs.select(id_col, text_col).mapInArrow(scan, StructType([docs.schema[id_col], StructField("spans", ArrayType(SPAN))]))
