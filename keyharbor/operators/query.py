"""A predicate language that is composed in Python and evaluated by Catalyst.

    q = (col("age") > 30) & col("status").has_tag("active") & ~col("name").fuzzy("jon")
    df.filter(q.to_column())          # what runs
    q.to_query()                      # the same predicate in search syntax, for logs and comparison

Predicates have two values: a row without the field fails every leaf, so negation keeps it. One tree is one Column; nothing is split
between sides, and Catalyst pushes what it can to the scan. is_client_side and explain() only tell which leaves the search
syntax can't say.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyharbor.functions import geo, parse, text, vector
from keyharbor.operators.fields import Field, TagField, VectorField

#: Characters that search syntax escapes (fixed values).
TAG_SPECIAL = ",.<>{}[]\\\"':;!@#$%^&*()-+=~ "
TEXT_SPECIAL = "@{}[]()|-~"

#: Leaves that the search syntax can't say.
CLIENT = {"regex", "icontains", "iequals", "contains_any", "similar_to", "date", "date_part", "array_contains", "array_len", "json_path"}
_COMPARE: dict[str, Callable[[Any, Any], Any]] = {"eq": lambda a, b: a == b, "gt": lambda a, b: a > b, "gte": lambda a, b: a >= b, "lt": lambda a, b: a < b, "lte": lambda a, b: a <= b, "ne": lambda a, b: a != b, "in": lambda a, b: a.isin(list(b))}


@dataclass(frozen=True)
class Context:
    """fields: of an index (undeclared names: equality is plain, words are text). params: vectors by name. slop, in_order: of phrases that don't say their own."""

    fields: Mapping[str, Field] = field(default_factory=dict)
    params: Mapping[str, Any] = field(default_factory=dict)
    slop: int | None = None
    in_order: bool | None = None


def _escaped(s: str, special: str) -> str:
    return "".join("\\" + c if c in special else c for c in s)


def _numeric(v: Any) -> bool:
    return isinstance(v, int | float) and not isinstance(v, bool)


def _tag(v: Any) -> str:
    return str(v).lower() if isinstance(v, bool) else str(v) if _numeric(v) else _escaped(str(v), TAG_SPECIAL)


@dataclass(frozen=True, eq=False)
class Expr:
    op: str
    name: str | None = None
    args: tuple = ()
    parts: tuple[Expr, ...] = ()

    # Comparisons

    def _leaf(self, op: str, *args: Any) -> Expr:
        if self.op in ("array_len", "json_path"):
            return Expr(self.op, self.name, (*self.args, op, *args))
        if self.op != "column":
            raise TypeError(f"a comparison needs a field, and this is a whole predicate ({self.op}); & and | bind tighter than comparisons, so each goes in parentheses")
        return Expr(op, self.name, args)

    def __gt__(self, v: Any) -> Expr:
        return self._leaf("gt", v)

    def __ge__(self, v: Any) -> Expr:
        return self._leaf("gte", v)

    def __lt__(self, v: Any) -> Expr:
        return self._leaf("lt", v)

    def __le__(self, v: Any) -> Expr:
        return self._leaf("lte", v)

    def __eq__(self, v: Any) -> Expr:  # type: ignore[override]
        return self._leaf("eq", v)

    def __ne__(self, v: Any) -> Expr:  # type: ignore[override]
        return self._leaf("ne", v)

    __hash__ = None  # type: ignore[assignment]

    def is_between(self, low: Any, high: Any) -> Expr:
        return self._leaf("between", low, high)

    def is_in(self, values: list) -> Expr:
        """One of the values; none of them if there are none."""
        out = match_none()
        for k, v in enumerate(values):
            out = self == v if not k else out | (self == v)
        return out

    # Logic

    def _bool(self, op: str, other: Expr) -> Expr:
        for side in (self, other):
            if not isinstance(side, Expr) or side.op == "column":
                raise TypeError("& and | join predicates; put comparisons in parentheses")
        return Expr(op, parts=(self, other))

    def __and__(self, other: Expr) -> Expr:
        return self._bool("and", other)

    def __or__(self, other: Expr) -> Expr:
        return self._bool("or", other)

    __rand__ = __and__
    __ror__ = __or__

    def __bool__(self) -> bool:
        raise TypeError("a predicate has no truth value; use &, | and ~")

    def __invert__(self) -> Expr:
        return Expr("not", parts=(self,))

    not_ = negate = __invert__

    # Text, tags, geography, vectors

    def contains(self, words: str) -> Expr:
        return self._leaf("text", words)

    def starts_with(self, start: str) -> Expr:
        return self._leaf("prefix", start)

    def ends_with(self, end: str) -> Expr:
        return self._leaf("suffix", end)

    def contains_substring(self, part: str) -> Expr:
        return self._leaf("infix", part)

    def matches(self, glob: str) -> Expr:
        return self._leaf("wildcard", glob)

    def matches_exact(self, glob: str) -> Expr:
        return self._leaf("wildcard_exact", glob)

    def fuzzy(self, term: str, distance: int = 1) -> Expr:
        return self._leaf("fuzzy", term, min(3, max(1, distance)))

    def phrase(self, *words: str, slop: int | None = None, inorder: bool | None = None) -> Expr:
        return self._leaf("phrase", words, slop, inorder)

    def has_tag(self, tag: Any) -> Expr:
        return self._leaf("tag", (tag,))

    def has_any_tag(self, tags: list) -> Expr:
        return self._leaf("tag", tuple(tags))

    def within_radius(self, lon: float, lat: float, radius: float, unit: str = "km") -> Expr:
        geo.unit_metres(unit)
        return self._leaf("radius", lon, lat, radius, unit)

    def within_polygon(self, points: list[tuple[float, float]]) -> Expr:
        return self._leaf("polygon", tuple(map(tuple, points)))

    def knn(self, k: int, param: str = "query_vec") -> Expr:
        return self._leaf("knn", k, param)

    def vector_range(self, radius: float, param: str = "query_vec") -> Expr:
        return self._leaf("vector_range", radius, param)

    # Null, score

    def is_null(self) -> Expr:
        return self._leaf("null")

    def is_not_null(self) -> Expr:
        return self._leaf("not_null")

    def boost(self, weight: float) -> Expr:
        return Expr("boost", args=(weight,), parts=(self,))

    def optional(self) -> Expr:
        return Expr("optional", parts=(self,))

    # Beyond search syntax

    def matches_regex(self, pattern: str) -> Expr:
        return self._leaf("regex", pattern)

    def icontains(self, part: str) -> Expr:
        return self._leaf("icontains", part)

    def iequals(self, value: str) -> Expr:
        return self._leaf("iequals", value)

    def contains_any(self, parts: list[str]) -> Expr:
        return self._leaf("contains_any", tuple(parts))

    def similar_to(self, other: str, threshold: float = 0.8) -> Expr:
        return self._leaf("similar_to", other, threshold)

    def as_date(self) -> DateExpr:
        return DateExpr(str(self.name), "date")

    def as_datetime(self) -> DateExpr:
        return DateExpr(str(self.name), "datetime")

    def array_contains(self, value: Any) -> Expr:
        return self._leaf("array_contains", value)

    def array_len(self) -> Expr:
        """To be compared: col("tags").array_len() > 5."""
        return self._leaf("array_len")

    def json_path(self, path: str) -> Expr:
        """To be compared: col("doc").json_path("$.user.name") == "x"."""
        return self._leaf("json_path", path)

    # What runs

    def to_column(self, context: Context | None = None, exact: bool = False) -> Column:
        """The predicate as a filter: rows without a field fail its leaves, as null or (exact) as false. Plain comparisons stay plain, so that Parquet can skip by them."""
        c = context or Context()
        if self.op in ("and", "or"):
            a, b = (p.to_column(c, exact) for p in self.parts)
            return a & b if self.op == "and" else a | b
        if self.op == "not":
            return ~self.parts[0].to_column(c, True)
        if self.op == "boost":
            return self.parts[0].to_column(c, exact)
        if self.op in ("optional", "all"):
            return F.lit(True)
        if self.op == "none":
            return F.lit(False)
        if self.op == "ne":
            return ~replace(self, op="eq").to_column(c, True)
        if self.op == "null":
            return F.col(self.name).isNull()
        if self.op == "not_null":
            return F.col(self.name).isNotNull()
        if self.op == "knn":
            raise ValueError("the nearest k are no filter: use search(), with knn at the root or a filter before it")
        if self.op == "column":
            raise TypeError(f"field {self.name!r} is compared with nothing")
        found = F.expr(self.args[0]) if self.op == "raw" else _LEAVES[self.op](self, c)
        return F.coalesce(found, F.lit(False)) if exact else found

    # Search syntax

    def to_query(self) -> str:
        if self.op in ("and", "or"):
            tags = self._one_field_tags() if self.op == "or" else None
            if tags:
                return f"@{tags[0]}:{{{'|'.join(map(_tag, tags[1]))}}}"
            other = "or" if self.op == "and" else "and"  # a part of the other kind is bracketed
            a, b = (f"({p.to_query()})" if p.op == other else p.to_query() for p in self.parts)
            return f"{a} {b}" if self.op == "and" else f"({a} | {b})"
        if self.op == "not":
            return f"-({self.parts[0].to_query()})"
        if self.op == "boost":
            return f"({self.parts[0].to_query()}) => {{ $weight: {self.args[0]}; }}"
        if self.op == "optional":
            return f"~{self.parts[0].to_query()}"
        return _SYNTAX.get(self.op, lambda e: "*")(self)

    __str__ = to_query

    def _one_field_tags(self) -> tuple[str, list] | None:
        """(field, values) of a tree of ORs of tag equalities on one field."""
        if self.op == "eq" and not _numeric(self.args[0]):
            return self.name, [self.args[0]]
        found = [p._one_field_tags() for p in self.parts] if self.op == "or" else []
        if found and all(found) and len({f[0] for f in found}) == 1:
            return found[0][0], [v for f in found for v in f[1]]
        return None

    @property
    def is_client_side(self) -> bool:
        return self.op in CLIENT or any(p.is_client_side for p in self.parts)

    def get_server_filter(self) -> Expr | None:
        """What search syntax can say of it, such that the rest can be ANDed. An OR is said as a whole or not at all."""
        if self.op == "and":
            said = [s for s in (p.get_server_filter() for p in self.parts) if s is not None]
            return said[0] & said[1] if len(said) == 2 else said[0] if said else None
        return None if self.is_client_side else self

    def get_client_filter(self) -> Expr | None:
        """The rest. An OR with a side that search syntax can't say is in here as a whole."""
        if self.op == "and":
            rest = [s for s in (p.get_client_filter() for p in self.parts) if s is not None]
            return rest[0] & rest[1] if len(rest) == 2 else rest[0] if rest else None
        return self if self.is_client_side else None

    def explain(self) -> str:
        server, client = self.get_server_filter(), self.get_client_filter()
        return f"Search: {server.to_query() if server is not None else '* (fetch all)'}\nFilter: {client.to_column() if client is not None else 'none (search syntax says it all)'}"


def col(name: str) -> Expr:
    return Expr("column", name)


def match_all() -> Expr:
    return Expr("all")


def match_none() -> Expr:
    return Expr("none")


def raw(condition: str) -> Expr:
    """A condition in Spark SQL, as it is; null counts as false."""
    return Expr("raw", args=(condition,))


@dataclass(frozen=True)
class MultiFieldExpr:
    names: tuple[str, ...]

    def contains(self, words: str) -> Expr:
        return Expr("any_text", args=(self.names, words))

    def starts_with(self, start: str) -> Expr:
        return Expr("any_prefix", args=(self.names, start))


def cols(*names: str) -> MultiFieldExpr:
    return MultiFieldExpr(names)


@dataclass(frozen=True, eq=False)
class DatePartExpr:
    name: str
    kind: str
    part: str

    def _leaf(self, op: str, v: Any) -> Expr:
        return Expr("date_part", self.name, (self.kind, self.part, op, v))

    def __eq__(self, v: int) -> Expr:  # type: ignore[override]
        return self._leaf("eq", v)

    def __gt__(self, v: int) -> Expr:
        return self._leaf("gt", v)

    def __lt__(self, v: int) -> Expr:
        return self._leaf("lt", v)

    def __ge__(self, v: int) -> Expr:
        return self._leaf("gte", v)

    def __le__(self, v: int) -> Expr:
        return self._leaf("lte", v)

    def is_in(self, values: list[int]) -> Expr:
        return self._leaf("in", tuple(values))

    __hash__ = None  # type: ignore[assignment]


@dataclass(frozen=True, eq=False)
class DateExpr:
    """A field read as a date or datetime: text by the parsing rules, dates and timestamps as they are."""

    name: str
    kind: str

    def _leaf(self, op: str, v: Any) -> Expr:
        return Expr("date", self.name, (self.kind, op, v))

    def __eq__(self, v: Any) -> Expr:  # type: ignore[override]
        return self._leaf("eq", v)

    def __gt__(self, v: Any) -> Expr:
        return self._leaf("gt", v)

    def __ge__(self, v: Any) -> Expr:
        return self._leaf("gte", v)

    def __lt__(self, v: Any) -> Expr:
        return self._leaf("lt", v)

    def __le__(self, v: Any) -> Expr:
        return self._leaf("lte", v)

    __hash__ = None  # type: ignore[assignment]

    def _part(self, part: str) -> DatePartExpr:
        return DatePartExpr(self.name, self.kind, part)

    def year(self) -> DatePartExpr:
        return self._part("year")

    def month(self) -> DatePartExpr:
        return self._part("month")

    def day(self) -> DatePartExpr:
        return self._part("day")

    def weekday(self) -> DatePartExpr:
        """Monday is 0."""
        return self._part("weekday")

    def hour(self) -> DatePartExpr:
        return self._part("hour")

    def minute(self) -> DatePartExpr:
        return self._part("minute")


_PARTS = {"year": F.year, "month": F.month, "day": F.day, "weekday": F.weekday, "hour": F.hour, "minute": F.minute}


def _date(name: str, kind: str) -> Column:
    """Dates and timestamps pass through their text; epochs and ISO text follow the parsing rules."""
    value = parse.parsed(F.col(name).cast("string"), kind, strict=False)
    return value if kind == "datetime" else F.coalesce(value, parse.parsed(F.col(name).cast("string"), "datetime", strict=False).cast("date"))


def _date_value(value: Any, kind: str) -> Column:
    return parse.parsed(F.lit(str(value)), kind)


def _tag_field(e: Expr, c: Context) -> TagField | None:
    f = c.fields.get(str(e.name))
    return f if isinstance(f, TagField) else None


def _equal(e: Expr, c: Context) -> Column:
    """Tags of a declared tag field; else plain equality."""
    value = e.args[0]
    if (tag := _tag_field(e, c)) and not _numeric(value):
        return _tagged(e, c, (value,))
    return F.col(e.name) == F.lit(value)


def _tagged(e: Expr, c: Context, tags: tuple) -> Column:
    f = _tag_field(e, c) or TagField(str(e.name))
    fold = (lambda s: s) if f.casesensitive else str.lower
    wanted = [fold(_plain(t)) for t in tags]
    return F.arrays_overlap(text.tag_values(F.col(e.name).cast("string"), f.separator, f.casesensitive), F.array(*(F.lit(w) for w in wanted))) if wanted else F.lit(False)


def _plain(v: Any) -> str:
    return str(v).lower() if isinstance(v, bool) else str(v)


def _affix(in_tokens: Callable[[Column, str], Column], of_value: Callable[[Column, str], Column]):
    """Over tokens, or over the value of a declared tag field."""

    def leaf(e: Expr, c: Context) -> Column:
        tag = _tag_field(e, c)
        if not tag:
            return in_tokens(F.col(e.name), e.args[0])
        fold = (lambda s: s) if tag.casesensitive else str.lower
        return F.exists(text.tag_values(F.col(e.name), tag.separator, tag.casesensitive), lambda t: of_value(t, fold(e.args[0])))

    return leaf


def _point(e: Expr, c: Context) -> tuple[Column, Column]:
    """(lon, lat): of a field of "lon,lat" text."""
    parts = F.split(F.col(e.name).cast("string"), ",")
    return F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")


def _metric(name: str, c: Context) -> str:
    f = c.fields.get(name)
    return f.distance_metric if isinstance(f, VectorField) else "COSINE"


def vector_distance(e: Expr, c: Context) -> Column:
    """Distance of a knn or vector_range leaf's field to its parameter."""
    if e.args[1] not in c.params:
        raise ValueError(f"no parameter {e.args[1]!r}: pass params={{{e.args[1]!r}: [...]}}")
    return vector.distance(F.col(e.name), vector.literal(c.params[e.args[1]]), _metric(str(e.name), c))


def _any_of(found: list[Column]) -> Column:
    out = F.lit(False)
    for x in found:
        out = out | F.coalesce(x, F.lit(False))
    return out


_LEAVES: dict[str, Callable[[Expr, Context], Column]] = {
    "eq": _equal,
    **{k: (lambda e, c, f=_COMPARE[k]: f(F.col(e.name), F.lit(e.args[0]))) for k in ("gt", "gte", "lt", "lte")},
    "between": lambda e, c: F.col(e.name).between(F.lit(e.args[0]), F.lit(e.args[1])),
    "text": lambda e, c: text.has_term(F.col(e.name), e.args[0]),
    "prefix": _affix(text.has_prefix, lambda v, s: v.startswith(s)),
    "suffix": _affix(text.has_suffix, lambda v, s: v.endswith(s)),
    "infix": _affix(text.has_infix, lambda v, s: v.contains(s)),
    "wildcard": _affix(text.matches_token, text.matches_glob),
    "wildcard_exact": lambda e, c: text.matches_glob(F.col(e.name), e.args[0]),
    "fuzzy": lambda e, c: text.is_fuzzy(F.col(e.name), *e.args),
    "phrase": lambda e, c: text.has_phrase(F.col(e.name), list(e.args[0]), e.args[1] if e.args[1] is not None else c.slop, e.args[2] if e.args[2] is not None else c.in_order),
    "tag": lambda e, c: _tagged(e, c, e.args[0]),
    "any_text": lambda e, c: _any_of([text.has_term(F.col(n), e.args[1]) for n in e.args[0]]),
    "any_prefix": lambda e, c: _any_of([text.has_prefix(F.col(n), e.args[1]) for n in e.args[0]]),
    "radius": lambda e, c: geo.within_radius(*_point(e, c), *e.args),
    "polygon": lambda e, c: geo.within_polygon(*_point(e, c), list(e.args[0])),
    "vector_range": lambda e, c: vector_distance(e, c) <= e.args[0],
    "regex": lambda e, c: F.col(e.name).rlike(e.args[0]),
    "icontains": lambda e, c: F.lower(e.name).contains(e.args[0].lower()),
    "iequals": lambda e, c: F.lower(e.name) == e.args[0].lower(),
    "contains_any": lambda e, c: _any_of([F.col(e.name).contains(p) for p in e.args[0]]),
    "similar_to": lambda e, c: text.similarity(F.col(e.name), e.args[0]) >= e.args[1],
    "date": lambda e, c: _COMPARE[e.args[1]](_date(str(e.name), e.args[0]), _date_value(e.args[2], e.args[0])),
    "date_part": lambda e, c: _COMPARE[e.args[2]](_PARTS[e.args[1]](_date(str(e.name), e.args[0])), e.args[3]),
    "array_contains": lambda e, c: F.array_contains(e.name, e.args[0]),
    "array_len": lambda e, c: F.size(e.name).between(*e.args[1:]) if e.args[0] == "between" else (F.col(e.name).isNotNull() & _COMPARE[e.args[0]](F.size(e.name), e.args[1])),
    "json_path": lambda e, c: _json(e),
}


def _json(e: Expr) -> Column:
    path, op, *values = e.args
    found = F.get_json_object(F.col(e.name).cast("string"), path)
    typed = found.try_cast("double") if all(map(_numeric, values)) else found
    values = [_plain(v) if isinstance(v, bool) else v for v in values]
    return typed.between(*values) if op == "between" else _COMPARE[op](typed, F.lit(values[0]))


def _range(low: str, high: str):
    return lambda e: f"@{e.name}:[{low.format(*e.args)} {high.format(*e.args)}]"


def _phrase_syntax(e: Expr) -> str:
    words, slop, in_order = e.args
    said = [f"$slop: {slop}"] * (slop is not None) + [f"$inorder: {str(in_order).lower()}"] * (in_order is not None)
    return f"@{e.name}:({' '.join(map(str, words))})" + (f" => {{ {'; '.join(said)}; }}" if said else "")


def _around(before: str, after: str):
    return lambda e: f"@{e.name}:{before}{_escaped(str(e.args[0]), TEXT_SPECIAL)}{after}"


_SYNTAX: dict[str, Callable[[Expr], str]] = {
    "gt": _range("({0}", "+inf"), "gte": _range("{0}", "+inf"), "lt": _range("-inf", "({0}"), "lte": _range("-inf", "{0}"), "between": _range("{0}", "{1}"),
    "eq": lambda e: f"@{e.name}:[{e.args[0]} {e.args[0]}]" if _numeric(e.args[0]) else f"@{e.name}:{{{_tag(e.args[0])}}}",
    "ne": lambda e: f"-@{e.name}:[{e.args[0]} {e.args[0]}]" if _numeric(e.args[0]) else f"-@{e.name}:{{{_tag(e.args[0])}}}",
    "all": lambda e: "*", "none": lambda e: "-*", "raw": lambda e: str(e.args[0]),
    "text": _around("", ""), "prefix": _around("", "*"), "suffix": _around("*", ""), "infix": _around("*", "*"),
    "wildcard": lambda e: f"@{e.name}:{e.args[0]}", "wildcard_exact": lambda e: f"@{e.name}:\"w'{e.args[0]}'\"",
    "fuzzy": lambda e: _around("%" * e.args[1], "%" * e.args[1])(e), "phrase": _phrase_syntax,
    "tag": lambda e: f"@{e.name}:{{{'|'.join(map(_tag, e.args[0]))}}}",
    "any_text": lambda e: f"@{'|'.join(e.args[0])}:{_escaped(e.args[1], TEXT_SPECIAL)}", "any_prefix": lambda e: f"@{'|'.join(e.args[0])}:{_escaped(e.args[1], TEXT_SPECIAL)}*",
    "radius": lambda e: f"@{e.name}:[{' '.join(map(str, e.args))}]", "polygon": lambda e: f"@{e.name}:[WITHIN $poly]",
    "knn": lambda e: f"*=>[KNN {e.args[0]} @{e.name} ${e.args[1]}]", "vector_range": lambda e: f"@{e.name}:[VECTOR_RANGE {e.args[0]} ${e.args[1]}]",
    "null": lambda e: f"ismissing(@{e.name})", "not_null": lambda e: f"-ismissing(@{e.name})",
}


def polygon_wkt(e: Expr) -> str:
    """The parameter $poly of a polygon leaf: a closed ring."""
    points = list(e.args[0])
    ring = points if points[0] == points[-1] else [*points, points[0]]
    return f"POLYGON(({', '.join(f'{x} {y}' for x, y in ring)}))"


#: How a token matches a searched word: of the token, the word, and the edit distance of fuzzy ones.
MATCHES: dict[str, Callable[[Column, str, int], Column]] = {
    "is": lambda t, w, d: t == w, "prefix": lambda t, w, d: t.startswith(w), "suffix": lambda t, w, d: t.endswith(w), "infix": lambda t, w, d: t.contains(w),
    "fuzzy": lambda t, w, d: F.levenshtein(t, F.lit(w), d) >= 0,
}


@dataclass(frozen=True)
class Term:
    """A searched word of a field: what scoring and highlighting go by."""

    field: str
    word: str
    weight: float = 1.0
    how: str = "is"
    distance: int = 0

    def matches(self, token: Column) -> Column:
        return MATCHES[self.how](token, self.word, self.distance)


def terms_of(e: Expr) -> list[Term]:
    """The words that a predicate searches for, outside negations."""
    if e.op == "not":
        return []
    if e.op == "boost":
        return [replace(t, weight=t.weight * e.args[0]) for t in terms_of(e.parts[0])]
    if e.parts:
        return [t for p in e.parts for t in terms_of(p)]
    name = str(e.name)
    if e.op == "text":
        return [Term(name, w) for w in text.words_of(e.args[0])]
    if e.op == "fuzzy":
        return [Term(name, e.args[0].lower(), how="fuzzy", distance=e.args[1])]
    if e.op in ("prefix", "suffix", "infix"):
        return [Term(name, e.args[0].lower(), how=e.op)]
    if e.op == "phrase":
        return [Term(name, w) for word in e.args[0] for w in text.words_of(word)]
    if e.op == "any_text":
        return [Term(n, w) for n in e.args[0] for w in text.words_of(e.args[1])]
    if e.op == "any_prefix":
        return [Term(n, e.args[1].lower(), how="prefix") for n in e.args[0]]
    return []
