"""Search and aggregation over a table: predicates, scoring, nearest neighbours, and the fixed order of aggregation stages."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyharbor.functions import text
from keyharbor.operators.fields import Field, TextField
from keyharbor.operators.query import Context, Expr, Term, match_all, raw, terms_of, vector_distance
from keyharbor.sources.options import HighlightOptions, SearchOptions, SummarizeOptions
from keyharbor.sources.scan import EXPIRES, KEY, Schema, Source, _options, hash_fields, json_field, live, row_index, table_of, ttl, typed_fields, with_variant


def _query(query: Any) -> Expr:
    """An Expr as it is; "*" is everything; other text is a condition in Spark SQL."""
    return query if isinstance(query, Expr) else match_all() if query in (None, "", "*") else raw(str(query))


def _nearest(e: Expr) -> tuple[Expr | None, Expr | None]:
    """(filter, knn leaf). knn stands at the root, or is ANDed to a filter there."""
    if e.op == "knn":
        return None, e
    if e.op == "and" and any(p.op == "knn" for p in e.parts):
        leaf = next(p for p in e.parts if p.op == "knn")
        rest = next((p for p in e.parts if p is not leaf), None)
        return rest, leaf
    return e, None


def bm25(df: DataFrame, terms: list[Term], score_column: str, k1: float = 1.2, b: float = 0.75, tfidf: bool = False) -> DataFrame:
    """df with the BM25 (or TF-IDF) score of the terms, counted over df. A word part or a fuzzy word counts all tokens that it matches.

    Counts of documents and lengths are one aggregate of one row, broadcast; nothing is exploded, and each field is cut into tokens once a pass.
    """
    names = sorted({t.field for t in terms})
    wanted = list(dict.fromkeys(replace(t, weight=1.0) for t in terms))
    counted = df.withColumns({f"__tok{k}": text.tokens(F.coalesce(F.col(f).cast("string"), F.lit(""))) for k, f in enumerate(names)})
    counted = counted.withColumns({f"__tf{k}": F.size(F.filter(f"__tok{names.index(t.field)}", t.matches)).cast("double") for k, t in enumerate(wanted)} | {f"__n{k}": F.size(f"__tok{k}") for k in range(len(names))})
    totals = counted.agg(F.count(F.lit(1)).alias("__docs"), *(F.avg(f"__n{k}").alias(f"__len{k}") for k in range(len(names))), *(F.count_if(F.col(f"__tf{k}") > 0).alias(f"__df{k}") for k in range(len(wanted))))
    joined = counted.crossJoin(F.broadcast(totals))  # one row
    score = F.lit(0.0)
    for t in terms:
        k, f = wanted.index(replace(t, weight=1.0)), names.index(t.field)
        tf, n = F.col(f"__tf{k}"), F.col(f"__df{k}")
        idf = F.log(1 + (F.col("__docs") - n + 0.5) / (n + 0.5))
        part = tf * F.log(1 + F.col("__docs") / F.greatest(n, F.lit(1))) if tfidf else idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col(f"__n{f}") / F.greatest(F.col(f"__len{f}"), F.lit(1e-9))))
        score = score + t.weight * part
    return joined.select(*df.columns, score.alias(score_column))


def search(source: Source, query: Any = "*", *, fields: dict[str, Field] | None = None, options: SearchOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """Live rows of a table under the pattern that the query finds, all of its columns (`projection`: these). knn gives the nearest k with `_distance`.

    Order is by sort_by (nulls last, ties by key), by score, or by distance; else none. Row index (in that order, else by key), key and TTL come first, where they are
    included; a table without a column _key has no such columns. slop and in_order hold for phrases that don't say their own.
    """
    o = _options(SearchOptions, options, {"query": query} | named)
    df, context = live(table_of(source), now), Context(fields or {}, o.params, o.slop, o.in_order)
    has_key = KEY in df.columns
    condition, nearest = _nearest(_query(query if isinstance(o.query, str) and o.query == "*" else o.query))  # options say more than keywords, but "*" says nothing
    if o.pattern != "*":
        df = df.where(text.matches_glob(F.col(KEY), o.pattern))
    if o.in_keys is not None:
        df = df.where(F.col(KEY).isin(o.in_keys))
    terms = [t for t in (terms_of(condition) if condition is not None else []) if (not o.in_fields or t.field in o.in_fields) and (o.no_stopwords or t.how != "is" or t.word not in text.STOPWORDS)]
    terms = [replace(t, weight=t.weight * fields[t.field].weight) if fields and isinstance(fields.get(t.field), TextField) else t for t in terms]
    # Documents are counted over the whole table, scores given to what is found.
    out = bm25(df, terms, o.score_column_name, tfidf=o.scorer.upper().startswith("TFIDF")) if o.include_score else df
    out = out.where(condition.to_column(context)) if condition is not None else out
    key, order = [F.asc(KEY)] if has_key else [], []
    if nearest is not None:
        out, order = out.withColumn("_distance", vector_distance(nearest, context)).where("_distance IS NOT NULL"), [F.asc("_distance"), *key]
    elif o.sort_by:
        order = [F.asc_nulls_last(o.sort_by) if o.sort_ascending else F.desc_nulls_last(o.sort_by), *key]
    elif o.include_score:
        order = [F.desc(o.score_column_name), *key]
    out = out.orderBy(*order) if order else out
    out = out.limit(nearest.args[0]) if nearest is not None else out
    if o.include_row_index:
        # The index counts what is found, from row_index_offset on, before an offset or limit takes a part of it.
        out = row_index(out, o.row_index_column_name, order or key, o.row_index_offset)
        out = out.orderBy(o.row_index_column_name) if order else out
    out = out.offset(o.offset) if o.offset else out
    out = out.limit(o.n_rows) if o.n_rows is not None else out
    if o.nocontent:
        return out.select(KEY)
    index = [F.col(o.row_index_column_name)] * o.include_row_index
    meta = index + ([F.col(KEY).alias(o.key_column_name)] * o.include_key + [ttl(df, now).alias(o.ttl_column_name)] * o.include_ttl if has_key else [])
    data = [c for c in out.columns if c not in (KEY, EXPIRES, *([o.row_index_column_name] if o.include_row_index else [])) and (o.projection is None or c in (*o.projection, o.score_column_name, "_distance"))]
    return _marked(out, terms, o.highlight, o.summarize).select(*meta, *data)


def _marked(df: DataFrame, terms: list[Term], highlight: HighlightOptions | None, summarize: SummarizeOptions | None) -> DataFrame:
    words = {t.field: [u.word for u in terms if u.field == t.field] for t in terms}
    for f in (summarize.fields or list(words)) if summarize else []:
        df = df.withColumn(f, text.summarized(F.col(f), words.get(f, []), summarize.frags, summarize.len, summarize.separator))
    for f in (highlight.fields or list(words)) if highlight else []:
        df = df.withColumn(f, text.highlighted(F.col(f), words.get(f, []), highlight.open_tag, highlight.close_tag))
    return df


def search_hashes(source: Source, query: Any = "*", schema: Schema | None = None, *, fields: dict[str, Field] | None = None, options: SearchOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """search() over a hash table whose fields (columns, or one map) are typed by the schema first; a field that no row has is null."""
    if not schema:
        raise ValueError("a search needs a schema")
    df = table_of(source)
    kept = [c for c in (KEY, EXPIRES) if c in df.columns]
    return search(df.select(*kept, *hash_fields(df, typed_fields(schema))), query, fields=fields, options=options, now=now, **named)


def search_json(source: Source, query: Any = "*", schema: Schema | None = None, *, fields: dict[str, Field] | None = None, options: SearchOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """search() over the top-level fields of JSON documents, typed by the schema."""
    if not schema:
        raise ValueError("a search needs a schema")
    df = table_of(source)
    kept = [c for c in (KEY, EXPIRES) if c in df.columns]
    typed = with_variant(df, schema).select(*kept, *(json_field(F.col("doc"), n, t, parsed_doc=F.col("__doc")).alias(n) for n, t in typed_fields(schema)))
    return search(typed, query, fields=fields, options=options, now=now, **named)


def expression(said: str) -> Column:
    """An APPLY or FILTER expression: Spark SQL, where fields may be written @name, and && || ! for AND OR NOT."""
    parts = re.split(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")""", said)
    for i in range(0, len(parts), 2):
        p = re.sub(r"@(\w+)", r"`\1`", parts[i])
        parts[i] = re.sub(r"!(?!=)", " NOT ", p.replace("&&", " AND ").replace("||", " OR "))
    return F.expr("".join(parts))


def _name(said: str) -> str:
    return said.lstrip("@")


_NUMBER = r"-?[0-9]+(\.[0-9]+)?"


def _argument(said: Any) -> Column:
    """A field, or a literal if it looks like a number."""
    return F.lit(float(said)) if re.fullmatch(_NUMBER, str(said)) else F.col(_name(str(said)))


#: Reducers: of their arguments.
REDUCERS: dict[str, Callable[..., Column]] = {
    "COUNT": lambda *a: F.count(F.lit(1)),
    "COUNT_DISTINCT": lambda f: F.count_distinct(_argument(f)),
    "COUNT_DISTINCTISH": lambda f: F.approx_count_distinct(_argument(f)),
    "SUM": lambda f: F.sum(_argument(f)),
    "AVG": lambda f: F.avg(_argument(f)),
    "MIN": lambda f: F.min(_argument(f)),
    "MAX": lambda f: F.max(_argument(f)),
    "FIRST_VALUE": lambda f, *by: _first(f, [b for b in by if str(b).upper() != "BY"]),
    "TOLIST": lambda f: F.array_sort(F.collect_set(_argument(f))),
    "QUANTILE": lambda f, q: F.percentile(_argument(f), float(q)),
    "STDDEV": lambda f: F.stddev_samp(_argument(f)),
}


def _of_distinct(f: str) -> Column:
    """COUNT_DISTINCTISH beside a COUNT_DISTINCT, for which Spark groups by the counted field too: it would keep a sketch for each value. A sketch of distinct values is the same, and none is made before they are."""
    return F.expr(f"approx_count_distinct(DISTINCT {float(f)!r}D)") if re.fullmatch(_NUMBER, str(f)) else F.expr(f"approx_count_distinct(DISTINCT `{_name(str(f))}`)")


def _first(f: str, by: Sequence[str]) -> Column:
    """The value of the least (or, with DESC, the greatest) `by`; without one, any."""
    if not by:
        return F.any_value(_argument(f))
    ways = [b for b in by if str(b).upper() in ("ASC", "DESC")]
    keys = F.struct(*(_argument(b) for b in by if b not in ways))
    return F.max_by(_argument(f), keys) if [w for w in ways if w.upper() == "DESC"] else F.min_by(_argument(f), keys)


def aggregate(
    source: Source, query: Any = "*", *, group_by: Sequence[str] = (), reduce: Sequence[tuple[str, Sequence[Any], str]] = (), apply: Sequence[tuple[str, str]] = (), filter_expr: str | None = None,
    sort_by: Sequence[tuple[str, bool]] = (), limit: int | None = None, offset: int = 0, load: Sequence[str] | None = None, fields: dict[str, Field] | None = None, params: dict[str, Any] | None = None,
) -> DataFrame:
    """query, load, group and reduce, apply, filter, sort (field, ascending), offset and limit, in this order.

    Reducers without group_by reduce all rows to one. offset counts only with a limit. Results keep their types.
    """
    out = table_of(source)
    condition = _query(query)
    if condition.op != "all":
        out = out.where(condition.to_column(Context(fields or {}, params or {})))
    if load and not (group_by or reduce):
        out = out.select(*map(_name, load))
    if group_by or reduce:
        made, exact = [], any(name.upper() == "COUNT_DISTINCT" for name, _, _ in reduce)
        for name, args, alias in reduce:
            if name.upper() not in REDUCERS:
                raise ValueError(f"unknown reducer {name!r}: one of {', '.join(REDUCERS)}")
            reducer = _of_distinct if exact and name.upper() == "COUNT_DISTINCTISH" else REDUCERS[name.upper()]
            made.append(reducer(*args).alias(alias))
        keys = list(map(_name, group_by))
        out = (out.groupBy(*keys).agg(*made) if keys else out.agg(*made)) if made else out.select(*keys).distinct()
    for said, alias in apply:
        out = out.withColumn(_name(alias), expression(said))
    if filter_expr:
        out = out.where(expression(filter_expr))
    if sort_by:
        out = out.orderBy(*(F.asc_nulls_last(_name(f)) if up else F.desc_nulls_last(_name(f)) for f, up in sort_by))
    if limit is not None:
        out = (out.offset(offset) if offset else out).limit(limit)
    return out


def aggregate_hashes(source: Source, query: Any = "*", **named: Any) -> DataFrame:
    return aggregate(source, query, **named)


def aggregate_json(source: Source, query: Any = "*", schema: Schema | None = None, **named: Any) -> DataFrame:
    """aggregate() over the typed fields of JSON documents."""
    df = table_of(source)
    return aggregate(with_variant(df, schema).select(KEY, *(json_field(F.col("doc"), n, t, parsed_doc=F.col("__doc")).alias(n) for n, t in typed_fields(schema))) if schema else df, query, **named)
