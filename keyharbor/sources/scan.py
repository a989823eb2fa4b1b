"""Scans: a keyspace's tables as typed, lazy DataFrames.

A source is a DataFrame (or the path of a Parquet table) with a column `_key`, one row for each key or for each of its parts, and optionally
`_expire_at` (epoch seconds; null: no expiry). What else it holds depends on the shape:

    hashes      a column of text for each field, or one map column `fields`
    json        `doc`, JSON text
    strings     `value`, text
    sets        a row for each `member`; or one for each key, with `members`, an array of text
    lists       a row for each `element`, with its place `pos`; or one for each key, with `elements`, an array of text
    zsets       a row for each `member` with its `score`; or one for each key, with `members`, an array of struct(member, score)
    streams     a row for each entry: `ms`, `seq`, and `fields` (map) or a column for each field
    timeseries  a row for each sample: `ts` (epoch ms), `value`, optionally `labels` (map)

Columns are pruned and filters pushed down by Catalyst; nothing is read until an action. Columns come as row index, key,
TTL, data. The row index is by key (and place within it), from row_index_offset on; keys are unique in a table, so it doesn't depend on
partitions. A scan with a row index sorts and writes its rows when it is built (row_index()).
"""

from __future__ import annotations

from dataclasses import fields as option_fields
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from keyharbor.errors import InvalidInput, SchemaMismatch
from keyharbor.functions.parse import parsed, type_of
from keyharbor.functions.text import matches_glob
from keyharbor.sources import options as opt
from keyharbor.sources.scratch import written

KEY, EXPIRES = "_key", "_expire_at"
Schema = dict[str, Any] | StructType
Source = DataFrame | str

#: Aggregations of a time series' buckets: of the value and its timestamp.
AGGREGATIONS = {
    "avg": lambda v, t: F.avg(v), "sum": lambda v, t: F.sum(v), "min": lambda v, t: F.min(v), "max": lambda v, t: F.max(v), "range": lambda v, t: F.max(v) - F.min(v),
    "count": lambda v, t: F.count(v).cast("double"), "first": lambda v, t: F.min_by(v, t), "last": lambda v, t: F.max_by(v, t),
    "std.p": lambda v, t: F.stddev_pop(v), "std.s": lambda v, t: F.stddev_samp(v), "var.p": lambda v, t: F.var_pop(v), "var.s": lambda v, t: F.var_samp(v),
}


def table_of(source: Source) -> DataFrame:
    return SparkSession.active().read.parquet(source) if isinstance(source, str) else source


def typed_fields(schema: Schema) -> list[tuple[str, Any]]:
    return [(f.name, f.dataType) for f in schema.fields] if isinstance(schema, StructType) else list(schema.items())


def _options(kind: type, given: Any, named: dict[str, Any]) -> Any:
    """The options object if there is one (it overrides), else one from keywords; unknown keywords raise."""
    known = {f.name for f in option_fields(kind)}
    if unknown := set(named) - known:
        raise TypeError(f"unknown options: {', '.join(sorted(unknown))}")
    return given or kind(**named)


def live(df: DataFrame, now: float | None = None) -> DataFrame:
    """Rows that haven't expired. now: epoch seconds (else the query's start), to be passed where results should be reproducible."""
    if EXPIRES not in df.columns:
        return df
    at = F.lit(now).cast("double") if now is not None else F.unix_micros(F.current_timestamp()) / 1e6
    return df.where(F.col(EXPIRES).isNull() | (F.col(EXPIRES) > at))


def ttl(df: DataFrame, now: float | None = None) -> Column:
    """Seconds to live; -1 without expiry."""
    if EXPIRES not in df.columns:
        return F.lit(-1).cast("long")
    at = F.lit(now).cast("double") if now is not None else F.unix_micros(F.current_timestamp()) / 1e6
    return F.when(F.col(EXPIRES).isNull(), F.lit(-1)).otherwise(F.floor(F.col(EXPIRES) - at)).cast("long")


def row_index(df: DataFrame, name: str, order: list[str], offset: int = 0) -> DataFrame:
    """df with numbers from `offset` on, in the order of the columns (none: the frame's own), and its columns after it.

    The sorted rows are written once, with their place, to the shared folder: a sort that runs again samples other bounds, so its
    places can't be counted in one run and used in another. The numbers are the places within a written part, and the rows of the parts before
    it: a count of one row a part, and no window over a single task.
    """
    at, part = "__at", F.shiftright("__at", 33)
    placed = written((df.orderBy(*order) if order else df).withColumn(at, F.monotonically_increasing_id()), "rows")
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))  # a row for each part
    joined = placed.withColumn("__part", part).join(F.broadcast(before), "__part")
    return joined.select((F.col("__before") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(offset)).alias(name), *(placed[c] for c in df.columns))


def _out(df: DataFrame, o: opt.ScanOptions, data: list[Column], order: list[str], now: float | None) -> DataFrame:
    """Key, TTL and data of the rows under the pattern; row index and n_rows where asked."""
    kept = live(df, now).where(matches_glob(F.col(KEY), o.pattern)) if o.pattern != "*" else live(df, now)
    meta = [F.col(KEY).alias(o.key_column_name)] * o.include_key + [ttl(df, now).alias(o.ttl_column_name)] * o.include_ttl
    if o.include_row_index:
        inner = kept.select(F.col(KEY).alias("_order_key"), *(F.col(c) for c in order), *meta, *data)
        numbered = row_index(inner, o.row_index_column_name, ["_order_key", *order], o.row_index_offset)
        out = numbered.drop("_order_key", *order)
    else:
        out = kept.select(*meta, *data)
    return out.limit(o.n_rows) if o.n_rows is not None else out


def scan_hashes(source: Source, pattern: str = "*", schema: Schema | None = None, *, options: opt.HashScanOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """A row for each key, fields typed by the schema; a missing field is null."""
    if not schema:
        raise ValueError("a hash scan needs a schema")
    o, df = _options(opt.HashScanOptions, options, {"pattern": pattern} | named), table_of(source)
    return _out(df, o, hash_fields(df, _projected(typed_fields(schema), o.projection), o.strict), [], now)


def hash_fields(df: DataFrame, fields: list[tuple[str, Any]], strict: bool = True) -> list[Column]:
    """Fields of a hash table, typed: from columns of text (others stay what they are where that is the type), or from one map `fields`; a missing one is null."""
    in_map = isinstance(df.schema["fields"].dataType, MapType) if "fields" in df.columns else False

    def of(name: str, to: Any) -> Column:
        if not in_map and name in df.columns and df.schema[name].dataType == type_of(to):
            return F.col(name)
        raw = F.try_element_at("fields", F.lit(name)) if in_map else F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
        return parsed(raw, to, strict).alias(name)

    return [of(n, t) for n, t in fields]


def json_field(doc: Column, name: str, to: Any, strict: bool = True, path: str = "$", parsed_doc: Column | None = None) -> Column:
    """A field of the object at `path` of JSON text: text as it is (other kinds: their JSON), longs truncated from decimals, null or missing: null.

    parsed_doc: the text as a variant, where it has been parsed already (with_variant()).
    """
    kind, whole = type_of(to).simpleString(), parsed_doc if parsed_doc is not None else F.try_parse_json(doc)
    if kind == "string":
        return F.get_json_object(doc, f"{path}['{name}']")
    wants = {"bigint": ("BIGINT", "DOUBLE", "DECIMAL"), "double": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",)}.get(kind)
    if wants is None:
        raise SchemaMismatch(f"JSON fields are string, long, double or boolean, not {kind}")
    at = f'{path}["{name}"]'
    # Casts that fail give null: a long is tried as such first, for doubles lose its last digits.
    if kind == "boolean":
        value = F.try_variant_get(whole, at, "boolean")
    else:
        number = F.try_variant_get(whole, at, "double")
        value = number if kind == "double" else F.coalesce(F.try_variant_get(whole, at, "bigint"), number.cast("bigint"))
    shape = F.schema_of_variant(F.try_variant_get(whole, at, "variant"))
    fits = F.regexp_extract(shape, r"^\w+", 0).isin(*wants)
    if not strict:
        return F.when(fits, value)
    wrong = F.raise_error(F.concat(F.lit(f"field {name} is not a {kind}: "), F.get_json_object(doc, f"{path}['{name}']"))).cast(kind)
    return F.when(fits, value).when(shape.isNotNull() & (shape != "VOID"), wrong)


def with_variant(df: DataFrame, schema: Schema) -> DataFrame:
    """df with its doc as a variant too, __doc, parsed once for all fields that aren't text."""
    return df.withColumn("__doc", F.try_parse_json("doc")) if any(type_of(t).simpleString() != "string" for _, t in typed_fields(schema)) else df.withColumn("__doc", F.lit(None).cast("variant"))


def scan_json(source: Source, pattern: str = "*", schema: Schema | None = None, *, options: opt.JsonScanOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """A row for each document, its top-level fields (those of the object at the option `path`) typed by the schema."""
    if not schema:
        raise ValueError("a JSON scan needs a schema")
    o, df = _options(opt.JsonScanOptions, options, {"pattern": pattern} | named), table_of(source)
    fields = _projected(typed_fields(schema), o.projection)
    return _out(with_variant(df, schema), o, [json_field(F.col("doc"), n, t, o.strict, o.path or "$", F.col("__doc")).alias(n) for n, t in fields], [], now)


def _projected(fields: list[tuple[str, Any]], names: list[str] | None) -> list[tuple[str, Any]]:
    """The fields that a projection names (none: all), in the schema's order."""
    if names is None:
        return fields
    if unknown := set(names) - {n for n, _ in fields}:
        raise InvalidInput(f"the schema has no fields {', '.join(sorted(unknown))}")
    return [(n, t) for n, t in fields if n in names]


def scan_strings(source: Source, pattern: str = "*", *, options: opt.StringScanOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    o, df = _options(opt.StringScanOptions, options, {"pattern": pattern} | named), table_of(source)
    return _out(df, o, [parsed(F.col("value").cast("string"), o.value_type, o.strict).alias(o.value_column_name)], [], now)


def scan_sets(source: Source, pattern: str = "*", *, options: opt.SetScanOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """A row for each member; empty sets have none."""
    o, df = _options(opt.SetScanOptions, options, {"pattern": pattern} | named), table_of(source)
    rows = df.withColumn("_member", F.explode(F.array_distinct("members"))) if "members" in df.columns else df.withColumn("_member", F.col("member"))
    return _out(rows, o, [F.col("_member").alias(o.member_column_name)], ["_member"], now)


def scan_lists(source: Source, pattern: str = "*", *, options: opt.ListScanOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """A row for each element, with its 0-based position if asked."""
    o, df = _options(opt.ListScanOptions, options, {"pattern": pattern} | named), table_of(source)
    rows = df.select("*", F.posexplode("elements").alias("_pos", "_element")) if "elements" in df.columns else df.withColumns({"_pos": F.col("pos"), "_element": F.col("element")})
    return _out(rows, o, [F.col("_pos").cast("long").alias(o.position_column_name)] * o.include_position + [F.col("_element").alias(o.element_column_name)], ["_pos"], now)


def scan_zsets(source: Source, pattern: str = "*", *, options: opt.ZSetScanOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """A row for each member with its score; rank is 0-based by (score, member) within the key.

    Members that are rows are ranked by a window, only where ranks are asked for: its sort spills and no key is held as a whole.
    """
    o, df = _options(opt.ZSetScanOptions, options, {"pattern": pattern} | named), table_of(source)
    if "members" in df.columns:
        ordered = F.array_sort(F.transform("members", lambda m: F.struct(m["score"].cast("double").alias("score"), m["member"].alias("member"))))
        rows = df.select("*", F.posexplode(ordered).alias("_rank", "_m")).select("*", F.col("_m.member").alias("_member"), F.col("_m.score").alias("_score"))
    else:
        rows = df.withColumns({"_member": F.col("member"), "_score": F.col("score").cast("double")})
        if o.include_rank:
            if o.pattern != "*":
                rows = rows.where(matches_glob(F.col(KEY), o.pattern))
            rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(KEY).orderBy("_score", "_member")) - 1)
    data = [F.col("_member").alias(o.member_column_name), F.col("_score").alias(o.score_column_name)] + ([F.col("_rank").cast("long").alias(o.rank_column_name)] if o.include_rank else [])
    return _out(rows, o, data, ["_score", "_member"], now)


def entry_id(text: str, last: bool = False) -> tuple[int, int]:
    """(ms, seq) of an entry id; without seq: 0, or the largest for an end."""
    ms, _, seq = text.partition("-")
    return int(ms), int(seq) if seq else (2**63 - 1 if last else 0)


def id_range(start: str, end: str, ms: str = "ms", seq: str = "seq") -> Column:
    """Entries from start to end, both included; "(" before an id excludes it; "-" and "+" are the ends."""
    out = F.lit(True)
    for bound, low in ((start, True), (end, False)):
        if bound in ("-", "+"):
            continue
        open_ = bound.startswith("(")
        m, s = entry_id(bound.lstrip("("), not low)
        at, than = F.col(ms), F.col(seq)
        beyond = (at > m) | ((at == m) & (than > s if open_ else than >= s)) if low else (at < m) | ((at == m) & (than < s if open_ else than <= s))
        out = out & (at >= m if low else at <= m) & beyond  # the plain bound on ms can be pushed down
    return out


def first_per_key(df: DataFrame, n: int | None, order: list[str]) -> DataFrame:
    """The first n rows of each key. Spark filters by rank before the shuffle where it can (window group limit)."""
    if n is None:
        return df
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(KEY).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def scan_streams(source: Source, pattern: str = "*", *, options: opt.StreamScanOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """A row for each entry of the streams: id, ms, seq, and the fields as text (missing: null)."""
    o, df = _options(opt.StreamScanOptions, options, {"pattern": pattern} | named), table_of(source)
    in_map = "fields" in df.columns
    rows = df.where(id_range(o.start_id, o.end_id))
    if o.count_per_stream is not None and o.pattern != "*":
        rows = rows.where(matches_glob(F.col(KEY), o.pattern))
    rows = first_per_key(rows, o.count_per_stream, ["ms", "seq"])
    names = o.fields if o.fields is not None else [c for c in df.columns if c not in (KEY, EXPIRES, "ms", "seq", "fields")]
    data = [F.concat_ws("-", "ms", "seq").alias(o.id_column_name)] * o.include_id + [F.col("ms").alias(o.timestamp_column_name)] * o.include_timestamp + [F.col("seq").alias(o.sequence_column_name)] * o.include_sequence
    data += [(F.try_element_at("fields", F.lit(n)) if in_map else F.col(n).cast("string") if n in df.columns else F.lit(None).cast("string")).alias(n) for n in names]
    return _out(rows, o, data, ["ms", "seq"], now)


def scan_timeseries(source: Source, pattern: str = "*", *, options: opt.TimeSeriesScanOptions | None = None, now: float | None = None, **named: Any) -> DataFrame:
    """A row for each sample, or for each bucket if an aggregation and a bucket size are given (buckets align to 0)."""
    o, df = _options(opt.TimeSeriesScanOptions, options, {"pattern": pattern} | named), table_of(source)
    rows = df.where((F.col("ts") >= int(o.start)) if o.start != "-" else F.lit(True)).where((F.col("ts") <= int(o.end)) if o.end != "+" else F.lit(True))
    if o.pattern != "*":
        rows = rows.where(matches_glob(F.col(KEY), o.pattern))
    held = [F.try_element_at("labels", F.lit(n)).alias(n) for n in o.labels]
    if o.aggregation and o.bucket_size_ms:
        if o.aggregation.lower() not in AGGREGATIONS:
            raise ValueError(f"unknown aggregation {o.aggregation!r}: one of {', '.join(AGGREGATIONS)}")
        keys = [KEY] + ([EXPIRES] if EXPIRES in df.columns else [])
        bucket = (F.floor(F.col("ts") / o.bucket_size_ms) * o.bucket_size_ms).cast("long").alias("_b")
        rows = live(rows, now).groupBy(*keys, bucket).agg(AGGREGATIONS[o.aggregation.lower()](F.col("value"), F.col("ts")).alias("value"), *([F.first("labels").alias("labels")] if o.labels else [])).withColumnRenamed("_b", "ts")
    rows = first_per_key(rows, o.count_per_series, ["ts"])
    return _out(rows, o, [F.col("ts").alias(o.timestamp_column_name), F.col("value").cast("double").alias(o.value_column_name), *held], ["ts"], now)


def scan_keys(source: Source, pattern: str = "*", count: int | None = None, now: float | None = None) -> DataFrame:
    keys = live(table_of(source), now).where(matches_glob(F.col(KEY), pattern)).select(KEY)
    return keys if count is None else keys.limit(count)


# Eager names: a DataFrame is read by its action, so these are the same.
read_hashes, read_json, read_strings, read_sets = scan_hashes, scan_json, scan_strings, scan_sets
read_lists, read_zsets, read_streams, read_timeseries = scan_lists, scan_zsets, scan_streams, scan_timeseries


class KeyScanner:
    """Keys in batches, for callers that want an iterator; each batch is a list of at most batch_size keys."""

    def __init__(self, source: Source, pattern: str = "*", batch_size: int | None = None):
        self._rows = scan_keys(source, pattern).toLocalIterator(prefetchPartitions=True)
        self._size = batch_size or opt.get_default_batch_size()
        self.rows_yielded, self.is_done = 0, False

    def next_batch(self) -> list[str] | None:
        out = []
        for row in self._rows:
            out.append(row[KEY])
            if len(out) == self._size:
                break
        self.rows_yielded += len(out)
        self.is_done = len(out) < self._size
        return out or None

    def __iter__(self):
        while (batch := self.next_batch()) is not None:
            yield batch


def key_info(tables: dict[str, Source], pattern: str = "*", *, include_memory: bool = False, now: float | None = None) -> DataFrame:
    """key, key_type, ttl, memory_usage (bytes of the row's text, if asked), encoding, over tables by type."""
    out = None
    for kind, source in tables.items():
        df = table_of(source)
        kept = live(df, now).where(matches_glob(F.col(KEY), pattern))
        size = F.length(F.to_json(F.struct(*df.columns))).cast("long") if include_memory else F.lit(None).cast("long")
        rows = kept.select(F.col(KEY).alias("key"), F.lit(kind).alias("key_type"), ttl(df, now).alias("ttl"), size.alias("memory_usage"), F.lit("parquet").alias("encoding"))
        rows = rows.groupBy("key", "key_type", "ttl", "encoding").agg(F.sum("memory_usage").alias("memory_usage")).select("key", "key_type", "ttl", "memory_usage", "encoding") if kind in ("stream", "timeseries", "set", "list", "zset") else rows
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no tables")
    return out
