"""Writers: rows become keys of a table, by one join with what is there.

merged() gives the new state of a table as a lazy DataFrame; write_*() save it and count. Modes: "replace" (a written key loses
what it held), "append" (merged into it), "fail" (existing keys are left as they are and skipped). Members of sets, lists and sorted sets are rows, so
that a key of very many members is no single value anywhere.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from keyharbor.errors import InvalidInput, TypeConflict, VersionConflict
from keyharbor.sources.scan import EXPIRES, KEY, row_index
from keyharbor.sources.scratch import deleted
from keyharbor.sources.table import Table, opened

MODES = ("replace", "append", "fail")


@dataclass
class WriteResult:
    """keys_failed: rows whose key is null. succeeded_keys names up to LISTED keys; keys() has all that were written (detailed writes only)."""

    keys_written: int = 0
    keys_failed: int = 0
    keys_skipped: int = 0
    succeeded_keys: list[str] = field(default_factory=list)
    failed_keys: list[str] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)
    keys: Callable[[], DataFrame] | None = field(default=None, repr=False, compare=False)

    @property
    def is_complete_success(self) -> bool:
        return not self.keys_failed


LISTED = 1000
#: Columns beside key and expiry that a table of a shape has, exactly; hashes have any.
COLUMNS = {"json": {"doc"}, "string": {"value"}, "set": {"member"}, "list": {"pos", "element"}, "zset": {"member", "score"}}
#: Times that a write starts again because another writer was faster.
RETRIES = 5


def _mode(if_exists: str) -> str:
    if if_exists not in MODES:
        raise InvalidInput(f"if_exists is {', '.join(MODES)}, not {if_exists!r}")
    return if_exists


def keyed(df: DataFrame, key_column: str | None, prefix: str = "", one_key: bool = False) -> DataFrame:
    """df with _key: prefix and the key column; without one, prefix and the row's number, or for collections the one key prefix0."""
    if key_column is None:
        if one_key:
            return df.withColumn(KEY, F.lit(f"{prefix}0"))
        return row_index(df, "__number", []).withColumn(KEY, F.concat(F.lit(prefix), F.col("__number").cast("string"))).drop("__number")
    if key_column not in df.columns:
        raise InvalidInput(f"no column {key_column!r}")
    return df.withColumn(KEY, F.concat(F.lit(prefix), F.col(key_column).cast("string"))).where(F.col(KEY).isNotNull()).drop(*([key_column] if key_column != KEY else []))


def expiry(ttl: float | None, now: float | None = None) -> Column:
    return F.lit(None).cast("double") if ttl is None else F.lit((time.time() if now is None else now) + ttl).cast("double")


def _with_expiry(df: DataFrame) -> DataFrame:
    return df if EXPIRES in df.columns else df.withColumn(EXPIRES, F.lit(None).cast("double"))


def _merged(old: DataFrame | None, new: DataFrame, mode: str, join: Callable[[str], Column] | None = None) -> DataFrame:
    """Of rows that are keys, or (replace and fail) parts of them. join(column): how an appended column is made of _old_<column> and <column>; None: the new row as it is."""
    mode = _mode(mode)
    if old is None:
        return new
    old = _with_expiry(old)
    if mode == "fail":
        fresh = new.join(old.select(KEY), KEY, "left_anti")
        return old.unionByName(fresh, allowMissingColumns=True)
    if mode == "replace" or join is None:
        return old.join(new.select(KEY), KEY, "left_anti").unionByName(new, allowMissingColumns=True)
    before = old.select(F.col(KEY), *(F.col(c).alias(f"_old_{c}") for c in old.columns if c != KEY))
    both = before.join(new, KEY, "full_outer")
    out = []
    for c in dict.fromkeys([*old.columns, *new.columns]):
        if c == KEY:
            out.append(F.col(KEY))
        elif c == EXPIRES:
            out.append(F.coalesce(EXPIRES, f"_old_{EXPIRES}").alias(c))
        else:
            out.append((join(c) if c in old.columns and c in new.columns else F.col(c if c in new.columns else f"_old_{c}")).alias(c))
    return both.select(*out)


def _appended(shape: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """Members of both: of a set's or sorted set's member the new row, a list's new elements after the old ones. A key takes the new expiry if there is one, else keeps its own."""
    old = _with_expiry(old)
    held = old.groupBy(KEY).agg(F.max(EXPIRES).alias("_until"), *([(F.max("pos") + 1).alias("_size")] if shape == "list" else []))
    given = new.groupBy(KEY).agg(F.max(EXPIRES).alias("_until"))
    if shape != "list":
        old = old.join(new.select(KEY, "member"), [KEY, "member"], "left_anti")
    before = old.join(given, KEY, "left").withColumn(EXPIRES, F.coalesce("_until", EXPIRES)).select(*new.columns)
    after = new.join(held, KEY, "left").withColumn(EXPIRES, F.coalesce(EXPIRES, "_until"))
    if shape == "list":
        after = after.withColumn("pos", F.col("pos") + F.coalesce("_size", F.lit(0)))
    return before.unionByName(after.select(*new.columns))


def _text(df: DataFrame, name: str) -> Column:
    """A value as it is stored: text; booleans as true and false."""
    return F.when(F.col(name), "true").otherwise(F.when(~F.col(name), "false")) if isinstance(df.schema[name].dataType, BooleanType) else F.col(name).cast("string")


def _last_of_key(df: DataFrame) -> DataFrame:
    """One row for each key: of repeats, the last in the frame's order."""
    data = [c for c in df.columns if c != KEY]
    return df.withColumn("_order", F.monotonically_increasing_id()).groupBy(KEY).agg(F.max_by(F.struct(*data), "_order").alias("_row")).select(KEY, "_row.*")


def hash_rows(df: DataFrame, key_column: str | None = KEY, key_prefix: str = "", ttl: float | None = None, now: float | None = None) -> DataFrame:
    rows = keyed(df, key_column, key_prefix)
    return _last_of_key(rows.select(KEY, *(_text(rows, c).alias(c) for c in rows.columns if c != KEY), expiry(ttl, now).alias(EXPIRES)))


def merged_hashes(old: DataFrame | None, rows: DataFrame, if_exists: str = "replace") -> DataFrame:
    """rows: of hash_rows(). Nulls are fields that aren't written; a row of nulls writes nothing, though in replace mode its key goes."""
    out = _merged(old, rows, if_exists, lambda c: F.coalesce(F.col(c), F.col(f"_old_{c}")))
    held = [F.col(c).isNotNull() for c in out.columns if c not in (KEY, EXPIRES)]
    return out.where(_any(held)) if held else out


def _any(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def json_rows(df: DataFrame, key_column: str | None = KEY, key_prefix: str = "", ttl: float | None = None, now: float | None = None) -> DataFrame:
    rows = keyed(df, key_column, key_prefix)
    data = [c for c in rows.columns if c != KEY]
    return _last_of_key(rows.select(KEY, F.to_json(F.struct(*data)).alias("doc"), expiry(ttl, now).alias(EXPIRES)))


def string_rows(df: DataFrame, key_column: str | None = KEY, value_column: str = "value", key_prefix: str = "", ttl: float | None = None, now: float | None = None) -> DataFrame:
    rows = keyed(df, key_column, key_prefix)
    if value_column not in rows.columns:
        raise InvalidInput(f"no column {value_column!r}")
    return _last_of_key(rows.where(F.col(value_column).isNotNull()).select(KEY, _text(rows, value_column).alias("value"), expiry(ttl, now).alias(EXPIRES)))


def set_rows(df: DataFrame, key_column: str | None = KEY, member_column: str = "member", key_prefix: str = "", ttl: float | None = None, now: float | None = None) -> DataFrame:
    """A row for each member of a key."""
    rows = keyed(df, key_column, key_prefix, True).where(F.col(member_column).isNotNull())
    return rows.select(KEY, F.col(member_column).cast("string").alias("member")).distinct().withColumn(EXPIRES, expiry(ttl, now))


def list_rows(df: DataFrame, key_column: str | None = KEY, element_column: str = "element", index_column: str | None = None, key_prefix: str = "", ttl: float | None = None, now: float | None = None) -> DataFrame:
    """A row for each element and its place, in the order of index_column, else of the frame. Places are a window's row numbers: its sort spills, and no list is held as a whole."""
    rows = keyed(df, key_column, key_prefix, True).where(F.col(element_column).isNotNull()).withColumn("__order", F.monotonically_increasing_id())
    order = [*([F.col(index_column)] if index_column else []), F.col("__order")]
    return rows.select(KEY, (F.row_number().over(Window.partitionBy(KEY).orderBy(*order)) - 1).cast("long").alias("pos"), F.col(element_column).cast("string").alias("element"), expiry(ttl, now).alias(EXPIRES))


def zset_rows(df: DataFrame, key_column: str | None = KEY, member_column: str = "member", score_column: str = "score", key_prefix: str = "", ttl: float | None = None, now: float | None = None) -> DataFrame:
    """A row for each member of a key; of a member's repeats, the last score in the frame's order."""
    rows = keyed(df, key_column, key_prefix, True).where(F.col(member_column).isNotNull() & F.col(score_column).isNotNull()).withColumn("__order", F.monotonically_increasing_id())
    return rows.groupBy(KEY, F.col(member_column).cast("string").alias("member")).agg(F.max_by(F.col(score_column).cast("double"), "__order").alias("score")).withColumn(EXPIRES, expiry(ttl, now))


def merged(shape: str, old: DataFrame | None, rows: DataFrame, if_exists: str = "replace") -> DataFrame:
    """The new state of a table of that shape (hash, json, string, set, list, zset); rows come from <shape>_rows()."""
    if shape == "hash":
        return merged_hashes(old, rows, if_exists)
    if shape in ("set", "list", "zset") and old is not None and _mode(if_exists) == "append":
        return _appended(shape, old, rows)
    return _merged(old, rows, if_exists)


def _write(shape: str, target: Table | str, make: Callable[[DataFrame], DataFrame], df: DataFrame, key_column: str | None, if_exists: str, detailed: bool = False) -> WriteResult:
    """make: from df to the shape's rows. They are computed once, into the table's folder; all else reads what was written there."""
    table, nulls = opened(target), Observation()
    _mode(if_exists)
    if detailed and key_column in df.columns:
        df = df.observe(nulls, F.count_if(F.col(key_column).isNull()).alias("n"))
    rows, staged = make(df), f"{table.path}/_staged/{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    rows = table.spark.read.schema(rows.schema).parquet(staged)
    for left in reversed(range(RETRIES)):
        number, version = table.latest()
        old = table.at(version)
        held = set(old.columns) - {KEY, EXPIRES} if old is not None else COLUMNS.get(shape)
        if shape in COLUMNS and held != COLUMNS[shape]:
            raise TypeConflict(f"{table.path} holds {', '.join(sorted(held))}, which is no {shape}")
        try:
            table.save(merged(shape, old, rows, if_exists), after=number)
            break
        except VersionConflict:
            if not left:
                raise
    # Keys that a write reaches: hashes of nulls only write none.
    some = [F.col(c).isNotNull() for c in rows.columns if c not in (KEY, EXPIRES)] if shape == "hash" else []
    reached = (rows.where(_any(some)) if some else rows).select(KEY).distinct()
    skipping = old is not None and if_exists == "fail"
    fresh = reached.join(old.select(KEY), KEY, "left_anti") if skipping else reached
    n = fresh.count()
    out = WriteResult(keys_written=n, keys_skipped=reached.count() - n if skipping else 0)
    if not detailed:
        deleted(table.spark, staged)
        return out
    out.succeeded_keys = [r[KEY] for r in fresh.limit(LISTED).collect()]
    out.keys = lambda: fresh
    out.keys_failed = nulls.get["n"] if key_column in df.columns else 0
    if out.keys_failed:
        out.failed_keys, out.errors = [""], {"": f"{out.keys_failed} rows have no key"}
    return out


def write_hashes(df: DataFrame, target: Table | str, key_column: str | None = KEY, ttl: float | None = None, key_prefix: str = "", if_exists: str = "replace", now: float | None = None) -> int:
    return _write("hash", target, lambda d: hash_rows(d, key_column, key_prefix, ttl, now), df, key_column, if_exists).keys_written


def write_hashes_detailed(df: DataFrame, target: Table | str, key_column: str | None = KEY, ttl: float | None = None, key_prefix: str = "", if_exists: str = "replace", now: float | None = None) -> WriteResult:
    """As write_hashes(), with what became of the keys. The rows as written stay under the table's _staged folder for WriteResult.keys(), until they are deleted there."""
    return _write("hash", target, lambda d: hash_rows(d, key_column, key_prefix, ttl, now), df, key_column, if_exists, detailed=True)


def write_json(df: DataFrame, target: Table | str, key_column: str | None = KEY, ttl: float | None = None, key_prefix: str = "", if_exists: str = "replace", now: float | None = None) -> int:
    return _write("json", target, lambda d: json_rows(d, key_column, key_prefix, ttl, now), df, key_column, if_exists).keys_written


def write_strings(df: DataFrame, target: Table | str, key_column: str | None = KEY, value_column: str = "value", ttl: float | None = None, key_prefix: str = "", if_exists: str = "replace", now: float | None = None) -> int:
    return _write("string", target, lambda d: string_rows(d, key_column, value_column, key_prefix, ttl, now), df, key_column, if_exists).keys_written


def write_sets(df: DataFrame, target: Table | str, key_column: str | None = KEY, member_column: str = "member", ttl: float | None = None, key_prefix: str = "", if_exists: str = "replace", now: float | None = None) -> int:
    return _write("set", target, lambda d: set_rows(d, key_column, member_column, key_prefix, ttl, now), df, key_column, if_exists).keys_written


def write_lists(df: DataFrame, target: Table | str, key_column: str | None = KEY, element_column: str = "element", index_column: str | None = None, ttl: float | None = None, key_prefix: str = "", if_exists: str = "replace", now: float | None = None) -> int:
    return _write("list", target, lambda d: list_rows(d, key_column, element_column, index_column, key_prefix, ttl, now), df, key_column, if_exists).keys_written


def write_zsets(df: DataFrame, target: Table | str, key_column: str | None = KEY, member_column: str = "member", score_column: str = "score", ttl: float | None = None, key_prefix: str = "", if_exists: str = "replace", now: float | None = None) -> int:
    return _write("zset", target, lambda d: zset_rows(d, key_column, member_column, score_column, key_prefix, ttl, now), df, key_column, if_exists).keys_written


# Several destinations


@dataclass
class Destination:
    target: Table | str
    key_prefix: str = ""
    transform: Callable[[DataFrame], DataFrame] | None = None
    name: str | None = None
    timeout_ms: int = 30_000

    @property
    def label(self) -> str:
        return self.name or (self.target if isinstance(self.target, str) else self.target.path)


@dataclass
class DestinationResult:
    destination: str
    keys_written: int = 0
    error: str | None = None
    duration_ms: float = 0.0

    @property
    def success(self) -> bool:
        return self.error is None


@dataclass
class MultiWriteResult:
    results: list[DestinationResult]

    @property
    def total_keys_written(self) -> int:
        return sum(r.keys_written for r in self.results)

    @property
    def total_keys_failed(self) -> int:
        return sum(not r.success for r in self.results)

    @property
    def all_succeeded(self) -> bool:
        return all(r.success for r in self.results)

    @property
    def failed_destinations(self) -> list[str]:
        return [r.destination for r in self.results if not r.success]


def _write_multi(write: Callable[..., int], df: DataFrame, destinations: list[Destination], **named: Any) -> MultiWriteResult:
    """One failure leaves the others be. The frame is kept while it is written more than once."""
    kept = df.persist() if len(destinations) > 1 else df
    results = []
    try:
        for d in destinations:
            began = time.monotonic()
            try:
                n, error = write(d.transform(kept) if d.transform else kept, d.target, key_prefix=d.key_prefix, **named), None
            except Exception as e:  # reported, not raised: that is what isolation means here
                n, error = 0, f"{type(e).__name__}: {e}"
            results.append(DestinationResult(d.label, n, error, (time.monotonic() - began) * 1000))
    finally:
        if kept is df and len(destinations) > 1:
            df.unpersist()
    return MultiWriteResult(results)


def write_hashes_multi(df: DataFrame, destinations: list[Destination], key_column: str | None = KEY, ttl: float | None = None, if_exists: str = "replace") -> MultiWriteResult:
    return _write_multi(write_hashes, df, destinations, key_column=key_column, ttl=ttl, if_exists=if_exists)


def write_json_multi(df: DataFrame, destinations: list[Destination], key_column: str | None = KEY, ttl: float | None = None, if_exists: str = "replace") -> MultiWriteResult:
    return _write_multi(write_json, df, destinations, key_column=key_column, ttl=ttl, if_exists=if_exists)
