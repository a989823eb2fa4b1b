"""Key management over tables: expiry, deletion, renaming. Each takes a list of keys or a DataFrame's column, and is one join."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyharbor.functions.text import matches_glob
from keyharbor.sources.scan import EXPIRES, KEY, live, ttl
from keyharbor.sources.table import Table, opened
from keyharbor.sources.write import _with_expiry

Keys = list[str] | DataFrame
#: Missing keys that a result names, at most; its counts are whole.
LISTED = 1000


@dataclass
class TtlResult:
    succeeded: int = 0
    failed: int = 0
    errors: list[tuple[str, str]] = field(default_factory=list)


@dataclass
class DeleteResult:
    deleted: int = 0
    not_found: int = 0


@dataclass
class RenameResult:
    succeeded: int = 0
    failed: int = 0
    errors: list[tuple[str, str]] = field(default_factory=list)


def _frame(table: Table, keys: Keys, column: str = KEY) -> DataFrame:
    df = keys if isinstance(keys, DataFrame) else table.spark.createDataFrame([(k,) for k in keys], f"{column} string")
    return df.select(F.col(column).cast("string").alias(KEY), *(c for c in df.columns if c not in (column, KEY)))


def _state(table: Table) -> DataFrame:
    found = table.read()
    return found if found is not None else table.spark.createDataFrame([], f"{KEY} string, {EXPIRES} double")


def _missing(wanted: DataFrame, held: DataFrame) -> list[tuple[str, str]]:
    return [(r[KEY], "Key does not exist") for r in wanted.join(held.select(KEY), KEY, "left_anti").limit(LISTED).collect()]


def _expiring(table: Table, wanted: DataFrame, now: float | None) -> TtlResult:
    """wanted: (_key, seconds or null for none)."""
    at = time.time() if now is None else now
    state = _with_expiry(_state(table))
    held = live(state, at)
    n = wanted.join(held.select(KEY), KEY, "left_semi").count()
    total = wanted.count()
    errors = _missing(wanted, held) if n < total else []
    last = wanted.groupBy(KEY).agg(F.struct(F.max("seconds").alias("s")).alias("_new"))
    moved = held.join(last, KEY, "left").withColumn(EXPIRES, F.when(F.col("_new").isNull(), F.col(EXPIRES)).otherwise(F.lit(at) + F.col("_new.s"))).select(*state.columns)
    if n:
        table.save(moved)
    return TtlResult(n, total - n, errors)


def set_ttl(target: Table | str, keys: Keys, ttl_seconds: float, now: float | None = None) -> TtlResult:
    t = opened(target)
    return _expiring(t, _frame(t, keys).select(KEY, F.lit(float(ttl_seconds)).alias("seconds")), now)


def set_ttl_from_column(target: Table | str, df: DataFrame, key_column: str = KEY, ttl_column: str = "ttl", now: float | None = None) -> TtlResult:
    return _expiring(opened(target), df.select(F.col(key_column).cast("string").alias(KEY), F.col(ttl_column).cast("double").alias("seconds")).where("seconds IS NOT NULL"), now)


def persist_keys(target: Table | str, keys: Keys, now: float | None = None) -> TtlResult:
    t = opened(target)
    return _expiring(t, _frame(t, keys).select(KEY, F.lit(None).cast("double").alias("seconds")), now)


def get_ttl(target: Table | str, keys: Keys, now: float | None = None) -> DataFrame:
    """(_key, ttl): -1 without expiry, -2 if the key isn't there."""
    t = opened(target)
    held = live(_with_expiry(_state(t)), now)
    return _frame(t, keys).select(KEY).join(held.select(KEY, ttl(held, now).alias("ttl")).distinct(), KEY, "left").select(KEY, F.coalesce("ttl", F.lit(-2)).cast("long").alias("ttl"))


def exists_keys(target: Table | str, keys: Keys, now: float | None = None) -> DataFrame:
    """(_key, exists)."""
    t = opened(target)
    held = live(_with_expiry(_state(t)), now).select(KEY, F.lit(True).alias("exists")).distinct()
    return _frame(t, keys).select(KEY).join(held, KEY, "left").select(KEY, F.coalesce("exists", F.lit(False)).alias("exists"))


def delete_keys(target: Table | str, keys: Keys, now: float | None = None) -> DeleteResult:
    t = opened(target)
    wanted, state = _frame(t, keys).select(KEY), _with_expiry(_state(t))
    held = live(state, now)
    n, total = wanted.distinct().join(held.select(KEY), KEY, "left_semi").count(), wanted.count()
    if n:
        t.save(held.join(wanted, KEY, "left_anti"))
    return DeleteResult(n, total - n)


def delete_keys_from_column(target: Table | str, df: DataFrame, key_column: str = KEY, now: float | None = None) -> DeleteResult:
    return delete_keys(target, df.select(F.col(key_column).cast("string").alias(KEY)), now)


def delete_keys_pattern(target: Table | str, pattern: str, now: float | None = None) -> DeleteResult:
    t = opened(target)
    held = live(_with_expiry(_state(t)), now)
    n = held.where(matches_glob(F.col(KEY), pattern)).select(KEY).distinct().count()
    if n:
        t.save(held.where(~matches_glob(F.col(KEY), pattern)))
    return DeleteResult(n, 0)


def renamed(state: DataFrame, names: DataFrame) -> DataFrame:
    """state under new names, names: (_key, new). A key that a rename lands on goes; of several that land on one, the last of the old names stays."""
    to = names.groupBy(KEY).agg(F.max("new").alias("_to"))
    moved = state.join(to, KEY, "left")
    taken = moved.where("_to IS NOT NULL").groupBy("_to").agg(F.max(KEY).alias("_winner")).withColumnRenamed("_to", "_name")
    named = moved.withColumn("_name", F.coalesce("_to", KEY)).join(taken, "_name", "left")
    return named.where(F.col("_winner").isNull() | (F.col("_winner") == F.col(KEY))).select(*(F.col("_name").alias(KEY) if c == KEY else F.col(c) for c in state.columns))


def rename_keys_from_columns(target: Table | str, df: DataFrame, old_column: str, new_column: str, now: float | None = None) -> RenameResult:
    t = opened(target)
    held = live(_with_expiry(_state(t)), now)
    names = df.select(F.col(old_column).cast("string").alias(KEY), F.col(new_column).cast("string").alias("new")).where(f"{KEY} IS NOT NULL AND new IS NOT NULL")
    n, total = names.join(held.select(KEY), KEY, "left_semi").count(), names.count()
    errors = _missing(names, held) if n < total else []
    if n:
        t.save(renamed(held, names))
    return RenameResult(n, total - n, errors)


def rename_keys(target: Table | str, mapping: dict[str, str], now: float | None = None) -> RenameResult:
    t = opened(target)
    return rename_keys_from_columns(t, t.spark.createDataFrame(list(mapping.items()), "old string, new string"), "old", "new", now)
