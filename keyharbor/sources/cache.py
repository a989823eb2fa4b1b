"""Frames kept under a key, as Parquet with a one-row note of codec and expiry, and decorators that keep what a function returns."""

from __future__ import annotations

import functools
import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyharbor.errors import InvalidInput
from keyharbor.sources.table import Table

#: Codecs of a format. "ipc" names are taken too; frames are Parquet either way, which Spark reads in parallel.
CODECS = {"parquet": ("uncompressed", "snappy", "gzip", "lz4", "zstd"), "ipc": ("uncompressed", "lz4", "zstd")}
_SPARK = {"lz4": "lz4_raw"}


@dataclass
class CacheInfo:
    format: str
    compression: str
    size_bytes: int
    num_chunks: int
    ttl: int

    @property
    def is_chunked(self) -> bool:
        return self.num_chunks > 1


def _folder(path: str, key: str) -> str:
    return f"{path.rstrip('/')}/{hashlib.sha256(key.encode()).hexdigest()[:32]}"


def _note(path: str, key: str, now: float | None = None) -> dict[str, Any] | None:
    df = Table(_folder(path, key)).read()
    note = None if df is None else df.first().asDict()
    return note if note and not note["gone"] and (note["expire_at"] is None or note["expire_at"] > (time.time() if now is None else now)) else None


def _noted(path: str, key: str, **note: Any) -> None:
    values = {"key": key, "data": "", "format": "parquet", "compression": "zstd", "expire_at": None, "gone": False} | note
    spark = SparkSession.active()
    Table(_folder(path, key)).save(spark.createDataFrame([tuple(values.values())], "key string, data string, format string, compression string, expire_at double, gone boolean").coalesce(1))


def cache_dataframe(df: DataFrame, path: str, key: str, *, format: str = "parquet", compression: str = "zstd", ttl: float | None = None, now: float | None = None) -> int:
    """Writes the frame under the key, in place of what was there; the bytes that it takes."""
    if format not in CODECS or compression not in CODECS[format]:
        raise InvalidInput(f"format and compression are of {CODECS}, not {format!r}, {compression!r}")
    began = time.time() if now is None else now
    data = f"{_folder(path, key)}/data-{time.time_ns():x}"
    df.write.option("compression", _SPARK.get(compression, compression)).parquet(data)
    _noted(path, key, data=data, format=format, compression=compression, expire_at=None if ttl is None else began + ttl)
    return _size(data)[0]


def _size(data: str) -> tuple[int, int]:
    """(bytes, files), from the file metadata that Spark's readers show."""
    spark = SparkSession.active()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(data)
    found = files.agg(F.sum("length"), F.count(F.lit(1))).first()
    return int(found[0] or 0), int(found[1])


def get_cached_dataframe(path: str, key: str, *, columns: list[str] | None = None, n_rows: int | None = None, now: float | None = None) -> DataFrame | None:
    """The frame, lazily; None if the key isn't there or has expired."""
    note = _note(path, key, now)
    if note is None:
        return None
    df = SparkSession.active().read.parquet(note["data"])
    df = df.select(*columns) if columns else df
    return df if n_rows is None else df.limit(n_rows)


scan_cached = get_cached_dataframe


def delete_cached(path: str, key: str) -> bool:
    if _note(path, key) is None:
        return False
    _noted(path, key, gone=True)
    return True


def cache_exists(path: str, key: str, now: float | None = None) -> bool:
    return _note(path, key, now) is not None


def cache_ttl(path: str, key: str, now: float | None = None) -> int:
    """Seconds to live; -1 without expiry, -2 if the key isn't there."""
    at = time.time() if now is None else now
    note = _note(path, key, at)
    return -2 if note is None else -1 if note["expire_at"] is None else int(note["expire_at"] - at)


def cache_info(path: str, key: str) -> CacheInfo | None:
    note = _note(path, key)
    return None if note is None else CacheInfo(note["format"], note["compression"], *_size(note["data"]), cache_ttl(path, key))


def _said(value: Any) -> str:
    return f"frame:{value.semanticHash()}" if isinstance(value, DataFrame) else repr(value)


def cache(path: str, ttl: float | None = None, key_prefix: str = "cache", key_fn: Callable[..., str] | None = None, compression: str = "zstd"):
    """Keeps the frame that a function returns under a key of its name and arguments.

    Calls take _cache_refresh=True (make it anew) and _cache_skip=True (leave the cache alone); the function gets invalidate(), is_cached() and cache_key_for().
    """

    def of(fn: Callable[..., DataFrame]):
        def key_for(*args: Any, **named: Any) -> str:
            if key_fn:
                return f"{key_prefix}:{key_fn(*args, **named)}"
            said = "|".join([*map(_said, args), *(f"{k}={_said(v)}" for k, v in sorted(named.items()))])
            return f"{key_prefix}:{fn.__module__}.{fn.__qualname__}:{hashlib.sha256(said.encode()).hexdigest()[:16]}"

        @functools.wraps(fn)
        def kept(*args: Any, _cache_refresh: bool = False, _cache_skip: bool = False, **named: Any) -> DataFrame:
            if _cache_skip:
                return fn(*args, **named)
            key = key_for(*args, **named)
            found = None if _cache_refresh else get_cached_dataframe(path, key)
            if found is None:
                cache_dataframe(fn(*args, **named), path, key, compression=compression, ttl=ttl)
                found = get_cached_dataframe(path, key)
            return found

        kept.cache_key_for = key_for
        kept.invalidate = lambda *a, **k: delete_cached(path, key_for(*a, **k))
        kept.is_cached = lambda *a, **k: cache_exists(path, key_for(*a, **k))
        return kept

    return of


#: Frames are lazy, so both decorators are one.
cache_lazy = cache
