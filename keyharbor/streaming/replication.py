"""Replication of a log to tables: per destination a filter, a transform and a keyed write, in micro-batches."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyharbor.operators.query import Expr
from keyharbor.sources.scan import scan_streams
from keyharbor.sources.table import Table, opened
from keyharbor.sources.write import write_hashes, write_json


@dataclass(frozen=True)
class FieldFilter:
    """Filters on a field of text. A missing field passes ne() and not_in(), and fails the others. Numbers compare as numbers; text that is none fails."""

    name: str

    def _value(self, like: Any) -> Column:
        return F.col(self.name).try_cast("double") if isinstance(like, int | float) and not isinstance(like, bool) else F.col(self.name).cast("string")

    def _is(self, like: Any, test: Callable[[Column, Any], Column], missing: bool = False) -> Column:
        like = str(like).lower() if isinstance(like, bool) else like
        return F.coalesce(test(self._value(like), like), F.lit(missing))

    def eq(self, v: Any) -> Column:
        return self._is(v, lambda a, b: F.abs(a - b) < 2.220446049250313e-16 if isinstance(b, float) else a == b)

    def ne(self, v: Any) -> Column:
        return ~self.eq(v)

    def gt(self, v: Any) -> Column:
        return self._is(v, lambda a, b: a > b)

    def gte(self, v: Any) -> Column:
        return self._is(v, lambda a, b: a >= b)

    def lt(self, v: Any) -> Column:
        return self._is(v, lambda a, b: a < b)

    def lte(self, v: Any) -> Column:
        return self._is(v, lambda a, b: a <= b)

    def in_list(self, values: list) -> Column:
        out = F.lit(False)
        for v in values:
            out = out | self.eq(v)
        return out

    def not_in_list(self, values: list) -> Column:
        return ~self.in_list(values)

    def contains(self, v: str) -> Column:
        return self._is(v, lambda a, b: a.contains(b))

    def starts_with(self, v: str) -> Column:
        return self._is(v, lambda a, b: a.startswith(b))

    def ends_with(self, v: str) -> Column:
        return self._is(v, lambda a, b: a.endswith(b))

    def is_null(self) -> Column:
        return F.col(self.name).isNull()

    def is_not_null(self) -> Column:
        return F.col(self.name).isNotNull()


def field_filter(name: str) -> FieldFilter:
    return FieldFilter(name)


@dataclass
class ReplicationDestination:
    target: Table | str
    key_column: str
    name: str = ""
    filter: Expr | Column | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    key_prefix: str = ""
    write_type: str = "hash"
    timeout_ms: int = 30_000
    keep_versions: int = 3

    def rows(self, df: DataFrame) -> DataFrame:
        if self.filter is not None:
            df = df.where(self.filter.to_column() if isinstance(self.filter, Expr) else self.filter)
        return self.transform(df) if self.transform else df

    def write(self, df: DataFrame) -> int:
        writers = {"hash": write_hashes, "json": write_json}
        if self.write_type not in writers:
            raise ValueError(f"write_type is one of {', '.join(writers)}")
        table = opened(self.target)
        n = writers[self.write_type](self.rows(df), table, key_column=self.key_column, key_prefix=self.key_prefix, if_exists="replace")
        table.vacuum(self.keep_versions)  # every batch makes a version
        return n


@dataclass
class BatchResult:
    batch_id: int
    entries: int
    written: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    @property
    def success(self) -> bool:
        return not self.errors


@dataclass
class ReplicationStats:
    batches: int = 0
    entries: int = 0
    written: dict[str, int] = field(default_factory=dict)
    failures: dict[str, int] = field(default_factory=dict)
    last_error: str | None = None
    started: float = field(default_factory=time.time)


class ReplicationPipeline:
    """A batch counts as done only if every destination took it; else it is given to all again, and replace makes that harmless."""

    def __init__(self, log: DataFrame, checkpoint: str, fields: list[str] | None = None):
        self.log, self.checkpoint, self.fields = log, checkpoint, fields
        self.destinations: list[ReplicationDestination] = []
        self.stats, self.results, self._query = ReplicationStats(), [], None

    def add_destination(self, destination: ReplicationDestination) -> ReplicationPipeline:
        self.destinations.append(destination)
        return self

    def _batch(self, df: DataFrame, batch_id: int) -> None:
        entries = scan_streams(df, fields=self.fields).persist()
        try:
            result = BatchResult(batch_id, entries.count())
            for k, d in enumerate(self.destinations):
                name = d.name or f"destination{k}"
                try:
                    n = d.write(entries) if result.entries else 0
                    result.written[name] = n
                    self.stats.written[name] = self.stats.written.get(name, 0) + n
                except Exception as e:  # the others are still tried; then the batch fails as a whole
                    result.errors[name] = f"{type(e).__name__}: {e}"
                    self.stats.failures[name] = self.stats.failures.get(name, 0) + 1
        finally:
            entries.unpersist()
        self.results.append(result)
        if not result.success:
            self.stats.last_error = "; ".join(f"{k}: {v}" for k, v in result.errors.items())
            raise RuntimeError(f"batch {batch_id}: {self.stats.last_error}")
        self.stats.batches += 1
        self.stats.entries += result.entries

    def run(self, *, available_now: bool = False, batch_timeout_ms: int = 1000) -> StreamingQuery:
        writer = self.log.writeStream.foreachBatch(self._batch).option("checkpointLocation", self.checkpoint)
        self._query = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{batch_timeout_ms} milliseconds")).start()
        return self._query

    def run_once(self) -> ReplicationStats:
        self.run(available_now=True).awaitTermination()
        return self.stats

    def request_shutdown(self) -> None:
        if self._query is not None:
            self._query.stop()
