"""Append logs: batch reads by id, micro-batches, consumer groups with their pending entries.

A log is a folder of Parquet (or any streaming DataFrame) with columns _key, ms, seq and fields (a map) or a column for each field. Spark's
checkpoint records what a consumer is done with: a batch whose handler fails, or that an iterator hadn't gone past, is given again (at least once).
"""

from __future__ import annotations

import itertools
import json
import queue
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from keyharbor.errors import InvalidInput, VersionConflict
from keyharbor.sources.scan import KEY, Source, first_per_key, id_range, scan_streams, table_of
from keyharbor.sources.scratch import deleted, written
from keyharbor.sources.table import Table


def read_stream(source: Source, stream: str, *, schema: list[str] | None = None, start_id: str = "-", end_id: str = "+", count: int | None = None, group: Group | None = None, consumer: str = "consumer", auto_ack: bool = False, **columns: Any) -> DataFrame:
    """Entries of one log in the range, the first `count` of them. With a group: those that it hasn't delivered yet, which become pending."""
    rows = table_of(source).where(F.col(KEY) == stream)
    if group is not None:
        return scan_streams(group.deliver(rows.where(id_range(start_id, end_id)), consumer, count, auto_ack), fields=schema, **columns)
    return scan_streams(first_per_key(rows.where(id_range(start_id, end_id)), count, ["ms", "seq"]), fields=schema, **columns)


scan_stream = read_stream


def open_log(path: str, schema: StructType | str | None = None, *, spark: SparkSession | None = None, max_files: int | None = None) -> DataFrame:
    """A folder of Parquet as a streaming DataFrame; its schema is read from it if not given."""
    spark = spark or SparkSession.active()
    reader = spark.readStream.schema(schema if schema is not None else spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


class _Stopped(Exception):
    """The caller has gone: the batch at hand isn't done."""


class _Handing:
    """Hands rows from a query's thread to a caller's, a list at a time, and holds the query's batch back until the caller has gone past its last list."""

    def __init__(self, batch_size: int | None):
        self.size, self.given, self.done = batch_size, queue.Queue(maxsize=1), threading.Event()
        self.answer: queue.Queue = queue.Queue(maxsize=1)

    def _wait(self, act: Callable[..., Any], *args: Any) -> Any:
        while not self.done.is_set():
            try:
                return act(*args, timeout=0.1)
            except (queue.Full, queue.Empty):
                continue
        raise _Stopped

    def batch(self, df: DataFrame, _: int) -> None:
        """For foreachBatch: returns, so that the checkpoint moves on, once all of the batch is committed; rolled back lists are given again."""
        rows, more = df.orderBy("ms", "seq").toLocalIterator(), True
        while more:
            held = [r.asDict(recursive=True) for r in (itertools.islice(rows, self.size) if self.size else rows)]
            more = bool(self.size) and len(held) == self.size
            while held:
                self._wait(self.given.put, held)
                if self._wait(self.answer.get):
                    break

    def lists(self, query: StreamingQuery, settle: Callable[[], bool]) -> Iterator[list[dict[str, Any]]]:
        """settle: asked when the caller wants the next list; whether the one before is committed."""
        try:
            while query.isActive or not self.given.empty():
                try:
                    held = self.given.get(timeout=0.1)
                except queue.Empty:
                    continue
                yield held
                self.answer.put(settle())
            if query.exception() is not None:
                raise query.exception()
        finally:
            self.done.set()
            query.stop()


def _started(log: DataFrame, checkpoint: str, hand: Callable[[DataFrame, int], None], available_now: bool, batch_timeout_ms: int) -> StreamingQuery:
    writer = log.writeStream.foreachBatch(hand).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{batch_timeout_ms} milliseconds")).start()


def iter_stream(log: DataFrame, checkpoint: str, *, available_now: bool = True, batch_timeout_ms: int = 1000, batch_size: int | None = None) -> Iterator[list[dict[str, Any]]]:
    """Micro-batches as lists of rows, in order of id: for small logs and tests; handlers of large ones take DataFrames (StreamConsumer).

    batch_size: rows of a list, at most (else all of a micro-batch). A micro-batch counts as done when the list after it, or the end, is asked for: a caller that breaks off is given it
    again. With available_now it ends with what is there; else it goes on until the caller stops.
    """
    handing = _Handing(batch_size)
    yield from handing.lists(_started(log, checkpoint, handing.batch, available_now, batch_timeout_ms), lambda: True)


async def iter_stream_async(log: DataFrame, checkpoint: str, **named: Any):
    """iter_stream() for asyncio."""
    import asyncio

    batches = iter_stream(log, checkpoint, **named)
    try:
        while (batch := await asyncio.to_thread(next, batches, None)) is not None:
            yield batch
    finally:
        await asyncio.to_thread(batches.close)


class Deliveries(Table):
    """An append log of folders: every version adds its own, and all of them are the content."""

    def __init__(self, path: str):
        super().__init__(path)
        self._known: dict[int, str] = {}

    def folders(self, upto: int) -> list[str]:
        for n in self._numbers():
            if n not in self._known:
                self._known[n] = self._named(n)  # pointers never change
        return [f"{self.path}/{v}" for n, v in sorted(self._known.items()) if n <= upto]


class Group:
    """A consumer group of a log: tables of what was delivered and of what was acknowledged, under one folder. Pending: delivered less acknowledged."""

    def __init__(self, path: str, start_id: str = "0"):
        """start_id: entries after it are delivered ("0": all)."""
        self.path, self.start = path.rstrip("/"), start_id
        self._deliveries = Deliveries(f"{self.path}/delivered")

    def _delivered(self, upto: int | None = None) -> DataFrame:
        spark, schema = SparkSession.active(), "_key string, ms long, seq long, consumer string, at double, acked boolean"
        last = self._deliveries.latest()[0] if upto is None else upto
        folders = self._deliveries.folders(last)
        return spark.read.schema(schema.replace("consumer", "__consumer").replace("at double", "__at double").replace("acked", "__acked")).parquet(*folders).toDF("_key", "ms", "seq", "consumer", "at", "acked") if folders else spark.createDataFrame([], schema)

    def _acked(self) -> DataFrame:
        spark, schema = SparkSession.active(), "_key string, ms long, seq long"
        try:
            return spark.read.schema(schema).parquet(f"{self.path}/acked")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e.getCondition() or e):
                raise
            return spark.createDataFrame([], schema)

    def deliver(self, rows: DataFrame, consumer: str, count: int | None = None, auto_ack: bool = False) -> DataFrame:
        """The first undelivered entries, which are pending from now on (or acknowledged at once).

        What is given is recorded in one step, as the delivery after the last one: of two consumers at a time, one is too late and chooses again, so no entry goes to both.
        """
        while True:
            last = self._deliveries.latest()[0]
            fresh = rows.join(self._delivered(last).select(KEY, "ms", "seq"), [KEY, "ms", "seq"], "left_anti")
            if self.start != "0":
                fresh = fresh.where(id_range(f"({self.start}", "+"))
            marked = first_per_key(fresh, count, ["ms", "seq"]).withColumns({"__consumer": F.lit(consumer), "__at": F.lit(time.time()), "__acked": F.lit(auto_ack)})
            try:
                return self._deliveries.save(marked, after=last).drop("__consumer", "__at", "__acked")
            except VersionConflict:
                continue

    def pending(self, consumer: str | None = None) -> DataFrame:
        """(_key, ms, seq, consumer, at) of entries delivered (to the consumer) and not acknowledged."""
        held = self._delivered().where("NOT acked").drop("acked")
        held = held if consumer is None else held.where(F.col("consumer") == consumer)
        return held.join(self._acked(), [KEY, "ms", "seq"], "left_anti")

    def pending_count(self, consumer: str | None = None) -> int:
        return self.pending(consumer).count()

    def pending_by_consumer(self) -> DataFrame:
        """(consumer, n, first_id, last_id)."""
        at = F.struct("ms", "seq")
        found = self.pending().groupBy("consumer").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("a"), F.max(at).alias("z"))
        return found.select("consumer", "n", *(F.concat_ws("-", f"{c}.ms", f"{c}.seq").alias(name) for c, name in (("a", "first_id"), ("z", "last_id"))))

    def ack(self, stream: str, ids: list[str]) -> int:
        """Acknowledges pending entries; how many were."""
        spark = SparkSession.active()
        asked = spark.createDataFrame([(stream, *map(int, i.split("-"))) for i in ids], "_key string, ms long, seq long").distinct()
        found = self.pending().join(asked, [KEY, "ms", "seq"], "left_semi").select(KEY, "ms", "seq")
        done = written(found, "acked")  # chosen once: what is counted is what is recorded
        n = done.count()
        if n:
            done.write.mode("append").parquet(f"{self.path}/acked")
        return n

    def destroy(self) -> None:
        """Forgets all that was delivered and acknowledged."""
        deleted(SparkSession.active(), self.path)
        self._deliveries = Deliveries(f"{self.path}/delivered")


def ack_entries(group: Group, stream: str, ids: list[str]) -> int:
    return group.ack(stream, ids)


class CheckpointStore:
    """Last ids by consumer, for programs that keep their own place; StreamConsumer's place is in Spark's checkpoint."""

    def get(self, key: str) -> str | None:
        raise NotImplementedError

    def set(self, key: str, last_id: str) -> None:
        raise NotImplementedError

    def delete(self, key: str) -> None:
        raise NotImplementedError


class MemoryCheckpointStore(CheckpointStore):
    def __init__(self) -> None:
        self._ids: dict[str, str] = {}

    def get(self, key: str) -> str | None:
        return self._ids.get(key)

    def set(self, key: str, last_id: str) -> None:
        self._ids[key] = last_id

    def delete(self, key: str) -> None:
        self._ids.pop(key, None)


class FileCheckpointStore(MemoryCheckpointStore):
    """A JSON file on the driver."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self._path = path
        try:
            with open(path) as f:
                self._ids = json.load(f)
        except FileNotFoundError:
            pass

    def set(self, key: str, last_id: str) -> None:
        super().set(key, last_id)
        self._save()

    def delete(self, key: str) -> None:
        super().delete(key)
        self._save()

    def _save(self) -> None:
        with open(self._path, "w") as f:
            json.dump(self._ids, f)


class TableCheckpointStore(CheckpointStore):
    """A table in a store that Spark reads."""

    def __init__(self, path: str) -> None:
        self._table = Table(path)

    def _all(self) -> dict[str, str]:
        df = self._table.read()
        return {} if df is None else {r["k"]: r["v"] for r in df.collect()}  # a row for each consumer

    def _save(self, ids: dict[str, str]) -> None:
        self._table.save(self._table.spark.createDataFrame(list(ids.items()), "k string, v string").coalesce(1))

    def get(self, key: str) -> str | None:
        return self._all().get(key)

    def set(self, key: str, last_id: str) -> None:
        self._save(self._all() | {key: last_id})

    def delete(self, key: str) -> None:
        self._save({k: v for k, v in self._all().items() if k != key})


@dataclass
class ConsumerStats:
    batches_processed: int = 0
    entries_processed: int = 0
    last_entry_id: str | None = None
    started: float = 0.0

    @property
    def uptime(self) -> float:
        return time.time() - self.started if self.started else 0.0

    @property
    def entries_per_second(self) -> float:
        return self.entries_processed / self.uptime if self.uptime else 0.0


class StreamConsumer:
    """Hands a log's micro-batches to a handler, or to who iterates. The checkpoint moves on only when a batch is done; a consumer that starts again goes on from there.

    With a handler (start, run_once), a batch is done when the handler returns. An iteration, plain or async, gives lists of rows of batch_size at most, which are done once commit() has
    been called (with auto_commit: once the next one is asked for); after rollback(), or without a commit, the same list comes again. group: where ack() acknowledges entries.
    """

    def __init__(
        self, log: DataFrame, group: str, consumer: str, checkpoint_root: str, *, checkpoint_store: CheckpointStore | None = None, entries: Group | None = None, batch_size: int | None = None, auto_commit: bool = True,
        available_now: bool = True, batch_timeout_ms: int = 1000,
    ):
        self.log, self.name = log, f"{group}:{consumer}"
        self.checkpoint = f"{checkpoint_root.rstrip('/')}/{group}/{consumer}"
        self.store, self.stats, self._query = checkpoint_store, ConsumerStats(), None
        self.entries, self.batch_size, self.auto_commit = entries, batch_size, auto_commit
        self.available_now, self.batch_timeout_ms = available_now, batch_timeout_ms
        self._current: list[dict[str, Any]] = []
        self._committed, self._rolled_back, self._batches = False, False, None

    def _done(self, n: int, last: tuple[int, int]) -> None:
        self.stats.batches_processed += 1
        self.stats.entries_processed += n
        self.stats.last_entry_id = f"{last[0]}-{last[1]}"
        if self.store:
            self.store.set(self.name, self.stats.last_entry_id)

    def start(self, handler: Callable[[DataFrame, int], None], *, available_now: bool = False, batch_timeout_ms: int = 1000) -> StreamingQuery:
        self.stats.started = self.stats.started or time.time()

        def hand(df: DataFrame, batch: int) -> None:
            df = df.persist()  # the handler's rows are counted too, and not computed again for that
            try:
                handler(df, batch)
                found = df.agg(F.count(F.lit(1)), F.max(F.struct("ms", "seq"))).first()
            finally:
                df.unpersist()
            if found[0]:
                self._done(found[0], (found[1]["ms"], found[1]["seq"]))

        self._query = _started(self.log, self.checkpoint, hand, available_now, batch_timeout_ms)
        return self._query

    def run_once(self, handler: Callable[[DataFrame, int], None]) -> ConsumerStats:
        """All that is there now; a handler's exception comes out here, and its batch will be given again."""
        self.start(handler, available_now=True).awaitTermination()
        return self.stats

    def _settled(self) -> bool:
        if self.auto_commit and not self._rolled_back:
            self.commit()
        return self._committed

    def __iter__(self) -> Iterator[list[dict[str, Any]]]:
        self.stats.started = self.stats.started or time.time()
        handing = _Handing(self.batch_size)
        self._query = _started(self.log, self.checkpoint, handing.batch, self.available_now, self.batch_timeout_ms)
        self._batches = handing.lists(self._query, self._settled)
        for held in self._batches:
            self._current, self._committed, self._rolled_back = held, False, False
            yield held

    def commit(self) -> None:
        """The list at hand is done."""
        if self._current and not self._committed:
            self._committed = True
            last = self._current[-1]
            self._done(len(self._current), (last["ms"], last["seq"]))

    def rollback(self) -> None:
        """The list at hand isn't done: it comes again when the next one is asked for."""
        if not self._committed:
            self._rolled_back = True

    def ack(self, ids: list[str] | None = None) -> int:
        """Acknowledges entries (those of the list at hand, if not said) in the group; how many were pending."""
        if self.entries is None:
            raise InvalidInput("a consumer without a group acknowledges nothing: pass entries=Group(...)")
        by_stream: dict[str, list[str]] = {}
        for row in self._current:
            entry = f"{row['ms']}-{row['seq']}"
            if ids is None or entry in ids:
                by_stream.setdefault(row[KEY], []).append(entry)
        return sum(self.entries.ack(stream, found) for stream, found in by_stream.items())

    async def __aiter__(self):
        import asyncio

        batches = iter(self)
        try:
            while (held := await asyncio.to_thread(next, batches, None)) is not None:
                yield held
        finally:
            await asyncio.to_thread(batches.close)

    def __enter__(self) -> StreamConsumer:
        return self

    def __exit__(self, *_: object) -> None:
        self.request_shutdown()

    async def __aenter__(self) -> StreamConsumer:
        return self

    async def __aexit__(self, *_: object) -> None:
        import asyncio

        await asyncio.to_thread(self.request_shutdown)

    def request_shutdown(self) -> None:
        if self._query is not None:
            self._query.stop()
