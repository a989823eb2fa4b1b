"""Messages of channels: tables or streams of (channel, message, ts in epoch seconds), collected for a while or in micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keyharbor.functions.text import matches_glob
from keyharbor.streaming.log import iter_stream, iter_stream_async


def _chosen(messages: DataFrame, channels: list[str], pattern: bool) -> DataFrame:
    if not pattern:
        return messages.where(F.col("channel").isin(channels))
    out = F.lit(False)
    for c in channels:
        out = out | matches_glob(F.col("channel"), c)
    return messages.where(out)


def parsed_messages(messages: DataFrame, message_format: str = "raw", schema: StructType | str | None = None, parser: Callable[[DataFrame], DataFrame] | None = None, include_channel: bool = True, include_timestamp: bool = True) -> DataFrame:
    """raw: the text as `message`. json: the schema's fields; text that isn't JSON has none of them, and stands in `message`. parser: of the frame, in place of both."""
    if parser is not None:
        out, data = parser(messages), None
    elif message_format == "json":
        if schema is None:
            raise ValueError("JSON messages need a schema")
        kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        out = messages.withColumn("_p", F.from_json("message", kind))
        good = F.try_parse_json("message").isNotNull()
        data = [F.col(f"_p.{f.name}").alias(f.name) for f in kind.fields] + [F.when(~good, F.col("message")).alias("message")]
    elif message_format == "raw":
        out, data = messages, [F.col("message")]
    else:
        raise ValueError("message_format is raw or json")
    meta = [F.col("channel").alias("_channel")] * include_channel + [F.col("ts").alias("_received_at")] * include_timestamp
    kept = data if data is not None else [F.col(c) for c in out.columns if c not in ("channel", "ts", "message")]
    return out.select(*meta, *kept)


def collect_pubsub(messages: DataFrame, channels: list[str], *, count: int | None = None, timeout_ms: int | None = None, window_seconds: float | None = None, pattern: bool = False, since: float | None = None, **named: Any) -> DataFrame:
    """The first `count` messages of the channels, within the shorter of timeout and window after `since` (else after the first message)."""
    found = _chosen(messages, channels, pattern)
    limits = [x for x in (None if timeout_ms is None else timeout_ms / 1000, window_seconds) if x is not None]
    if since is not None:
        found = found.where(F.col("ts") >= since)
    if limits:
        first = F.lit(since) if since is not None else F.col("_first")
        if since is None:
            found = found.crossJoin(F.broadcast(found.agg(F.min("ts").alias("_first"))))  # one row
        found = found.where(F.col("ts") < first + min(limits)).drop("_first")
    if count is not None:
        found = found.orderBy("ts", "channel", "message").limit(count)
    return parsed_messages(found, **named)


def _log(messages: DataFrame, channels: list[str], pattern: bool) -> DataFrame:
    """Messages as a log: ms orders them."""
    return _chosen(messages, channels, pattern).withColumns({"ms": (F.col("ts") * 1000).cast("long"), "seq": F.lit(0).cast("long")})


def iter_pubsub(messages: DataFrame, channels: list[str], checkpoint: str, *, pattern: bool = False, batch_timeout_ms: int = 1000, available_now: bool = True, batch_size: int | None = None) -> Iterator[list[dict[str, Any]]]:
    """Lists of messages of a streaming frame, batch_size at most each; a micro-batch ends with the source's own size limit or the time between triggers."""
    yield from iter_stream(_log(messages, channels, pattern), checkpoint, available_now=available_now, batch_timeout_ms=batch_timeout_ms, batch_size=batch_size)


def iter_pubsub_async(messages: DataFrame, channels: list[str], checkpoint: str, *, pattern: bool = False, **named: Any):
    return iter_stream_async(_log(messages, channels, pattern), checkpoint, **named)
