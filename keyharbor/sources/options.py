"""Options of scans and searches. Those that only tune a client's round trips are accepted and change nothing here: Spark deals the work."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any


def _env(name: str, default: int) -> int:
    value = os.environ.get(name, "")
    return int(value) if value.isdigit() else default


def get_default_batch_size() -> int:
    return _env("KEYHARBOR_BATCH_SIZE", 1000)


def get_default_count_hint() -> int:
    return _env("KEYHARBOR_COUNT_HINT", 100)


def get_default_timeout_ms() -> int:
    return _env("KEYHARBOR_TIMEOUT_MS", 30_000)


def _setter(*names: str, given: tuple = ()) -> Callable[..., Any]:
    """A method for chains: it sets the options of these names (given: what the first ones are if not said) and returns them all."""

    def put(self: Any, *values: Any, **named: Any) -> Any:
        known = dict(zip(names, given, strict=False)) | dict(zip(names, values, strict=False)) | named
        if len(values) > len(names) or set(known) != set(names):
            raise TypeError(f"takes {', '.join(names)}")
        for name, value in known.items():
            setattr(self, name, value)
        return self

    return put


def _included(flag: str, *columns: str) -> Callable[..., Any]:
    """A method for chains: whether a column is included, and, if said, its name (and offset)."""

    def put(self: Any, include: bool = True, name: str | None = None, offset: int | None = None) -> Any:
        setattr(self, flag, include)
        for column, value in zip(columns, (name, offset), strict=False):
            if value is not None:
                setattr(self, column, value)
        return self

    return put


@dataclass(kw_only=True)
class ScanOptions:
    pattern: str = "*"
    batch_size: int = field(default_factory=get_default_batch_size)
    count_hint: int = field(default_factory=get_default_count_hint)
    n_rows: int | None = None
    parallel: Any = None
    include_key: bool = True
    key_column_name: str = "_key"
    include_ttl: bool = False
    ttl_column_name: str = "_ttl"
    include_row_index: bool = False
    row_index_column_name: str = "_index"
    row_index_offset: int = 0

    with_pattern, with_batch_size, with_count_hint, with_n_rows = _setter("pattern"), _setter("batch_size"), _setter("count_hint"), _setter("n_rows")
    with_key, with_ttl = _included("include_key", "key_column_name"), _included("include_ttl", "ttl_column_name")
    with_row_index = _included("include_row_index", "row_index_column_name", "row_index_offset")


@dataclass(kw_only=True)
class HashScanOptions(ScanOptions):
    strict: bool = True
    projection: list[str] | None = None

    with_projection = _setter("projection")


@dataclass(kw_only=True)
class JsonScanOptions(ScanOptions):
    strict: bool = True
    path: str | None = None
    projection: list[str] | None = None

    with_path, with_projection = _setter("path"), _setter("projection")


@dataclass(kw_only=True)
class StringScanOptions(ScanOptions):
    value_type: Any = "string"
    value_column_name: str = "value"
    strict: bool = True

    with_value_column_name = _setter("value_column_name")


@dataclass(kw_only=True)
class SetScanOptions(ScanOptions):
    member_column_name: str = "member"

    with_member_column_name = _setter("member_column_name")


@dataclass(kw_only=True)
class ListScanOptions(ScanOptions):
    element_column_name: str = "element"
    include_position: bool = False
    position_column_name: str = "position"

    with_element_column_name, with_position = _setter("element_column_name"), _included("include_position", "position_column_name")


@dataclass(kw_only=True)
class ZSetScanOptions(ScanOptions):
    member_column_name: str = "member"
    score_column_name: str = "score"
    include_rank: bool = False
    rank_column_name: str = "rank"

    with_member_column_name, with_score_column_name, with_rank = _setter("member_column_name"), _setter("score_column_name"), _included("include_rank", "rank_column_name")


@dataclass(kw_only=True)
class StreamScanOptions(ScanOptions):
    fields: list[str] | None = None
    start_id: str = "-"
    end_id: str = "+"
    count_per_stream: int | None = None
    include_id: bool = True
    id_column_name: str = "_id"
    include_timestamp: bool = True
    timestamp_column_name: str = "_ts"
    include_sequence: bool = False
    sequence_column_name: str = "_seq"

    with_fields, with_count_per_stream, with_range = _setter("fields"), _setter("count_per_stream"), _setter("start_id", "end_id", given=("-", "+"))
    with_id, with_timestamp, with_sequence = _included("include_id", "id_column_name"), _included("include_timestamp", "timestamp_column_name"), _included("include_sequence", "sequence_column_name")


@dataclass(kw_only=True)
class TimeSeriesScanOptions(ScanOptions):
    start: str | int = "-"
    end: str | int = "+"
    count_per_series: int | None = None
    aggregation: str | None = None
    bucket_size_ms: int | None = None
    labels: list[str] = field(default_factory=list)
    timestamp_column_name: str = "_ts"
    value_column_name: str = "value"

    with_range, with_count_per_series, with_labels, with_aggregation = _setter("start", "end", given=("-", "+")), _setter("count_per_series"), _setter("labels"), _setter("aggregation", "bucket_size_ms")
    with_timestamp_column_name, with_value_column_name = _setter("timestamp_column_name"), _setter("value_column_name")


@dataclass
class SummarizeOptions:
    fields: list[str] | None = None
    frags: int = 3
    len: int = 20
    separator: str = "..."


@dataclass
class HighlightOptions:
    fields: list[str] | None = None
    open_tag: str = "<b>"
    close_tag: str = "</b>"


@dataclass(kw_only=True)
class SearchOptions(ScanOptions):
    """All of these take effect, but for timeout_ms, dialect, language, expander and verbatim (there is no stemming to switch off)."""

    index: str | None = None
    query: Any = "*"
    projection: list[str] | None = None
    sort_by: str | None = None
    sort_ascending: bool = True
    offset: int = 0
    include_score: bool = False
    score_column_name: str = "_score"
    scorer: str = "BM25"
    verbatim: bool = False
    no_stopwords: bool = False
    language: str | None = None
    in_keys: list[str] | None = None
    in_fields: list[str] | None = None
    timeout_ms: int | None = None
    dialect: int | None = None
    params: dict[str, Any] = field(default_factory=dict)
    summarize: SummarizeOptions | None = None
    highlight: HighlightOptions | None = None
    slop: int | None = None
    in_order: bool | None = None
    expander: str | None = None
    nocontent: bool = False

    with_index, with_query, with_projection, with_sort = _setter("index"), _setter("query"), _setter("projection"), _setter("sort_by", "sort_ascending", given=(None, True))
    with_score, with_scorer, with_language = _included("include_score", "score_column_name"), _setter("scorer"), _setter("language")
    with_verbatim, with_no_stopwords, with_in_order = _setter("verbatim", given=(True,)), _setter("no_stopwords", given=(True,)), _setter("in_order", given=(True,))
    with_in_keys, with_in_fields, with_timeout, with_dialect = _setter("in_keys"), _setter("in_fields"), _setter("timeout_ms"), _setter("dialect")
    with_params, with_slop, with_expander, with_nocontent = _setter("params"), _setter("slop"), _setter("expander"), _setter("nocontent", given=(True,))

    def with_summarize(self, fields: list[str] | None = None, frags: int = 3, len: int = 20, separator: str = "...") -> SearchOptions:
        self.summarize = SummarizeOptions(fields, frags, len, separator)
        return self

    def with_highlight(self, fields: list[str] | None = None, open_tag: str = "<b>", close_tag: str = "</b>") -> SearchOptions:
        self.highlight = HighlightOptions(fields, open_tag, close_tag)
        return self
