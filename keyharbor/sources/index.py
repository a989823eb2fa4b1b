"""Indexes: which key prefix has which fields. They are metadata that gives predicates their meaning; Parquet's statistics do the skipping."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

from keyharbor.errors import IndexNotFound, InvalidInput, KeyExists
from keyharbor.operators.fields import Field, GeoField, GeoShapeField, NumericField, TagField, TextField, VectorField
from keyharbor.operators.keys import delete_keys_pattern
from keyharbor.operators.query import Expr
from keyharbor.operators.search import search_hashes
from keyharbor.sources.scan import Schema, Source, scan_hashes, typed_fields
from keyharbor.sources.table import Table, opened

FIELDS = {k.kind: k for k in (TextField, NumericField, TagField, GeoField, VectorField, GeoShapeField)}


@dataclass
class IndexDiff:
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    changed: dict[str, tuple[Field, Field]] = field(default_factory=dict)
    unchanged: list[str] = field(default_factory=list)

    @property
    def has_changes(self) -> bool:
        return bool(self.added or self.removed or self.changed)


@dataclass
class IndexInfo:
    name: str
    prefixes: list[str]
    on: str
    fields: list[Field]


@dataclass
class Index:
    name: str
    prefix: str
    schema: list[Field]
    on: str = "HASH"
    stopwords: list[str] | None = None
    language: str | None = None

    def by_name(self) -> dict[str, Field]:
        return {f.name: f for f in self.schema}

    def to_args(self) -> list[str]:
        stop = [] if self.stopwords is None else ["STOPWORDS", str(len(self.stopwords)), *self.stopwords]
        return [self.name, "ON", self.on, "PREFIX", "1", self.prefix, *(["LANGUAGE", self.language] if self.language else []), *stop, "SCHEMA", *(a for f in self.schema for a in f.to_args())]

    def __str__(self) -> str:
        return " ".join(self.to_args())

    def to_json(self) -> str:
        return json.dumps(asdict(self) | {"schema": [asdict(f) | {"kind": f.kind} for f in self.schema]})

    @classmethod
    def from_json(cls, said: str) -> Index:
        d = json.loads(said)
        d["schema"] = [FIELDS[f.pop("kind")](**f) for f in d["schema"]]
        return cls(**d)

    @classmethod
    def from_schema(cls, name: str, prefix: str, schema: Schema, text_fields: list[str] | None = None, sortable: list[str] | None = None, on: str = "HASH") -> Index:
        """Numbers are NUMERIC; text is TAG, or TEXT where named; booleans are TAG; other types and names that begin with _ are left out."""
        out: list[Field] = []
        kinds = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in typed_fields(schema))) if isinstance(schema, dict) and all(isinstance(t, str) for t in schema.values()) else None
        for n, t in (typed_fields(kinds) if kinds else typed_fields(schema)):
            sort = n in (sortable or [])
            if n.startswith("_"):
                continue
            if t in (int, float) or isinstance(t, NumericType):
                out.append(NumericField(n, sortable=sort))
            elif t is str or isinstance(t, StringType):
                out.append(TextField(n, sortable=sort) if n in (text_fields or []) else TagField(n, sortable=sort))
            elif t is bool or isinstance(t, BooleanType):
                out.append(TagField(n, sortable=sort))
        return cls(name, prefix, out, on)

    @classmethod
    def from_frame(cls, name: str, prefix: str, df: DataFrame, text_fields: list[str] | None = None, sortable: list[str] | None = None) -> Index:
        return cls.from_schema(name, prefix, df.schema, text_fields, sortable)

    def validate_schema(self, schema: Schema) -> list[str]:
        """Fields of the schema that the index lacks."""
        return [n for n, _ in typed_fields(schema) if n not in self.by_name()]


class Catalog:
    """A table of indexes."""

    def __init__(self, target: Table | str):
        self.table = opened(target)

    def _rows(self) -> list[Index]:
        df = self.table.read()
        return [] if df is None else [Index.from_json(r["said"]) for r in df.orderBy("name").collect()]  # a row for each index

    def _save(self, indexes: list[Index]) -> None:
        self.table.save(self.table.spark.createDataFrame([(i.name, i.prefix, i.to_json()) for i in indexes], "name string, prefix string, said string").coalesce(1))

    def list_indexes(self) -> list[IndexInfo]:
        return [IndexInfo(i.name, [i.prefix], i.on, i.schema) for i in self._rows()]

    def get(self, name: str) -> Index:
        for i in self._rows():
            if i.name == name:
                return i
        raise IndexNotFound(name)

    def exists(self, name: str) -> bool:
        return any(i.name == name for i in self._rows())

    def info(self, name: str) -> IndexInfo:
        i = self.get(name)
        return IndexInfo(i.name, [i.prefix], i.on, i.schema)

    def create(self, index: Index, if_not_exists: bool = False) -> None:
        if self.exists(index.name):
            if if_not_exists:
                return
            raise KeyExists(f"index {index.name!r} exists")
        self._save([*self._rows(), index])

    def drop(self, name: str, missing_ok: bool = False, delete_docs: Table | str | None = None) -> None:
        """delete_docs: the table whose keys under the index's prefix go too."""
        if delete_docs is not None and self.exists(name):
            delete_keys_pattern(delete_docs, f"{self.get(name).prefix}*")
        rest = [i for i in self._rows() if i.name != name]
        if len(rest) == len(self._rows()):
            if missing_ok:
                return
            raise IndexNotFound(name)
        self._save(rest)

    def ensure_exists(self, index: Index, recreate: bool = False) -> None:
        if recreate:
            self.drop(index.name, missing_ok=True)
        self.create(index, if_not_exists=True)

    def diff(self, index: Index) -> IndexDiff:
        new, old = index.by_name(), self.get(index.name).by_name() if self.exists(index.name) else {}
        both = [n for n in new if n in old]
        return IndexDiff([n for n in new if n not in old], [n for n in old if n not in new], {n: (old[n], new[n]) for n in both if old[n] != new[n]}, [n for n in both if old[n] == new[n]])

    def migrate(self, index: Index, drop_existing: bool = False) -> bool:
        """Puts the index in the place of its namesake; whether anything changed. An existing one must be given up by drop_existing."""
        if self.exists(index.name) and not self.diff(index).has_changes:
            return False
        if self.exists(index.name) and not drop_existing:
            raise InvalidInput(f"index {index.name!r} differs; pass drop_existing=True")
        self.ensure_exists(index, recreate=True)
        return True

    def find_index_for_pattern(self, pattern: str) -> Index | None:
        """The index of the longest prefix that holds all keys of the pattern."""
        start = pattern.split("*")[0].split("?")[0].split("[")[0].replace("\\", "")
        found = [i for i in self._rows() if start.startswith(i.prefix)]
        return max(found, key=lambda i: len(i.prefix), default=None)


def list_indexes(catalog: Catalog | Table | str) -> list[IndexInfo]:
    return (catalog if isinstance(catalog, Catalog) else Catalog(catalog)).list_indexes()


def find_index_for_pattern(catalog: Catalog | Table | str, pattern: str) -> Index | None:
    return (catalog if isinstance(catalog, Catalog) else Catalog(catalog)).find_index_for_pattern(pattern)


class ExecutionStrategy(Enum):
    SEARCH = "search"
    SCAN = "scan"
    HYBRID = "hybrid"


@dataclass
class DetectedIndex:
    name: str
    prefixes: list[str]
    on: str
    fields: list[str]


@dataclass
class QueryPlan:
    """Which fields' meaning a scan goes by, and the parts of its predicate. How it runs is Spark's plan."""

    strategy: ExecutionStrategy
    index: DetectedIndex | None = None
    server_query: str | None = None
    client_filters: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    physical: str = ""

    def explain(self) -> str:
        said = [f"Strategy: {self.strategy.name}", f"Index: {self.index.name if self.index else 'none'}"]
        said += [f"Query: {self.server_query}"] * (self.server_query is not None) + [f"Filter: {x}" for x in self.client_filters] + [f"Warning: {w}" for w in self.warnings]
        return "\n".join([*said, self.physical]).rstrip()


def explain_scan(source: Source, pattern: str = "*", schema: Schema | None = None, *, catalog: Catalog | None = None, query: Expr | None = None) -> QueryPlan:
    found = catalog.find_index_for_pattern(pattern) if catalog else None
    said = DetectedIndex(found.name, [found.prefix], found.on, [f.name for f in found.schema]) if found else None
    server, client = (query.get_server_filter(), query.get_client_filter()) if query is not None else (None, None)
    strategy = ExecutionStrategy.SCAN if found is None else ExecutionStrategy.HYBRID if client is not None else ExecutionStrategy.SEARCH
    df = smart_scan(source, pattern, schema, catalog=catalog, query=query)
    plan = df._jdf.queryExecution().executedPlan().toString()
    return QueryPlan(strategy, said, server.to_query() if server is not None else "*" if found else None, [str(client.to_column())] if client is not None else [], [] if found or query is None else ["no index declares these fields: equality is plain, words are text"], plan)


plan_query = explain_scan


def smart_scan(source: Source, pattern: str = "*", schema: Schema | None = None, *, catalog: Catalog | None = None, index: Index | None = None, query: Expr | None = None, **named: Any) -> DataFrame:
    """scan_hashes(), and the predicate by the meaning that the pattern's index gives its fields."""
    index = index or (catalog.find_index_for_pattern(pattern) if catalog else None)
    rows = scan_hashes(source, pattern, schema, **named)
    if query is None:
        return rows
    return search_hashes(rows, query, _plain_schema(rows), fields=index.by_name() if index else None)


def _plain_schema(df: DataFrame) -> StructType:
    return StructType([f for f in df.schema.fields if f.name != "_key"])

