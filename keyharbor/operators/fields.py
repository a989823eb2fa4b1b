"""Fields of an index: how a predicate on a column is meant, and the argument lists that declare them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    name: str
    sortable: bool = False
    noindex: bool = False

    kind = "FIELD"

    def options(self) -> list[str]:
        return []

    def to_args(self) -> list[str]:
        """Name, kind, options, then SORTABLE and NOINDEX where set."""
        return [self.name, self.kind, *self.options(), *(["SORTABLE"] if self.sortable else []), *(["NOINDEX"] if self.noindex else [])]


@dataclass(frozen=True)
class TextField(Field):
    nostem: bool = False
    weight: float = 1.0
    phonetic: str | None = None
    withsuffixtrie: bool = False
    kind = "TEXT"

    def options(self) -> list[str]:
        return [*(["NOSTEM"] if self.nostem else []), *(["WEIGHT", str(self.weight)] if self.weight != 1.0 else []), *(["PHONETIC", self.phonetic] if self.phonetic else []), *(["WITHSUFFIXTRIE"] if self.withsuffixtrie else [])]


@dataclass(frozen=True)
class NumericField(Field):
    kind = "NUMERIC"


@dataclass(frozen=True)
class TagField(Field):
    separator: str = ","
    casesensitive: bool = False
    withsuffixtrie: bool = False
    kind = "TAG"

    def options(self) -> list[str]:
        return [*(["SEPARATOR", self.separator] if self.separator != "," else []), *(["CASESENSITIVE"] if self.casesensitive else []), *(["WITHSUFFIXTRIE"] if self.withsuffixtrie else [])]


@dataclass(frozen=True)
class GeoField(Field):
    """A field of "lon,lat" text, or columns <name>_lon and <name>_lat."""

    kind = "GEO"


@dataclass(frozen=True)
class GeoShapeField(Field):
    coord_system: str = "SPHERICAL"
    kind = "GEOSHAPE"

    def options(self) -> list[str]:
        return [self.coord_system]


@dataclass(frozen=True)
class VectorField(Field):
    """algorithm FLAT or HNSW: either is evaluated exactly; the rest is kept for the declaration."""

    algorithm: str = "FLAT"
    dim: int = 384
    distance_metric: str = "COSINE"
    initial_cap: int | None = None
    m: int | None = None
    ef_construction: int | None = None
    ef_runtime: int | None = None
    block_size: int | None = None
    kind = "VECTOR"

    def options(self) -> list[str]:
        named = {"TYPE": "FLOAT32", "DIM": self.dim, "DISTANCE_METRIC": self.distance_metric, "INITIAL_CAP": self.initial_cap}
        named |= {"M": self.m, "EF_CONSTRUCTION": self.ef_construction, "EF_RUNTIME": self.ef_runtime} if self.algorithm == "HNSW" else {"BLOCK_SIZE": self.block_size}
        pairs = [str(x) for k, v in named.items() if v is not None for x in (k, v)]
        return [self.algorithm, str(len(pairs)), *pairs]
