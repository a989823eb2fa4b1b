"""Schemas from samples, with the confidence that they deserve. One aggregate over the sample tells all columns at once."""

from __future__ import annotations

import re
from dataclasses import dataclass, field


from pyspark.sql import functions as F

from keyharbor.functions import parse
from keyharbor.sources.scan import EXPIRES, KEY, Source, table_of


@dataclass(frozen=True)
class FieldInfo:
    type: str
    confidence: float
    total: int
    nulls: int


@dataclass
class SchemaConfidence:
    schema: dict[str, str]
    sample_count: int
    field_info: dict[str, FieldInfo] = field(default_factory=dict)

    @property
    def average_confidence(self) -> float:
        found = [f.confidence for f in self.field_info.values()]
        return sum(found) / len(found) if found else 1.0

    @property
    def all_confident(self) -> bool:
        return not self.low_confidence_fields(0.9)

    def low_confidence_fields(self, threshold: float = 0.9) -> list[str]:
        return [n for n, f in self.field_info.items() if f.confidence < threshold]


def _chosen(n: int, longs: int, doubles: int, booleans: int) -> tuple[str, float]:
    """All of a kind, narrowest first; else the kind of most values if half are; else text."""
    if not n:
        return "string", 1.0
    kinds = (("long", longs), ("double", doubles), ("boolean", booleans))
    for kind, k in kinds:
        if k == n:
            return kind, 1.0
    kind, k = max(kinds, key=lambda x: x[1])
    return (kind, k / n) if k / n >= 0.5 else ("string", 1.0)


def infer_hash_schema_with_confidence(source: Source, sample_size: int = 100, type_inference: bool = True) -> SchemaConfidence:
    """From the first sample_size rows of a hash table; fields in alphabetical order."""
    df = table_of(source)
    names = sorted(c for c in df.columns if c not in (KEY, EXPIRES))
    sample = df.select(*(F.col(c).cast("string") for c in names)).limit(sample_size)
    tests = [lambda c: parse.parsed(c, "long", False), lambda c: parse.parsed(c, "double", False), lambda c: parse.parsed(c, "boolean", False)]
    found = sample.agg(F.count(F.lit(1)), *(F.count(x) for c in names for x in (F.col(c), *(t(F.col(c)) for t in tests)))).first()
    out = SchemaConfidence({}, found[0])
    for k, c in enumerate(names):
        n, *counts = found[1 + 4 * k : 5 + 4 * k]
        kind, confidence = _chosen(n, *counts) if type_inference else ("string", 1.0)
        out.schema[c], out.field_info[c] = kind, FieldInfo(kind, confidence, found[0], found[0] - n)
    return out


def infer_hash_schema(source: Source, sample_size: int = 100, type_inference: bool = True) -> dict[str, str]:
    return infer_hash_schema_with_confidence(source, sample_size, type_inference).schema


def infer_hash_schema_with_overwrite(source: Source, overwrite: dict[str, str], sample_size: int = 100) -> dict[str, str]:
    """Inferred types, but for the given ones; given names that the sample lacks are added."""
    return dict(sorted((infer_hash_schema(source, sample_size) | overwrite).items()))


#: JSON kinds as types; others are text.
KINDS = {"BIGINT": "long", "DOUBLE": "double", "DECIMAL": "double", "BOOLEAN": "boolean", "STRING": "string"}


def _members(said: str) -> list[tuple[str, str]]:
    """(name, type) of the parts of OBJECT<a: T, b: U>, where T may have parts of its own."""
    body = re.sub(r"^OBJECT<(.*)>$", r"\1", said)
    if body == said:
        return []
    out, depth, begin = [], 0, 0
    for i, c in enumerate(body + ","):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            name, _, kind = body[begin:i].strip().partition(": ")
            out.append((name.strip("`"), kind))
            begin = i + 1
    return out


def infer_json_schema(source: Source, sample_size: int = 100) -> dict[str, str]:
    """From the top-level fields of the first sample_size documents: of one kind, that; whole and decimal numbers, double; else text."""
    sample = table_of(source).select(F.try_parse_json("doc").alias("v")).where("v IS NOT NULL").limit(sample_size)
    said = sample.agg(F.schema_of_variant_agg("v")).first()[0]
    return dict(sorted((n, KINDS.get(re.sub(r"\W.*", "", k), "string")) for n, k in _members(said or "")))


def infer_json_schema_with_overwrite(source: Source, overwrite: dict[str, str], sample_size: int = 100) -> dict[str, str]:
    return dict(sorted((infer_json_schema(source, sample_size) | overwrite).items()))
