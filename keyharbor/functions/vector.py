"""Vector distances as Column expressions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("COSINE", "L2", "IP")


def literal(values: list[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def distance(a: Column, b: Column, metric: str = "COSINE") -> Column:
    """COSINE: 1 - cosine (null for a zero vector); L2: squared Euclidean; IP: 1 - inner product. Null where lengths differ."""
    if metric.upper() == "COSINE":
        norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
        found = F.when(norms != 0, 1 - dot(a, b) / norms)
    elif metric.upper() == "L2":
        found = F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    elif metric.upper() == "IP":
        found = 1 - dot(a, b)
    else:
        raise ValueError(f"unknown metric {metric!r}: one of {', '.join(METRICS)}")
    return F.when(F.size(a) == F.size(b), found)
