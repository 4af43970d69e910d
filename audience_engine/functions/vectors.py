"""Array / vector column helpers (P7 and distance arithmetic)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_columns(col: str, n: int, prefix: str = "feature_col_") -> list[Column]:
    """Element i of an array column as ``<prefix>{i+1}``, i < n."""
    return [F.col(col)[i].alias(f"{prefix}{i + 1}") for i in range(n)]


def squared_distance(a: str | Column, b: str | Column) -> Column:
    """Squared Euclidean distance of two equal-length numeric arrays, as one
    JVM expression (zip + aggregate), so it stays inside whole-stage codegen."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    diffs = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)
