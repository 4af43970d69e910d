"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from .ids import id_as_string, parse_id
from .vectors import array_columns, squared_distance

__all__ = ["parse_id", "id_as_string", "array_columns", "squared_distance"]
