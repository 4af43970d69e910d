"""Identifier parsing.

The reference cast text ids to long and dropped the rows that came out null.
Under ANSI mode (the Spark 4 default) a plain ``cast`` fails the whole job on
one malformed value, so ids are parsed with ``try_cast``: malformed text
becomes null and the caller's null filter drops the row, as before.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Text with a decimal point: the old cast kept the whole part.  No exponents.
_DECIMAL = r"^\s*[+-]?([0-9]+\.[0-9]*|\.[0-9]+)\s*$"


def parse_id(col: str | Column, to: str = "bigint") -> Column:
    """Text or number -> ``to``; decimal text is cut to its whole part, as a number
    is; malformed or empty text -> null."""
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    decimal = F.when(text.rlike(_DECIMAL), text.try_cast("decimal(38,18)").try_cast(to))
    return F.coalesce(c.try_cast(to), decimal)


def id_as_string(col: str | Column) -> Column:
    """Ids are joined as strings on both sides so that joins never coerce."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")
