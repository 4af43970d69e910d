"""Match spans from regular expressions with built-in functions only.

``regexp_extract_all`` gives the matches and ``split`` the text between them; running sums
of their lengths (code points) give the places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Running sums are taken in chunks, so a text with very many matches stays cheap.
CHUNK = 128
SPAN = "array<struct<s:int,e:int,m:string,before:string,after:string>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` loops over it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def sums_before(values: Column) -> Column:
    """For each place of an int array the sum of what stands before it."""
    def use(v: Column) -> Column:
        n = F.size(v)
        chunks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")), lambda c: _sum(F.slice(v, c * CHUNK + 1, F.lit(CHUNK))))
        return let(chunks, lambda cs: let(
            F.transform(cs, lambda _, c: _sum(F.slice(cs, F.lit(1), c))),
            lambda offs: F.transform(v, lambda _, i: F.get(offs, F.floor(i / CHUNK).cast("int")) + _sum(
                F.slice(v, F.floor(i / CHUNK).cast("int") * CHUNK + 1, i % CHUNK)))))
    return let(values, lambda v: F.when(F.size(v) > 0, use(v)).otherwise(F.array().cast("array<int>")))


def match_spans(text: Column, regex: str, only_if: Column, context: int = 24) -> Column:
    """Leftmost non-overlapping matches as structs: s and e (code points, end exclusive), m, and up to
    ``context`` characters before and after.  ``only_if`` is a cheap necessary condition."""
    def build(t: Column) -> Column:
        return let(F.regexp_extract_all(t, F.lit(regex), F.lit(0)), lambda m: F.when(F.size(m) > 0, let(
            F.split(t, regex, -1), lambda gap: let(
                F.transform(m, lambda x, i: F.length(F.get(gap, i)) + F.length(x)), lambda step: let(
                    sums_before(step), lambda at: F.transform(m, lambda x, i: F.struct(
                        (F.get(at, i) + F.length(F.get(gap, i))).cast("int").alias("s"),
                        (F.get(at, i) + F.get(step, i)).cast("int").alias("e"),
                        x.alias("m"),
                        F.substring(F.get(gap, i), -context, context).alias("before"),
                        F.substring(F.get(gap, i + 1), 1, context).alias("after"))))))))
    empty = F.array().cast(SPAN)
    return F.coalesce(F.when(only_if, let(text, build)), empty)


def tagged(spans: Column, rank: int, by_start: bool) -> Column:
    """Sort keys (start, kind rank, end) or (kind rank, start, end) of spans of one kind."""
    r = F.lit(rank)
    if by_start:
        return F.transform(spans, lambda x: F.struct(x["s"].alias("a"), r.alias("b"), x["e"].alias("e")))
    return F.transform(spans, lambda x: F.struct(r.alias("a"), x["s"].alias("b"), x["e"].alias("e")))


def joined(keys: Column, kinds: list[str], by_start: bool) -> Column:
    """``kind:start:end`` of tagged spans in order, comma-joined."""
    names = F.lit(kinds)
    rank, start = ("b", "a") if by_start else ("a", "b")
    return F.array_join(F.transform(F.array_sort(keys), lambda x: F.concat_ws(
        ":", F.get(names, x[rank]), x[start].cast("string"), x["e"].cast("string"))), ",")


def _overlapped(c: Column, spans: Column) -> Column:
    """Whether a span meets one of the others, which are in order and apart from each other: by binary
    search the last one that starts before it ends."""
    last = F.aggregate(F.lit([1 << b for b in reversed(range(24))]), F.lit(0), lambda lo, step: F.when(
        (lo + step <= F.size(spans)) & (F.get(spans, F.least(lo + step, F.size(spans)) - 1)["s"] < c["e"]), lo + step).otherwise(lo))
    return (F.size(spans) > 0) & let(last, lambda n: (n > 0) & F.coalesce(F.get(spans, n - 1)["e"] > c["s"], F.lit(False)))


def apart_from(spans: Column, *others: Column | str) -> Column:
    """The spans that overlap none of the others; each of these is one kind's matches, in order."""
    def meets(c: Column) -> Column:
        found = F.lit(False)
        for o in others:
            found = found | _overlapped(c, F.col(o) if isinstance(o, str) else o)
        return found
    return F.filter(spans, lambda c: ~meets(c))


__all__ = ["let", "sums_before", "match_spans", "tagged", "joined", "apart_from", "SPAN"]
