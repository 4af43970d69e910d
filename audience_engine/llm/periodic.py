"""Periodic run detection by descending-LCP Kruskal.

A run is a stretch of consecutive words with least period q and a length of at least
``min_length`` words and ``min_exponent`` periods that no neighbouring word extends with
period q.  For each text:

1. Words become numbers and suffixes are ranked by prefix doubling; the ranks of all levels
   give the longest common prefix (LCP) of neighbours in suffix order.
2. Neighbours are united by decreasing LCP (Kruskal) with union-find.  Each class holds its
   text positions in order; the smaller class goes into the larger.
3. When two positions x < x + d become adjacent in their class at LCP l, words x to x + d + l
   have period d, and no further.  If that is long enough for a run and the word before x does
   not agree with the word before x + d, this is a run: its start, and d its least period.

Why every run is found, once: its start s and s + q have LCP l = length - q >= 3q.  A position
of their class between them would give the run a period below q (by the theorem of Fine and
Wilf), so they become adjacent when they are united, at LCP l; later starts inside the
run can be extended to the left.  With a longer period than the least one, x + q would
already lie between x and x + d.

A run needs an LCP of at least ``min_length`` - ``min_length`` / ``min_exponent`` words, so texts without a
repeated word shingle of that length have none and leave after one sort, and Kruskal stops there.

Texts are handled alone, whole, in the task that reads them, with memory proportional to
n log n for n words: nothing is shuffled.

Defined cases: null or empty text, or one without words: no run, nothing kept; rows that repeat an id
or have none are handled each (a null id plants no tail); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

MIN_LENGTH, MIN_EXPONENT = 6, 4
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Positions in a block of an ordered set.
FULL = 1024


class Positions:
    """An ordered set of integers in blocks, so that an insertion moves at most one block."""

    def __init__(self, first: int):
        self.blocks, self.least = [[first]], [first]

    def __len__(self) -> int:
        return sum(map(len, self.blocks))

    def __iter__(self):
        for b in self.blocks:
            yield from b

    def insert(self, x: int) -> tuple[int, int]:
        """Inserts x; its neighbours before and after, -1 where there is none."""
        k = max(bisect_right(self.least, x) - 1, 0)
        block = self.blocks[k]
        at = bisect_right(block, x)
        before = block[at - 1] if at else -1
        after = block[at] if at < len(block) else self.least[k + 1] if k + 1 < len(self.blocks) else -1
        insort(block, x)
        self.least[k] = block[0]
        if len(block) > FULL:
            half = len(block) // 2
            self.blocks.insert(k + 1, block[half:])
            self.least.insert(k + 1, block[half])
            del block[half:]
        return before, after


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the LCP of each but the first with the one before."""
    n = len(ids)
    levels, width = [np.unique(ids, return_inverse=True)[1].astype(np.int32)], 1
    while width < n and levels[-1].max() < n - 1:
        rank = levels[-1].astype(np.int64)
        after = np.zeros(n, dtype=np.int64)
        after[:n - width] = rank[width:] + 1
        levels.append(np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int32))
        width *= 2
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[1:].copy(), order[:-1].copy()
    lcp = np.zeros(n - 1, dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step, rank = 1 << k, levels[k]
        # equal ranks of a level mean equal words only where the whole width lies in the text
        inside = (a + step <= n) & (b + step <= n)
        same = np.zeros(n - 1, dtype=bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        a[same] += step
        b[same] += step
        lcp[same] += step
    return order, lcp


def _repeats(ids: np.ndarray, k: int) -> bool:
    """Whether some k consecutive words may occur twice (equal hashes)."""
    n = len(ids) - k + 1
    if n < 2:
        return False
    h = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        h = (h ^ ids[i:i + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def find_runs(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a list of words, by start, then period."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be at least 3: shorter runs may have other positions between")
    least = max(min_length - min_length // min_exponent, 1)
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    if not _repeats(ids, least):
        return []
    order, lcp = suffix_order(ids)
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    size: dict[int, int] = {}
    out = []
    for u, v, l in zip(order[edges].tolist(), order[edges + 1].tolist(), lcp[edges].tolist(), strict=True):
        u, v = root(u), root(v)
        if size.get(u, 1) < size.get(v, 1):
            u, v = v, u
        into = members.get(u)
        if into is None:
            into = members[u] = Positions(u)
        # only a pair with one position of each class is new; what follows x counts once the next
        # position of the smaller class is known not to come between
        pairs, last, open_after = [], -1, -1
        for x in members.pop(v, (v,)):
            before, after = into.insert(x)
            if 0 <= open_after < x:
                pairs.append((last, open_after))
            if before >= 0 and before != last:
                pairs.append((before, x))
            last, open_after = x, after
        if open_after >= 0:
            pairs.append((last, open_after))
        for a, b in pairs:
            d = b - a
            if l + d >= min_length and l + d >= min_exponent * d and (not a or ids[a - 1] != ids[b - 1]):
                out.append((a, l + d, d))
        parent[v] = u
        size[u] = size.get(u, 1) + size.get(v, 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    best = None
    for r in runs:  # by start, then period: only a greater quotient replaces
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def planted_tail(words: list[str], doc_id: object) -> list[str]:
    """The fixed rule of the query: one in ten ids has its text end in a period.
    With h the crc32 of the id, h % 10 = 0 and g = h // 10, word i >= a = g % n becomes word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8)."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
                  plant_tails: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, runs (array of start, length, period), collapsed (text without
    the repeats).  ``plant_tails`` applies ``planted_tail`` to the words first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at:at + 500]
                runs, texts = [], []
                for doc_id, t in zip(part["doc_id"], part["text"], strict=True):
                    words = WORD.findall(t)
                    if plant_tails:
                        words = planted_tail(words, doc_id)
                    found = find_runs(words, min_length, min_exponent)
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    texts.append(" ".join(collapse(words, found)))
                yield pd.DataFrame({"doc_id": part["doc_id"], "runs": runs, "collapsed": texts})

    rows = documents(docs)
    kind = dict(rows.dtypes)["doc_id"]
    # ids travel as text: pandas would turn whole numbers beside nulls into floats
    found = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        run, "doc_id string, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def digest(found: DataFrame) -> DataFrame:
    """Per row: n_runs, the run with the greatest exact length / period (ties: smallest start, then
    period), and hashes of all runs and of the collapsed text."""
    # runs are sorted by start, then period, so only a strictly greater quotient replaces the best so far
    first = F.when(F.size("runs") > 0, F.col("runs")[0])
    best = F.aggregate(F.col("runs"), first, lambda b, r: F.when(
        r["length"].cast("decimal(20,0)") * b["period"] > b["length"].cast("decimal(20,0)") * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                       F.col("best.period").alias("period"),
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


__all__ = ["periodic_runs", "find_runs", "collapse", "strongest", "planted_tail", "suffix_order", "Positions", "digest"]
