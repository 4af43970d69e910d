"""Best-fit packing by length patterns.

1. Documents become token pieces of at most ``capacity`` tokens; only longer documents are cut.
2. The histogram of piece lengths (at most ``capacity`` numbers, whatever the corpus) goes to
   the driver.  Patterns of one to four lengths that fill a sequence exactly, or as nearly as
   the lengths allow, are enumerated; non-negative least squares fits repeat counts to the
   histogram; counts are rounded down to what is there.
3. The residual histogram is packed best fit, largest first, by repeated patterns.
4. Each piece finds its place from its length and its rank among pieces of that length: a
   binary search in the plan.  Ranks come from windows over (length, cell), where a length that
   many pieces share is split into cells by a hash, so no task holds a hot length.

The plan has at most ``PATTERNS`` fitted patterns and one run per length of residual ones; it
depends on the histogram only and travels in the task closure.

Tokenising remembers the ids of words and of what stands between them, which the tokenizer
never joins, so this gives the ids of the whole text.

Defined cases: null text counts as empty and is one piece with the end id only; rows that repeat
a doc_id are separate documents; null ids are kept; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, documents, literal_array

CAPACITY = 4096
END_ID = 1
#: Fitted patterns at most, rounds of the fit, and quantile lengths that patterns are built from.
PATTERNS = 20_000
ROUNDS = 150
GRID = 16
#: Pieces of one length in a cell, at least; and cells besides one per length, at most.
CELL_ROWS, CELLS = 20_000, 20_000
#: Words and other parts of texts whose ids a task remembers.
KNOWN = 600_000
RUN = re.compile(r"[^\x20\x09-\x0D]+")
# Lower-case Latin-1 letters, and what the tokenizer's own split says about them.
_LETTERS = "a-zªµºß-öø-ÿ"
PARTS = re.compile(rf"[{_LETTERS}]+|[^\x20\x09-\x0D{_LETTERS}]+")
QUOTED = re.compile(rf"[^\x20\x09-\x0D']*'[^\x20\x09-\x0D]*|[{_LETTERS}]+|[^\x20\x09-\x0D{_LETTERS}]+")


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's content; the default is a public vocabulary that is installed with Python."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Path(path).read_text(encoding="utf-8")


class _Ids:
    """Ids of texts as little-endian 32-bit bytes.

    The tokenizer lower-cases, and parts letters from everything else and at white space, but
    for its rules on apostrophes.  So a Latin-1 text is split into words and what stands between
    them, with runs that hold an apostrophe left whole; any other text, and one that may hold a
    special token, is split at ASCII white space only.  Each part is encoded once and remembered;
    words are encoded many at a time, parted by a full stop, whose id no word contains."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.stop = self.tokenizer.encode(".", add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        if any(x in text for x in self.special):
            return RUN.findall(text)
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return RUN.findall(text)
        return (QUOTED if "'" in text else PARTS).findall(text.lower())

    def plainly(self, parts: list[str]) -> None:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        self.known.update((p, array("I", x.ids).tobytes()) for p, x in zip(parts, found, strict=True))

    def learn(self, parts: set[str]) -> None:
        new = [p for p in parts if p.isalpha()] if len(self.stop) == 1 else []
        self.plainly(list(parts.difference(new)))
        for at in range(0, len(new), 512):
            own = new[at:at + 512]
            joined = self.tokenizer.encode_batch_fast([" . ".join(own)], add_special_tokens=False)[0].ids
            ids = np.array(joined, dtype="<u4")
            raw, ends = ids.tobytes(), (4 * np.append(np.flatnonzero(ids == self.stop[0]), len(ids))).tolist()
            first = 0
            for w, e in zip(own, ends, strict=True):
                self.known[w] = raw[first:e]
                first = e + 4

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 1000):
            split = [self.split(t) for t in texts[at:at + 1000]]
            here = set(chain.from_iterable(split))
            missing = here.difference(self.known)
            if len(self.known) + len(missing) > KNOWN:
                self.known, missing = {}, here
            self.learn(missing)
            for parts in split:
                yield b"".join(map(self.known.__getitem__, parts))


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (and the ids)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, end = _Ids(vocabulary), np.array([END_ID], dtype="<u4").tobytes()
        for b in batches:
            for at in range(0, len(b), 2000):
                part = b.iloc[at:at + 2000]
                rows = []
                for d, raw in zip(part["doc_id"].tolist(), ids_of(part["text"].tolist()), strict=True):
                    raw += end
                    for k, s in enumerate(range(0, len(raw), 4 * capacity)):
                        cut = raw[s:s + 4 * capacity]
                        rows.append((d, k, s // 4, len(cut) // 4, zlib.crc32(cut)) + ((np.frombuffer(cut, dtype="<u4").astype(np.int32),) if with_ids else ()))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return documents(docs).mapInPandas(run, schema)


def _candidates(h: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns (rows of up to four lengths, 0 for none) that fill a sequence as nearly as the lengths allow."""
    have = np.flatnonzero(h)
    floor_of = np.zeros(capacity + 1, dtype=np.int64)  # the largest length there is, at most the index
    floor_of[have] = have
    floor_of = np.maximum.accumulate(floor_of)
    weight = np.cumsum(h[have])
    grid = np.unique(have[np.searchsorted(weight, np.linspace(0, weight[-1] - 1, GRID) + 0.5)])
    out = []
    for middle in [(), *[(g,) for g in grid], *[(g, k) for i, g in enumerate(grid) for k in grid[i:]]]:
        left = capacity - have - sum(middle)
        ok = left >= 0
        first, last = have[ok], floor_of[left[ok]]
        rows = np.zeros((len(first), 4), dtype=np.int64)
        rows[:, 0], rows[:, 1] = first, last
        for i, g in enumerate(middle):
            rows[:, 2 + i] = g
        out.append(rows)
    every = np.unique(-np.sort(-np.concatenate(out), axis=1), axis=0)
    return every[every.sum(axis=1) >= 0.995 * capacity]


def fit_patterns(h: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Non-negative least squares of repeat counts (multiplicative updates), rounded down to what is there."""
    patterns = _candidates(h, capacity) if h.any() else np.zeros((0, 4), dtype=np.int64)
    if not len(patterns):
        return []
    goal = h.astype(float)
    cells, live = patterns.ravel(), (patterns > 0).ravel()
    owner = np.repeat(np.arange(len(patterns)), 4)[live]
    cells = cells[live]
    x = np.ones(len(patterns))
    up = np.bincount(owner, weights=goal[cells], minlength=len(patterns))
    for _ in range(ROUNDS):
        used = np.bincount(cells, weights=x[owner], minlength=len(goal))
        x *= up / np.maximum(np.bincount(owner, weights=used[cells], minlength=len(patterns)), 1e-9)
    left, out = h.copy(), []
    for j in np.argsort(-x, kind="stable")[:PATTERNS]:
        lengths = [int(v) for v in patterns[j] if v]
        n = int(x[j])
        for v in set(lengths):
            n = min(n, int(left[v]) // lengths.count(v))
        if n > 0:
            for v in lengths:
                left[v] -= n
            out.append((tuple(lengths), n))
    return out


def pack_rest(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, largest first, on a histogram: each pattern is repeated as often as its lengths last."""
    left, out = left.copy(), []
    have = [int(v) for v in np.flatnonzero(left)]
    from bisect import bisect_right

    while have:
        room, lengths, taken = capacity, [], {}
        while room:
            i = bisect_right(have, room) - 1
            while i >= 0 and left[have[i]] - taken.get(have[i], 0) <= 0:
                i -= 1
            if i < 0:
                break
            v = have[i]
            k = min(room // v, int(left[v]) - taken.get(v, 0))
            lengths += [v] * k
            taken[v] = taken.get(v, 0) + k
            room -= k * v
        n = min(int(left[v]) // k for v, k in taken.items())
        for v, k in taken.items():
            left[v] -= n * k
            if not left[v]:
                have.remove(v)
        out.append((tuple(lengths), n))
    return out


def plan(h: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Runs of ranks: pieces of a length from rank ``first`` on lie in sequences ``seq`` to ``seq + n - 1``,
    ``copies`` of them in each, the first at ``offset``.  Sorted by (length, first)."""
    whole = [((capacity,), int(h[capacity]))] if h[capacity] else []
    rest = h.copy()
    rest[capacity] = 0
    fitted = fit_patterns(rest, capacity)
    for lengths, n in fitted:
        for v in lengths:
            rest[v] -= n
    rows, seq, used = [], 0, np.zeros(capacity + 1, dtype=np.int64)
    for lengths, n in whole + fitted + pack_rest(rest, capacity):
        at = 0
        for v in sorted(set(lengths), reverse=True):
            k = lengths.count(v)
            rows.append((v, used[v], seq, n, at))
            used[v] += n * k
            at += k * v
        seq += n
    rows.sort()
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(("length", "first", "seq", "n", "offset"))}


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    vocabulary = tokenizer_json() if vocabulary is None else vocabulary
    pieces = cut_lineage(token_pieces(docs, vocabulary, capacity), "pieces")
    h = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        h[r["length"]] = r["n"]
    runs = plan(h, capacity)
    rows_of = max(CELL_ROWS, int(h.sum()) // CELLS)
    parts = np.maximum(1, -(-h // rows_of))
    celled = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(literal_array(parts.tolist()), F.col("length").cast("int"))).cast("int"))
    # ranks of the first piece of each cell
    cell0 = np.concatenate([[0], np.cumsum(parts)])
    sizes = np.zeros(cell0[-1], dtype=np.int64)
    for r in celled.where(F.get(literal_array(parts.tolist()), F.col("length").cast("int")) > 1).groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[cell0[r["length"]] + r["cell"]] = r["n"]
    before = np.cumsum(sizes) - sizes
    before -= np.repeat(before[cell0[:-1]], parts)
    # one number line for all (length, rank)
    line0 = np.cumsum(h) - h
    starts = line0[runs["length"]] + runs["first"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = b["length"].to_numpy()
            rank = b["nth"].to_numpy() + before[cell0[v] + b["cell"].to_numpy()]
            i = np.searchsorted(starts, line0[v] + rank, side="right") - 1
            q = rank - runs["first"][i]
            b["sequence_id"] = runs["seq"][i] + q % runs["n"][i]
            b["offset"] = runs["offset"][i] + (q // runs["n"][i]) * v
            yield b.drop(columns=["nth", "cell"])

    order = Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")
    ranked = celled.withColumn("nth", F.row_number().over(order).cast("long") - 1)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    if not len(starts):
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "cell", "nth").mapInPandas(run, schema)


def sequences(docs: DataFrame, packed: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed token sequences.  A group is one sequence, so at most ``capacity`` ids.
    Rows that repeat a doc_id must not be among the documents."""
    vocabulary = tokenizer_json() if vocabulary is None else vocabulary
    ids = token_pieces(docs, vocabulary, capacity, with_ids=True).select(F.col("doc_id").alias("_d"), F.col("piece").alias("_p"), "ids")
    at = packed.select("doc_id", "piece", "sequence_id", "offset")
    joined = at.join(ids, at["doc_id"].eqNullSafe(F.col("_d")) & (F.col("piece") == F.col("_p")))
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))


__all__ = ["pack", "sequences", "token_pieces", "plan", "fit_patterns", "pack_rest", "tokenizer_json"]
