"""Spelling variant grouping by sorted-list dynamic programming.

The vocabulary is counted over whole texts.  Two words are near if they differ by exactly one
inserted, deleted or replaced code point; a word's form is its most frequent near word, if that
is frequent enough; following forms gives the root.

Near words are found in frames.  In a frame all words agree on their first p and last s code
points, and the longer word of a pair has ``longest`` code points, so only the middles differ, by
one edit.  A frame is split in two: the pairs that also agree on the first half of the middle,
and the rest, which must agree on its last half (one edit cannot lie in both).  Every word
starts in the frames of its own length and of one more, split once.  Frames with more than
``GROUP`` words, or middles over ``MIDDLE`` code points, are split again, until a middle of one
code point bounds the frame by the alphabet; words alone in such a frame leave.  So no task holds an
unbounded group, whatever prefix a third of the words share.

In a frame the sorted middles are scanned by dynamic programming.  Words that share a prefix are a
range of the list, bounded by the longest common prefixes (LCP) of neighbours, and the edit
matrix's row for that prefix, a band of three cells, is computed once for the range.  Where
all cells exceed one edit, the whole range is skipped.  The scan goes over the depth, for
all words of the frame at a time.

Defined cases: null or empty texts have no words; rows that repeat a document count each; a null
doc_id deletes nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, documents, lower_ascii

#: Runs of these are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words of a frame and code points of a middle, above which a frame is split again.
GROUP, MIDDLE = 4096, 32
#: Rows that are scanned together.
BLOCK = 16_384
FRAME = ["longest", "front", "shared"]


def vocabulary(docs: DataFrame, min_chars: int = 5, min_count: int = 3, slip_one_in: int = 97) -> DataFrame:
    """(word, n): words of at least ``min_chars`` code points that occur ``min_count`` times.

    One in ``slip_one_in`` of the pairs of document and word loses a code point, by the crc32 of
    ``<doc_id>:<word>`` (0: none does)."""
    runs = documents(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("word"))
    runs = runs.where(F.char_length("word") >= min_chars).withColumn("word", lower_ascii(F.col("word")))
    if slip_one_in:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
        k = (F.col("h") % F.char_length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), k), F.substring("word", k + 2, F.char_length("word")))
        runs = runs.withColumn("h", h)
        runs = runs.select(F.when(F.col("h") % slip_one_in == 0, cut).otherwise(F.col("word")).alias("word"))
        runs = runs.where(F.char_length("word") >= min_chars)
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _part(text: Column, start: Column, length: Column) -> Column:
    return F.substring(text, start, length)


def _split(rows: DataFrame) -> DataFrame:
    """Each row in the two halves of its frame.  ``shared`` is the agreed front and back, one after
    the other, ``front`` the length of the first."""
    size = F.col("longest") - F.char_length("shared")
    half = F.floor(size / 2).cast("int")
    back = (size - half).cast("int")
    keep = (F.char_length("middle") - back).cast("int")
    before, after = _part(F.col("shared"), F.lit(1), F.col("front")), _part(F.col("shared"), F.col("front") + 1, F.char_length("shared"))
    first = F.struct((F.col("front") + half).cast("int").alias("front"),
                     F.concat(before, _part(F.col("middle"), F.lit(1), half), after).alias("shared"),
                     _part(F.col("middle"), half + 1, F.char_length("middle")).alias("middle"))
    last = F.struct(F.col("front").cast("int").alias("front"),
                    F.concat(before, _part(F.col("middle"), keep + 1, back), after).alias("shared"),
                    _part(F.col("middle"), F.lit(1), keep).alias("middle"))
    return rows.select("longest", F.explode(F.array(first, last)).alias("f"), "n").select(
        "longest", "f.front", "f.shared", "f.middle", "n")


def adjacent_lcp(codes: np.ndarray, lens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """LCP of each row of the sorted code matrix with the one before; -1 at the first of a frame."""
    out = np.full(len(lens), -1, dtype=np.int64)
    if len(lens) > 1:
        equal = np.minimum.accumulate(codes[1:] == codes[:-1], axis=1).sum(axis=1)
        out[1:] = np.minimum(equal, np.minimum(lens[1:], lens[:-1]))
    out[first] = -1
    return out


def near_middles(middles: list[str], size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) in the same frame at exactly one edit with i as long as its frame allows (``size``).

    ``middles`` are sorted within frames; ``first`` marks where frames begin."""
    n, wide = len(middles), max(map(len, middles), default=0) + 3
    codes = np.array(middles, dtype=f"U{wide}").view(np.uint32).reshape(n, wide)
    lens = np.fromiter(map(len, middles), dtype=np.int64, count=n)
    lcp = adjacent_lcp(codes, lens, first)
    low = np.flatnonzero(first)  # the ranges at depth 0: whole frames
    frame = np.cumsum(first) - 1
    query = np.flatnonzero(lens == size)
    at = frame[query]  # of each pair of a word and a range: the range
    # the band of the row: edits between the prefix of length d and the word's first d-1, d, d+1 code points
    one = np.full(len(query), 2, dtype=np.int8), np.zeros(len(query), dtype=np.int8), np.where(lens[query] > 0, 1, 2).astype(np.int8)
    found_i, found_j = [], []
    d = 0
    while len(query):
        left, length = low[at], lens[query]
        # a word that ends at this depth is the first of its range
        end = lens[left] == d
        cell = length - d
        for k, e in zip((-1, 0, 1), one, strict=True):
            hit = end & (cell == k) & (e == 1)
            found_i.append(query[hit])
            found_j.append(left[hit])
        # the ranges of the next depth, and the range that holds each
        child = np.flatnonzero((lcp <= d) & (lens > d))
        above = np.searchsorted(low, child, side="right") - 1
        count = np.bincount(above, minlength=len(low))
        start = np.cumsum(count) - count
        times = count[at]
        pair = np.repeat(np.arange(len(query)), times)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        to = start[at][pair] + nth
        query = query[pair]
        length = length[pair]
        c = codes[child[to], d]
        e0, e1, e2 = (e[pair] for e in one)
        before = codes[query, d - 1] != c if d else np.ones(len(query), dtype=bool)
        n0 = np.minimum(e1 + 1, e0 + before)
        n1 = np.minimum(np.minimum(e2 + 1, e1 + (codes[query, d] != c)), n0 + 1)
        n2 = np.minimum(e2 + (codes[query, d + 1] != c), n1 + 1)
        n0, n1, n2 = (np.where(d + k > length, 2, np.minimum(e, 2)).astype(np.int8) for k, e in ((0, n0), (1, n1), (2, n2)))
        alive = np.minimum(np.minimum(n0, n1), n2) <= 1
        query, at, one, low = query[alive], to[alive], (n0[alive], n1[alive], n2[alive]), child
        d += 1
    return np.concatenate(found_i or [np.zeros(0, dtype=np.int64)]), np.concatenate(found_j or [np.zeros(0, dtype=np.int64)])


def _scan(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words of whole frames, sorted by frame and middle: per word the number found here and the
    best one (greatest n, then least in code-point order)."""
    longest, front, shared, middle, n = (rows[c].to_numpy() for c in ("longest", "front", "shared", "middle", "n"))
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (longest[1:] != longest[:-1]) | (front[1:] != front[:-1]) | (shared[1:] != shared[:-1])
    alone = first & np.append(first[1:], True)
    keep = np.flatnonzero(~alone)
    longest, front, shared, middle, n, first = (x[keep] for x in (longest, front, shared, middle, n, first))
    middle = middle.tolist()
    size = longest - np.fromiter(map(len, shared), dtype=np.int64, count=len(keep))
    i, j = near_middles(middle, size, first)
    lens = np.fromiter(map(len, middle), dtype=np.int64, count=len(keep))
    shorter = lens[j] < lens[i]
    # a letter doubled across the middle's end also agrees on more of the front: the other half has that pair
    twice = np.fromiter((s and middle[a].startswith(middle[b]) and shared[a][front[a]:front[a] + 1] == middle[a][-1]
                         for s, a, b in zip(shorter.tolist(), i.tolist(), j.tolist(), strict=True)), dtype=bool, count=len(i))
    i, j, shorter = i[~twice], j[~twice], shorter[~twice]
    i, j = np.concatenate([i, j[shorter]]), np.concatenate([j, i[shorter]])
    involved = np.unique(np.concatenate([i, j]))
    words = {k: shared[k][:front[k]] + middle[k] + shared[k][front[k]:] for k in involved.tolist()}
    by_word = np.zeros(len(keep), dtype=np.int64)
    by_word[sorted(words, key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((by_word[j], -n[j], i))
    i, j = i[order], j[order]
    who, where, count = np.unique(i, return_index=True, return_counts=True)
    return pd.DataFrame({"word": np.array([words[k] for k in who.tolist()], dtype=object), "n_near": count,
                         "near": np.array([words[k] for k in j[where].tolist()], dtype=object), "near_n": n[j[where]]}).astype(
                             {"word": object, "near": object})


def _scanned(rows: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) per frame; each frame lies whole and sorted in one partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        held = 0
        for b in batches:
            waiting.append(b)
            held += len(b)
            if held < BLOCK:
                continue
            both = pd.concat(waiting, ignore_index=True)
            last = both.iloc[-1]
            same = (both["longest"] == last["longest"]) & (both["front"] == last["front"]) & (both["shared"] == last["shared"])
            cut = int(same.to_numpy().argmax())  # where the last frame, which may go on, begins
            if cut:
                yield _scan(both.iloc[:cut])
            waiting, held = [both.iloc[cut:]], len(both) - cut
        if held:
            yield _scan(pd.concat(waiting, ignore_index=True))

    dealt = rows.repartition(*FRAME).sortWithinPartitions(*FRAME, "middle")
    return dealt.mapInPandas(run, "word string, n_near long, near string, near_n long")


def near_words(words: DataFrame, group: int = GROUP, middle: int = MIDDLE) -> DataFrame:
    """(word, n_near, near, near_n) of every word of ``words`` (word, n) with near words: how many, and
    the one with the greatest n (ties: least in code-point order)."""
    rows = words.select(F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)).alias("longest"),
                        F.lit(0).alias("front"), F.lit("").alias("shared"), F.col("word").alias("middle"), "n")
    found = None
    while True:
        rows = cut_lineage(_split(rows), "frames")
        size = F.col("longest") - F.char_length("shared")
        of = rows.groupBy(*FRAME).agg(F.count(F.lit(1)).alias("c")).where(size > 1)
        again = cut_lineage(of.where((F.col("c") > group) | ((size > middle) & (F.col("c") > 1))).select(*FRAME), "wide-frames")
        more = not again.isEmpty()
        ready = (rows.join(again, FRAME, "left_anti") if more else rows).where(size <= middle)
        scanned = cut_lineage(_scanned(ready), "near")
        found = scanned if found is None else found.unionByName(scanned)
        if not more:
            break
        rows = rows.join(again, FRAME, "left_semi")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return out.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def follow(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that forms lead to.  Each round doubles the steps."""
    at = cut_lineage(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not at.where("moved").isEmpty():
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = cut_lineage(at.select("word", "root").join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return at.select("word", "root")


def group_spellings(docs: DataFrame, min_chars: int = 5, min_count: int = 3, factor: int = 2, slip_one_in: int = 97) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.  The form is the near word of greatest n (ties: least in
    code-point order), if that n is at least ``factor`` times the word's own."""
    if factor < 2:
        raise ValueError("factor must be at least 2: forms must lead to ever more frequent words")
    words = cut_lineage(vocabulary(docs, min_chars, min_count, slip_one_in), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    lead = F.col("near_n") >= factor * F.col("n")
    formed = cut_lineage(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                     F.when(lead, F.col("near")).alias("form"), F.when(lead, F.col("near_n")).alias("form_n")), "formed")
    roots = follow(formed.where("form is not null").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


__all__ = ["group_spellings", "vocabulary", "near_words", "follow", "near_middles"]
