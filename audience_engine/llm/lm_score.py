"""Language-model scores: a gated recurrent model over corpus counts.

1. Token counts of all learning documents, combined in the tasks first, are a written table.
   The ``DICTIONARY`` most frequent words travel with the tasks; all others are met by a join.
2. The vocabulary is factored: the ``HEADS`` most frequent words are symbols of their own in
   classes; the other dictionary words are middle words in ``GROUPS`` groups (clustered by the
   frequent words they occur with in all learning documents, counted in the tasks and summed by word); the rest, unseen words included, is the rare class.  Inside a middle
   group a word has its share of the group's tokens, inside the rare class (c + 1) / (tokens + types + 1).
   Unseen words count as one type, as in the base score, so the shares of all types add up to one.
3. The recurrent model (``gru.py``) learns from all learning documents, all alike.  These are dealt
   into parts of about ``PART_TOKENS`` tokens by a hash of id and text.  In each of two rounds every part is put in order
   and learned from the same start in steps of ``STEP`` documents, and the parameters of the round's parts are averaged,
   weighted by their tokens.  The first round has one part in ``FIRST`` and starts from the counts, the second has the others
   and starts from the first one's average at a lower rate: each document is learned from once.  Where one part holds
   all, both rounds learn from it.  So the model depends on the rows alone, not on files, partitions or cores, and counts,
   group sizes and the learning of the model grow with the input.
4. Scoring carries the state through whole documents.  What rare words add to the base score and
   to the model's score is summed by document after the join with their counts.

Defined cases: null text counts as empty and has the end token only; rows that repeat a doc_id and
a text are scored each; a null doc_id never counts as held out; without learning tokens every
score is the base score (0); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gru
from .common import cut_lineage, documents, remainder
from .near_dedup import words

FOLD, HELD = 7, 2
DICTIONARY, HEADS, GROUPS, CLASS_WORDS = 65_536, 2_048, 8, 64
#: Words whose occurrence beside a word decides its group.
CONTEXT = 64
#: One part in so many is learned in the first round.
FIRST = 8
#: Tokens of a part, the most parts (beyond, parts grow), and the documents of a learning step.
PART_TOKENS, MOST_PARTS, STEP = 2_000_000, 32_768, 2_000
#: Words a task counts before it hands them on.
HOLD = 500_000
END = ""


def _token_counts(learning: DataFrame) -> DataFrame:
    """(word, c) over all learning documents; the end token is the empty word."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for b in batches:
            for text in b["text"]:
                held.update(words(text))
                held[b""] += 1
                if len(held) > HOLD:
                    yield _words_frame(held)
                    held = Counter()
        yield _words_frame(held)

    return learning.select("text").mapInPandas(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _words_frame(held: Counter) -> pd.DataFrame:
    # object, not Arrow strings: those may come in chunks, which Spark's batches can't hold
    return pd.DataFrame({"word": pd.Series([w.decode("utf-8", "replace") for w in held], dtype=object), "c": list(held.values())})


class Vocabulary:
    """Numbers of dictionary words, their counts, symbols and classes."""

    def __init__(self, top: list[tuple[str, int]], n: int, v: int, c_end: int):
        self.n, self.v, self.c_end = n, v, c_end
        self.counts = np.array([c for _, c in top], dtype=np.int64)
        self.number = {w.encode("utf-8"): i for i, (w, _) in enumerate(top)}
        self.heads = min(HEADS, len(top))
        self.n_rare, self.v_rare = n - int(self.counts.sum()) - c_end, v - len(top) - (1 if c_end else 0)
        self.group = np.zeros(len(top), dtype=np.int64)

    def numbers(self, text: str) -> np.ndarray:
        """Dictionary numbers of the words, -1 if they aren't in it."""
        get = self.number.get
        w = words(text)
        return np.fromiter([get(x, -1) for x in w], dtype=np.int64, count=len(w))

    def cluster(self, near: np.ndarray, rounds: int = 10) -> None:
        """Groups of words by the most frequent words in their documents: how many have both."""
        near = np.sqrt(near / np.maximum(near.sum(axis=1, keepdims=True), 1))
        near -= near[near.sum(axis=1) > 0].mean(axis=0) if (near.sum(axis=1) > 0).any() else 0
        near /= np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)
        chosen, far = [0], 1 - near @ near[0]
        while len(chosen) < min(GROUPS, len(near)):
            chosen.append(int(far[:self.heads].argmax()))
            far = np.minimum(far, 1 - near @ near[chosen[-1]])
        centres = near[chosen]
        for _ in range(rounds):
            self.group = (near @ centres.T).argmax(axis=1)
            centres = np.stack([(near * self.counts[:, None])[self.group == g].sum(axis=0) if (self.group == g).any() else centres[g] for g in range(len(centres))])
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)

    def factor(self) -> None:
        """Symbols and classes: frequent words by group and frequency, then the groups, rare, end."""
        order = np.lexsort((-self.counts[:self.heads], self.group[:self.heads]))
        self.symbol = np.empty(len(self.counts) + 1, dtype=np.int32)
        self.symbol[order] = np.arange(self.heads)
        self.symbol[self.heads:-1] = self.heads + self.group[self.heads:]
        self.rare, self.end = self.heads + GROUPS, self.heads + GROUPS + 1
        self.symbol[-1] = self.rare  # number -1
        self.class_of, c = np.zeros(self.end + 1, dtype=np.int64), -1
        last, size = None, 0
        for s in range(self.heads):
            g = self.group[order[s]]
            if g != last or size >= CLASS_WORDS:
                c, last, size = c + 1, g, 0
            self.class_of[s] = c
            size += 1
        self.class_of[self.heads:] = c + 1 + np.arange(GROUPS + 2)
        self.n_classes = c + 1 + GROUPS + 2
        own = np.bincount(self.group[self.heads:], weights=self.counts[self.heads:], minlength=GROUPS)
        self.weights = np.concatenate([self.counts[order], own, [self.n_rare, self.c_end]]).astype(float)
        # shares inside the middle groups, natural logarithm
        self.inside = np.zeros(len(self.counts) + 1)
        self.inside[self.heads:-1] = np.log(self.counts[self.heads:] / own[self.group[self.heads:]])

    def symbols(self, numbers: np.ndarray) -> np.ndarray:
        return np.append(self.symbol[numbers], np.int32(self.end))


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _together(learning: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """For each dictionary word, how many learning documents have it and each of the ``CONTEXT`` most frequent words."""
    size = len(vocabulary.counts)
    columns = [f"c{i}" for i in range(min(CONTEXT, size))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        near = np.zeros((size, len(columns)), dtype=np.int64)
        for b in batches:
            for text in b["text"]:
                d = vocabulary.numbers(text)
                own = np.unique(d[d >= 0])
                beside = np.zeros(len(columns), dtype=np.int64)
                beside[own[own < len(columns)]] = 1
                near[own] += beside
        at = np.flatnonzero(near.any(axis=1))
        for i in range(0, len(at), 8192):
            k = at[i:i + 8192]
            yield pd.DataFrame({"number": k} | {c: near[k, j] for j, c in enumerate(columns)})

    out = np.zeros((size, CONTEXT), dtype=np.float32)
    if columns:
        rows = learning.select("text").mapInPandas(run, "number int, " + ", ".join(f"{c} long" for c in columns))
        found = rows.groupBy("number").agg(*[F.sum(c).alias(c) for c in columns]).select("number", F.array(*columns).alias("c"))
        for r in found.toLocalIterator():
            out[r["number"], :len(columns)] = r["c"]
    return out


def _averaged(learning: DataFrame, vocabulary: Vocabulary, start: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The parameters after both rounds."""
    parts = max(1, min(MOST_PARTS, -(-vocabulary.n // PART_TOKENS)))
    first = max(1, parts // FIRST)
    draw = F.xxhash64("doc_id", "text", F.lit(21))
    dealt = learning.select("text", "doc_id", draw.alias("draw"), F.pmod(draw, F.lit(parts)).cast("int").alias("part"))
    p = _round(dealt.where(F.col("part") < first), first, vocabulary, start, gru.RATE)
    rest = dealt.where(F.col("part") >= first) if parts > 1 else dealt
    return _round(rest, max(1, parts - first), vocabulary, p, gru.RATE / 4)


def _round(dealt: DataFrame, parts: int, vocabulary: Vocabulary, start: dict[str, np.ndarray], rate: float) -> dict[str, np.ndarray]:
    """Every part learns from the same start; the weighted mean of their parameters, in pieces."""
    piece = 8192
    slots = math.isqrt(parts - 1) + 1

    def pieces(part: int, p: dict[str, np.ndarray], n: int) -> pd.DataFrame:
        flat = _flat(p).astype(np.float64) * n
        k = range(0, len(flat), piece)
        return pd.DataFrame({"k": list(range(len(k))), "part": part, "n": n, "sums": [flat[i:i + piece] for i in k]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = gru.Output(vocabulary.class_of, vocabulary.heads)
        part, p, n, docs = None, start, 0, []

        def step() -> None:
            nonlocal p, n, docs
            if docs:
                p, n, docs = gru.learn(p, out, docs, rate), n + sum(len(d) for d in docs), []

        for b in batches:
            for own, text in zip(b["part"].tolist(), b["text"], strict=True):
                if own != part:
                    step()
                    if n:
                        yield pieces(part, p, n)
                    part, p, n = own, start, 0
                docs.append(vocabulary.symbols(vocabulary.numbers(text)))
                if len(docs) == STEP:
                    step()
        step()
        if n:
            yield pieces(part, p, n)

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        return pd.DataFrame({"k": [rows["k"].iat[0]], "part": [rows["part"].iat[0]], "n": [rows["n"].sum()], "sums": [np.sum(np.stack(rows["sums"].to_numpy()), axis=0)]})

    schema = "k int, part int, n long, sums array<double>"
    # a partition for each part: by hash, several would meet in one
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "draw", "doc_id", "text").select("part", "text")
    sums = dealt.mapInPandas(run, schema).withColumn("slot", F.col("part") % slots)
    # at most the square root of the parts in a group, twice
    rows = sums.groupBy("k", "slot").applyInPandas(lambda g: add(g), schema).groupBy("k").applyInPandas(lambda g: add(g), schema).collect()
    if not rows:
        return start
    rows.sort(key=lambda r: r["k"])
    return _shaped(np.concatenate([np.array(r["sums"]) / r["n"] for r in rows]), start)


def train(docs: DataFrame) -> tuple[Vocabulary, dict[str, np.ndarray] | None, DataFrame]:
    """The vocabulary, the model's parameters (None without learning tokens), and the written counts."""
    learning = documents(docs).where(F.coalesce(remainder("doc_id", FOLD), F.lit(0)) != HELD)
    counts = cut_lineage(_token_counts(learning), "token-counts")
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.col("word") == END, F.col("c"))).alias("e")).first()
    n, v, e = total["n"] or 0, total["v"] or 0, total["e"] or 0
    top = [(r["word"], r["c"]) for r in counts.where(F.col("word") != END).orderBy(F.desc("c"), "word").limit(DICTIONARY).collect()]
    vocabulary = Vocabulary(top, n, v, e)
    if not n:
        return vocabulary, None, counts
    if top:
        vocabulary.cluster(_together(learning, vocabulary))
    vocabulary.factor()
    p = gru.initial(vocabulary.class_of, vocabulary.weights, vocabulary.n_classes, vocabulary.heads)
    p = _averaged(learning, vocabulary, p)
    return vocabulary, p, counts


def score_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    vocabulary, p, counts = train(docs)
    n, v = vocabulary.n, vocabulary.v
    log_all = math.log10(n + v + 1)
    log_rare = math.log10(max(vocabulary.n_rare + vocabulary.v_rare + 1, 1))
    keyed = documents(docs).withColumn("h", F.xxhash64("text"))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = gru.Output(vocabulary.class_of, vocabulary.heads) if p is not None else None
        logs = np.append(np.log10(vocabulary.counts + 1.0), 0.0)
        for b in batches:
            numbers = [vocabulary.numbers(t) for t in b["text"]]
            base = np.array([logs[x].sum() for x in numbers]) + math.log10(vocabulary.c_end + 1)
            known = [int((x >= 0).sum()) + (vocabulary.c_end > 0) for x in numbers]
            rare = [int((x < 0).sum()) for x in numbers]
            score = base * 0
            if out is not None:
                inside = np.array([vocabulary.inside[x].sum() for x in numbers])
                score = (gru.score(p, out, [vocabulary.symbols(x) for x in numbers]) + inside) / math.log(10)
            yield pd.DataFrame({"doc_id": b["doc_id"], "h": b["h"], "n_tokens": [len(x) + 1 for x in numbers], "known": known, "rare": rare, "base": base, "score": score})

    scored = keyed.mapInPandas(run, f"doc_id {kind}, h long, n_tokens long, known long, rare long, base double, score double")

    def rare_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = vocabulary.number
        for b in batches:
            for at in range(0, len(b), 500):
                ids, hs, ws, fs = [], [], [], []
                part = b.iloc[at:at + 500]
                for d, h, text in zip(part["doc_id"].tolist(), part["h"].tolist(), part["text"], strict=True):
                    found = Counter([x for x in words(text) if x not in number])
                    ids += [d] * len(found)
                    hs += [h] * len(found)
                    ws += [x.decode("utf-8", "replace") for x in found]
                    fs += found.values()
                yield pd.DataFrame({"doc_id": pd.Series(ids, dtype=part["doc_id"].dtype), "h": hs, "word": pd.Series(ws, dtype=object), "f": fs})

    met = keyed.mapInPandas(rare_words, f"doc_id {kind}, h long, word string, f long")
    tail = counts.where(F.col("c") <= F.lit(int(vocabulary.counts.min()) if len(vocabulary.counts) else 0)).where(F.col("word") != END)
    # the empty word marks each row, so that repeated rows can be told from repeated words; it takes no part in the join
    marks = keyed.select("doc_id", "h", F.lit(END).alias("word"), F.lit(1).cast("long").alias("f"), F.lit(None).cast("long").alias("c"))
    joined = met.join(tail, "word", "left").select("doc_id", "h", "word", "f", "c").unionByName(marks)
    mark = F.col("word") == END
    sums = joined.groupBy("doc_id", "h").agg(
        F.sum(F.when(mark, F.col("f"))).alias("copies"), F.sum(F.when(~mark & F.col("c").isNotNull(), F.col("f"))).alias("known"),
        F.sum(F.when(~mark, F.col("f") * F.log10(F.coalesce("c", F.lit(0)) + 1))).alias("logs"))
    sums = sums.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), (F.coalesce("known", F.lit(0)) / F.col("copies")).cast("long").alias("more"),
                       (F.coalesce("logs", F.lit(0.0)) / F.col("copies")).alias("logs"))
    every = scored.join(sums, scored["doc_id"].eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")))
    base = F.col("base") + F.col("logs") - F.col("n_tokens") * F.lit(log_all)
    score = F.col("score") + F.col("logs") - F.col("rare") * F.lit(log_rare) if p is not None else base
    return every.select(
        "doc_id", F.coalesce(remainder("doc_id", FOLD) == HELD, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("known") + F.col("more")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"), score.alias("score"))


__all__ = ["score_documents", "train", "Vocabulary"]
