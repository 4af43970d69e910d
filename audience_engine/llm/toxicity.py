"""Toxic passages by maximum-scoring segments.

Tokens are words; each word takes the score of the longest of its prefixes (or itself) in a
lexicon of log-odds between toxic and other documents.  Log-odds are smoothed by a Dirichlet
prior, the share of the token in both classes together, and kept where the odds of
document counts are significant (z score).  Words outside the lexicon score the
log-odds of not being in it, a little below zero.

Scores are log-likelihood ratios, so a linear scan (all maximal scoring segments) finds the
passages, and the best segment of a harmless document of n words follows an extreme-value law:
P(M >= m) = 1 - exp(-K n exp(-lambda m)).  K and lambda are fitted to the harmless learning
documents.  A passage is significant if its expected number by chance is below ``E_VALUE``; a
document's score is a logistic function of the log p-value of its best passage, also fitted.

Learning uses at most about ``SAMPLE`` labelled rows, drawn by a hash of the id (a documented
bound; their ids and labels, some hundred kB, are all that is broadcast).  The lexicon has
``LEXICON`` entries at most, those of the largest z.  Scoring is one pass without a shuffle.

Defined cases: null text counts as empty and is scored like a text without toxic words;
documents with several labels count as toxic if any label says so; null labels don't count;
without labels, or with fewer than ``LEAST_DOCS`` toxic learning documents, every score is 0; repeated
rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, remainder

FOLD, HELD = 5, 0
SAMPLE = 40_000
LEXICON = 20_000
#: Words of the lexicon: prefixes of these lengths, and whole words.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Weight of the prior, in tokens and in documents; least z score, least number of toxic documents.
PRIOR_TOKENS, PRIOR_DOCS = 2000.0, 30.0
LEAST_Z, LEAST_DOCS = 3.5, 4
E_VALUE = 0.01
WORD = re.compile(r"[^\W\d_]+")
KNOWN = 200_000


def _features(word: str) -> list[str]:
    return [word[:n] for n in PREFIXES if n <= len(word)] + [word + "$"]


def segments(hits: list[tuple[int, float]], n: int, miss: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, word after the last, score) of n words, given the
    scored words in order; every other word scores ``miss`` < 0.  Linear: each segment is merged once."""
    stack: list[list[float]] = []  # start, end, sum before, sum at the end, index of the last one with a smaller sum before
    total, at = 0.0, 0
    for pos, score in hits:
        total += miss * (pos - at)
        low, total, at = total, total + score, pos + 1
        if score <= 0:
            continue
        start, high = pos, total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = int(stack[j][4])
            if j < 0 or stack[j][3] >= high:
                stack.append([start, pos + 1, low, high, j])
                break
            start, low = int(stack[j][0]), stack[j][2]
            del stack[j:]
    return [(int(s), int(e), hi - lo) for s, e, lo, hi, _ in stack]


class _Scores(dict):
    """Word to score, None if outside the lexicon; forgets all when it is full."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float | None:
        out = None
        for f in reversed(_features(word)):
            if f in self.lexicon:
                out = self.lexicon[f]
                break
        if len(self) >= KNOWN:
            self.clear()
        self[word] = out
        return out


def _best(text: str, scores: _Scores, miss: float) -> tuple[int, list[tuple[int, int, float]]]:
    words = WORD.findall(text.lower())
    hits = [(i, s) for i, w in enumerate(words) if (s := scores[w]) is not None]
    return len(words), segments(hits, len(words), miss) if hits else []


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of the labelled learning rows."""
    own = labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    own = own.where(remainder("doc_id", FOLD) != HELD).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, SAMPLE / max(own.count(), 1))
    drawn = own.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    return documents(docs).join(F.broadcast(drawn), "doc_id")


def _lexicon(sample: DataFrame) -> tuple[dict[str, float], float]:
    """Scores of the significant tokens, and the score of any other word."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words: list[Counter] = [Counter(), Counter()]
            docs: list[Counter] = [Counter(), Counter()]
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                found = Counter(WORD.findall(text.lower()))
                words[toxic].update(found)
                docs[toxic].update({f for w in found for f in _features(w)})
            tokens: list[Counter] = [Counter(), Counter()]
            for y in (0, 1):
                for w, k in words[y].items():
                    for f in _features(w):
                        tokens[y][f] += k
            keys = list(tokens[0].keys() | tokens[1].keys())
            yield pd.DataFrame({"token": pd.Series(keys, dtype=object), **{f"{n}{y}": [c[y][k] for k in keys] for n, c in (("t", tokens), ("d", docs)) for y in (0, 1)}})
            yield pd.DataFrame({"token": [""], "t0": [sum(words[0].values())], "t1": [sum(words[1].values())],
                                "d0": [int((b["toxic"] == 0).sum())], "d1": [int((b["toxic"] != 0).sum())]})

    flat = sample.select("text", (F.col("toxic") != 0).cast("int").alias("toxic")).mapInPandas(run, "token string, t0 long, t1 long, d0 long, d1 long")
    counts = flat.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("t0", "t1", "d0", "d1")])
    counts = counts.where((F.col("d1") >= LEAST_DOCS) & ((F.col("d1") > 0.02 * F.col("d0")) | (F.col("token") == "")))
    all_of = counts.where("token = ''").first()
    if all_of is None or not all_of["d1"] or not all_of["d0"]:
        return {}, 0.0
    t0, t1, d0, d1 = all_of["t0"], all_of["t1"], all_of["d0"], all_of["d1"]

    def odds(y1, n1, y0, n0, weight):
        prior = weight * (y1 + y0) / F.lit(float(n1 + n0))
        # one more of each, for tokens that every document has
        rest1, rest0 = n1 + weight + 1 - y1 - prior, n0 + weight + 1 - y0 - prior
        return F.log((y1 + prior) / rest1) - F.log((y0 + prior) / rest0), 1 / (y1 + prior) + 1 / (y0 + prior)

    by_doc, variance = odds(F.col("d1").cast("double"), d1, F.col("d0").cast("double"), d0, PRIOR_DOCS)
    by_token, _ = odds(F.col("t1").cast("double"), t1, F.col("t0").cast("double"), t0, PRIOR_TOKENS)
    kept = counts.where("token != ''").select("token", "t0", "t1", (by_doc / F.sqrt(variance)).alias("z"), by_token.alias("score"))
    rows = kept.where((F.col("z") >= LEAST_Z) & (F.col("score") > 0.5)).orderBy(F.desc("z"), "token").limit(LEXICON).collect()
    lexicon = {r["token"]: float(r["score"]) for r in rows}
    heads = [r for r in rows if not any(r["token"][:n] in lexicon for n in PREFIXES if n < len(r["token"].rstrip("$")))]
    in1, in0 = (min(0.9, sum(r[k] for r in heads) / max(t, 1)) for k, t in (("t1", t1), ("t0", t0)))
    return lexicon, min(-0.005, math.log((1 - in1) / (1 - in0)))


def _gumbel(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Maximum likelihood (lambda, K) of P(M < m) = exp(-K n exp(-lambda m)), by a grid over lambda."""
    found, top = (1.0, 1.0), -np.inf
    for lam in np.linspace(0.1, 2.0, 39):
        y = n * np.exp(-lam * best)
        k = len(best) / y.sum()
        fit = np.sum(np.log(k * n * lam) - lam * best) - k * y.sum()
        if fit > top:
            found, top = (float(lam), float(k)), fit
    return found


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method with a small ridge."""
    w = np.zeros(2)
    a = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (y - p) - 1e-3 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame) -> dict:
    sample = _sample(docs, labels)
    lexicon, miss = _lexicon(sample)
    if not lexicon:
        return {"lexicon": {}, "miss": -0.01, "lam": 1.0, "k": 1.0, "slope": 0.0, "at": -30.0}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = _Scores(lexicon)
        for b in batches:
            got = [_best(t, scores, miss) for t in b["text"]]
            yield pd.DataFrame({"toxic": b["toxic"], "n": [max(n, 1) for n, _ in got], "best": [max((s[2] for s in f), default=0.0) for _, f in got]})

    fits = sample.select("text", (F.col("toxic") != 0).cast("int").alias("toxic")).mapInPandas(run, "toxic int, n long, best double").toPandas()
    best, n, y = fits["best"].to_numpy(), fits["n"].to_numpy(dtype=float), fits["toxic"].to_numpy(dtype=float)
    lam, k = _gumbel(best[(y == 0) & (best > 0)], n[(y == 0) & (best > 0)]) if ((y == 0) & (best > 0)).sum() >= 20 else (1.0, 0.1)
    model = {"lexicon": lexicon, "miss": miss, "lam": lam, "k": k}
    slope, at = _logistic(evidence(best, n, model), y)
    return model | {"slope": max(slope, 0.0), "at": at}


def evidence(best: np.ndarray, n: np.ndarray, model: dict) -> np.ndarray:
    """Minus the log p-value of the best segment, at most 50; 0 without any segment."""
    e = model["k"] * np.maximum(n, 1) * np.exp(-model["lam"] * best)
    return np.where(best > 0, np.minimum(-np.log(np.maximum(-np.expm1(-e), 1e-30)), 50.0), 0.0)


PASSAGE = "array<struct<start:int,end:int,score:double,e_value:double>>"


def score_toxicity(docs: DataFrame, labels: DataFrame, model: dict | None = None) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, passages (characters, end exclusive, of every significant segment)."""
    model = train(docs, labels) if model is None else model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = _Scores(model["lexicon"])
        for b in batches:
            best, sizes, passages = [], [], []
            for text in b["text"]:
                n, found = _best(text, scores, model["miss"])
                best.append(max((s[2] for s in found), default=0.0))
                sizes.append(n)
                strong = [(s, e, x, v) for s, e, x in found if (v := model["k"] * n * math.exp(-model["lam"] * x)) < E_VALUE]
                if strong:
                    places = [m.span() for m in WORD.finditer(low)] if len(low := text.lower()) == len(text) else [m.span() for m in WORD.finditer(text)]
                    strong = [(places[s][0], places[min(e, len(places)) - 1][1], x, v) for s, e, x, v in strong if s < len(places)]
                passages.append([{"start": s, "end": e, "score": x, "e_value": v} for s, e, x, v in strong])
            x = evidence(np.array(best, dtype=float), np.array(sizes, dtype=float), model)
            p = 1 / (1 + np.exp(-np.clip(model["slope"] * x + model["at"], -30, 30))) if model["lexicon"] else np.zeros(len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": p, "predicted": (p >= 0.5).astype(np.int32), "passages": passages})

    kind = dict(docs.dtypes)["doc_id"]
    out = documents(docs).mapInPandas(run, f"doc_id {kind}, score double, predicted int, passages {PASSAGE}")
    held = F.coalesce(remainder("doc_id", FOLD) == HELD, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", "passages")


__all__ = ["score_toxicity", "train", "segments", "evidence"]
