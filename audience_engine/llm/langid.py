"""Language ID by nearest centroids of TF-IDF character n-grams.

Each text is a normalised TF-IDF vector of hashed letter n-grams (1 to 3, with word edges).
Inverse document frequencies come from all learning rows.  Each language gets several
centroids: spherical k-means over all of its learning rows.  Their counts are written once; the
starts and every round are passes over that table, of which sums by language and n-gram come
back.  A text goes to the language of the centroid with the largest cosine; it is rejected if that cosine is far below
what the language's own learning rows have at that length.  Cosines rise with the number of different
n-grams, also those of unknown scripts, so each language has a floor per power of two of that
number: a low quantile over all its learning texts and their beginnings of 4 to 4,096 characters,
from counts of the cosines in steps of 1 / ``STEPS``.

Memory: texts are handled in slices of a bounded number of characters; the model is
``languages * CENTROIDS * BUCKETS`` floats and is carried in the task closure.

Defined cases: null text, or text without a letter: ``und``, score 0, rejected; no learning
rows: every text is ``und``; repeated rows are scored each; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, documents, drop_table, remainder

BUCKETS = 4096
CENTROIDS = 4
#: k-means rounds.
ROUNDS = 12
#: A text is rejected if its cosine is below this share of the floor: the quantile of the learning texts' cosines at its length.
REJECT_AT, QUANTILE = 0.5, 0.01
#: Lengths of the beginnings, classes of length, and texts that a class needs for a floor of its own.
BEGINNINGS = [1 << e for e in range(2, 13)]
CLASSES, LEAST = BUCKETS.bit_length(), 20
#: Steps between 0 and 1 in which cosines are counted.
STEPS = 1 << 13
#: Beginnings up to this length are handled as lists of n-grams, longer ones as rows of all ``BUCKETS``.
SHORT = 256
_LOGS = np.log1p(np.arange(256, dtype=np.float32))
#: Softness of the score.
TEMPERATURE = 0.05
#: Characters handled at once.
SLICE = 1 << 20
FOLD, HELD = 4, 2

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """For each code point its lower-case letter's code point, 0 for anything else."""
    global _letters
    if _letters is None:
        out = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _letters = out
    return _letters


def _slices(texts: list[str]) -> Iterator[tuple[int, int, str]]:
    """(first row, row after the last, joined) with at most SLICE characters unless one text is longer; long texts come in pieces."""
    start, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > SLICE:
            yield start, i, "\n".join(held)
            start, held, size = i, [], 0
        held.append(t)
        size += len(t) + 1
        if size > SLICE or len(held) >= 512:
            yield start, i + 1, "\n".join(held)
            start, held, size = i + 1, [], 0
    if held:
        yield start, len(texts), "\n".join(held)


def _hashed(codes: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, row * BUCKETS + bucket of the n-grams; codes are letters or 0."""
    a = codes.astype(np.uint64)
    mul = np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(52)  # 12 bits: BUCKETS
    key = a
    for order in (1, 2, 3):
        if order > 1:
            if len(a) < order:
                break
            key = key[:-1] * np.uint64(0x100000001B3) + a[order - 1:]
        m = len(key)
        live = a[:m] > 0  # grams start at a letter; later places may be word edges
        if order > 1:
            live &= rows[:m] == rows[order - 1:]
        h = ((key[live] + np.uint64(order)) * mul) >> shift
        yield rows[:m][live] * BUCKETS + h.astype(np.int64)


def _grams(codes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Counts (n x BUCKETS) of the hashed n-grams."""
    out = np.zeros(n * BUCKETS, dtype=np.float32)
    for flat in _hashed(codes, rows):
        out += np.bincount(flat, minlength=n * BUCKETS).astype(np.float32)
    return out.reshape(n, BUCKETS)


def gram_counts(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row after the last, counts) for slices of the texts; every character counts."""
    table = _letter_table()
    for first, last, joined in _slices(texts):
        n = last - first
        total = np.zeros((n, BUCKETS), dtype=np.float32)
        row0 = 0
        for at in range(0, max(len(joined), 1), SLICE):
            piece = joined[at:at + SLICE]
            # two characters of the next piece, so no n-gram is lost at the seam
            raw = np.frombuffer((piece + joined[at + SLICE:at + SLICE + 2]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            rows = np.cumsum(raw == 10).astype(np.int64)
            if n == 1:
                rows[:] = 0
            else:
                rows += row0
            codes = table[raw]
            keep = len(piece)
            counts = _grams(codes, np.minimum(rows, n - 1), n)
            if len(raw) > keep:  # the seam is counted with the next piece
                counts -= _grams(codes[keep:], np.minimum(rows[keep:], n - 1), n)
            total += counts
            row0 = int(rows[keep - 1]) if keep else row0
        yield first, last, total


def _split_rows(texts: list[str]) -> list[str]:
    """Line breaks inside a text become spaces: they part the texts of a slice."""
    return [t.replace("\n", " ") for t in texts]


def vectors(texts: list[str], idf: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, unit TF-IDF vectors, whether the text has a letter)."""
    for first, last, counts in gram_counts(_split_rows(texts)):
        has = counts.sum(axis=1) > 0
        v = np.log1p(counts) * idf
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        yield first, last, v / np.maximum(norm, 1e-9), has


def _learning(docs: DataFrame) -> DataFrame:
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    return rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(remainder("doc_id", FOLD), F.lit(0)) != HELD))


def _counted(learning: DataFrame) -> DataFrame:
    """Per learning row with a letter: lang, order (null ids last, then the id and the text's hash), and its counts as
    bits of the buckets, bytes and those of 255 and more in full."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first, last, counts in gram_counts(_split_rows(b["text"].tolist())):
                has = counts.sum(axis=1) > 0
                held = [c[c > 0] for c in counts[has]]
                part = b.iloc[first:last][has]
                yield pd.DataFrame({
                    "lang": part["lang"], "id": part["id"], "h": part["h"],
                    "bits": [x.tobytes() for x in np.packbits(counts[has] > 0, axis=1)],
                    "low": [np.minimum(c, 255).astype(np.uint8).tobytes() for c in held],
                    "high": [c[c >= 255].tobytes() for c in held]})

    # ids travel as text: pandas would turn whole numbers beside nulls into floats
    rows = learning.select("lang", F.col("doc_id").cast("string").alias("id"), F.xxhash64("text").alias("h"), "text")
    counted = rows.mapInPandas(run, "lang string, id string, h long, bits binary, low binary, high binary")
    none = F.col("id").isNull().alias("none")
    return counted.select("lang", F.struct(none, F.col("id").cast(dict(learning.dtypes)["doc_id"]).alias("id"), "h").alias("order"), "bits", "low", "high")


def _frequencies(counted: DataFrame) -> np.ndarray:
    """Documents of each bucket, over all learning rows: summed per partition, then per bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for at in range(0, len(b), 512):
                seen += _cells(b.iloc[at:at + 512]).sum(axis=0, dtype=np.int64)
        yield pd.DataFrame({"bucket": np.arange(BUCKETS), "n": seen})

    df = np.zeros(BUCKETS, dtype=np.int64)
    for r in counted.select("bits").mapInPandas(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r["bucket"]] = r["n"]
    return df


def _cells(b: pd.DataFrame) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(b["bits"]), dtype=np.uint8).reshape(len(b), BUCKETS // 8), axis=1)


def _unit(b: pd.DataFrame, idf: np.ndarray) -> np.ndarray:
    """The unit vectors of counted rows."""
    at = np.flatnonzero(_cells(b).view(bool))
    low = np.frombuffer(b"".join(b["low"]), dtype=np.uint8)
    w = _LOGS[low]
    w[low == 255] = np.log1p(np.frombuffer(b"".join(b["high"]), dtype=np.float32))
    w *= idf[at % BUCKETS]
    sizes = np.array([len(x) for x in b["low"]])  # none is 0: every row has a letter
    norm = np.sqrt(np.add.reduceat(w * w, np.cumsum(sizes) - sizes))
    v = np.zeros(len(b) * BUCKETS, dtype=np.float32)
    v[at] = w / np.repeat(np.maximum(norm, 1e-9), sizes)
    return v.reshape(len(b), BUCKETS)


def _by_language(b: pd.DataFrame, most: int = 512) -> Iterator[tuple[str, pd.DataFrame]]:
    """Slices of one language and at most ``most`` rows."""
    for lang, rows in b.groupby("lang"):
        for at in range(0, len(rows), most):
            yield lang, rows.iloc[at:at + most]


def _starts(counted: DataFrame, idf: np.ndarray) -> dict[str, np.ndarray]:
    """Per language at most CENTROIDS rows: the first one, then those far from all chosen before."""
    picked = counted.groupBy("lang").agg(F.min(F.struct("order", "bits", "low", "high")).alias("top"))
    chosen: dict[str, np.ndarray] = {}
    for _ in range(CENTROIDS):
        found = {r["lang"]: _unit(pd.DataFrame([r["top"].asDict()]), idf) for r in picked.collect()}
        chosen = {x: np.concatenate([chosen[x], v]) if x in chosen else v for x, v in found.items()} | {x: v for x, v in chosen.items() if x not in found}
        known = chosen

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for lang, rows in _by_language(b):
                    far = (1 - _unit(rows, idf) @ known[lang].T).min(axis=1)
                    at = np.flatnonzero(far == far.max())  # the first of these in the order is chosen
                    out = rows.iloc[at]
                    yield pd.DataFrame({"lang": lang, "near": -far[at].astype(float), "none": out["none"], "id": out["id"], "h": out["h"], "bits": out["bits"], "low": out["low"], "high": out["high"]})

        kind = dict(counted.select("order.id").dtypes)["id"]
        flat = counted.select("lang", "order.none", F.col("order.id").cast("string").alias("id"), "order.h", "bits", "low", "high")
        far = flat.mapInPandas(run, "lang string, near double, none boolean, id string, h long, bits binary, low binary, high binary")
        # a language with no more rows than centroids has each of them once
        picked = far.groupBy("lang").agg(F.min(F.struct("near", "none", F.col("id").cast(kind).alias("id"), "h", "bits", "low", "high")).alias("top"))
    return chosen


def _spherical_kmeans(counted: DataFrame, idf: np.ndarray, centres: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Rounds over all learning rows: each row joins its nearest centroid, the sums come back by language and bucket."""
    columns = [f"s{i}" for i in range(CENTROIDS)]
    for _ in range(ROUNDS):
        known = centres

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[str, np.ndarray] = {}
            for b in batches:
                for lang, rows in _by_language(b):
                    v = _unit(rows, idf)
                    near = (v @ known[lang].T).argmax(axis=1)
                    own = sums.setdefault(lang, np.zeros((CENTROIDS, BUCKETS)))
                    for c in np.unique(near):
                        own[c] += v[near == c].sum(axis=0, dtype=np.float64)
            for lang, own in sums.items():
                at = np.flatnonzero(own.any(axis=0))
                yield pd.DataFrame({"lang": lang, "bucket": at} | {c: own[i, at] for i, c in enumerate(columns)})

        rows = counted.select("lang", "bits", "low", "high").mapInPandas(run, "lang string, bucket int, " + ", ".join(f"{c} double" for c in columns))
        total = {x: np.zeros((CENTROIDS, BUCKETS)) for x in known}
        for r in rows.groupBy("lang", "bucket").agg(*[F.sum(c).alias(c) for c in columns]).collect():
            total[r["lang"]][:, r["bucket"]] = [r[c] for c in columns]
        centres = {}
        for lang, own in known.items():
            sums = total[lang][:len(own)]
            sums = np.where(sums.any(axis=1, keepdims=True), sums, own)  # a centroid without rows stays
            centres[lang] = (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        if all(np.array_equal(centres[x], known[x]) for x in known):
            break
    return centres


def _length_class(v: np.ndarray) -> np.ndarray:
    """The power of two of each vector's number of different n-grams."""
    return np.log2(np.maximum((v > 0).sum(axis=1), 1)).astype(int)


def _short_cosines(texts: list[str], idf: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest cosine and the class of length of each short text that has a letter, without rows of all buckets."""
    raw = np.frombuffer("\n".join(_split_rows(texts)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rows = np.cumsum(raw == 10).astype(np.int64)
    flat = [np.zeros(0, dtype=np.int64), *_hashed(_letter_table()[raw], rows)]
    flat, counts = np.unique(np.concatenate(flat), return_counts=True)
    row, bucket = flat // BUCKETS, flat % BUCKETS
    w = np.log1p(counts) * idf[bucket]
    norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(texts)))
    cosine = np.max([np.bincount(row, weights=w * c[bucket], minlength=len(texts)) for c in centres], axis=0) / np.maximum(norm, 1e-9)
    size = np.bincount(row, minlength=len(texts))
    return cosine[size > 0], np.log2(size[size > 0]).astype(int)


def _add(counts: np.ndarray, cosine: np.ndarray, classes: np.ndarray) -> None:
    """Counts the cosines in CLASSES x (STEPS + 1)."""
    np.add.at(counts, (classes, np.rint(np.clip(cosine, 0, 1) * STEPS).astype(np.int64)), 1)


def _count_vectors(counts: np.ndarray, v: np.ndarray, centres: np.ndarray) -> None:
    _add(counts, (v @ centres.T).max(axis=1), _length_class(v))


def _count_beginnings(counts: np.ndarray, texts: list[str], idf: np.ndarray, centres: np.ndarray) -> None:
    for size in BEGINNINGS:
        part = [t[:size] for t in texts if len(t) > size]
        if size <= SHORT:
            for at in range(0, len(part), 2048):
                _add(counts, *_short_cosines(part[at:at + 2048], idf, centres))
        else:
            for _, _, v, has in vectors(part, idf):
                _count_vectors(counts, v[has], centres)


def _low(counts: np.ndarray) -> list[float]:
    """The low quantile of the counted cosines in each class of length; it never falls with the length."""
    size, low = counts.sum(axis=1), np.zeros(CLASSES)
    for c in range(CLASSES):
        # a class with few texts takes those of shorter classes; without any, nothing is rejected
        at = next((d for d in range(c, 0, -1) if size[d:c + 1].sum() >= LEAST), 0)
        upto = np.cumsum(counts[at:c + 1].sum(axis=0))
        if upto[-1]:
            place = QUANTILE * (upto[-1] - 1)
            below, above = np.searchsorted(upto, [np.floor(place), np.ceil(place)], side="right") / STEPS
            low[c] = below + (above - below) * (place - np.floor(place))
    return np.minimum.accumulate(low[::-1])[::-1].tolist()


def _floors(texts: list[str], idf: np.ndarray, centres: np.ndarray) -> list[float]:
    """The floors of a language that has these texts only."""
    counts = np.zeros((CLASSES, STEPS + 1), dtype=np.int64)
    for _, _, v, has in vectors(texts, idf):
        _count_vectors(counts, v[has], centres)
    _count_beginnings(counts, texts, idf, centres)
    return _low(counts)


def _all_floors(learning: DataFrame, counted: DataFrame, idf: np.ndarray, centres: dict[str, np.ndarray]) -> dict[str, list[float]]:
    """The floors of every language, from all its learning rows: counts per task, summed by language, class and step."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, rows in _by_language(b):
                if lang in centres:
                    own = held.setdefault(lang, np.zeros((CLASSES, STEPS + 1), dtype=np.int64))
                    if "text" in rows:
                        _count_beginnings(own, rows["text"].tolist(), idf, centres[lang])
                    else:
                        _count_vectors(own, _unit(rows, idf), centres[lang])
        for lang, own in held.items():
            cls, step = np.nonzero(own)
            yield pd.DataFrame({"lang": lang, "cls": cls, "step": step, "n": own[cls, step]})

    schema = "lang string, cls int, step int, n long"
    whole = counted.select("lang", "bits", "low", "high").mapInPandas(run, schema)
    both = whole.unionByName(learning.select("lang", "text").mapInPandas(run, schema))
    summed = both.groupBy("lang", "cls", "step").agg(F.sum("n").alias("n"))

    def low(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((CLASSES, STEPS + 1), dtype=np.int64)
        counts[rows["cls"], rows["step"]] = rows["n"]
        return pd.DataFrame({"lang": [rows["lang"].iat[0]], "floor": [_low(counts)]})

    return {r["lang"]: r["floor"] for r in summed.groupBy("lang").applyInPandas(low, "lang string, floor array<double>").collect()}


def train(docs: DataFrame) -> dict:
    """idf, the centroids with their languages, and the floors of each language's cosines."""
    learning = _learning(docs)
    n = learning.count()
    if n == 0:
        return {"idf": np.ones(BUCKETS, dtype=np.float32), "langs": [], "of": np.zeros(0, dtype=int), "centres": np.zeros((0, BUCKETS), dtype=np.float32), "floor": []}
    counted = cut_lineage(_counted(learning), "language-counts")
    idf = (np.log((n + 1) / (_frequencies(counted) + 1)) + 0.05).astype(np.float32)
    centres = _spherical_kmeans(counted, idf, _starts(counted, idf))
    floors = _all_floors(learning, counted, idf, centres)
    drop_table(counted)
    langs = sorted(centres)
    found = [(i, c) for i, x in enumerate(langs) for c in sorted(centres[x].tolist())]
    return {"idf": idf, "langs": langs, "of": np.array([i for i, _ in found], dtype=int),
            "centres": np.array([c for _, c in found], dtype=np.float32).reshape(len(found), BUCKETS),
            "floor": np.array([floors[x] for x in langs])}


def identify(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, cosine, rejected."""
    model = train(docs) if model is None else model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, of, centres = model["langs"], model["of"], model["centres"]
        for b in batches:
            out = pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": "und", "score": 0.0, "cosine": 0.0, "rejected": True})
            if langs:
                pred, score, cosine, bad = out["lang_pred"].tolist(), np.zeros(len(b)), np.zeros(len(b)), np.ones(len(b), dtype=bool)
                for first, last, v, has in vectors(b["text"].tolist(), model["idf"]):
                    by_centre = v @ centres.T
                    best = np.stack([by_centre[:, of == i].max(axis=1) for i in range(len(langs))], axis=1)
                    soft = np.exp((best - best.max(axis=1, keepdims=True)) / TEMPERATURE)
                    top = best.argmax(axis=1)
                    low = best.max(axis=1) < REJECT_AT * model["floor"][top, _length_class(v)]
                    for j in np.flatnonzero(has):
                        i = first + j
                        pred[i], cosine[i] = langs[top[j]], best[j, top[j]]
                        score[i] = soft[j, top[j]] / soft[j].sum()
                        bad[i] = low[j]
                out = pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": pred, "score": score, "cosine": cosine, "rejected": bad})
            yield out

    kind = dict(docs.dtypes)["doc_id"]
    out = documents(docs).mapInPandas(run, f"doc_id {kind}, lang_pred string, score double, cosine double, rejected boolean")
    return out.select("doc_id", F.coalesce(remainder("doc_id", FOLD) == HELD, F.lit(False)).alias("held_out"), "lang_pred", "score", "cosine", "rejected")


__all__ = ["identify", "train", "vectors", "gram_counts"]
