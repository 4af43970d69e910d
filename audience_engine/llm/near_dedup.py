"""Near-duplicates by SetSketch registers.

A document's set is its distinct word shingles.  Each of ``REGISTERS`` registers holds, on an
exponentially spaced and truncated scale, the least of exponentially distributed hashes of
the set: sketches of parts merge by taking the larger register, and registers of similar sets
agree often.

1. Documents with the same set (same size and digest) form a class, and one text of each goes on.
2. Registers are banded; classes that agree in a band are candidates.  With 32 bands of 4, a
   pair at similarity 0.8 is missed with a chance below 1e-7.
3. In each bucket one class leads: the one that meets most others, the likely middle of a family.
   The buckets of one leader form a group, and all its classes are compared with the leader (a star, so
   the pairs grow with the rows).  Pairs are estimated jointly by likelihood from their registers and
   sizes, and those that can reach the threshold are verified on the full shingle sets.
4. Groups whose classes still lie in several components are searched for pairs across components.
   Where these are few for the rows of the group, they are met directly.  In the others, classes meet
   where they differ alike from the group's centre C, the shingles that more than half of its classes hold.
   With D(x) = the symmetric difference of x and C, D(x) and D(y) differ exactly as x and y do; so if x and
   y are linked, with |x| + |y| = s, the two differ in at most d = s (1 - t) / (1 + t) elements and share at
   least o = (|D(x)| + |D(y)| - d) / 2.  In any fixed order, their first common element
   is then among the first |D(x)| - o + 1 of D(x) and likewise of D(y): these
   prefixes are the keys of the join, and both positions its condition.  (Pairs with o <= 0 are near the
   centre: they meet the class nearest to it first, and one key that all near classes share.)  Differences come rarest first: those
   of less than a hundredth of the group, then the others by their number.  Two classes whose first common
   element is a popular one share no rare one, so with p rare and q popular elements they differ in at
   least p(x) + p(y) + |q(x) - q(y)|: a class takes popular keys only if that leaves a possible partner in another
   component of its group.  So the shingles that a family shares are never a key, and
   members that differ from the centre each in their own way never meet.
   Pairs also need parities (``BITS``) that differ in no more places than linked sets may in elements; the
   joins of this step leave the others out, so a family whose members are alike but not linked makes few pairs.
5. Classes whose keys are so popular that they would still make many pairs are compared
   in square blocks of at most ``BLOCK`` classes, so no task holds a large group.
6. Components come from the verified links.

So a link is lost only if no band agrees or the estimate is five standard errors off.

Texts travel to the verification of their pairs, for the classes in shared buckets only; hot groups and
hub classes are keys of plain joins, which AQE splits.  Intermediate tables are deleted on the way.

Defined cases: null text counts as empty; a document without words has an empty set and is its
own component; fewer words than a shingle: the whole sequence is the one shingle; rows that
repeat a doc_id are judged each by their text (classes have numbers of their own); a row with a null
id belongs to its text's group like others, but gives it no id: where no row of a group has one, the
component is null and its rows stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audience_engine.session import drop_tables, scratch_tables

from .common import cut_lineage, documents, drop_table, text_key, without
from .components import components

REGISTERS, BAND = 128, 4
#: Bits of a set, each the parity of the number of its elements that fall on it.
BITS = 1024
#: Base of the register scale, rate, and largest register value.
BASE, RATE, TOP = 1.001, 20.0, 32_000
#: Standard errors below the threshold at which an estimate rules a pair out.
MARGIN = 5.0
#: Pairs across components, for each row of a bucket, up to which they are met directly.
FEW = 16
#: A difference that more than one in so many classes of a group have is a popular one.
POPULAR = 100
#: Classes on a side of a block of a group that still has more then.
BLOCK = 256
#: The same where rows of differences meet, whose places leave few of the pairs.
FEW_ALIKE = 512
KNOWN = 500_000
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str) -> list[bytes]:
    """A-Z lower-cased, split at ASCII white space."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def shingle_set(text: str, k: int) -> set[tuple[bytes, ...]]:
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(k)], strict=False))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh3_64_intdigest(word)
        if len(self) >= KNOWN:
            self.clear()
        self[word] = out
        return out


def shingle_hashes(text: str, k: int, known: _WordHash) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted."""
    w = words(text)
    if not w:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter([known[x] for x in w], dtype=np.uint64, count=len(w))
    mul = np.uint64(0x9E3779B97F4A7C15)
    n = max(len(w) - k + 1, 1)
    out = np.full(n, min(k, len(w)), dtype=np.uint64)
    for i in range(min(k, len(w))):
        out = (out ^ h[i:i + n]) * mul
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _multipliers(m: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, size=m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(hashes: np.ndarray, mul: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    least = np.full(len(mul), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 512):
        least = np.minimum(least, (mul[:, None] * hashes[None, at:at + 512]).min(axis=1))
    # of exponentially distributed values, the least belongs to the least hash
    x = -np.log1p(-(least.astype(np.float64) + 1) / 2.0**64 * (1 - 1e-15)) / RATE
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.int16)


def parities(hashes: np.ndarray) -> np.ndarray:
    """``BITS`` parities of a set of 64-bit hashes, as 64-bit numbers.  An element that only one of two sets has changes one
    bit, so the bits in which two sets differ are at most the elements in which they differ."""
    at = (hashes >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=BITS) & 1).astype(bool)).view(np.int64)


def _log_likelihood(j: np.ndarray, greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, m: int) -> np.ndarray:
    """Of the similarity j, from how many registers of a are greater or smaller than those of b, given both
    set sizes: a register of a is greater with the chance -log_base(1 - x (base - 1) / base), x = u - v j."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    scale = np.log(BASE)
    up = np.maximum(-np.log1p(-np.maximum(u - v * j, 0) * (BASE - 1) / BASE) / scale, 1e-12)
    down = np.maximum(-np.log1p(-np.maximum(v - u * j, 0) * (BASE - 1) / BASE) / scale, 1e-12)
    return greater * np.log(up) + smaller * np.log(down) + (m - greater - smaller) * np.log(np.maximum(1 - up - down, 1e-12))


def estimate(greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs.  The likelihood is concave: ternary search."""
    low, high = np.zeros(len(n_a)), np.minimum(n_a / n_b, n_b / n_a)
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        worse = _log_likelihood(a, greater, smaller, n_a, n_b, m) < _log_likelihood(b, greater, smaller, n_a, n_b, m)
        low, high = np.where(worse, a, low), np.where(worse, high, b)
    return (low + high) / 2


def can_reach(t: float, greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Whether ``estimate`` is at least t, without the search: the concave likelihood still rises at t."""
    return _log_likelihood(np.full(len(n_a), t + 1e-4), greater, smaller, n_a, n_b, m) >= _log_likelihood(
        np.full(len(n_a), t - 1e-4), greater, smaller, n_a, n_b, m)


def _floor(percent: int) -> float:
    t = percent / 100
    return t - MARGIN * (t * (1 - t) / REGISTERS) ** 0.5


def _sketched(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_sha256, n, digest of the set, registers, parities."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, mul = _WordHash(), _multipliers(REGISTERS)
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.iloc[at:at + 1000]
                sets = [shingle_hashes(t, k, known) for t in part["text"]]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "text_sha256": part["text_sha256"], "n": [len(s) for s in sets],
                    "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                    "regs": [sketch(s, mul) if len(s) else None for s in sets],
                    "bits": [parities(s) if len(s) else None for s in sets]})

    rows = documents(docs)
    kind = dict(rows.dtypes)["doc_id"]
    # ids travel as text: pandas would turn whole numbers beside nulls into floats
    named = rows.select(F.col("doc_id").cast("string").alias("doc_id"), text_key(rows).alias("text_sha256"), "text")
    out = named.mapInPandas(run, "doc_id string, text_sha256 string, n long, digest binary, regs array<short>, bits array<long>")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose registers and sizes allow the threshold."""
    one = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    two = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    rows = pairs.join(one, "a").join(two, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                ra, rb = np.stack(b["ra"].to_numpy()), np.stack(b["rb"].to_numpy())
                ok = can_reach(_floor(percent), (ra > rb).sum(axis=1), (ra < rb).sum(axis=1), b["na"].to_numpy(dtype=float), b["nb"].to_numpy(dtype=float))
                yield b.loc[ok, ["a", "b"]]

    kind = dict(pairs.dtypes)["a"]
    return rows.mapInPandas(run, f"a {kind}, b {kind}")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that their full shingle sets confirm.  Rows come sorted by a, whose set is kept."""
    one = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, own = None, set()
        for b in batches:
            keep = np.zeros(len(b), dtype=bool)
            for i, (x, ta, tb) in enumerate(zip(b["a"], b["ta"], b["tb"], strict=True)):
                if last is None or last != x:
                    last, own = x, shingle_set(ta, k)
                other = shingle_set(tb, k)
                both = len(own & other)
                keep[i] = 100 * both >= percent * (len(own) + len(other) - both)
            yield b.loc[keep, ["a", "b"]]

    kind = dict(pairs.dtypes)["a"]
    return pairs.join(two, "b").join(one, "a").mapInPandas(run, f"a {kind}, b {kind}")


def _measured(rows: DataFrame, few: int | None = None) -> DataFrame:
    """Rows of buckets that hold several components, with the largest one (``main``) and whether the pairs
    across components are few: at most ``few`` (``FEW``) for each row."""
    few = FEW if few is None else few
    by = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"))
    of = by.groupBy("bucket").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("sq"), F.max(F.struct("c", "component")).alias("top"))
    of = of.where(F.col("m") * F.col("m") > F.col("sq")).select(
        "bucket", F.col("top.component").alias("main"), F.col("m").alias("size"),
        (F.col("m") * F.col("m") - F.col("sq") <= 2 * few * F.col("m")).alias("few"))
    return rows.join(of, "bucket")


def _centres(members: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(bucket, m, e, c): per group its size, and the elements that more than m / ``POPULAR`` of its classes hold, with their
    number; sorted by element.  At most ``POPULAR`` times as many as a class has on average."""
    rows = members.select("bucket", "rep").join(texts.select("rep", "text"), "rep")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _WordHash()
        for b in batches:
            sets = [shingle_hashes(t, k, known).view(np.int64) for t in b["text"]]
            for bucket, at in b.groupby("bucket").indices.items():
                e, c = np.unique(np.concatenate([sets[i] for i in at]), return_counts=True)
                yield pd.DataFrame({"bucket": bucket, "e": e, "c": c})

    held = rows.select("bucket", "text").mapInPandas(run, "bucket long, e long, c long").groupBy("bucket", "e").agg(F.sum("c").alias("c"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"))
    often = held.join(sizes, "bucket").where(F.col("c") * POPULAR > F.col("m"))
    both = often.groupBy("bucket", "m").agg(F.array_sort(F.collect_list(F.struct("e", "c"))).alias("held"))
    return both.select("bucket", "m", F.col("held.e").alias("e"), F.col("held.c").alias("c"))


def _differences(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row (bucket, rep, component) the first elements of the set's difference from the centre, rarest first, as
    (bucket, rep, component, n, p, q, first): p of all are rare, q popular."""
    centres = cut_lineage(_centres(members, texts, k), "centres")
    rows = members.join(texts.select("rep", "text"), "rep").join(centres, "bucket")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, last, often, times, centre, m = _WordHash(), None, None, None, None, 0
        for b in batches:
            firsts, n, p, q = [], [], [], []
            for bucket, size, e, c, text in zip(b["bucket"], b["m"], b["e"], b["c"], b["text"], strict=True):
                if last is None or last != bucket:
                    last, m, often, times = bucket, size, np.asarray(e, dtype=np.int64), np.asarray(c, dtype=np.int64)
                    centre = often[2 * times > m]
                own = shingle_hashes(text, k, known).view(np.int64)
                differ = np.setxor1d(own, centre, assume_unique=True)
                at = np.minimum(np.searchsorted(often, differ), max(len(often) - 1, 0))
                listed = often[at] == differ if len(often) else np.zeros(len(differ), dtype=bool)
                rank = np.where(listed, np.minimum(times[at], m - times[at]) if len(often) else 0, 0)
                popular = rank * POPULAR > m
                rank[~popular] = 0
                firsts.append(differ[np.lexsort((differ, rank))][:len(own) * (100 - percent) // percent + 1])
                n.append(len(own))
                p.append(int((~popular).sum()))
                q.append(int(popular.sum()))
            yield pd.DataFrame({"bucket": b["bucket"], "rep": b["rep"], "component": b["component"], "n": n, "p": p, "q": q, "first": firsts})

    out = cut_lineage(rows.mapInPandas(run, "bucket long, rep long, component long, n long, p long, q long, first array<long>"), "differences")
    drop_table(centres)
    return out


def _keyed(differing: DataFrame, percent: int) -> DataFrame:
    """Rows of differences by element: (g, bucket of the element, rep, component, n, at, p, q), of which linked
    classes of different components share one."""
    by = differing.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"))
    main = by.groupBy("bucket").agg(F.max(F.struct("c", "component")).alias("top")).select("bucket", F.col("top.component").alias("main"))
    each = differing.join(main, "bucket")
    outside = F.col("component") != F.col("main")
    # per group the least p for each q, inside and outside the largest component
    least = each.groupBy("bucket", outside.alias("out"), "q").agg(F.min("p").alias("p"))
    others = least.groupBy("bucket").agg(F.collect_list(F.when(F.col("out"), F.struct("p", "q"))).alias("outer"), F.collect_list(F.struct("p", "q")).alias("any"))
    most = F.floor(F.col("n") * (100 - percent) / percent)
    partner = F.exists(F.when(outside, F.col("any")).otherwise(F.col("outer")), lambda o: F.col("p") + o["p"] + F.abs(F.col("q") - o["q"]) <= most)
    first = F.when(partner, F.col("first")).otherwise(F.slice("first", F.lit(1), F.col("p").cast("int")))
    kept = each.join(others, "bucket").select(F.col("bucket").alias("g"), "rep", "component", "n", "p", "q", (F.col("p") + F.col("q") <= most).alias("near"), first.alias("first"))
    found = kept.select("g", "rep", "component", "n", "p", "q", F.posexplode("first").alias("at", "e")).select(
        "g", F.xxhash64("g", "e").alias("bucket"), "rep", "component", "n", F.col("at").cast("long").alias("at"), "p", "q")
    near = kept.where("near").select("g", F.xxhash64("g", F.lit("near")).alias("bucket"), "rep", "component", "n", F.lit(0).cast("long").alias("at"), "p", "q")
    return found.union(near)


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs across components in buckets where they are few: what is outside the largest component meets the
    bucket.  Rows of differences (with at, p, q) meet only where linked pairs can meet first.  Pairs whose parities
    differ in more bits than the sets may in elements aren't linked, and the join leaves them out."""
    few = rows.where("few")
    words = [f"bits{i}" for i in range(BITS // 64)]
    few = few.select("*", *[F.col("bits")[i].alias(w) for i, w in enumerate(words)])
    placed = [c for c in ("at", "p", "q") if c in rows.columns]
    one = few.where("component != main").select("bucket", F.col("rep").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"),
                                                *[F.col(c).alias(f"{c}_x") for c in placed + words])
    two = few.select("bucket", F.col("rep").alias("y"), F.col("component").alias("cy"), F.col("n").alias("ny"),
                     *[F.col(c).alias(f"{c}_y") for c in placed + words])
    near = (one["bucket"] == two["bucket"]) & (F.col("cx") != F.col("cy")) & (F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent)
    apart = F.floor((F.col("nx") + F.col("ny")) * (100 - percent) / (100 + percent))
    near &= reduce(add, [F.bit_count(F.col(f"{w}_x").bitwiseXOR(F.col(f"{w}_y"))) for w in words]) <= apart
    if placed:
        more = F.col("p_x") + F.col("q_x") - F.col("p_y") - F.col("q_y")
        near &= (2 * F.col("at_x") <= more + apart) & (2 * F.col("at_y") <= apart - more)
        # a popular element that is the first in common: nothing rare is
        popular = (F.col("at_x") >= F.col("p_x")) & (F.col("at_y") >= F.col("p_y"))
        near &= ~popular | (F.col("p_x") + F.col("p_y") + F.abs(F.col("q_x") - F.col("q_y")) <= apart)
    return one.join(two, near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _in_blocks(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs across components in buckets where they are many: square blocks of at most ``BLOCK`` classes a
    side, of which only pairs that the estimate allows come out."""
    dealt = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    dealt = dealt.select("bucket", "i", "j", "own", "rep", "component").join(classes.select("rep", "n", "regs"), "rep")
    kind = dict(rows.dtypes)["rep"]

    def run(b: pd.DataFrame) -> pd.DataFrame:
        i, j = b["i"].iat[0], b["j"].iat[0]
        b = b.sort_values("rep")
        left, right = (b[b["own"] == i], b[b["own"] == j]) if i != j else (b, b)
        out = []
        if len(left) and len(right):
            regs, n, comp, rep = np.stack(right["regs"].to_numpy()), right["n"].to_numpy(dtype=float), right["component"].to_numpy(), right["rep"].to_numpy()
            for r, x, c, d in zip(left["regs"], left["n"].astype(float), left["component"], left["rep"], strict=True):
                at = np.flatnonzero((comp != c) & (np.minimum(n, x) * 100 >= np.maximum(n, x) * percent) & ((rep > d) | (i != j)))
                if len(at):
                    r = np.asarray(r)
                    ok = can_reach(_floor(percent), (r > regs[at]).sum(axis=1), (r < regs[at]).sum(axis=1), np.full(len(at), x), n[at])
                    out += [(min(d, rep[q]), max(d, rep[q])) for q in at[ok]]
        return pd.DataFrame(out, columns=["a", "b"])

    return dealt.groupBy("bucket", "i", "j").applyInPandas(run, f"a {kind}, b {kind}").distinct()


def _linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """The verified links among the pairs, as a written table."""
    likely = cut_lineage(_likely(pairs, classes, percent), f"{name}-pairs")
    links = cut_lineage(_verified(likely, texts, k, percent), f"{name}-links")
    drop_table(likely)
    return links


def _placed(members: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """Members (bucket, leader, rep) with size, parities and component, in buckets that hold several components."""
    found = components(links).withColumnRenamed("id", "rep")
    rows = members.join(classes.select("rep", "n", "bits"), "rep").join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = cut_lineage(rows, "placed")
    mixed = cut_lineage(_measured(placed), "mixed")
    drop_table(placed)
    return mixed


def _links(classes: DataFrame, texts: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified links (a, b) that connect all that links connect, from the groups (bucket, leader, rep)."""
    star = members.where("leader != rep").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = _linked(star, classes, texts, k, percent, "star")
    mixed = _placed(members, classes, links)
    pairs = _across(mixed, percent)
    wide = mixed.where("not few").select("bucket", "rep", "component")
    if wide.isEmpty():
        return links.unionByName(_linked(pairs, classes, texts, k, percent, "mixed"))
    differing = _differences(wide, texts, k, percent)
    # the class nearest to the centre meets all that may be linked to it
    nearest = differing.groupBy("bucket").agg(F.min(F.struct(F.col("p") + F.col("q"), "rep", "component")).alias("top"))
    nearest = nearest.select("bucket", F.col("top.rep").alias("leader"), F.col("top.component").alias("led"))
    met = differing.join(nearest, "bucket").where("component != led")
    met = met.select(F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")).distinct()
    links = links.unionByName(_linked(met, classes, texts, k, percent, "nearest"))
    found = components(links).withColumnRenamed("id", "rep")
    differing = differing.drop("component").join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    differing = cut_lineage(differing, "replaced")
    keyed = cut_lineage(_keyed(differing, percent), "elements")
    alike = cut_lineage(_measured(keyed, FEW_ALIKE).join(classes.select("rep", "bits"), "rep"), "alike")
    drop_table(keyed)
    pairs = pairs.union(_across(alike, percent)).distinct()
    popular = alike.where("not few").select(F.col("g").alias("bucket"), "rep").distinct()
    rest = cut_lineage(_measured(differing.select("bucket", "rep", "component", "n").join(popular, ["bucket", "rep"])), "popular")
    return links.unionByName(_linked(pairs.union(_in_blocks(rest, classes, percent)).distinct(), classes, texts, k, percent, "mixed"))


def _judged(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row: doc_id, text_sha256, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    sketched = cut_lineage(_sketched(docs, k), "sketches")
    with scratch_tables() as made:
        found = sketched.where("n > 0").groupBy("n", "digest").agg(
            F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_sha256")).alias("pick"),
            F.first("regs").alias("regs"), F.first("bits").alias("bits"))
        classes = cut_lineage(found.withColumn("rep", F.monotonically_increasing_id()), "classes")
        keys = F.array(*[F.xxhash64(F.lit(i), F.slice("regs", i * BAND + 1, BAND)) for i in range(REGISTERS // BAND)])
        banded = classes.select("rep", F.explode(keys).alias("bucket"))
        shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        sized = cut_lineage(banded.join(shared, "bucket"), "sizes")
        # a bucket's leader is the class that meets most others in all its buckets: the middle of a family
        meets = sized.groupBy("rep").agg(F.sum("c").alias("meets"))
        leaders = sized.join(meets, "rep").groupBy("bucket").agg(F.max(F.struct("meets", "rep")).alias("top")).select("bucket", F.col("top.rep").alias("leader"))
        groups = sized.join(leaders, "bucket").select(F.col("leader").alias("bucket"), "leader", "rep").distinct()
        members = cut_lineage(groups, "groups")
        picked = classes.join(members.select("rep").distinct(), "rep").select(
            "rep", F.col("pick.doc_id").alias("_d"), F.col("pick.text_sha256").alias("_t"))
        rows = documents(docs)
        rows = rows.select("doc_id", "text", text_key(rows).alias("text_sha256"))
        texts = rows.join(picked, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_sha256") == F.col("_t")))
        texts = cut_lineage(texts.select("rep", "text").dropDuplicates(["rep"]), "candidates")
        final = components(_links(classes, texts, members, k, percent)).withColumnRenamed("id", "rep")
        grouped = classes.select("n", "digest", "rep", "least").join(final, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
        named = grouped.join(least, "component").select(F.col("n").alias("_n"), F.col("digest").alias("_digest"), F.col("component_id").alias("_component"))
        with scratch_tables():
            by_class = cut_lineage(named, "class-components")
        made.remove(next(p for p in made if p.rsplit("/", 1)[-1].startswith("class-components")))
        drop_tables(spark, made)
    out = sketched.drop("regs", "bits").join(by_class, (F.col("n") == F.col("_n")) & (F.col("digest") == F.col("_digest")), "left")
    component = F.when(F.col("n") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "text_sha256", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least doc_id that links reach), kept."""
    return _judged(docs, k, percent).drop("text_sha256")


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all its columns, less the rows of a group of near-duplicates that its least doc_id replaces."""
    return without(docs, _judged(docs, k, percent).where("not kept").select("doc_id", "text_sha256"))


__all__ = ["near_duplicates", "drop_near_copies", "shingle_set", "shingle_hashes", "sketch", "estimate"]
