"""Benchmark decontamination by SimHash windows (DataFrame operations only).

A benchmark item is the multiset of its word shingles (words: lower-cased, split at ASCII
white space).  A document is contaminated if some window of it, as long as the item, has a
weighted Jaccard similarity (sum of least over sum of greatest counts) of ``percent`` or more.

1. Windows: a window that shares no shingle with any item has similarity 0, so windows are
   laid where a document and some item share one: the place of the shared shingle in the
   item gives the window's start, the item's length its size.  Shared shingles are found by a
   bit table of the benchmark's shingle hashes (a Bloom filter of at most ``2^MOST_BITS``
   bits, so its size is bounded whatever the benchmark) inside the scan, without exploding
   texts, and then by an exact join of what is left.  A window with fewer shingles in the bit
   table than the similarity needs goes at once.
2. Fingerprints: 64-bit SimHash of each window and item.
3. Multi-index: the fingerprint has ``BLOCKS`` blocks; of two fingerprints within
   ``BLOCKS * (NEAR + 1) - 1`` bits at least one block differs in at most ``NEAR`` bits.  Items
   are entered under every block value that near, so an equality join finds all pairs within
   the radius; a pair counts in the first such block only.
   Pairs beyond the radius come from an exact join: a similar window has ``percent`` of the item's
   shingles, so it has one of any larger rest of them; the item's rarest are taken.
4. Verification: exact similarity of the multisets of 64-bit shingle hashes.

Defined cases: null text counts as empty and has no shingle; fewer words than a shingle: the
whole sequence is the one shingle, so a short item is found only as a whole document; windows
that reach over an end of the document are cut there; rows that repeat a doc_id count as one
document; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAK, by_text, cut_lineage, documents, literal_array, without
from .spans import let

#: Bits of the bit table: at least, at most, and per shingle of the benchmark.
LEAST_BITS, MOST_BITS, BITS_EACH = 21, 24, 128
BLOCKS, NEAR = 4, 3
RADIUS = BLOCKS * (NEAR + 1) - 1
WIDTH = 64 // BLOCKS


def _shingles(text: Column, k: int) -> Column:
    """Hashes of the word shingles in order."""
    def hashed(w: Column) -> Column:
        n = F.size(w)
        run = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(w, i + d) for d in range(k)]))
        return F.when(n >= k, run).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return let(F.filter(F.split(F.lower(text), WORD_BREAK), lambda x: x != ""), hashed)


def _weighted(hashes: Column) -> Column:
    """The multiset as a set: each occurrence of a hash gets a number, so that set operations count weights."""
    return let(F.array_sort(hashes), lambda s: F.transform(s, lambda h, i: F.xxhash64(h, i - F.array_position(s, h).cast("int"))))


def _probes(h: Column, bits: int) -> list[Column]:
    mask = F.lit((1 << bits) - 1).cast("bigint")
    return [h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)]


def _items(bench: DataFrame, k: int) -> DataFrame:
    own = bench.select(bench["item_id"].alias("item_id"), _shingles(F.coalesce(bench["text"].cast("string"), F.lit("")), k).alias("s"))
    return own.where(F.size("s") > 0).select("item_id", "s", _weighted(F.col("s")).alias("w"))


def _bit_table(items: DataFrame) -> tuple[list[int], int]:
    hashes = items.select(F.explode("s").alias("h")).distinct()
    n = hashes.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (n * BITS_EACH).bit_length()))
    at = hashes.select(F.explode(F.array(*_probes(F.col("h"), bits))).alias("p"))
    rows = at.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")).collect()
    table = [0] * (1 << (bits - 6))
    for r in rows:
        table[r["word"]] = r["b"]
    return table, bits


def _fingerprints(sets: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the SimHash ``fp`` of the column ``w``: each element votes on each of 64 bits.  Two votes share a long."""
    each = sets.select(*keys, F.explode("w").alias("h"))
    lanes = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(0x0000000100000001))).alias(f"v{j}") for j in range(32)]
    votes = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *lanes)
    fp = F.lit(0).cast("bigint")
    for j in range(32):
        low, high = F.col(f"v{j}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"v{j}", 32)
        fp = fp.bitwiseOR(F.when(low * 2 > F.col("n"), F.lit(1 << j)).otherwise(F.lit(0)).cast("bigint"))
        fp = fp.bitwiseOR(F.when(high * 2 > F.col("n"), F.lit((1 << (32 + j)) - ((1 << 64) if j == 31 else 0))).otherwise(F.lit(0)).cast("bigint"))
    return votes.select(*keys, fp.alias("fp"))


def _rare_parts(items: DataFrame, percent: int) -> DataFrame:
    """(item_id, h): of each item so many elements, the rarest in the benchmark first, that a similar window has one of them."""
    each = items.select("item_id", F.size("w").alias("m"), F.explode("w").alias("h"))
    each = each.join(each.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "h")
    order = each.groupBy("item_id").agg(F.max("m").alias("m"), F.sort_array(F.collect_list(F.struct("n", "h"))).alias("order"))
    return order.select("item_id", F.explode(F.slice("order", F.lit(1), F.expr(f"m - (m * {percent} + 99) div 100 + 1").cast("int"))).alias("e")).select("item_id", F.col("e.h").alias("h"))


def _block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, b * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int")


def _nearby() -> list[int]:
    """All masks of a block with at most NEAR bits."""
    return [sum(1 << i for i in c) for r in range(NEAR + 1) for c in combinations(range(WIDTH), r)]


def contaminated(docs: DataFrame, bench: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per contaminated document and item: doc_id, item_id, similarity of the best window, n_windows, first_word."""
    items = cut_lineage(_items(bench, k), "items")
    table, bits = _bit_table(items)
    held = literal_array(table)

    def seen(h: Column) -> Column:
        hit = F.lit(True)
        for p in _probes(h, bits):
            hit = hit & (F.bit_get(F.get(held, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return hit

    # 1. windows
    hashed = documents(docs).select("doc_id", _shingles(F.col("text"), k).alias("s"))
    seeds = hashed.select("doc_id", "s", F.filter(F.transform("s", lambda h, i: F.when(seen(h), i)), lambda i: i.isNotNull()).alias("at"))
    seeds = cut_lineage(seeds.where(F.size("at") > 0).withColumn("row", F.monotonically_increasing_id()), "seeds")
    places = items.select(F.posexplode("s").alias("ipos", "h"), F.size("s").alias("m")).distinct()
    found = seeds.select("row", F.col("s"), F.explode("at").alias("pos")).select("row", "pos", F.get("s", F.col("pos")).alias("h"))
    windows = found.join(places, "h").select("row", (F.col("pos") - F.col("ipos")).alias("start"), "m").distinct()
    first = F.greatest(F.col("start"), F.lit(0))
    cut = F.slice("s", first + 1, F.col("start") + F.col("m") - first)
    windows = windows.join(seeds.select("row", "doc_id", "s"), "row").select("row", "doc_id", "start", "m", cut.alias("cut"))
    windows = windows.where(F.size(F.filter("cut", seen)) * 100 >= F.col("m") * percent)
    windows = cut_lineage(windows.select("row", "doc_id", "start", "m", _weighted(F.col("cut")).alias("w")), "windows")
    # 2-3. fingerprints and the multi-index
    of_items = _fingerprints(items, ["item_id"])
    of_windows = cut_lineage(_fingerprints(windows, ["row", "start", "m"]), "fingerprints")
    near = literal_array(_nearby(), "int")
    entries = of_items.select("item_id", F.col("fp").alias("ifp"), F.posexplode(F.array(*[_block(F.col("fp"), b) for b in range(BLOCKS)])).alias("b", "v"))
    entries = entries.select("item_id", "ifp", "b", F.explode(F.transform(near, lambda x: F.col("v").bitwiseXOR(x))).alias("key"))
    lookups = of_windows.select("row", "start", "m", "fp", F.posexplode(F.array(*[_block(F.col("fp"), b) for b in range(BLOCKS)])).alias("b", "key"))
    apart = F.col("fp").bitwiseXOR(F.col("ifp"))
    first_near = F.lit(BLOCKS)
    for b in reversed(range(BLOCKS)):
        first_near = F.when(F.bit_count(_block(apart, b)) <= NEAR, F.lit(b)).otherwise(first_near)
    pairs = lookups.join(entries, ["b", "key"]).where((F.bit_count(apart) <= RADIUS) & (F.col("b") == first_near))
    shared = windows.select("row", "start", "m", F.explode("w").alias("h")).join(_rare_parts(items, percent), "h")
    shared = shared.select("row", "start", "m", "item_id").distinct()
    beyond = shared.join(of_windows, ["row", "start", "m"]).join(of_items.select("item_id", F.col("fp").alias("ifp")), "item_id").where(F.bit_count(apart) > RADIUS)
    pairs = pairs.select("row", "start", "m", "item_id").unionByName(beyond.select("row", "start", "m", "item_id"))
    # 4. verification
    sets = pairs.join(windows, ["row", "start", "m"]).join(items.select("item_id", F.col("w").alias("iw")), "item_id")
    both = F.size(F.array_intersect("w", "iw"))
    sets = sets.select("doc_id", "item_id", "start", both.alias("both"), (F.size("w") + F.size("iw") - both).alias("any"))
    hits = sets.where(F.col("both") * 100 >= F.col("any") * percent)
    return hits.groupBy("doc_id", "item_id").agg(
        F.max(F.col("both") / F.col("any")).alias("similarity"), F.count(F.lit(1)).alias("n_windows"),
        F.min(F.greatest("start", F.lit(0))).cast("long").alias("first_word"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all its columns, less the rows whose text is contaminated."""
    return without(docs, contaminated(by_text(docs), bench, k, percent).select(F.col("doc_id").alias("text_sha256")))


__all__ = ["contaminated", "drop_contaminated", "RADIUS"]
