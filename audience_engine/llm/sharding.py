"""Sharding by sampled splitters (DataFrame operations only), under the law ``bytes``.

Records are ordered by a key, a hash of the text, so equal texts are neighbours.
1. A key sample is drawn with a chance proportional to the record's size (the draw is a
   hash of the record, so a lost task draws the same again).
2. The sample's quantiles are the splitters of many key ranges per shard.
3. Records are dealt to ranges by binary search; exact bytes and rows per range are summed
   (map-side first).  In the ranges over the target every key that is over it by itself, e.g. a
   text that a third of all rows hold, gets a range of its own.  An overfull range is then
   subdivided into as many cells as it needs: by a hash of the key, so that equal texts stay
   together, and a single key's range by a hash of the doc_id.
4. Cells have a place in the byte order from their exact sums; inside a cell a window adds
   the place of each record.  A record goes to the shard in whose share of the bytes its
   middle lies (for a small group of copies, the group's middle, so that it stays whole), so
   shard sizes differ by half a percent at most or one record, whatever the sample was.

Driver and broadcast hold the splitters and cells only: at most ``shards * cells_per_shard``
ranges, half as many keys with ranges of their own, and as many subdivided cells again.  Text is never shuffled for the plan.

Defined cases: null text has no bytes (size 8); rows of equal doc_id and text are placed one
after the other; null ids sort first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, literal_array

#: Key ranges per shard, and expected sample draws per range.
CELLS_PER_SHARD = 64
DRAWS_PER_CELL = 32
#: Bytes a record costs besides its text.
RECORD_BYTES = 8
#: Copies of one text stay in one shard if together they are at most this share of a shard.
KEEP_TOGETHER = 0.005


def _range_of(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at most ``key``: a binary search in a constant array."""
    n = len(splitters)
    if not n:
        return F.lit(0)
    at = literal_array(splitters)
    steps = F.lit([1 << b for b in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda lo, s: F.when(
        (lo + s <= F.lit(n)) & (F.get(at, F.least(lo + s, F.lit(n)) - 1) <= key), lo + s).otherwise(lo))


def shard_documents(docs: DataFrame, shards: int = 24, cells_per_shard: int = CELLS_PER_SHARD,
                    draws_per_cell: int = DRAWS_PER_CELL) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot (gapless in the shard), grown_shard (null)."""
    size = F.coalesce(F.octet_length(F.col("text").cast("binary")), F.lit(0)).cast("long") + RECORD_BYTES
    rows = docs.select(
        docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")).select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.shiftright(F.xxhash64("text"), 11).alias("key"))
    rows = cut_lineage(rows.withColumn("draw", F.xxhash64("doc_id", "key", F.lit(5))), "shard-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    cells = shards * cells_per_shard
    # 1-2. size-weighted draws: the chance is size / total * draws, at most one
    rate = float(cells * draws_per_cell) / max(total, 1)
    chance = (F.col("draw").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))) < F.col("size") * F.lit(rate)
    draws = F.greatest(F.lit(1), F.round(F.col("size") * F.lit(rate))).cast("long")
    quantiles = F.lit([i / cells for i in range(1, cells)])
    cut = rows.where(chance).agg(F.percentile("key", quantiles, draws).alias("q")).first()[0]
    splitters = sorted({int(q) for q in cut or []})
    # 3. exact bytes per range; overfull ranges get several cells
    target = max(total / cells, 1.0)
    full = int(2 * target)

    def ranges(at: list[int]) -> tuple[DataFrame, dict[int, int]]:
        ranged = rows.withColumn("range", _range_of(F.col("key"), at).cast("int"))
        sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).collect()
        return ranged, {r["range"]: max(1, -(-r["bytes"] // full)) for r in sums}

    ranged, parts = ranges(splitters)
    overfull = literal_array([int(parts.get(i, 1) > 1) for i in range(len(splitters) + 1)], "int")
    hot = ranged.where(F.get(overfull, F.col("range")) == 1).groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > full)
    alone = {r["key"] for r in hot.select("key").collect()}
    if alone:
        splitters = sorted(set(splitters) | alone | {k + 1 for k in alone})
        ranged, parts = ranges(splitters)
    part_of = literal_array([parts.get(i, 1) for i in range(len(splitters) + 1)])
    by_id = literal_array([int(i > 0 and splitters[i - 1] in alone) for i in range(len(splitters) + 1)], "int")
    dealt_by = F.when(F.get(by_id, F.col("range")) == 1, F.col("draw")).otherwise(F.xxhash64("key", F.lit(7)))
    dealt = ranged.withColumn("cell", F.pmod(dealt_by, F.get(part_of, F.col("range"))).cast("int"))
    tally = dealt.groupBy("range", "cell").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    # 4. the place of each cell, then of each record in its cell
    place, at_byte, at_row = [], 0, 0
    for r in sorted(tally, key=lambda r: (r["range"], r["cell"])):
        place.append((r["range"], r["cell"], at_byte, at_row))
        at_byte, at_row = at_byte + r["bytes"], at_row + r["n"]
    spark = docs.sparkSession
    places = spark.createDataFrame(place, "range int, cell int, byte0 long, row0 long")
    order = Window.partitionBy("range", "cell").orderBy("key", "text_crc32", "doc_id", "size")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    copies = Window.partitionBy("range", "cell", "key", "text_crc32")
    placed = dealt.withColumn("upto", F.sum("size").over(run)).withColumn("nth", F.row_number().over(order) - 1)
    placed = placed.withColumn("group_bytes", F.sum("size").over(copies)).withColumn("group_end", F.max("upto").over(copies))
    placed = placed.join(F.broadcast(places), ["range", "cell"])
    small = F.col("group_bytes") <= F.lit(total / shards * KEEP_TOGETHER)
    middle = F.col("byte0") + F.when(small, F.col("group_end") - F.col("group_bytes") / 2).otherwise(F.col("upto") - F.col("size") / 2)
    placed = placed.select(
        "doc_id", "size", "text_crc32", (F.col("row0") + F.col("nth")).alias("row"),
        F.least(F.floor(middle * F.lit(shards / max(total, 1))), F.lit(shards - 1)).cast("int").alias("shard"))
    placed = cut_lineage(placed, "shard-places")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("row").alias("first")))
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, files_per_shard: int = 8) -> DataFrame:
    """Writes the documents (all columns) as parquet, one folder ``shard=N`` per shard, each in
    ``files_per_shard`` files that hold every n-th slot in order, and returns the plan.
    Rows that repeat a doc_id and a text are written once each, every one at a slot of its own."""
    plan = cut_lineage(shard_documents(docs, shards), "shard-plan")
    body = docs.drop("shard", "slot")
    raw = F.coalesce(body["text"].cast("string"), F.lit("")).cast("binary")
    key = {"_d": body["doc_id"], "_c": F.crc32(raw), "_s": F.octet_length(raw) + RECORD_BYTES}
    # which of the rows with the same id, checksum and size
    turn = F.row_number().over(Window.partitionBy(*key.values()).orderBy(body["text"].isNull()))
    placed = plan.select(F.col("doc_id").alias("_d"), F.col("text_crc32").alias("_c"), F.col("size").alias("_s"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    placed = placed.withColumn("_n", F.row_number().over(Window.partitionBy("_d", "_c", "_s").orderBy("_shard", "_slot")))
    counted = body.select(*[body[c] for c in body.columns], *[v.alias(f"_own{k}") for k, v in key.items()], turn.alias("_own_n"))
    same = [F.col(f"_own{k}").eqNullSafe(F.col(k)) for k in ("_d", "_c", "_s", "_n")]
    dealt = counted.join(placed, same).select(*[F.col(f"`{c}`") for c in body.columns], F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
    dealt.repartition(shards * files_per_shard, "shard", F.col("slot") % files_per_shard).sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").mode("overwrite").parquet(path)
    return plan


__all__ = ["shard_documents", "write_shards"]
