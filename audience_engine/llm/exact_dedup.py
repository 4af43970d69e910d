"""Exact dedup by deterministic block naming (DataFrame operations only).

Each text is cut into blocks of a fixed number of UTF-8 bytes.  The distinct blocks that
occur more than once are sorted and numbered: a block's number is its name.  Then adjacent
names are paired, the distinct pairs are sorted and numbered again, and so on until each
document has one name.  Two documents end with the same name exactly if their texts are
equal: names stand for whole sorted keys, never for digests.  (Rows of one doc_id, and all rows
without one, are told from each other by a 64-bit hash of the text.)

A block (or pair) that occurs once in the corpus makes its document unique, so such documents
leave at once and only true repeats go through the later, integer-only rounds.  Numbers come
from one range sort and are written to the shared checkpoint folder before use: a lost
executor rereads them instead of numbering anew.

Skew: a block that a third of all documents hold is counted after map-side combining, and the
join that attaches names is a plain sort-merge join of two shuffles, which AQE splits.

Defined cases: null text counts as empty; empty texts are equal to each other; rows that
repeat a doc_id and a text are one document with several rows (all counted in ``group_size``,
all kept if their id is kept); a null doc_id never wins over another id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, documents, without

#: Bytes of a first-level block.
BLOCK_BYTES = 4096
#: Leading bytes of a block by which blocks are dealt to sorted ranges; blocks with the same ones (a licence
#: header) are dealt by a hash of the whole block, so that no range grows with a prefix.
PREFIX_BYTES = 48


def _numbered(keys: DataFrame, by: list[str], dealt_by: list[Column], name: str) -> DataFrame:
    """The distinct keys with a number that follows their sort order, as a written table.

    The order is that of ``dealt_by``, then of the keys; the range partitioning samples ``dealt_by``
    only, so that the sample on the driver does not hold whole blocks."""
    ranked = keys.repartitionByRange(*dealt_by).sortWithinPartitions(*dealt_by, *by)
    return cut_lineage(ranked.withColumn("name", F.monotonically_increasing_id()), name)


def _repeated(rows: DataFrame, by: list[str], rows_each: str = "1") -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(F.expr(rows_each)).alias("n")).where("n > 1").select(*by)


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(doc_id, h, n_blocks, pos, block): h tells rows of one doc_id with different texts apart."""
    raw = docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("raw"))
    starts = F.sequence(F.lit(0), F.greatest(F.octet_length("raw") - 1, F.lit(0)), F.lit(block_bytes))
    cut = raw.select("doc_id", "h", F.transform(starts, lambda i: F.substring(F.col("raw"), i + 1, F.lit(block_bytes))).alias("cut"))
    return cut.select("doc_id", "h", F.size("cut").alias("left"), F.posexplode("cut").alias("pos", "block"))


def _whole(named: DataFrame) -> DataFrame:
    """Only documents all of whose names are still there; ``left`` is how many they have."""
    full = named.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("have"), F.max("left").alias("need"))
    full = full.where("have = need").select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"))
    return named.join(full, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left_semi")


def named_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, h, copies, name) of the documents whose text occurs more than once."""
    blocks = _blocks(documents(docs), block_bytes)
    names = _numbered(_repeated(blocks, ["block"]), ["block"], [F.substring("block", 1, PREFIX_BYTES), F.xxhash64("block")], "block-names")
    named = blocks.join(names, "block").groupBy("doc_id", "h", "pos").agg(
        F.max("left").alias("left"), F.max("name").alias("name"), F.count(F.lit(1)).alias("copies"))
    named = cut_lineage(_whole(cut_lineage(named, "block-named")), "named-0")
    longest = named.agg(F.max("left")).first()[0] or 1
    level = 0
    while longest > 1:
        level += 1
        pair = named.groupBy("doc_id", "h", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max(F.ceil(F.col("left") / 2)).alias("left"), F.max("copies").alias("copies"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        pair = cut_lineage(pair, f"pairs-{level}")
        names = _numbered(_repeated(pair, ["a", "b"], "copies"), ["a", "b"], [F.col("a"), F.col("b")], f"pair-names-{level}")
        named = cut_lineage(_whole(pair.join(names, ["a", "b"]).drop("a", "b")), f"named-{level}")
        longest = -(-longest // 2)
    return named.select("doc_id", "h", "copies", "name")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays."""
    named = named_documents(docs, block_bytes)
    groups = named.groupBy("name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    member = named.join(groups.where("group_size > 1"), "name").select(
        F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "keep_id", "group_size")
    rows = documents(docs).select("doc_id", F.xxhash64("text").alias("h"),
                                  F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    out = rows.join(member, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")
    alone = F.col("_h").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("group_size")).cast("long").alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with all its columns, less the rows that an equal text with a larger doc_id replaces."""
    return without(docs, exact_dedup(docs, block_bytes).where("not kept").select("doc_id", "text_sha256"))


__all__ = ["exact_dedup", "drop_exact_copies", "named_documents", "BLOCK_BYTES"]
