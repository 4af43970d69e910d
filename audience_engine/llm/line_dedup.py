"""Line dedup (DataFrame operations only).

Texts are split into lines.  A line's key is the line without white space at both ends and with
A-Z lower-cased.  The keys are exploded and hashed (two 64-bit hashes with different seeds), the
distinct documents of each hash are counted, and the lines of hashes with at least ``min_docs``
documents go from every document; the others are put together again by position.

What is shuffled: hash and document of each line for the count; hash, document and position for
the join with the repeated hashes (broadcast by Spark where their table is small); positions by
document; and each text once.  A line that a third of all documents hold is counted in
two steps, by (hash, document) and then from partial counts, and its join partition can be split.

A document is a distinct (doc_id, text): rows that repeat both count once and are each returned;
rows with a null id, or with one id and different texts, are documents of their own.

Defined cases: a null or empty text is one empty line; keys shorter than ``min_chars`` code
points never go; a text that loses all its lines is empty; a text of any length is handled
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, documents, lower_ascii

#: White space that a key loses at both ends.
BLANKS = " \t\n\x0b\f\r"
ROW = ["doc_id", "h1", "h2"]


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, two hashes of the text (which tell rows of one id apart), lines."""
    raw = documents(docs)
    return raw.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), F.col("text")).alias("h2"),
                      F.split("text", "\n").alias("lines"))


def line_keys(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(doc_id, h1, h2, pos, k1, k2) of every line whose key has at least ``min_chars`` code points."""
    each = _rows(docs).select(*ROW, F.posexplode("lines").alias("pos", "line"))
    each = each.select(*ROW, "pos", lower_ascii(F.btrim("line", F.lit(BLANKS))).alias("key"))
    each = each.where(F.char_length("key") >= min_chars)
    return each.select(*ROW, "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), F.col("key")).alias("k2"))


def repeated_keys(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(k1, k2, n_docs) of the keys found in at least ``min_docs`` documents."""
    counted = line_keys(docs, min_chars).groupBy("k1", "k2").agg(F.count_distinct(F.struct(*ROW)).alias("n_docs"))
    return counted.where(F.col("n_docs") >= min_docs)


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines (before), n_dropped, text (what is left)."""
    repeated = cut_lineage(repeated_keys(docs, min_docs, min_chars).select("k1", "k2"), "repeated-lines")
    found = line_keys(docs, min_chars).join(repeated, ["k1", "k2"], "left_semi")
    gone = found.groupBy(*ROW).agg(F.collect_set("pos").alias("gone")).select(
        F.col("doc_id").alias("_d"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "gone")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    rows = _rows(docs).join(gone, same, "left")
    n = F.size("lines")
    left = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone")), lambda p: F.col("lines")[p])
    return rows.select("doc_id", n.cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                       F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(left), "\n").alias("text"))


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


__all__ = ["drop_repeated_lines", "repeated_keys", "line_keys", "digest"]
