"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from audience_engine.session import cut_lineage, drop_tables

#: Words of the word-based operators: runs of anything but ASCII white space.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(docs: DataFrame, text: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) only, so that extra columns of any name stay out of the operators."""
    return docs.select(docs[id_col].alias("doc_id"), whole_text(docs, text).alias("text"))


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (the fold rule of the learned operators)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def literal_array(values: list, kind: str = "bigint") -> Column:
    """A constant array column.  One string literal cast to an array: Catalyst folds it
    into a constant, and a lookup by index is then O(1) whatever the length."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    text = ",".join(repr(v) if isinstance(v, float) else str(v) for v in values)
    return F.split(F.lit(text), ",").cast(f"array<{kind}>")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def text_key(docs: DataFrame) -> Column:
    """The hash that stands for a row's text where ids are null or repeated."""
    return F.sha2(whole_text(docs).cast("binary"), 256)


def by_text(docs: DataFrame) -> DataFrame:
    """``documents`` with the text's key in place of the id, for decisions that depend on the text alone."""
    return docs.select(text_key(docs).alias("doc_id"), whole_text(docs).alias("text"))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the rows that agree with a row of ``dropped`` in all its columns, of doc_id and text_sha256."""
    own = {"doc_id": docs["doc_id"], "text_sha256": text_key(docs)}
    gone = dropped.select(*[F.col(c).alias(f"_gone_{c}") for c in dropped.columns]).distinct()
    same = [own[c].eqNullSafe(gone[f"_gone_{c}"]) for c in dropped.columns]
    return docs.join(gone, same, "left_anti")


def drop_table(df: DataFrame) -> None:
    """Deletes the written table that ``df`` reads; ``df`` is of no use afterwards."""
    drop_tables(df.sparkSession, sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}))


__all__ = ["WORD_BREAK", "table", "whole_text", "documents", "remainder", "literal_array", "lower_ascii", "text_key", "by_text", "without", "cut_lineage", "drop_table"]
