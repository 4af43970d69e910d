"""Join helpers: exact salts for hot keys, and a Bloom filter before a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
SALTS = "_salts"
#: Rows of one key that one task may hold before the key is salted.
ROWS_PER_TASK = 1_000_000
#: 64-bit words of a Bloom filter at most (16 bytes each when broadcast), and keys a word.
BLOOM_WORDS, BLOOM_KEYS = 1 << 20, 8


def salt_table(rows: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(on..., _salts) of the hot keys: a key with more than ``rows_per_task`` rows gets
    rows / ``rows_per_task`` salts, rounded up; every other key has one and is not listed.

    Counted exactly, with partial counts map-side.  The table has at most rows / ``rows_per_task`` rows,
    fewer than the tasks that read ``rows``, which bounds its broadcast."""
    return salts_of(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), on, "_n", rows_per_task)


def salts_of(counts: DataFrame, on: Sequence[str], count: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``salt_table`` from the rows' counts by key."""
    return counts.where(F.col(count) > rows_per_task).select(*on, F.ceil(F.col(count) / rows_per_task).cast("int").alias(SALTS))


def with_salt(rows: DataFrame, salts: DataFrame, on: Sequence[str], spread_by: str) -> DataFrame:
    """``rows`` with ``_salt``: for a hot key a hash of ``spread_by`` below its number of salts, else 0."""
    salt = F.pmod(F.xxhash64(spread_by), F.col(SALTS)).cast("int")
    return rows.join(F.broadcast(salts), list(on), "left").withColumn(SALT, F.coalesce(salt, F.lit(0))).drop(SALTS)


def repeated(rows: DataFrame, salts: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` once for each salt of their key."""
    last = F.coalesce(F.col(SALTS), F.lit(1)) - 1
    return rows.join(F.broadcast(salts), list(on), "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), last))).drop(SALTS)


def salted_join(large: DataFrame, small: DataFrame, on: Sequence[str], spread_by: str,
                salts: int | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Inner equi-join of a large relation with a small one on a key that has
    few distinct values (an artist, a notification), any of which may hold a
    third of the large side.

    The large side gets a salt from a hash of ``spread_by`` (a column with many
    values, e.g. the user), the small side is repeated once per salt, and the
    salt joins the key.  How many salts a key has comes from its exact number of rows
    (``salt_table``): a key with a third of the rows spreads over a third of
    the tasks, one with ten rows is not repeated at all.  ``salts`` gives every key that
    number instead.  When AQE finds the small side small enough it broadcasts it."""
    on = list(on)
    if salts is None:
        table = salt_table(large, on, rows_per_task)
        big, rep = with_salt(large, table, on, spread_by), repeated(small, table, on)
    else:
        big = large.withColumn(SALT, F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
        rep = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.join(rep, on + [SALT]).drop(SALT)


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words)).cast("int")


def _mask(keys: Sequence[str]) -> Column:
    """Three bits of a 64-bit word, from other hash bits than the word's number."""
    h = F.xxhash64(F.lit(1), *[F.col(k) for k in keys])
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(h, s), F.lit(64)).cast("int")) for s in (0, 6, 12)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def bloom_filter(rows: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """(_word, _bits): a Bloom filter of the keys in ``words`` 64-bit words, at most as many rows."""
    each = rows.select(_word(keys, words).alias("_word"), _mask(keys).alias("_bits"))
    return each.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))


def bloom_words(n_keys: int, most: int = BLOOM_WORDS) -> int | None:
    """The filter's size for so many keys: a power of two with at most ``BLOOM_KEYS`` keys a word, or None where
    ``most`` words would be so full that the filter lets nearly everything through."""
    words = 64
    while words * BLOOM_KEYS < n_keys:
        words *= 2
    return min(words, most) if words <= 2 * most else None


def bloom_semi_join(large: DataFrame, rows: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """``large`` without most rows whose keys are not in ``rows``; none whose keys are is lost.

    The filter (16 bytes a word, ``words`` is the bound) is broadcast, so rows leave in the stage that reads
    them, before any shuffle.  About 3 % of the other rows pass, so an exact join must follow."""
    found = bloom_filter(rows, keys, words)
    tagged = large.withColumn("_word", _word(keys, words)).withColumn("_mask", _mask(keys))
    kept = tagged.join(F.broadcast(found), "_word").where(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
    return kept.select(*large.columns)
