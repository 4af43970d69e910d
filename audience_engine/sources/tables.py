"""The job's four inputs derived from the parquet test tables.

The mapping is fixed by FIXTURES.md section 3:

* plays: ``orders`` joined to ``lineitem`` on the order key; user = ``o_custkey``,
  song = ``l_partkey``, time = ``l_shipdate``;
* song -> artist: ``part``; artist = the number in ``p_brand`` (``Brand#17`` -> 17);
* notification -> artist: every distinct ``k`` in ``events.props``; artist
  ``k % 25 + 1``, and for ``k % 10 = 0`` also ``(k + 7) % 25 + 1`` (notifications
  aimed at two artists);
* notification clicks: ``events`` of type ``click``; notification ``k``, user ``user_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .csv import clean_notification_artist, clean_notification_clicks, clean_plays, clean_song_artist

# Fixed values of the derivation above.
ARTIST_COUNT = 25
SECOND_ARTIST_EVERY = 10
SECOND_ARTIST_SHIFT = 7


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plays_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw click log: (UserId, TimeStamp, SongId, Date)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    return (orders.join(items, orders.o_orderkey == items.l_orderkey)
            .select(F.col("o_custkey").cast("string").alias("UserId"),
                    F.col("l_shipdate").alias("TimeStamp"),
                    F.col("l_partkey").cast("string").alias("SongId"),
                    F.to_date("l_shipdate").alias("Date")))


def song_artist_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw song metadata: (SongId, ArtistId) with the artist still text."""
    return (read_table(spark, sf_dir, "part")
            .select(F.col("p_partkey").cast("string").alias("SongId"),
                    F.regexp_extract("p_brand", r"(\d+)\s*$", 1).alias("ArtistId")))


def _notification_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_table(spark, sf_dir, "events")
            .select(F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))
            .where(F.col("k").isNotNull())
            .distinct())


def notification_artist_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw notification -> artist rows (NotificationId, ArtistId): one scan of
    ``events``, one distinct, then one or two artist rows per notification."""
    k = F.col("k")
    first = k % ARTIST_COUNT + 1
    second = (k + SECOND_ARTIST_SHIFT) % ARTIST_COUNT + 1
    artists = F.when(k % SECOND_ARTIST_EVERY == 0, F.array(first, second)).otherwise(F.array(first))
    return (_notification_ids(spark, sf_dir)
            .select(k.alias("NotificationId"), F.explode(artists).alias("ArtistId")))


def notification_clicks_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw notification clicks (NotificationId, UserId, Date)."""
    return (read_table(spark, sf_dir, "events")
            .where(F.col("event_type") == "click")
            .select(F.get_json_object("props", "$.k").alias("NotificationId"),
                    F.col("user_id").cast("string").alias("UserId"),
                    F.to_date("ts").alias("Date")))


@dataclass(frozen=True)
class Inputs:
    """The four cleaned inputs of the job."""

    plays: DataFrame                # UserId, SongId
    song_artist: DataFrame          # ArtistId, SongId
    notification_artist: DataFrame  # NotificationId, ArtistId
    notification_clicks: DataFrame  # NotificationId, UserId


def inputs_from_tables(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        plays=clean_plays(plays_from_tables(spark, sf_dir)),
        song_artist=clean_song_artist(song_artist_from_tables(spark, sf_dir)),
        notification_artist=clean_notification_artist(notification_artist_from_tables(spark, sf_dir)),
        notification_clicks=clean_notification_clicks(notification_clicks_from_tables(spark, sf_dir)),
    )
