"""Headerless CSV sources (S1-S7) and the cleaning every input goes through
(P3, P5).

A source path may be a file, a folder, a glob or a list of them, on any Hadoop
file system (S5); Spark lists the files.  Columns are named by position (S6):
with an explicit schema by default - one pass fewer than inference, and ids
stay strings on both sides of every join - or, with ``infer=True``, by
inference plus ``toDF`` as the reference did (S7).  ``fmt="parquet"`` (or
"orc", "json") reads the same columns by name from a self-describing format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.ids import id_as_string, parse_id

# Fixed input layouts (column order of the files).
PLAYS = "UserId string, TimeStamp string, SongId string, Date string"
SONG_ARTIST = "SongId string, ArtistId string"
NOTIFICATION_ARTIST = "NotificationId string, ArtistId string"
NOTIFICATION_CLICKS = "NotificationId string, UserId string, Date string"


def _names(schema: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in schema.split(",")]


def _read(spark: SparkSession, path: str | Sequence[str], schema: str, infer: bool, fmt: str = "csv") -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    if fmt != "csv":
        # columnar and self-describing formats: columns are taken by name, and
        # only the ones the job keeps are read (the scan prunes the rest)
        return spark.read.format(fmt).load(paths).select(*_names(schema))
    reader = spark.read.option("header", False)
    if infer:
        df = reader.option("inferSchema", True).csv(paths)
        return df.toDF(*_names(schema))
    return reader.schema(schema).csv(paths)


# -- cleaning: the same for CSV and parquet-derived inputs -------------------

def clean_plays(df: DataFrame) -> DataFrame:
    """(UserId, SongId) as strings; rows with a null in either are dropped."""
    return (df.select(id_as_string("UserId").alias("UserId"), id_as_string("SongId").alias("SongId"))
            .na.drop())


def clean_song_artist(df: DataFrame) -> DataFrame:
    """(ArtistId bigint, SongId string) - the reference's column order."""
    return (df.select(parse_id("ArtistId").alias("ArtistId"), id_as_string("SongId").alias("SongId"))
            .na.drop())


def clean_notification_artist(df: DataFrame) -> DataFrame:
    """(NotificationId bigint, ArtistId bigint)."""
    return (df.select(parse_id("NotificationId").alias("NotificationId"), parse_id("ArtistId").alias("ArtistId"))
            .na.drop())


def clean_notification_clicks(df: DataFrame) -> DataFrame:
    """(NotificationId bigint, UserId string); the click date is dropped."""
    return (df.select(parse_id("NotificationId").alias("NotificationId"), id_as_string("UserId").alias("UserId"))
            .na.drop())


# -- readers ------------------------------------------------------------------

def read_plays(spark: SparkSession, path, infer: bool = False, fmt: str = "csv") -> DataFrame:
    """Click log (UserId, TimeStamp, SongId, Date) -> (UserId, SongId)."""
    return clean_plays(_read(spark, path, PLAYS, infer, fmt))


def read_song_artist(spark: SparkSession, path, infer: bool = False, fmt: str = "csv") -> DataFrame:
    """Song metadata (SongId, ArtistId) -> (ArtistId, SongId)."""
    return clean_song_artist(_read(spark, path, SONG_ARTIST, infer, fmt))


def read_notification_artist(spark: SparkSession, path, infer: bool = False, fmt: str = "csv") -> DataFrame:
    """S3: notification -> artist."""
    return clean_notification_artist(_read(spark, path, NOTIFICATION_ARTIST, infer, fmt))


def read_notification_clicks(spark: SparkSession, path, infer: bool = False, fmt: str = "csv") -> DataFrame:
    """Notification clicks (NotificationId, UserId, Date) -> (NotificationId, UserId)."""
    return clean_notification_clicks(_read(spark, path, NOTIFICATION_CLICKS, infer, fmt))


__all__ = [
    "PLAYS", "SONG_ARTIST", "NOTIFICATION_ARTIST", "NOTIFICATION_CLICKS",
    "read_plays", "read_song_artist", "read_notification_artist", "read_notification_clicks",
    "clean_plays", "clean_song_artist", "clean_notification_artist", "clean_notification_clicks",
]
