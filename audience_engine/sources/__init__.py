"""Sources: the four inputs of the job, from headerless CSV folders (the
reference's format) or from the parquet test tables."""

from .csv import (
    NOTIFICATION_ARTIST,
    NOTIFICATION_CLICKS,
    PLAYS,
    SONG_ARTIST,
    clean_notification_artist,
    clean_notification_clicks,
    clean_plays,
    clean_song_artist,
    read_notification_artist,
    read_notification_clicks,
    read_plays,
    read_song_artist,
)
from .tables import (
    Inputs,
    inputs_from_tables,
    notification_artist_from_tables,
    notification_clicks_from_tables,
    plays_from_tables,
    read_table,
    song_artist_from_tables,
)

__all__ = [
    "PLAYS", "SONG_ARTIST", "NOTIFICATION_ARTIST", "NOTIFICATION_CLICKS",
    "read_plays", "read_song_artist", "read_notification_artist", "read_notification_clicks",
    "clean_plays", "clean_song_artist", "clean_notification_artist", "clean_notification_clicks",
    "Inputs", "inputs_from_tables", "read_table", "plays_from_tables", "song_artist_from_tables",
    "notification_artist_from_tables", "notification_clicks_from_tables",
]
