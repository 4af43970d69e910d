"""Play counts and id indexing (A1, M1-M3).

ALS needs dense int ids, so users and songs get an index: their frequency rank
(0 = most played; ties by ascending id), the labels ``StringIndexer`` gives.
``StringIndexer`` collects every label on the driver, which does not scale to
hundreds of millions of users; here ids are ranked with a distributed range
sort, which gives the same labels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, cut_lineage_bucketed
from .joins import ROWS_PER_TASK, SALT, repeated, salts_of, with_salt

_N = "_n"        # frequency of a label
_PART = "_part"  # range partition of a label
_MID = "_mid"    # monotonically increasing id within the sorted partitions


def play_counts(plays: DataFrame, user_col: str = "UserId", song_col: str = "SongId") -> DataFrame:
    """A1: one row per (user, song) with ``hits`` = number of plays.

    A plain group-by: Spark aggregates map-side first, so a user with a third
    of all plays still shuffles at most one row per (user, song) per task."""
    return plays.groupBy(user_col, song_col).agg(F.count(F.lit(1)).alias("hits"))


def label_frequencies(df: DataFrame, col: str, weight: str | None = None) -> DataFrame:
    """(label, _n): rows per label, or the sum of ``weight`` per label."""
    agg = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(col).agg(agg.alias(_N))


def rank_labels(freqs: DataFrame, col: str, index_col: str) -> DataFrame:
    """(label, index): frequency rank of every label, without a single-task step.

    1. range-partition and sort by (frequency desc, label asc) - a total order -
       and write each row with its partition and its position there;
    2. partition sizes -> running offsets (one row per partition, so the
       broadcast is bounded by the partition count) -> rank = offset + position.

    The offsets and the positions must come from the same partitioning: both
    read the written table, which a lost executor rereads."""
    tagged = cut_lineage(
        freqs.orderBy(F.desc(_N), F.asc(col)).select(
            col, F.spark_partition_id().alias(_PART), F.monotonically_increasing_id().alias(_MID)),
        f"order-{index_col}")
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_size"))
               .select(_PART, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")))
    # monotonically_increasing_id() is documented to hold the partition index in
    # its upper 31 bits and the record number within the partition in the
    # lower 33, so this is the row's position inside its sorted partition.
    position = F.col(_MID) - F.shiftleft(F.col(_PART).cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), _PART)
            .select(col, (F.col("_offset") + position).cast("int").alias(index_col)))


def index_ids(plays: DataFrame, col: str, index_col: str, freqs: DataFrame | None = None) -> DataFrame:
    """M1/M2: (label, index int) for every label of ``col`` in ``plays``.

    ``freqs`` may carry precomputed (label, _n) frequencies (e.g. summed from
    play counts) so that the raw log is not scanned again."""
    return rank_labels(freqs if freqs is not None else label_frequencies(plays, col), col, index_col)


@dataclass(frozen=True)
class Activity:
    activity: DataFrame   # UserId, SongId, UserIndex, SongIndex, hits
    users: DataFrame      # UserId, UserIndex
    songs: DataFrame      # SongId, SongIndex
    by_song: DataFrame    # activity and _salt, bucketed by (SongId, _salt)
    song_salts: DataFrame  # SongId, _salts of the hot songs


def build_activity(plays: DataFrame, song_buckets: int = 8, rows_per_task: int = ROWS_PER_TASK) -> Activity:
    """M1-M3 + A1: index users and songs, count plays per (user, song).

    The counts are taken once and written to the shared folder; both indexes
    are ranked from them (the sum of hits per label is its play count, the
    frequency ``StringIndexer`` uses), so the raw log is read once.  The activity
    is written too: ALS, the popularity counts and the audience all start from
    files, and nothing stays in executor memory.

    The activity's one shuffle by song, for the index join, is kept: the table is bucketed by
    (SongId, salt), so the popularity count (J2) joins the song metadata without shuffling it again.
    A song with more than ``rows_per_task`` listeners has a salt per so many, which
    spreads it over buckets.  Choose ``song_buckets`` near rows / ``rows_per_task``: a bucket is one task."""
    pairs = cut_lineage(play_counts(plays), "pairs")
    users = rank_labels(label_frequencies(pairs, "UserId", "hits"), "UserId", "UserIndex")
    # one pass for both: a song's plays give its index, its listeners its salts
    heard = cut_lineage(pairs.groupBy("SongId").agg(F.sum("hits").alias(_N), F.count(F.lit(1)).alias("_listeners")), "song-counts")
    songs = rank_labels(heard.select("SongId", _N), "SongId", "SongIndex")
    salts = cut_lineage(salts_of(heard, ["SongId"], "_listeners", rows_per_task), "song-salts")
    dealt = with_salt(pairs.join(users, "UserId"), salts, ["SongId"], "UserId").repartition(song_buckets, "SongId", SALT)
    indexed = dealt.join(repeated(songs, salts, ["SongId"]), ["SongId", SALT])
    columns = ["UserId", "SongId", "UserIndex", "SongIndex", "hits"]
    by_song = cut_lineage_bucketed(indexed.select(*columns, SALT), "activity", song_buckets, ["SongId", SALT])
    return Activity(activity=by_song.select(*columns), users=users, songs=songs, by_song=by_song, song_salts=salts)
