"""From clusters to audiences (J1-J4, A2, W1, W2; composites C2-C4).

Sizes that bound the plans below: ``user_cluster`` has one row per user (grows
with the data, so it is never broadcast by a hint); ``cluster_artist`` has one row per cluster, at most k rows (a parameter), so
it is always safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import ROWS_PER_TASK, SALT, repeated, salted_join


def attach_clusters(activity: DataFrame, user_cluster: DataFrame) -> DataFrame:
    """Activity rows with their user's cluster.

    The reference forced a broadcast of the per-user table; that table grows
    with the user count, so AQE picks the strategy from runtime sizes in
    bytes and splits a skewed user's partition."""
    return activity.join(user_cluster.select("UserIndex", "cluster"), "UserIndex").select(
        "UserIndex", "UserId", "SongId", "SongIndex", "hits", "cluster")


def user_clusters(users: DataFrame, user_cluster: DataFrame) -> DataFrame:
    """(UserId, cluster) for every indexed user: a join of two per-user tables,
    no pass over the activity rows."""
    return users.join(user_cluster.select("UserIndex", "cluster"), "UserIndex").select("UserId", "cluster")


def cluster_artist_hits(activity: DataFrame, user_cluster: DataFrame, song_artist: DataFrame,
                        weight: str = "pairs", song_salts: DataFrame | None = None, user_col: str = "UserIndex") -> DataFrame:
    """J2 + A2: (cluster, ArtistId, artistHits).

    ``weight="pairs"`` counts (user, song) rows as the reference does;
    ``"plays"`` sums their hits.  A song with several metadata rows counts
    once per row, as in the reference's join.

    Pre-aggregation: activity is first joined to the song metadata and summed
    per (user, artist) - far fewer rows than (user, song) - before the per-user
    cluster is attached, so the big table never shuffles on the user key.

    With ``song_salts`` the activity is ``Activity.by_song``, bucketed by (SongId, _salt): the metadata is
    repeated for the salts of hot songs and only it is shuffled for the join.  ``user_col`` names
    the user's key in ``activity`` and ``user_cluster``."""
    if weight not in ("pairs", "plays"):
        raise ValueError("weight must be 'pairs' or 'plays'")
    w = F.lit(1).cast("bigint") if weight == "pairs" else F.col("hits")
    songs, on = song_artist.select("SongId", "ArtistId"), ["SongId"]
    if song_salts is not None:
        songs, on = repeated(songs, song_salts, on), ["SongId", SALT]
    per_user = (activity.select(user_col, *on, w.alias("_w")).join(songs, on)
                .groupBy(user_col, "ArtistId").agg(F.sum("_w").alias("_w")))
    return (per_user.join(user_cluster.select(user_col, "cluster"), user_col)
            .groupBy("cluster", "ArtistId").agg(F.sum("_w").alias("artistHits")))


def cluster_artist_hits_from_clustered(clustered_activity: DataFrame, song_artist: DataFrame,
                                       weight: str = "pairs") -> DataFrame:
    """J2 + A2 as the reference writes it, from J1's output."""
    agg = F.count(F.lit(1)) if weight == "pairs" else F.sum("hits")
    return (clustered_activity.join(song_artist.select("SongId", "ArtistId"), "SongId")
            .groupBy("cluster", "ArtistId").agg(agg.alias("artistHits")))


def top_artist_per_cluster(hits: DataFrame, n: int = 1) -> DataFrame:
    """W1 + W2 + T1: each cluster's most-hit artist, and ``artistCluster``, the
    artist's dense rank among the chosen artists (clusters sharing a top
    artist share the number).

    Ties on hits go to the lower ArtistId (the reference left them arbitrary).
    Catalyst plans the ``row_number <= n`` filter as a per-partition
    WindowGroupLimit, so only the top rows of each cluster reach the window.
    The dense rank is a global window over at most k * n rows."""
    by_hits = Window.partitionBy("cluster").orderBy(F.desc("artistHits"), F.asc("ArtistId"))
    top = (hits.withColumn("_rn", F.row_number().over(by_hits))
           .where(F.col("_rn") <= n)
           .select("cluster", "ArtistId"))
    return top.withColumn("artistCluster", F.dense_rank().over(Window.orderBy("ArtistId")))


def build_audience(clustered_users: DataFrame, cluster_artist: DataFrame, distinct: bool = True,
                   unique_input: bool = False) -> DataFrame:
    """J3 (C3): (UserId, cluster, ArtistId, artistCluster) - every user of a
    cluster is in the audience of the cluster's top artist.

    ``clustered_users`` is (UserId, cluster): J1's activity rows (one per user
    and song) or ``user_clusters`` (one per user).  ``distinct=False`` keeps
    the reference's bag.  ``unique_input=True`` says the rows are already one
    per user, which saves the shuffle of the distinct.  ``cluster_artist``
    holds at most k rows, hence the broadcast."""
    users = clustered_users.select("UserId", "cluster")
    if distinct and not unique_input:
        users = users.distinct()
    return (users.join(F.broadcast(cluster_artist.select("cluster", "ArtistId", "artistCluster")), "cluster")
            .select("UserId", "cluster", "ArtistId", "artistCluster"))


def notified_users(notification_artist: DataFrame, audience: DataFrame, salts: int | None = None,
                   rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """J4 (C4): the notification list - every audience user of each
    notification's artist: (NotificationId, ArtistId, UserId, cluster, artistCluster).

    This is the job's largest relation (notifications x audience); the CTR
    path never materialises it.  The join key has at most k distinct values
    and one artist may own a third of all users, so the join is salted by
    user (``salted_join``): an artist's audience spreads over as many tasks as its exact size
    asks for, ``rows_per_task`` users each (or over ``salts`` tasks, if given)."""
    na = notification_artist.select("NotificationId", "ArtistId")
    return (salted_join(audience, na, ["ArtistId"], spread_by="UserId", salts=salts, rows_per_task=rows_per_task)
            .select("NotificationId", "ArtistId", "UserId", "cluster", "artistCluster"))
