"""A third of all rows on one key: results stay whole and right, and AQE
splits the hot join partitions (thresholds lowered so tiny data counts as skewed)."""

import contextlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from audience_engine.operators import (
    build_activity,
    build_audience,
    cluster_artist_hits,
    top_artist_per_cluster,
    user_clusters,
)
from audience_engine.sources import clean_plays, clean_song_artist
from audience_engine.sources.tables import plays_from_tables, read_table, song_artist_from_tables

from .conftest import SF_SMALL

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    raw = plays_from_tables(spark, SF_SMALL).withColumn("_r", F.pmod(F.xxhash64("UserId", "SongId", "TimeStamp"), F.lit(3)))
    plays = clean_plays(raw.select(
        F.when(F.col("_r") == 0, F.lit("1")).otherwise(F.col("UserId")).alias("UserId"),
        F.when(F.col("_r") == 1, F.lit("1")).otherwise(F.col("SongId")).alias("SongId")))
    meta = clean_song_artist(song_artist_from_tables(spark, SF_SMALL))
    nation = read_table(spark, SF_SMALL, "customer").select(
        F.col("c_custkey").cast("string").alias("UserId"), F.col("c_nationkey").cast("int").alias("cluster"))
    return plays, meta, nation


def test_hot_user_and_song_give_whole_right_results(spark, skewed):
    plays, meta, nation = skewed
    p = plays.toPandas()
    m = meta.toPandas()
    n = nation.toPandas()
    assert (p.UserId == "1").mean() > 0.3 and (p.SongId == "1").mean() > 0.3

    with conf(spark, SKEW_CONF):
        act = build_activity(plays, rows_per_task=20)  # so that the hot song counts as hot here: its salts spread it over files
        uc = act.users.join(nation, "UserId").select("UserIndex", "cluster")
        hits = cluster_artist_hits(act.activity, uc, meta)
        got_hits = {(r.cluster, r.ArtistId): r.artistHits for r in hits.collect()}
        ca = top_artist_per_cluster(hits)
        aud = build_audience(user_clusters(act.users, uc), ca, unique_input=True)
        got_aud = sorted(tuple(r) for r in aud.collect())
        # the hot song, with a third of the rows, meets its metadata row
        joined = act.activity.where("SongId = '1' or UserIndex % 8 = 0").join(meta, "SongId")
        joined.collect()
        final_plan = joined._jdf.queryExecution().executedPlan().toString()

    pairs = p.groupby(["UserId", "SongId"]).size().rename("hits").reset_index()
    exp = pairs.merge(n, on="UserId").merge(m, on="SongId").groupby(["cluster", "ArtistId"]).size()
    assert got_hits == {(int(c), int(a)): int(v) for (c, a), v in exp.items()}
    top = (exp.rename("h").reset_index().sort_values(["cluster", "h", "ArtistId"], ascending=[True, False, True])
           .groupby("cluster").head(1))
    rank = {a: i + 1 for i, a in enumerate(sorted(top.ArtistId.unique()))}
    users = pd.Series(sorted(p.UserId.unique()), name="UserId").to_frame().merge(n, on="UserId")
    exp_aud = sorted((r.UserId, int(r.cluster), int(a), rank[a])
                     for r in users.itertuples() for a in top[top.cluster == r.cluster].ArtistId)
    assert got_aud == exp_aud
    assert "isFinalPlan=true" in final_plan
    assert "skew=true" in final_plan  # AQE split the hot partitions


def _skew_split(df) -> bool:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "isFinalPlan=true" in plan and "skew=true" in plan


def test_index_joins_and_cluster_join_split_a_hot_key(spark, skewed):
    """pairs x users, and J1: the hot user's partition is split."""
    from audience_engine.operators import attach_clusters, index_ids, play_counts
    plays, _, _ = skewed
    with conf(spark, SKEW_CONF):
        pairs = play_counts(plays)
        users = index_ids(plays, "UserId", "UserIndex")
        assert _skew_split(pairs.join(users, "UserId"))
        # one user with a third of all (user, song) rows
        act = spark.range(6000).selectExpr(
            "cast(if(id % 3 = 0, 0, id % 500) as string) as UserId", "cast(id as string) as SongId",
            "cast(if(id % 3 = 0, 0, id % 500) as int) as UserIndex", "cast(id as int) as SongIndex", "1L as hits")
        uc = spark.range(500).selectExpr("cast(id as int) as UserIndex", "cast(id % 7 as int) as cluster")
        joined = attach_clusters(act, uc)
        assert _skew_split(joined) and joined.count() == 6000


def test_hot_notification_gives_right_clicks(spark):
    """A third of all clicks on one notification: the salted join is whole and spreads it."""
    from audience_engine.operators import clicked_audience
    clicks = [(1 if i % 3 == 0 else 2 + i % 7, f"u{i % 400}") for i in range(3000)]
    na = [(n, 10 + n % 3) for n in range(1, 10)]
    aud = [(f"u{i}", i % 3, 10 + i % 3, i % 3) for i in range(400)]
    frames = (spark.createDataFrame(clicks, "NotificationId bigint, UserId string"),
              spark.createDataFrame(na, "NotificationId bigint, ArtistId bigint"),
              spark.createDataFrame(aud, "UserId string, cluster int, ArtistId bigint, artistCluster int"))
    with conf(spark, SKEW_CONF):
        for salts in (1, 8):
            got = sorted(tuple(r) for r in clicked_audience(*frames, salts=salts).collect())
            artist = dict(na)
            want = sorted({(n, artist[n], u, c, x) for n, u in clicks for v, c, a, x in aud if u == v and artist[n] == a})
            assert got == want
