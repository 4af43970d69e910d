"""Physical plan shapes that the scale design depends on."""

import contextlib
import io

from audience_engine.operators import (
    click_counts,
    clicked_audience,
    notification_ctr,
    target_counts,
    top_artist_per_cluster,
    top_notifications,
)
from audience_engine.sources import inputs_from_tables
from audience_engine.sources.tables import notification_clicks_from_tables

from .conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_click_scan_pushes_filter_and_prunes_columns(spark):
    p = plan(notification_clicks_from_tables(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p
    schema = p[p.index("ReadSchema: struct<") + len("ReadSchema: struct<"):].split(">")[0]
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["event_type", "props", "ts", "user_id"]


def test_top_artist_uses_group_limit(spark):
    hits = spark.createDataFrame([(0, 1, 5), (0, 2, 3)], "cluster int, ArtistId bigint, artistHits bigint")
    assert "WindowGroupLimit" in plan(top_artist_per_cluster(hits))


def test_top_notifications_is_a_top_n_sort(spark):
    ctr = spark.createDataFrame([(1, 2, 3, 1.0)],
                                "NotificationId bigint, notificationClicks bigint, "
                                "notificationTotalCounts bigint, CTR double")
    assert "TakeOrderedAndProject" in plan(top_notifications(ctr, 5))


def test_ctr_path_never_joins_targets_to_users(spark):
    """Targets come from audience sizes: the audience is counted per artist
    before the only join, which is on ArtistId - no notification x user
    relation is built."""
    inputs = inputs_from_tables(spark, SF_SMALL)
    aud = spark.createDataFrame([("1", 0, 1, 1)], "UserId string, cluster int, ArtistId bigint, artistCluster int")
    t = target_counts(inputs.notification_artist, aud, audience_is_set=True)
    p = plan(t).split("\n\n")[0]  # the operator tree
    joins = [line for line in p.splitlines() if "Join" in line]
    assert len(joins) == 1, joins
    details = plan(t)
    join_keys = [line for line in details.splitlines() if line.startswith(("Left keys", "Right keys"))]
    assert join_keys and all("ArtistId" in k and "UserId" not in k for k in join_keys), join_keys
    assert "count(1)" in details and "count(distinct" not in details.lower()
    ctr = notification_ctr(click_counts(clicked_audience(inputs.notification_clicks, inputs.notification_artist, aud)), t)
    assert ctr.columns == ["NotificationId", "notificationClicks", "notificationTotalCounts", "CTR"]


def test_explicit_broadcasts_are_bounded(spark):
    """The audience broadcasts the cluster -> artist table (at most k rows),
    never the per-user side."""
    from audience_engine.operators import build_audience
    users = spark.createDataFrame([("u1", 0)], "UserId string, cluster int")
    ca = spark.createDataFrame([(0, 10, 1)], "cluster int, ArtistId bigint, artistCluster int")
    p = plan(build_audience(users, ca, unique_input=True))
    assert "BroadcastExchange" in p
    bx = p[p.index("BroadcastExchange"):]
    assert "artistCluster" in bx


def test_user_clusters_are_never_broadcast_by_a_hint(spark):
    from audience_engine.operators import attach_clusters
    act = spark.createDataFrame([("u", "s", 0, 0, 1)],
                                "UserId string, SongId string, UserIndex int, SongIndex int, hits bigint")
    uc = spark.range(50).selectExpr("cast(id as int) as UserIndex", "cast(id % 3 as int) as cluster")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(attach_clusters(act, uc))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p


def test_notification_list_join_is_salted(spark):
    from audience_engine.operators import notified_users
    na = spark.createDataFrame([(1, 10)], "NotificationId bigint, ArtistId bigint")
    aud = spark.createDataFrame([("u1", 0, 10, 1)], "UserId string, cluster int, ArtistId bigint, artistCluster int")
    p = plan(notified_users(na, aud, salts=16))
    assert "_salt" in p and "xxhash64(UserId" in p
