"""J1-J6, A1-A6, W1-W3 on tiny frames (FIXTURES.md section 4)."""

import pytest

from audience_engine.operators import (
    attach_clusters,
    build_activity,
    build_audience,
    click_counts,
    clicked_audience,
    cluster_artist_hits,
    cluster_artist_hits_from_clustered,
    cluster_sizes,
    notification_ctr,
    notified_clicks,
    notified_users,
    play_counts,
    target_counts,
    target_counts_from_notified,
    top_artist_per_cluster,
    top_notifications,
    user_clusters,
)


def _plays(spark, rows):
    return spark.createDataFrame(rows, "UserId string, SongId string")


def test_repeated_plays_make_one_activity_row(spark):
    act = build_activity(_plays(spark, [("u1", "s1")] * 3 + [("u2", "s2")])).activity
    rows = {(r.UserId, r.SongId): r.hits for r in act.collect()}
    assert rows == {("u1", "s1"): 3, ("u2", "s2"): 1}
    assert act.dtypes == [("UserId", "string"), ("SongId", "string"), ("UserIndex", "int"),
                          ("SongIndex", "int"), ("hits", "bigint")]


def test_index_is_frequency_rank_with_id_tiebreak(spark):
    plays = _plays(spark, [("b", "s1"), ("b", "s1"), ("a", "s2"), ("c", "s2"), ("c", "s3"), ("c", "s3")])
    users = {r.UserId: r.UserIndex for r in build_activity(plays).users.collect()}
    # c: 3 plays, b: 2 plays, a: 1 play
    assert users == {"c": 0, "b": 1, "a": 2}


def test_index_ties_by_ascending_string(spark):
    plays = _plays(spark, [("10", "s"), ("9", "s"), ("2", "s")])
    users = {r.UserId: r.UserIndex for r in build_activity(plays).users.collect()}
    assert users == {"10": 0, "2": 1, "9": 2}


def test_play_counts(spark):
    out = play_counts(_plays(spark, [("u1", "s1"), ("u1", "s1"), ("u1", "s2")]))
    assert sorted(tuple(r) for r in out.collect()) == [("u1", "s1", 2), ("u1", "s2", 1)]


@pytest.fixture
def small(spark):
    """Users u1-u4 in clusters 0/0/1/2; songs s1-s4 by artists 10/20/20/10."""
    act = spark.createDataFrame(
        [("u1", "s1", 0, 0, 3), ("u2", "s1", 1, 0, 1), ("u2", "s2", 1, 1, 1), ("u3", "s3", 2, 2, 1),
         ("u4", "s4", 3, 3, 1), ("u4", "s1", 3, 0, 2)],
        "UserId string, SongId string, UserIndex int, SongIndex int, hits bigint")
    uc = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 2)], "UserIndex int, cluster int")
    meta = spark.createDataFrame([(10, "s1"), (20, "s2"), (20, "s3"), (10, "s4")], "ArtistId bigint, SongId string")
    users = act.select("UserId", "UserIndex").distinct()
    return act, uc, meta, users


def test_artist_hits_count_pairs_not_plays(spark, small):
    act, uc, meta, _ = small
    hits = {(r.cluster, r.ArtistId): r.artistHits for r in cluster_artist_hits(act, uc, meta).collect()}
    assert hits == {(0, 10): 2, (0, 20): 1, (1, 20): 1, (2, 10): 2}
    plays = {(r.cluster, r.ArtistId): r.artistHits
             for r in cluster_artist_hits(act, uc, meta, weight="plays").collect()}
    assert plays == {(0, 10): 4, (0, 20): 1, (1, 20): 1, (2, 10): 3}


def test_rewritten_hits_equal_reference_formulation(spark, small):
    act, uc, meta, _ = small
    a = sorted(tuple(r) for r in cluster_artist_hits(act, uc, meta).collect())
    b = sorted(tuple(r) for r in cluster_artist_hits_from_clustered(attach_clusters(act, uc), meta).collect())
    assert a == b


def test_duplicate_metadata_doubles_hits(spark, small):
    act, uc, meta, _ = small
    dup = meta.unionByName(spark.createDataFrame([(10, "s1")], "ArtistId bigint, SongId string"))
    hits = {(r.cluster, r.ArtistId): r.artistHits for r in cluster_artist_hits(act, uc, dup).collect()}
    assert hits[(0, 10)] == 4


def test_top_artist_tie_goes_to_lower_id_and_shared_artist_shares_number(spark):
    hits = spark.createDataFrame([(0, 20, 5), (0, 10, 5), (1, 10, 7), (1, 30, 1), (2, 30, 9)],
                                 "cluster int, ArtistId bigint, artistHits bigint")
    top = {r.cluster: (r.ArtistId, r.artistCluster) for r in top_artist_per_cluster(hits).collect()}
    assert top == {0: (10, 1), 1: (10, 1), 2: (30, 2)}


def test_audience_set_and_bag(spark, small):
    act, uc, meta, users = small
    ca = top_artist_per_cluster(cluster_artist_hits(act, uc, meta))
    aud = build_audience(user_clusters(users, uc), ca)
    assert sorted((r.UserId, r.cluster, r.ArtistId) for r in aud.collect()) == [
        ("u1", 0, 10), ("u2", 0, 10), ("u3", 1, 20), ("u4", 2, 10)]
    bag = build_audience(attach_clusters(act, uc), ca, distinct=False)
    assert bag.count() == act.count()
    assert sorted(set(tuple(r) for r in bag.collect())) == sorted(tuple(r) for r in aud.collect())


def test_cluster_sizes(spark, small):
    _, uc, _, _ = small
    assert [tuple(r) for r in cluster_sizes(uc).collect()] == [(0, 2), (1, 1), (2, 1)]


@pytest.fixture
def ctr_case(spark):
    """Audience: artist 10 -> u1..u8 (cluster 0), artist 20 -> u9..u12 (cluster 1)."""
    aud = spark.createDataFrame(
        [(f"u{i}", 0, 10, 1) for i in range(1, 9)] + [(f"u{i}", 1, 20, 2) for i in range(9, 13)],
        "UserId string, cluster int, ArtistId bigint, artistCluster int")
    # n1 -> artists 10 and 20; n2 -> 10 (never clicked); n3 -> 20
    na = spark.createDataFrame([(1, 10), (1, 20), (2, 10), (3, 20)], "NotificationId bigint, ArtistId bigint")
    clicks = spark.createDataFrame(
        [(1, "u1"), (1, "u2"), (1, "u3"), (1, "u1"),  # three clickers, one twice
         (1, "u99"),                                   # not in any audience
         (3, "u9"), (3, "u10"), (3, "u11")],
        "NotificationId bigint, UserId string")
    return aud, na, clicks


def test_click_paths_agree(spark, ctr_case):
    aud, na, clicks = ctr_case
    direct = sorted(tuple(r) for r in clicked_audience(clicks, na, aud).collect())
    via_notified = sorted(tuple(r) for r in notified_clicks(notified_users(na, aud), clicks).collect())
    assert direct == via_notified
    assert len(direct) == 6  # repeated click counted once, outsider ignored


def test_target_paths_agree(spark, ctr_case):
    aud, na, _ = ctr_case
    a = sorted(tuple(r) for r in target_counts(na, aud).collect())
    b = sorted(tuple(r) for r in target_counts_from_notified(notified_users(na, aud)).collect())
    assert a == b


def test_ctr_fanout_reference_and_exact(spark, ctr_case):
    aud, na, clicks = ctr_case
    cc = click_counts(clicked_audience(clicks, na, aud))
    tc = target_counts(na, aud)
    ref = {r.NotificationId: (r.notificationClicks, r.notificationTotalCounts)
           for r in notification_ctr(cc, tc).collect()}
    exact = {r.NotificationId: (r.notificationClicks, r.notificationTotalCounts)
             for r in notification_ctr(cc, tc, fanout="exact").collect()}
    # n1: one clicked group (3) and two targeted groups (8, 4)
    assert ref[1] == (6, 12)
    assert exact[1] == (3, 12)
    assert ref[3] == exact[3] == (3, 4)
    assert 2 not in ref and 2 not in exact


def test_keep_zero_click(spark, ctr_case):
    aud, na, clicks = ctr_case
    cc = click_counts(clicked_audience(clicks, na, aud))
    out = {r.NotificationId: r for r in
           notification_ctr(cc, target_counts(na, aud), fanout="exact", keep_zero_click=True).collect()}
    assert out[2].notificationClicks == 0 and out[2].CTR == 0.0
    assert out[2].notificationTotalCounts == 8


def test_top_notifications_ties_and_rank_by(spark):
    ctr = spark.createDataFrame(
        [(5, 8, 100, 8.0), (2, 8, 400, 2.0), (9, 3, 10, 30.0), (1, 1, 1, 100.0), (7, 8, 50, 16.0), (4, 2, 80, 2.5)],
        "NotificationId bigint, notificationClicks bigint, notificationTotalCounts bigint, CTR double")
    by_clicks = [(r.NotificationId, r.rowNumber) for r in top_notifications(ctr, n=5).orderBy("rowNumber").collect()]
    assert by_clicks == [(2, 1), (5, 2), (7, 3), (9, 4), (4, 5)]
    by_ctr = [r.NotificationId for r in top_notifications(ctr, n=2, rank_by="ctr").orderBy("rowNumber").collect()]
    assert by_ctr == [1, 9]
    with pytest.raises(ValueError):
        top_notifications(ctr, rank_by="views")


def test_duplicate_notification_rows_change_nothing(spark, ctr_case):
    aud, na, clicks = ctr_case
    dup = na.unionByName(na)
    def ctr(n):
        cc = click_counts(clicked_audience(clicks, n, aud))
        return sorted(tuple(r) for r in notification_ctr(cc, target_counts(n, aud)).collect())
    assert ctr(dup) == ctr(na)


def test_reference_multiset_keeps_every_repeat(spark, ctr_case):
    aud, na, clicks = ctr_case
    dup = na.unionByName(na.where("NotificationId = 3"))
    ref = notified_clicks(notified_users(dup, aud), clicks, dedupe_clicks=False)
    mine = clicked_audience(clicks, dup, aud, dedupe_clicks=False)
    assert sorted(tuple(r) for r in mine.collect()) == sorted(tuple(r) for r in ref.collect())
    assert mine.where("NotificationId = 3").count() == 6  # three clickers x two copies of the row
