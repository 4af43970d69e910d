"""Property tests for the two pieces of hand-written logic: the distributed
frequency-rank indexer and the CTR fan-out arithmetic."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from audience_engine.functions import parse_id, squared_distance
from audience_engine.operators import label_frequencies, notification_ctr, rank_labels

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

labels = st.lists(st.sampled_from([str(i) for i in range(40)] + ["a", "b", "007", "7", ""]), min_size=1, max_size=120)


@SETTINGS
@given(rows=labels, parts=st.integers(min_value=1, max_value=9))
def test_rank_is_frequency_then_label_order(spark, rows, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame([(x,) for x in rows], "UserId string").repartition(parts)
        got = {r.UserId: r.UserIndex for r in rank_labels(label_frequencies(df, "UserId"), "UserId", "UserIndex").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    counts = pd.Series(rows).value_counts()
    order = sorted(counts.index, key=lambda x: (-counts[x], x.encode()))
    assert got == {x: i for i, x in enumerate(order)}


groups = st.lists(st.integers(min_value=1, max_value=50), min_size=1, max_size=3)


@SETTINGS
@given(clicks=groups, targets=groups)
def test_reference_fanout_is_m_sum_clicks_over_n_sum_targets(spark, clicks, targets):
    c = spark.createDataFrame([(1, a, n) for a, n in enumerate(clicks)],
                              "NotificationId bigint, ArtistId bigint, clusterUserClicks bigint")
    t = spark.createDataFrame([(1, a, n) for a, n in enumerate(targets)],
                              "NotificationId bigint, ArtistId bigint, clusterUserCounts bigint")
    ref = notification_ctr(c, t).first()
    exact = notification_ctr(c, t, fanout="exact").first()
    n, m = len(clicks), len(targets)
    assert (ref.notificationClicks, ref.notificationTotalCounts) == (m * sum(clicks), n * sum(targets))
    assert (exact.notificationClicks, exact.notificationTotalCounts) == (sum(clicks), sum(targets))
    assert exact.CTR == sum(clicks) / sum(targets) * 100


def test_parse_id_and_distance(spark):
    df = spark.createDataFrame([("12", [1.0, 2.0], [1.0, 4.0]), ("x", [0.0], [3.0])], "s string, a array<double>, b array<double>")
    out = df.select(parse_id("s").alias("i"), squared_distance("a", "b").alias("d")).collect()
    assert [(r.i, r.d) for r in out] == [(12, 4.0), (None, 9.0)]


keys = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30)), min_size=0, max_size=60)


@SETTINGS
@given(big=keys, small=st.lists(st.tuples(st.integers(0, 4), st.integers(100, 103)), max_size=8),
       salts=st.integers(1, 7))
def test_salted_join_equals_plain_join(spark, big, small, salts):
    from audience_engine.operators import salted_join
    b = spark.createDataFrame(big, "k int, u int")
    s = spark.createDataFrame(small, "k int, v int")
    got = sorted(tuple(r) for r in salted_join(b, s, ["k"], spread_by="u", salts=salts).select("k", "u", "v").collect())
    want = sorted((k, u, v) for k, u in big for k2, v in small if k == k2)
    assert got == want


audiences = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 3)), min_size=1, max_size=25)  # (user, cluster)
tops = st.lists(st.integers(0, 4), min_size=4, max_size=4)                                       # artist per cluster
notifs = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 5)), min_size=1, max_size=12)      # (notification, artist)
clicklog = st.lists(st.tuples(st.integers(0, 7), st.integers(0, 14)), max_size=40)              # (notification, user)


@SETTINGS
@given(users=audiences, top=tops, na_rows=notifs, click_rows=clicklog)
def test_scalable_ctr_equals_reference_formulation(spark, users, top, na_rows, click_rows):
    """The CTR path without the notified relation gives the reference's
    numbers, in both fan-out modes, with repeated rows anywhere."""
    from audience_engine.operators import (
        build_audience, click_counts, clicked_audience, notification_ctr, notified_clicks, notified_users,
        target_counts, target_counts_from_notified, top_artist_per_cluster)
    clustered = spark.createDataFrame([(f"u{u}", c) for u, c in users], "UserId string, cluster int")
    hits = spark.createDataFrame([(c, a, 1) for c, a in enumerate(top)], "cluster int, ArtistId bigint, artistHits bigint")
    ca = top_artist_per_cluster(hits)
    na = spark.createDataFrame(na_rows, "NotificationId bigint, ArtistId bigint")
    clicks = spark.createDataFrame([(n, f"u{u}") for n, u in click_rows], "NotificationId bigint, UserId string")
    bag = build_audience(clustered, ca, distinct=False)
    notified = notified_users(na, bag)
    ref_clicks = click_counts(notified_clicks(notified, clicks, dedupe_clicks=False))
    ref_targets = target_counts_from_notified(notified)
    aud = build_audience(clustered, ca)
    new_clicks = click_counts(clicked_audience(clicks, na, aud))
    new_targets = target_counts(na, aud)
    for fanout in ("reference", "exact"):
        want = sorted(tuple(r) for r in notification_ctr(ref_clicks, ref_targets, fanout=fanout).collect())
        got = sorted(tuple(r) for r in notification_ctr(new_clicks, new_targets, fanout=fanout).collect())
        assert got == want, fanout
