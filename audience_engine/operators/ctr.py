"""Clicks and click-through rate (J5, J6, A3-A5, P8, W3; composites C5, C6).

The reference materialises ``notified`` (every notification x every audience
user of its artist) and joins the clicks to it - the step its author timed at
30 minutes.  Here both CTR counts come from small relations instead:

* clicks per (notification, artist) = clicks joined to the notification's
  artists and then to the audience on (UserId, ArtistId);
* targets per (notification, artist) = audience size per artist joined to the
  notification -> artist rows.

Both give exactly the reference's ``countDistinct`` results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import ROWS_PER_TASK, bloom_semi_join, bloom_words, salted_join

#: Notification -> artist rows up to which they are broadcast (16 bytes each).
SMALL_ROWS = 1_000_000

_GROUP = ["NotificationId", "ArtistId", "artistCluster"]


def notified_clicks(notified: DataFrame, clicks: DataFrame, dedupe_clicks: bool = True) -> DataFrame:
    """J5 (C5) as the reference writes it: notified rows that were clicked,
    matched on (NotificationId, UserId)."""
    c = clicks.select("NotificationId", "UserId")
    if dedupe_clicks:
        c = c.distinct()
    return (notified.join(c, ["NotificationId", "UserId"])
            .select("NotificationId", "ArtistId", "UserId", "cluster", "artistCluster"))


def clicked_audience(clicks: DataFrame, notification_artist: DataFrame, audience: DataFrame,
                     dedupe_clicks: bool = True, salts: int | None = None, rows_per_task: int = ROWS_PER_TASK,
                     prefilter: bool = True) -> DataFrame:
    """J5 (C5) without the notified relation: the same rows as
    ``notified_clicks(notified_users(na, audience), clicks)``.

    Most clicks come from users outside the notification's audience.  The clicks get their
    notification's artists first (broadcast up to ``SMALL_ROWS`` counted rows, else a join salted
    by each notification's exact number of clicks), and a Bloom filter of the audience's (UserId, ArtistId),
    with a stated bound on its size (``bloom_words``), drops them in the stage that reads
    the clicks: only what passes is made distinct and shuffled to the exact join.  An audience
    too large for the bound goes without the filter (as ``prefilter=False``); the rows are the same.

    Repeated clicks collapse map-side (a user clicking one notification
    a million times shuffles one row per task); the last join is on (UserId, ArtistId)
    against one audience row per user.

    ``dedupe_clicks=False`` keeps every repeat (of clicks and of notification
    -> artist rows); with the reference's bag audience the rows are then the
    reference's multiset exactly."""
    c = clicks.select("NotificationId", "UserId")
    na = notification_artist.select("NotificationId", "ArtistId")
    if dedupe_clicks:
        na = na.distinct()
    na = cut_lineage(na, "notification-artist")  # its size is then known, and it is made once
    if salts is None and na.count() <= SMALL_ROWS:
        aimed = c.join(F.broadcast(na), "NotificationId")
    else:
        aimed = salted_join(c, na, ["NotificationId"], spread_by="UserId", salts=salts, rows_per_task=rows_per_task)
    members = audience.select("UserId", "ArtistId", "cluster", "artistCluster")
    words = bloom_words(members.count()) if prefilter else None
    if words:
        aimed = bloom_semi_join(aimed, members, ["UserId", "ArtistId"], words)
    if dedupe_clicks:
        aimed = aimed.distinct()
    return (aimed.join(members, ["UserId", "ArtistId"])
            .select("NotificationId", "ArtistId", "UserId", "cluster", "artistCluster"))


def click_counts(clicked: DataFrame) -> DataFrame:
    """A3: distinct clickers per (NotificationId, ArtistId, artistCluster)."""
    return clicked.groupBy(*_GROUP).agg(F.countDistinct("UserId").alias("clusterUserClicks"))


def target_counts_from_notified(notified: DataFrame) -> DataFrame:
    """A4 as the reference computes it, from the notified relation."""
    return notified.groupBy(*_GROUP).agg(F.countDistinct("UserId").alias("clusterUserCounts"))


def target_counts(notification_artist: DataFrame, audience: DataFrame, audience_is_set: bool = False) -> DataFrame:
    """A4 from audience sizes: distinct users per artist, joined to the
    notification -> artist rows.  Equal to ``target_counts_from_notified``.

    A distinct count shuffles every audience row once more, keyed by user;
    when the audience is known to hold each user once (``audience_is_set``)
    a plain count gives the same number with map-side partial counts only."""
    users = F.count(F.lit(1)) if audience_is_set else F.countDistinct("UserId")
    sizes = audience.groupBy("ArtistId", "artistCluster").agg(users.alias("clusterUserCounts"))
    na = notification_artist.select("NotificationId", "ArtistId").distinct()
    return na.join(sizes, "ArtistId").select(*_GROUP, "clusterUserCounts")


def notification_ctr(clicks_per_group: DataFrame, targets_per_group: DataFrame,
                     fanout: str = "reference", keep_zero_click: bool = False) -> DataFrame:
    """J6 + A5 + P8: (NotificationId, notificationClicks, notificationTotalCounts, CTR).

    ``fanout="reference"`` joins the per-artist groups on NotificationId alone
    and then sums, as the reference does: a notification with n clicked and m
    targeted artist groups gets m * clicks over n * targets.  ``"exact"`` sums
    each side per notification before the join.  ``keep_zero_click`` keeps
    targeted notifications nobody clicked, with 0 clicks.
    Both inputs hold one row per (notification, artist): small."""
    if fanout not in ("reference", "exact"):
        raise ValueError("fanout must be 'reference' or 'exact'")
    c = clicks_per_group.select("NotificationId", "clusterUserClicks")
    t = targets_per_group.select("NotificationId", "clusterUserCounts")
    if fanout == "exact":
        c = c.groupBy("NotificationId").agg(F.sum("clusterUserClicks").alias("clusterUserClicks"))
        t = t.groupBy("NotificationId").agg(F.sum("clusterUserCounts").alias("clusterUserCounts"))
    if keep_zero_click:
        joined = t.join(c, "NotificationId", "left").fillna(0, subset=["clusterUserClicks"])
    else:
        joined = c.join(t, "NotificationId")
    totals = joined.groupBy("NotificationId").agg(
        F.sum("clusterUserClicks").cast("bigint").alias("notificationClicks"),
        F.sum("clusterUserCounts").cast("bigint").alias("notificationTotalCounts"))
    return totals.withColumn("CTR", F.col("notificationClicks") / F.col("notificationTotalCounts") * 100)


def top_notifications(ctr: DataFrame, n: int = 5, rank_by: str = "clicks") -> DataFrame:
    """W3 + T2 + P6: the n best notifications with their ``rowNumber``.

    By clicks as the reference (the console said CTR but the window orders by
    clicks) or by ``rank_by="ctr"``; ties go to the lower NotificationId.
    Catalyst turns the global ``row_number <= n`` into a top-n sort
    (TakeOrderedAndProject), so no single task sees more than n rows per
    partition."""
    key = {"clicks": "notificationClicks", "ctr": "CTR"}.get(rank_by)
    if key is None:
        raise ValueError("rank_by must be 'clicks' or 'ctr'")
    order = Window.orderBy(F.desc(key), F.asc("NotificationId"))
    return (ctr.withColumn("rowNumber", F.row_number().over(order))
            .where(F.col("rowNumber") <= n))
