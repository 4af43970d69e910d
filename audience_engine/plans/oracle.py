"""DuckDB SQL twins of the registry queries (same column names and types).

The SQL follows the reference job's own formulation - the audience as a bag
of activity rows, the notified relation materialised, click and target
counts from it - so that it checks the rewritten Spark plans rather than
repeating them.  Clusters are the customer's nation and market segment, as in
the registry.
"""

from __future__ import annotations

_BASE = r"""
WITH plays AS (
    SELECT CAST(o.o_custkey AS VARCHAR) AS UserId, CAST(l.l_partkey AS VARCHAR) AS SongId
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
    WHERE o.o_custkey IS NOT NULL AND l.l_partkey IS NOT NULL
),
pairs AS (SELECT UserId, SongId, COUNT(*) AS hits FROM plays GROUP BY UserId, SongId),
users AS (
    SELECT UserId, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, UserId) - 1 AS INTEGER) AS UserIndex
    FROM plays GROUP BY UserId
),
songs AS (
    SELECT SongId, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, SongId) - 1 AS INTEGER) AS SongIndex
    FROM plays GROUP BY SongId
),
activity AS (
    SELECT p.UserId, p.SongId, u.UserIndex, s.SongIndex, p.hits
    FROM pairs p JOIN users u ON p.UserId = u.UserId JOIN songs s ON p.SongId = s.SongId
),
user_cluster AS (
    SELECT u.UserIndex,
           CAST(c.c_nationkey * 10 + CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
                WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 ELSE -1 END AS INTEGER)
           AS cluster
    FROM users u JOIN customer c ON u.UserId = CAST(c.c_custkey AS VARCHAR)
),
clustered_activity AS (
    SELECT a.UserIndex, a.UserId, a.SongId, a.SongIndex, a.hits, uc.cluster
    FROM activity a JOIN user_cluster uc ON a.UserIndex = uc.UserIndex
),
song_artist AS (
    SELECT * FROM (
        SELECT TRY_CAST(regexp_extract(p_brand, '(\d+)\s*$', 1) AS BIGINT) AS ArtistId,
               CAST(p_partkey AS VARCHAR) AS SongId
        FROM part) t
    WHERE ArtistId IS NOT NULL AND SongId IS NOT NULL
),
ks AS (
    SELECT DISTINCT TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
notification_artist AS (
    SELECT k AS NotificationId,
           UNNEST(CASE WHEN k % 10 = 0 THEN [k % 25 + 1, (k + 7) % 25 + 1] ELSE [k % 25 + 1] END) AS ArtistId
    FROM ks WHERE k IS NOT NULL
),
clicks AS (
    SELECT * FROM (
        SELECT TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS NotificationId,
               CAST(user_id AS VARCHAR) AS UserId
        FROM events WHERE event_type = 'click') t
    WHERE NotificationId IS NOT NULL AND UserId IS NOT NULL
),
hits AS (
    SELECT ca.cluster, sa.ArtistId, COUNT(*) AS artistHits
    FROM clustered_activity ca JOIN song_artist sa ON ca.SongId = sa.SongId
    GROUP BY ca.cluster, sa.ArtistId
),
cluster_artist AS (
    SELECT cluster, ArtistId, CAST(dense_rank() OVER (ORDER BY ArtistId) AS INTEGER) AS artistCluster
    FROM (SELECT cluster, ArtistId,
                 row_number() OVER (PARTITION BY cluster ORDER BY artistHits DESC, ArtistId) AS rn
          FROM hits) t
    WHERE rn = 1
),
audience_bag AS (
    SELECT ca.UserId, ca.cluster, x.ArtistId, x.artistCluster
    FROM clustered_activity ca JOIN cluster_artist x ON ca.cluster = x.cluster
),
notified AS (
    SELECT na.NotificationId, na.ArtistId, a.UserId, a.cluster, a.artistCluster
    FROM notification_artist na JOIN audience_bag a ON na.ArtistId = a.ArtistId
),
notified_clicks AS (
    SELECT c.NotificationId, n.ArtistId, c.UserId, n.cluster, n.artistCluster
    FROM notified n JOIN clicks c ON n.NotificationId = c.NotificationId AND n.UserId = c.UserId
),
click_groups AS (
    SELECT NotificationId, ArtistId, artistCluster, COUNT(DISTINCT UserId) AS clusterUserClicks
    FROM notified_clicks GROUP BY NotificationId, ArtistId, artistCluster
),
target_groups AS (
    SELECT NotificationId, ArtistId, artistCluster, COUNT(DISTINCT UserId) AS clusterUserCounts
    FROM notified GROUP BY NotificationId, ArtistId, artistCluster
),
ctr_reference AS (
    SELECT c.NotificationId,
           CAST(SUM(c.clusterUserClicks) AS BIGINT) AS notificationClicks,
           CAST(SUM(t.clusterUserCounts) AS BIGINT) AS notificationTotalCounts
    FROM click_groups c JOIN target_groups t ON c.NotificationId = t.NotificationId
    GROUP BY c.NotificationId
),
click_totals AS (
    SELECT NotificationId, SUM(clusterUserClicks) AS clicks FROM click_groups GROUP BY NotificationId
),
target_totals AS (
    SELECT NotificationId, SUM(clusterUserCounts) AS targets FROM target_groups GROUP BY NotificationId
),
ctr_exact AS (
    SELECT c.NotificationId, CAST(c.clicks AS BIGINT) AS notificationClicks,
           CAST(t.targets AS BIGINT) AS notificationTotalCounts
    FROM click_totals c JOIN target_totals t ON c.NotificationId = t.NotificationId
),
ctr_keep_zero AS (
    SELECT t.NotificationId, CAST(COALESCE(c.clicks, 0) AS BIGINT) AS notificationClicks,
           CAST(t.targets AS BIGINT) AS notificationTotalCounts
    FROM target_totals t LEFT JOIN click_totals c ON c.NotificationId = t.NotificationId
)
"""


def _ctr(rel: str) -> str:
    return (f"SELECT NotificationId, notificationClicks, notificationTotalCounts, "
            f"CAST(notificationClicks AS DOUBLE) / notificationTotalCounts * 100 AS CTR FROM {rel}")


def _top(rel: str, key: str) -> str:
    return (f"SELECT * FROM (SELECT NotificationId, notificationClicks, notificationTotalCounts, "
            f"CAST(notificationClicks AS DOUBLE) / notificationTotalCounts * 100 AS CTR, "
            f"CAST(row_number() OVER (ORDER BY {key} DESC, NotificationId) AS INTEGER) AS rowNumber "
            f"FROM {rel}) t WHERE rowNumber <= 5")


_TOP_BY_CTR = ("SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY CTR DESC, NotificationId) AS INTEGER) "
               "AS rowNumber FROM (" + _ctr("ctr_reference") + ") c) t WHERE rowNumber <= 5")

_TAILS = {
    "q_play_counts": "SELECT UserId, SongId, hits FROM pairs",
    "q_index_users": "SELECT UserId, UserIndex FROM users",
    "q_index_songs": "SELECT SongId, SongIndex FROM songs",
    "q_activity": "SELECT UserId, SongId, UserIndex, SongIndex, hits FROM activity",
    "q_activity_by_song": (
        "SELECT UserId, SongId, UserIndex, SongIndex, hits, "
        "CAST(ceil(COUNT(*) OVER (PARTITION BY SongId) / 10.0) AS INTEGER) AS salts, true AS salt_in_range FROM activity"),
    "q_csv_plays": "SELECT UserId, SongId FROM plays",
    "q_parquet_plays": "SELECT UserId, SongId FROM plays",
    # a price of 1,000 or more is written with a comma and stays malformed
    "q_csv_roundtrip_clean": (
        "SELECT ArtistId, SongId FROM song_artist UNION ALL "
        "SELECT CAST(floor(round(p_retailprice, 2)) AS BIGINT) AS ArtistId, CAST(p_partkey AS VARCHAR) AS SongId "
        "FROM part WHERE round(p_retailprice, 2) < 1000"),
    "q_csv_infer_plays": "SELECT UserId, SongId FROM plays",
    "q_csv_infer_song_artist": (
        "SELECT ArtistId, SongId FROM song_artist UNION ALL "
        "SELECT CAST(floor(round(p_retailprice, 2)) AS BIGINT) AS ArtistId, CAST(p_partkey AS VARCHAR) AS SongId FROM part"),
    "q_als_normal_equations": "SELECT UserIndex, true AS solved FROM users",
    "q_kmeans_clusters_check": "SELECT UserIndex, true AS nearest FROM users",
    "q_job_against_reference": "SELECT k AS NotificationId, CAST(0 AS BIGINT) AS differing FROM ks WHERE k IS NOT NULL",
    "q_sink_audience": "SELECT DISTINCT UserId, cluster, ArtistId, artistCluster FROM audience_bag",
    "q_csv_notification_artist": "SELECT NotificationId, ArtistId FROM notification_artist",
    "q_csv_notification_clicks": "SELECT NotificationId, UserId FROM clicks",
    "q_cluster_sizes": "SELECT cluster, COUNT(*) AS count FROM user_cluster GROUP BY cluster",
    "q_clustered_activity": "SELECT UserIndex, UserId, SongId, SongIndex, hits, cluster FROM clustered_activity",
    "q_cluster_artist_hits": "SELECT cluster, ArtistId, artistHits FROM hits",
    "q_cluster_artist_hits_reference": "SELECT cluster, ArtistId, artistHits FROM hits",
    "q_cluster_artist_plays": (
        "SELECT ca.cluster, sa.ArtistId, CAST(SUM(ca.hits) AS BIGINT) AS artistHits "
        "FROM clustered_activity ca JOIN song_artist sa ON ca.SongId = sa.SongId GROUP BY ca.cluster, sa.ArtistId"),
    "q_top_artist_per_cluster": "SELECT cluster, ArtistId, artistCluster FROM cluster_artist",
    "q_audience": "SELECT DISTINCT UserId, cluster, ArtistId, artistCluster FROM audience_bag",
    "q_audience_bag": "SELECT UserId, cluster, ArtistId, artistCluster FROM audience_bag",
    "q_notified": "SELECT DISTINCT NotificationId, ArtistId, UserId, cluster, artistCluster FROM notified",
    "q_notified_clicks": "SELECT DISTINCT NotificationId, ArtistId, UserId, cluster, artistCluster FROM notified_clicks",
    "q_notified_clicks_bag": "SELECT NotificationId, ArtistId, UserId, cluster, artistCluster FROM notified_clicks",
    "q_notified_clicks_join": (
        "SELECT DISTINCT NotificationId, ArtistId, UserId, cluster, artistCluster FROM notified_clicks"),
    "q_artist_salts": (
        "SELECT ArtistId, CAST(ceil(COUNT(DISTINCT UserId) / 100.0) AS INTEGER) AS salts FROM audience_bag "
        "GROUP BY ArtistId HAVING COUNT(DISTINCT UserId) > 100"),
    "q_notified_salted": "SELECT DISTINCT NotificationId, ArtistId, UserId, cluster, artistCluster FROM notified",
    "q_notified_clicks_salted": (
        "SELECT DISTINCT NotificationId, ArtistId, UserId, cluster, artistCluster FROM notified_clicks"),
    "q_clicks_past_the_filter": (
        "SELECT a.NotificationId, COUNT(*) AS clicks, COUNT(b.UserId) AS inside, true AS filter_holds "
        "FROM (SELECT DISTINCT c.NotificationId, c.UserId, na.ArtistId FROM clicks c "
        "JOIN notification_artist na ON c.NotificationId = na.NotificationId) a "
        "LEFT JOIN (SELECT DISTINCT UserId, ArtistId FROM audience_bag) b ON a.UserId = b.UserId AND a.ArtistId = b.ArtistId "
        "GROUP BY a.NotificationId"),
    "q_click_counts": "SELECT NotificationId, ArtistId, artistCluster, clusterUserClicks FROM click_groups",
    "q_target_counts": "SELECT NotificationId, ArtistId, artistCluster, clusterUserCounts FROM target_groups",
    "q_target_counts_bag": "SELECT NotificationId, ArtistId, artistCluster, clusterUserCounts FROM target_groups",
    "q_target_counts_notified": (
        "SELECT NotificationId, ArtistId, artistCluster, clusterUserCounts FROM target_groups"),
    "q_ctr_reference": _ctr("ctr_reference"),
    "q_ctr_exact": _ctr("ctr_exact"),
    "q_ctr_keep_zero": _ctr("ctr_keep_zero"),
    "q_top5": _top("ctr_reference", "notificationClicks"),
    "q_job_on_customer_groups": _top("ctr_reference", "notificationClicks"),
    "q_job_resumed": _top("ctr_reference", "notificationClicks"),
    "q_top5_by_ctr": _TOP_BY_CTR,
    "q_sink_partitioned": (
        "SELECT DISTINCT NotificationId, ArtistId, UserId, cluster, artistCluster FROM notified_clicks"),
    "q_sink_single": _top("ctr_reference", "notificationClicks"),
}

# Standardised vectors in long form (id, dim, value): dimension 0 is the id
# itself when it is a feature, then every embedding value; (x - mean) / sample sd.
def _scaled(with_id: bool) -> str:
    first = "0" if with_id else "1"
    shift = "" if with_id else " - 1"
    id_rows = ("SELECT vec_id AS id, 0 AS d, CAST(vec_id AS DOUBLE) AS v FROM embeddings UNION ALL "
               if with_id else "")
    return f"""
WITH x AS (
    {id_rows}SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) AS INTEGER) AS d,
           CAST(unnest(embedding) AS DOUBLE) AS v
    FROM embeddings
),
m AS (SELECT d, avg(v) AS mu, stddev_samp(v) AS sd FROM x GROUP BY d)
SELECT x.id, CAST(x.d{shift} AS INTEGER) AS dim, round((x.v - m.mu) / m.sd, 6) AS value
FROM x JOIN m ON x.d = m.d
WHERE x.d >= {first}
"""


# Per embedding value: (vec_id, label, dimension, value).
_POINTS = """
WITH x AS (
    SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS d
    FROM embeddings
),
centre AS (SELECT label, d, avg(v) AS m FROM x GROUP BY label, d)
"""

_WSSSE = _POINTS + """
SELECT CAST(x.label AS INTEGER) AS cluster, CAST(COUNT(DISTINCT x.vec_id) AS BIGINT) AS points,
       round(SUM((x.v - c.m) * (x.v - c.m)), 6) AS wssse
FROM x JOIN centre c ON x.label = c.label AND x.d = c.d
GROUP BY x.label
"""

# The nearest label mean of each point by squared distance, ties to the lower label.
_NEAREST = _POINTS + """,
apart AS (
    SELECT x.vec_id, c.label, SUM((x.v - c.m) * (x.v - c.m)) AS d2
    FROM x JOIN centre c ON x.d = c.d GROUP BY x.vec_id, c.label
)
SELECT vec_id, CAST(label AS INTEGER) AS cluster
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, label) AS rn FROM apart) t
WHERE rn = 1
"""

# The rule over k: a later k is chosen when its change of silhouette beats that of the
# last chosen k and its WSSSE is below that one's.
_CHOOSE_K = """
WITH RECURSIVE m AS (
    SELECT CAST(c_nationkey AS INTEGER) AS k, round(avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END), 6) AS silhouette,
           CAST(COUNT(*) AS DOUBLE) AS wssse
    FROM customer GROUP BY c_nationkey
),
o AS (
    SELECT *, row_number() OVER (ORDER BY k) AS i, lag(silhouette) OVER (ORDER BY k) AS before FROM m
),
r AS (
    SELECT i, k, silhouette, wssse, CAST(0 AS DOUBLE) AS silhouette_change, true AS chosen,
           CAST(0 AS DOUBLE) AS best_change, wssse AS best_wssse
    FROM o WHERE i = 1
    UNION ALL
    SELECT o.i, o.k, o.silhouette, o.wssse, (o.silhouette - o.before) / nullif(o.before, 0),
           coalesce((o.silhouette - o.before) / nullif(o.before, 0) > r.best_change AND o.wssse < r.best_wssse, false),
           CASE WHEN coalesce((o.silhouette - o.before) / nullif(o.before, 0) > r.best_change AND o.wssse < r.best_wssse, false)
                THEN (o.silhouette - o.before) / o.before ELSE r.best_change END,
           CASE WHEN coalesce((o.silhouette - o.before) / nullif(o.before, 0) > r.best_change AND o.wssse < r.best_wssse, false)
                THEN o.wssse ELSE r.best_wssse END
    FROM r JOIN o ON o.i = r.i + 1
)
SELECT k, silhouette, wssse, round(silhouette_change, 6) AS silhouette_change, chosen FROM r
"""

# Silhouette with squared Euclidean distance, from per-cluster sums: the mean
# squared distance of point p to cluster C is |p|^2 + sum_C|q|^2/n_C - 2 p.sum_C q/n_C;
# a point's own cluster is averaged over n_C - 1 others; singletons score 0.
_SILHOUETTE = _POINTS + """,
sums AS (SELECT label, d, SUM(v) AS s FROM x GROUP BY label, d),
norms AS (SELECT vec_id, label, SUM(v * v) AS nn FROM x GROUP BY vec_id, label),
stats AS (SELECT label, COUNT(*) AS n, SUM(nn) AS nn_sum FROM norms GROUP BY label),
dots AS (
    SELECT x.vec_id, s.label AS target, SUM(x.v * s.s) AS dot
    FROM x JOIN sums s ON x.d = s.d GROUP BY x.vec_id, s.label
),
dist AS (
    SELECT p.vec_id, p.label AS own, st.label AS target, st.n,
           p.nn + st.nn_sum / st.n - 2 * d.dot / st.n AS avg_d
    FROM norms p JOIN dots d ON p.vec_id = d.vec_id JOIN stats st ON d.target = st.label
),
per_point AS (
    SELECT vec_id,
           MAX(CASE WHEN target = own THEN n END) AS own_n,
           MAX(CASE WHEN target = own THEN avg_d * n / (n - 1) END) AS a,
           MIN(CASE WHEN target <> own THEN avg_d END) AS b
    FROM dist GROUP BY vec_id
)
SELECT round(AVG(CASE WHEN own_n = 1 THEN 0.0
                      WHEN a < b THEN 1 - a / b
                      WHEN a > b THEN b / a - 1
                      ELSE 0.0 END), 6) AS silhouette
FROM per_point
"""


def oracle_sql() -> dict[str, str]:
    out = {name: _BASE + tail for name, tail in _TAILS.items()}
    out["q_factor_vectors_scaled"] = _scaled(True)
    out["q_factor_vectors_no_id"] = _scaled(False)
    out["q_vectorize_columns"] = (
        "SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim, "
        "round(CAST(unnest(embedding) AS DOUBLE), 6) AS value FROM embeddings")
    out["q_kmeans_embeddings_check"] = "SELECT vec_id, true AS nearest FROM embeddings"
    out["q_kmeans_assign_fixed_centres"] = _NEAREST
    out["q_select_k_check"] = (
        "SELECT k, true AS silhouette_equal, true AS wssse_equal FROM (VALUES (4), (8), (12)) t(k) "
        "WHERE (SELECT COUNT(*) FROM embeddings) > 0")
    out["q_choose_k_on_nations"] = _CHOOSE_K
    out["q_wssse_fixed_labels"] = _WSSSE
    out["q_silhouette_fixed_labels"] = _SILHOUETTE
    return out
