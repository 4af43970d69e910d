"""Relational and ML operators; every public function is DataFrame -> DataFrame
(or a fitted spark.ml model).  Fits, rankings (``rank_labels``, ``index_ids``,
``build_activity``), ``clicked_audience`` and ``select_k`` run jobs; the rest is lazy."""

from .activity import Activity, build_activity, index_ids, label_frequencies, play_counts, rank_labels
from .audience import (
    attach_clusters,
    build_audience,
    cluster_artist_hits,
    cluster_artist_hits_from_clustered,
    notified_users,
    top_artist_per_cluster,
    user_clusters,
)
from .clustering import (
    KChoice,
    assign_clusters,
    centres_frame,
    choose_k,
    cluster_sizes,
    cluster_users,
    fit_kmeans,
    label_models,
    layout_points,
    mean_centres,
    model_silhouette,
    nearest_centre,
    score_models,
    select_k,
    silhouette,
    squared_errors,
    wssse,
)
from .ctr import (
    click_counts,
    clicked_audience,
    notification_ctr,
    notified_clicks,
    target_counts,
    target_counts_from_notified,
    top_notifications,
)
from .joins import bloom_filter, bloom_semi_join, bloom_words, repeated, salt_table, salted_join, with_salt
from .factors import als_blocks, factor_vectors, fit_taste_factors, standardise, user_factors, vectorize_columns

__all__ = [
    "Activity", "build_activity", "index_ids", "label_frequencies", "play_counts", "rank_labels",
    "attach_clusters", "build_audience", "cluster_artist_hits", "cluster_artist_hits_from_clustered",
    "notified_users", "top_artist_per_cluster", "user_clusters",
    "KChoice", "assign_clusters", "centres_frame", "choose_k", "cluster_sizes", "cluster_users", "fit_kmeans",
    "label_models", "layout_points", "mean_centres", "model_silhouette", "nearest_centre", "score_models", "select_k", "silhouette", "squared_errors", "wssse",
    "click_counts", "clicked_audience", "notification_ctr", "notified_clicks", "target_counts",
    "target_counts_from_notified", "top_notifications",
    "bloom_filter", "bloom_semi_join", "bloom_words", "repeated", "salt_table", "salted_join", "with_salt",
    "als_blocks", "factor_vectors", "fit_taste_factors", "standardise", "user_factors", "vectorize_columns",
]
