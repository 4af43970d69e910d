"""The whole job.

Lineage is cut (a parquet table in the shared checkpoint folder) wherever
later steps read more than once: the play counts and both index orders, the
indexed activity, the user factors and scaled vectors (so nobody refits ALS),
the cluster of each user, the top artists and the audience.  A lost executor
rereads those files; nothing is left persisted, and ``JobResult.release``
deletes them.

With ``resume_dir`` the tables are stages named by input and settings: a job started again after
its driver was lost reads the stages that were finished and goes on at the first one that was not.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import cache

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame

from ..config import PipelineConfig
from ..operators.activity import build_activity
from ..operators.audience import (
    attach_clusters,
    build_audience,
    cluster_artist_hits,
    notified_users,
    top_artist_per_cluster,
    user_clusters,
)
from ..operators.clustering import assign_clusters, fit_kmeans, select_k, silhouette
from ..operators.ctr import (
    click_counts,
    clicked_audience,
    notification_ctr,
    target_counts,
    top_notifications,
)
from ..operators.factors import factor_vectors, fit_taste_factors, standardise, user_factors
from ..session import cut_lineage, drop_tables, in_resumable, job_folder, released_blocks, resumable, scratch_tables, stage
from ..sinks.csv import write_files, write_partitioned_csv, write_single_csv
from ..sources.tables import Inputs


@dataclass
class ClusteredListeners:
    activity: DataFrame      # UserId, SongId, UserIndex, SongIndex, hits
    users: DataFrame         # UserId, UserIndex
    user_cluster: DataFrame  # UserIndex, features, cluster
    als: ALSModel | None     # None where a resumed job read the factors
    kmeans: KMeansModel | None  # None where a resumed job read the labels
    k: int | None = None
    silhouette: float | None = None
    wssse: float | None = None
    by_song: DataFrame | None = None     # the activity, bucketed by (SongId, _salt)
    song_salts: DataFrame | None = None


def _steady(value: float | None) -> float | None:
    """12 digits: the last ones depend on the order in which Spark adds the sums of partitions."""
    return None if value is None else float(f"{value:.12g}")


def cluster_listeners(plays: DataFrame, cfg: PipelineConfig = PipelineConfig()) -> ClusteredListeners:
    """Click log -> indexed activity -> ALS factors -> scaled vectors ->
    K-means clusters per user.  With ``search_k`` the k comes from the
    reference's search (M12)."""
    spark = plays.sparkSession
    act = build_activity(plays, cfg.song_buckets, cfg.rows_per_task)
    # what spark.ml keeps persisted is released once the vectors and the labels are written
    with released_blocks(spark):
        als = cache(lambda: fit_taste_factors(act.activity, rank=cfg.rank, max_iter=cfg.max_iter, reg=cfg.reg, alpha=cfg.alpha,
                                              seed=cfg.als_seed, blocks=cfg.als_blocks, rows_per_block=cfg.als_rows_per_block))
        factors = stage(spark, "factors", lambda: user_factors(als()))
        vectors = stage(spark, "vectors", lambda: standardise(factor_vectors(factors, include_id=cfg.include_id)))
        chosen = cache(lambda: cfg.k if not cfg.search_k else select_k(
            vectors, range(cfg.k_from, cfg.k_to + 1, cfg.k_step), seed=cfg.kmeans_seed, max_iter=cfg.kmeans_max_iter,
            tol=cfg.kmeans_tol, partitions=cfg.kmeans_partitions).k)
        km = cache(lambda: fit_kmeans(vectors, k=chosen(), seed=cfg.kmeans_seed, max_iter=cfg.kmeans_max_iter,
                                      tol=cfg.kmeans_tol, partitions=cfg.kmeans_partitions))
        uc = stage(spark, "user-cluster", lambda: assign_clusters(km(), vectors))

        def quality() -> DataFrame:
            """One row; the silhouette of the labels that were just written (undefined for one centre)."""
            sil = silhouette(uc) if cfg.evaluate and len(km().clusterCenters()) > 1 else None
            cost = float(km().summary.trainingCost) if cfg.evaluate else None
            return spark.createDataFrame([(chosen(), _steady(sil), _steady(cost))], "k int, silhouette double, wssse double")

        k, sil, wss = (stage(spark, "quality", quality) if in_resumable() else quality()).first()
    return ClusteredListeners(activity=act.activity, users=act.users, user_cluster=uc,
                              als=als() if als.cache_info().currsize else None, kmeans=km() if km.cache_info().currsize else None,
                              k=k, silhouette=sil, wssse=wss, by_song=act.by_song, song_salts=act.song_salts)


def popular_artists(listeners: ClusteredListeners, song_artist: DataFrame,
                    cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """(cluster, ArtistId, artistCluster).

    At most k rows, but each costs a pass over the whole activity; written,
    so that every later step reads those rows."""
    activity = listeners.activity if listeners.by_song is None else listeners.by_song
    hits = cluster_artist_hits(activity, listeners.user_cluster, song_artist, weight=cfg.weight, song_salts=listeners.song_salts)
    return cut_lineage(top_artist_per_cluster(hits), "cluster-artist")


def audience_of(listeners: ClusteredListeners, cluster_artist: DataFrame,
                cfg: PipelineConfig = PipelineConfig()) -> DataFrame:
    """The audience; a set of users by default, the reference's bag of
    activity rows with ``distinct_audience=False``."""
    if cfg.distinct_audience:
        return build_audience(user_clusters(listeners.users, listeners.user_cluster), cluster_artist,
                              unique_input=True)
    return build_audience(attach_clusters(listeners.activity, listeners.user_cluster), cluster_artist, distinct=False)


@dataclass
class JobResult:
    listeners: ClusteredListeners
    cluster_artist: DataFrame
    audience: DataFrame
    notified_clicks: DataFrame
    ctr: DataFrame
    top: DataFrame
    rows_per_task: int = 1_000_000
    tables: list[str] = field(default_factory=list)

    def notified(self, notification_artist: DataFrame) -> DataFrame:
        """C4: the full notification list (large; built only on request)."""
        return notified_users(notification_artist, self.audience, rows_per_task=self.rows_per_task)

    def quality(self) -> DataFrame:
        """The figures the reference prints after each fit: k, silhouette, WSSSE (one row)."""
        row = (self.listeners.k, self.listeners.silhouette, self.listeners.wssse)
        return self.top.sparkSession.createDataFrame([row], "k int, silhouette double, wssse double")

    def release(self) -> None:
        """Deletes the job's intermediate tables.  The frames above read them and
        are of no use afterwards; what the sinks wrote stays."""
        drop_tables(self.top.sparkSession, self.tables)


def analyse(listeners: ClusteredListeners, inputs: Inputs, cfg: PipelineConfig = PipelineConfig(),
            sink_dir: str | None = None) -> JobResult:
    """C2-C6 on fitted clusters: popular artist per cluster, audience, clicks,
    CTR and the top notifications.  With ``sink_dir`` the notified clicks (K2)
    and the top notifications (K3) are written as the reference's cluster
    mode did, and with ``write_audience`` the audience (K1)."""
    with scratch_tables() as tables:
        cluster_artist = popular_artists(listeners, inputs.song_artist, cfg)
        # read by the click side and the target side: without the table the two
        # branches (pruned to different columns) would each rebuild it
        audience = cut_lineage(audience_of(listeners, cluster_artist, cfg), "audience")
        clicked = clicked_audience(inputs.notification_clicks, inputs.notification_artist, audience,
                                   dedupe_clicks=cfg.dedupe_clicks, rows_per_task=cfg.rows_per_task)
        if sink_dir:
            clicked = cut_lineage(clicked, "clicked")  # read by the sink and by the counts
        targets = target_counts(inputs.notification_artist, audience, audience_is_set=cfg.distinct_audience)
        ctr = notification_ctr(click_counts(clicked), targets,
                               fanout=cfg.fanout, keep_zero_click=cfg.keep_zero_click)
        top = top_notifications(ctr, n=cfg.top_n, rank_by=cfg.rank_by)
        if sink_dir:
            top = cut_lineage(top, "top")  # the report's n rows: computed once, written and shown
            base = sink_dir.rstrip("/")
            write_partitioned_csv(clicked, f"{base}/notifications", rows_per_file=cfg.rows_per_file)
            write_single_csv(top, f"{base}/top5/CTR.csv")
            if cfg.write_audience:
                write_files(audience, f"{base}/audience", rows_per_file=cfg.audience_rows_per_file)
    return JobResult(listeners=listeners, cluster_artist=cluster_artist, audience=audience,
                     notified_clicks=clicked, ctr=ctr, top=top, rows_per_task=cfg.rows_per_task, tables=list(tables))


def run(inputs: Inputs, cfg: PipelineConfig = PipelineConfig(), sink_dir: str | None = None,
        resume_dir: str | None = None) -> JobResult:
    """The whole job - C1 then C2-C6 (and the sinks).

    ``resume_dir`` is a shared folder that outlives the driver (unlike the session's checkpoint
    folder, which is new in every session).  The job's tables are then stages under a folder there that is named by
    the settings and the input files (``job_folder``): started again, the job reads the finished
    ones.  ``JobResult.release`` deletes the folder, ``drop_stale_jobs`` those of jobs that never came back."""
    folder, stages = None, nullcontext()
    if resume_dir:
        spark = inputs.plays.sparkSession
        each = (inputs.plays, inputs.song_artist, inputs.notification_artist, inputs.notification_clicks)
        folder = job_folder(spark, resume_dir, each, cfg)
        stages = resumable(folder)
    with scratch_tables() as tables, stages:
        result = analyse(cluster_listeners(inputs.plays, cfg), inputs, cfg, sink_dir)
    result.tables = [*tables, folder] if folder else list(tables)
    return result
