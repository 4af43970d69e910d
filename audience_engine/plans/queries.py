"""

Each query takes (spark, sf_dir), reads the test tables in full and returns a
DataFrame.  Queries downstream of K-means take their clusters from the data
itself (the customer's nation and market segment, per-user attributes) so
that the relational operators can be checked against SQL; the K-means
queries have no SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable

from functools import cached_property

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import REFERENCE_K_SWEEP, PipelineConfig
from ..operators.activity import build_activity, index_ids, label_frequencies, play_counts
from ..operators.audience import (
    attach_clusters,
    build_audience,
    cluster_artist_hits,
    cluster_artist_hits_from_clustered,
    notified_users,
    top_artist_per_cluster,
    user_clusters,
)
from ..operators.clustering import (
    assign_clusters,
    centres_frame,
    choose_k,
    cluster_sizes,
    fit_kmeans,
    label_models,
    mean_centres,
    nearest_centre,
    score_models,
    select_k,
    silhouette,
    squared_errors,
    wssse,
)
from ..operators.ctr import (
    click_counts,
    clicked_audience,
    notification_ctr,
    notified_clicks,
    target_counts,
    target_counts_from_notified,
    top_notifications,
)
from ..functions.vectors import array_columns
from ..operators.joins import bloom_semi_join, bloom_words, salt_table, salted_join
from ..operators.factors import factor_vectors, fit_taste_factors, standardise, user_factors, vectorize_columns
from ..session import cut_lineage, drop_tables, released_blocks, resumable, scratch_path
from ..sinks.csv import write_files, write_partitioned_csv, write_single_csv
from ..sources.csv import PLAYS, read_notification_artist, read_notification_clicks, read_plays, read_song_artist
from ..sources.tables import (
    inputs_from_tables,
    notification_artist_from_tables,
    notification_clicks_from_tables,
    plays_from_tables,
    read_table,
)
from .pipeline import ClusteredListeners, analyse, cluster_listeners, run

Query = Callable[[SparkSession, str], DataFrame]
CFG = PipelineConfig()
K_SWEEP = list(REFERENCE_K_SWEEP)  # the reference's k sweep (commented out there)


# -- shared building blocks ---------------------------------------------------

# The market segments of the customer table, in this order.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def customer_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(UserId, cluster): a per-user grouping taken from the data - the
    customer's nation and market segment, ``nation * 10 + segment`` - that
    stands in for K-means labels where the result must be checkable in SQL."""
    seg = F.array_position(F.array(*[F.lit(x) for x in SEGMENTS]), F.col("c_mktsegment")) - 1
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("UserId"),
        (F.col("c_nationkey") * 10 + seg).cast("int").alias("cluster"))


class _Slice:
    """The relational slice on data-derived clusters (nation x segment)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.inputs = inputs_from_tables(spark, sf_dir)
        self.groups = customer_groups(spark, sf_dir)

    @cached_property
    def _built(self):
        return build_activity(self.inputs.plays)

    @property
    def activity(self) -> DataFrame:
        return self._built.activity

    @cached_property
    def users(self) -> DataFrame:
        """The user index alone, without the activity, if nothing has asked for that."""
        return self._built.users if "_built" in self.__dict__ else index_ids(self.inputs.plays, "UserId", "UserIndex")

    @cached_property
    def user_cluster(self) -> DataFrame:
        return self.users.join(self.groups, "UserId").select("UserIndex", "cluster")

    def hits(self, weight: str = "pairs") -> DataFrame:
        """J2 as the job runs it: the activity bucketed by song."""
        built = self._built  # first, so that its user index is the one in use
        return cluster_artist_hits(built.by_song, self.user_cluster, self.inputs.song_artist, weight=weight, song_salts=built.song_salts)

    def cluster_artist(self) -> DataFrame:
        """The top artists; from the play counts by user, where nothing else needs the indexed activity."""
        if "_built" in self.__dict__:
            return top_artist_per_cluster(self.hits())
        counts = play_counts(self.inputs.plays)
        return top_artist_per_cluster(cluster_artist_hits(counts, self.groups, self.inputs.song_artist, user_col="UserId"))

    @cached_property
    def _audience(self) -> DataFrame:
        top = self.cluster_artist()
        if "_built" in self.__dict__:
            members = user_clusters(self.users, self.user_cluster)
        else:
            members = self.inputs.plays.select("UserId").distinct().join(self.groups, "UserId")
        # read by several branches of one query: built once
        return cut_lineage(build_audience(members, top, unique_input=True), "audience")

    def audience(self) -> DataFrame:
        return self._audience

    def audience_bag(self) -> DataFrame:
        activity = self.activity
        return build_audience(attach_clusters(activity, self.user_cluster), self.cluster_artist(), distinct=False)

    def notified(self) -> DataFrame:
        return notified_users(self.inputs.notification_artist, self.audience())

    def clicked(self, audience: DataFrame | None = None) -> DataFrame:
        aud = audience if audience is not None else self.audience()
        return clicked_audience(self.inputs.notification_clicks, self.inputs.notification_artist, aud)

    def ctr(self, fanout: str = "reference", keep_zero_click: bool = False) -> DataFrame:
        aud = self.audience()
        targets = target_counts(self.inputs.notification_artist, aud, audience_is_set=True)
        return notification_ctr(click_counts(self.clicked(aud)), targets,
                                fanout=fanout, keep_zero_click=keep_zero_click)


def _embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features array<float>) from the whole embedding - the shape of ALS
    user factors, with the embedding width as the rank."""
    return read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


def _long_vectors(vecs: DataFrame) -> DataFrame:
    """(id, dim, value rounded to 6 places) from (id, features vector)."""
    return (vecs.select("id", F.posexplode(vector_to_array("features")).alias("dim", "value"))
            .select("id", "dim", F.round("value", 6).alias("value")))


def _embedding_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", array_to_vector("embedding").alias("features"), F.col("label").alias("cluster"))


# -- sources --------------------------------------------------------------------

def q_play_counts(spark, sf_dir):
    return play_counts(inputs_from_tables(spark, sf_dir).plays)


def q_index_users(spark, sf_dir):
    plays = inputs_from_tables(spark, sf_dir).plays
    return index_ids(plays, "UserId", "UserIndex", freqs=label_frequencies(plays, "UserId"))


def q_index_songs(spark, sf_dir):
    plays = inputs_from_tables(spark, sf_dir).plays
    return index_ids(plays, "SongId", "SongIndex")


def q_activity(spark, sf_dir):
    return build_activity(inputs_from_tables(spark, sf_dir).plays).activity


def q_activity_by_song(spark, sf_dir):
    """The activity table bucketed by song, with few enough rows a task that most songs are salted: every row
    lies in the bucket of its song and of a salt below the song's number."""
    built = build_activity(inputs_from_tables(spark, sf_dir).plays, song_buckets=16, rows_per_task=10)
    salted = built.by_song.join(built.song_salts, "SongId", "left")
    return salted.select("UserId", "SongId", "UserIndex", "SongIndex", "hits", F.coalesce("_salts", F.lit(1)).alias("salts"),
                         (F.col("_salt") < F.coalesce("_salts", F.lit(1))).alias("salt_in_range"))


def q_csv_plays(spark, sf_dir):
    """The click log written as headerless CSV, read back."""
    path = scratch_path(spark, "plays-csv")
    raw = plays_from_tables(spark, sf_dir).select(*[F.col(c).cast("string") for c in
                                                    [p.split(" ")[0] for p in PLAYS.split(", ")]])
    # the same plays once more without a song: P5 drops them on read
    no_song = raw.withColumn("SongId", F.lit(None).cast("string"))
    raw.unionByName(no_song).write.option("header", False).csv(path)
    return read_plays(spark, path)


def q_parquet_plays(spark, sf_dir):
    """S1 with a columnar source: the click log as parquet, read by name."""
    path = scratch_path(spark, "plays-parquet")
    plays_from_tables(spark, sf_dir).write.parquet(path)
    return read_plays(spark, path, fmt="parquet")


def q_csv_notification_artist(spark, sf_dir):
    """Notification -> artist CSV; every event's raw JSON props is
    also written as a notification id, which is malformed and dropped."""
    good = notification_artist_from_tables(spark, sf_dir).select(
        F.col("NotificationId").cast("string").alias("NotificationId"), F.col("ArtistId").cast("string").alias("ArtistId"))
    bad = read_table(spark, sf_dir, "events").select(
        F.col("props").alias("NotificationId"), F.col("event_id").cast("string").alias("ArtistId"))
    path = scratch_path(spark, "notification-artist-csv")
    good.unionByName(bad).write.option("header", False).csv(path)
    return read_notification_artist(spark, path)


def q_csv_notification_clicks(spark, sf_dir):
    """Click CSV (NotificationId, UserId, Date); the other events
    are written with their type as the notification id and are dropped."""
    clicks = notification_clicks_from_tables(spark, sf_dir)
    others = (read_table(spark, sf_dir, "events").where(F.col("event_type") != "click")
              .select(F.col("event_type").alias("NotificationId"), F.col("user_id").cast("string").alias("UserId"),
                      F.to_date("ts").alias("Date")))
    path = scratch_path(spark, "notification-clicks-csv")
    clicks.unionByName(others).select(*[F.col(c).cast("string") for c in ["NotificationId", "UserId", "Date"]]) \
        .write.option("header", False).csv(path)
    return read_notification_clicks(spark, path)


def q_csv_roundtrip_clean(spark, sf_dir):
    """Song metadata CSV with text ids, ids with a thousands comma and
    missing ids, which are dropped on read, and decimal ids, which are cut to
    their whole part."""
    part = read_table(spark, sf_dir, "part")
    song = F.col("p_partkey").cast("string").alias("SongId")
    good = part.select(song, F.regexp_extract("p_brand", r"(\d+)\s*$", 1).alias("ArtistId"))
    text = part.select(song, F.col("p_type").alias("ArtistId"))
    decimal = part.select(song, F.format_number("p_retailprice", 2).alias("ArtistId"))
    missing = part.select(song, F.lit(None).cast("string").alias("ArtistId"))
    path = scratch_path(spark, "song-artist-csv")
    good.unionByName(text).unionByName(decimal).unionByName(missing).write.option("header", False).csv(path)
    return read_song_artist(spark, path)


def q_csv_infer_plays(spark, sf_dir):
    """The click log as headerless CSV, column types inferred."""
    path = scratch_path(spark, "plays-infer")
    raw = plays_from_tables(spark, sf_dir)
    raw.select(*[F.col(c).cast("string") for c in raw.columns]).write.option("header", False).csv(path)
    return read_plays(spark, path, infer=True)


def q_csv_infer_song_artist(spark, sf_dir):
    """Song metadata with whole and decimal artist ids, inferred as a
    number and cut to the whole part."""
    part = read_table(spark, sf_dir, "part")
    song = F.col("p_partkey").cast("string").alias("SongId")
    good = part.select(song, F.regexp_extract("p_brand", r"(\d+)\s*$", 1).alias("ArtistId"))
    decimal = part.select(song, F.col("p_retailprice").cast("decimal(18,2)").cast("string").alias("ArtistId"))
    path = scratch_path(spark, "song-artist-infer")
    good.unionByName(decimal).write.option("header", False).csv(path)
    return read_song_artist(spark, path, infer=True)


# -- ML ------------------------------------------------------------------------
# Fits have no SQL twin; each has a query that checks it in Spark, with a twin.

def _als(spark, sf_dir):
    """The activity, and the written user and item factors of the job's ALS fit."""
    act = build_activity(inputs_from_tables(spark, sf_dir).plays).activity
    with released_blocks(spark):
        model = fit_taste_factors(act, rank=CFG.rank, max_iter=CFG.max_iter, reg=CFG.reg, alpha=CFG.alpha,
                                  seed=CFG.als_seed, blocks=CFG.als_blocks, rows_per_block=CFG.als_rows_per_block)
        return act, cut_lineage(user_factors(model), "factors"), cut_lineage(model.itemFactors, "item-factors")


def q_als_user_factors(spark, sf_dir):
    return _als(spark, sf_dir)[1]


def q_als_normal_equations(spark, sf_dir):
    """M4, M5: per user, whether the factors x solve the implicit normal equations
    (Y'Y + reg n I + sum alpha hits y y') x = sum (1 + alpha hits) y, up to a thousandth
    of the right-hand side's largest entry (factors are single precision)."""
    act, users, items = _als(spark, sf_dir)
    r = range(CFG.rank)
    x = users.select(F.col("id").alias("UserIndex"), *array_columns("features", CFG.rank, "x"))
    y = items.select(F.col("id").alias("SongIndex"), *array_columns("features", CFG.rank, "y"))
    square = items.select(*array_columns("features", CFG.rank, "y")).agg(
        *[F.sum(F.col(f"y{i + 1}").cast("double") * F.col(f"y{j + 1}")).alias(f"g{i}_{j}") for i in r for j in r]).first()
    each = act.select("UserIndex", "SongIndex", "hits").join(y, "SongIndex").join(x, "UserIndex")
    dot = sum((F.col(f"x{i + 1}").cast("double") * F.col(f"y{i + 1}") for i in r), F.lit(0.0))
    sums = each.groupBy("UserIndex", *[f"x{i + 1}" for i in r]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(CFG.alpha * F.col("hits") * dot * F.col(f"y{i + 1}")).alias(f"a{i}") for i in r],
        *[F.sum((1 + CFG.alpha * F.col("hits")) * F.col(f"y{i + 1}").cast("double")).alias(f"b{i}") for i in r])
    off = [sum((F.lit(float(square[f"g{i}_{j}"])) * F.col(f"x{j + 1}") for j in r), F.lit(0.0))
           + CFG.reg * F.col("n") * F.col(f"x{i + 1}") + F.col(f"a{i}") - F.col(f"b{i}") for i in r]
    scale = F.greatest(*[F.abs(F.col(f"b{i}")) for i in r])
    return sums.select("UserIndex", (F.greatest(*[F.abs(o) for o in off]) <= 1e-3 * scale).alias("solved"))


def q_factor_vectors_scaled(spark, sf_dir):
    """M6-M8, P7 on the embeddings: id + every value, standardised (long form)."""
    return _long_vectors(standardise(factor_vectors(_embedding_vectors(spark, sf_dir), include_id=True)))


def q_factor_vectors_no_id(spark, sf_dir):
    return _long_vectors(standardise(factor_vectors(_embedding_vectors(spark, sf_dir), include_id=False)))


def q_vectorize_columns(spark, sf_dir):
    """Every embedding value as a column of its own, then all columns but
    the id assembled into one vector (long form)."""
    emb = read_table(spark, sf_dir, "embeddings")
    width = int(emb.select(F.max(F.size("embedding")).alias("w")).first().w or 0)
    wide = emb.select(F.col("vec_id").alias("id"), *array_columns("embedding", width))
    return _long_vectors(vectorize_columns(wide, exclude=("id",)).select("id", "features"))


def q_kmeans_clusters(spark, sf_dir):
    listeners = cluster_listeners(inputs_from_tables(spark, sf_dir).plays, CFG)
    return listeners.user_cluster.select("UserIndex", "cluster")


def q_kmeans_embeddings(spark, sf_dir):
    """M9 on the embeddings with k = 10 labels: (vec_id, cluster)."""
    return _embedding_clusters(spark, sf_dir)[1]


def _embedding_clusters(spark, sf_dir):
    pts = _embedding_labelled(spark, sf_dir).select(F.col("vec_id").alias("id"), "features")
    with released_blocks(spark):
        model = fit_kmeans(pts, k=10, seed=CFG.kmeans_seed, partitions=CFG.kmeans_partitions)
    return model, assign_clusters(model, pts).select(F.col("UserIndex").alias("vec_id"), "cluster")


def _centres(model) -> list[tuple[int, list[float]]]:
    return [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]


def q_kmeans_embeddings_check(spark, sf_dir):
    """M9: every embedding is labelled once, with the nearest of the fitted centres."""
    model, labelled = _embedding_clusters(spark, sf_dir)
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return emb.join(labelled, "vec_id").select(
        "vec_id", (F.col("cluster") == nearest_centre(F.col("embedding"), _centres(model))).alias("nearest"))


def q_kmeans_clusters_check(spark, sf_dir):
    """Every user is labelled once, with the nearest of the job's centres."""
    listeners = cluster_listeners(inputs_from_tables(spark, sf_dir).plays, CFG)
    x = vector_to_array("features")
    return listeners.user_cluster.select(
        "UserIndex", (F.col("cluster") == nearest_centre(x, _centres(listeners.kmeans))).alias("nearest"))


def q_kmeans_assign_fixed_centres(spark, sf_dir):
    """M9's assignment with given centres, the label means: (vec_id, cluster), ties to the lower label."""
    pts = _embedding_labelled(spark, sf_dir)
    centres = sorted((r["cluster"], list(r["centre"])) for r in mean_centres(pts).collect())
    return read_table(spark, sf_dir, "embeddings").select("vec_id", nearest_centre(F.col("embedding"), centres).alias("cluster"))


def q_wssse_fixed_labels(spark, sf_dir):
    """Squared error of each labelled cluster around its mean."""
    pts = _embedding_labelled(spark, sf_dir)
    errs = squared_errors(pts, mean_centres(pts))
    return errs.groupBy("cluster").agg(F.count(F.lit(1)).alias("points"),
                                       F.round(F.sum("sq_error"), 6).alias("wssse"))


def q_silhouette_fixed_labels(spark, sf_dir):
    """Silhouette of the embedding labels (one row)."""
    value = silhouette(_embedding_labelled(spark, sf_dir))
    return spark.createDataFrame([(round(float(value), 6),)], "silhouette double")


def q_select_k(spark, sf_dir):
    vecs = standardise(factor_vectors(_als(spark, sf_dir)[1], include_id=CFG.include_id))
    with released_blocks(spark):
        return select_k(vecs, K_SWEEP, seed=CFG.kmeans_seed, partitions=CFG.kmeans_partitions).metrics


def q_select_k_check(spark, sf_dir):
    """Per k of a sweep over the embeddings, whether silhouette and WSSSE of the joint scoring equal
    spark.ml's silhouette and the squared errors recomputed from the written labels."""
    points = _embedding_labelled(spark, sf_dir).select(F.col("vec_id").alias("id"), "features")
    with released_blocks(spark):
        models = {k: fit_kmeans(points, k=k, seed=CFG.kmeans_seed, partitions=CFG.kmeans_partitions) for k in (4, 8, 12)}
        labels = cut_lineage(label_models(points, models), "sweep-labels")
        scores = score_models(labels, models)
    out = None
    for k, model in models.items():
        sil, cost = scores[k]
        same = abs(silhouette(labels, prediction_col=f"k{k}") - sil) <= 1e-9 if len(model.clusterCenters()) > 1 else sil is None
        errors = wssse(labels, centres_frame(spark, model), prediction_col=f"k{k}")
        row = errors.select(F.lit(k).alias("k"), F.lit(same).alias("silhouette_equal"),
                            (F.abs(F.col("wssse") - cost) <= 1e-9 * F.col("wssse")).alias("wssse_equal"))
        out = row if out is None else out.unionByName(row)
    return out


def q_choose_k_on_nations(spark, sf_dir):
    """M12's selection rule on metrics taken from the tables: per nation, the share of
    its customers in debt stands for the silhouette and their count for the WSSSE."""
    rows = read_table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("int").alias("k")).agg(
        F.round(F.avg(F.when(F.col("c_acctbal") < 0, 1.0).otherwise(0.0)), 6).alias("silhouette"),
        F.count(F.lit(1)).cast("double").alias("wssse")).collect()
    scored, _ = choose_k(sorted((r["k"], r["silhouette"], r["wssse"]) for r in rows))
    schema = "k int, silhouette double, wssse double, silhouette_change double, chosen boolean"
    return spark.createDataFrame(scored, schema).withColumn("silhouette_change", F.round("silhouette_change", 6))


# -- relational slice on data-derived clusters ---------------------------------

def q_cluster_sizes(spark, sf_dir):
    return cluster_sizes(_Slice(spark, sf_dir).user_cluster)


def q_clustered_activity(spark, sf_dir):
    s = _Slice(spark, sf_dir)
    return attach_clusters(s.activity, s.user_cluster)


def q_cluster_artist_hits(spark, sf_dir):
    return _Slice(spark, sf_dir).hits()


def q_cluster_artist_hits_reference(spark, sf_dir):
    s = _Slice(spark, sf_dir)
    return cluster_artist_hits_from_clustered(attach_clusters(s.activity, s.user_cluster), s.inputs.song_artist)


def q_cluster_artist_plays(spark, sf_dir):
    return _Slice(spark, sf_dir).hits(weight="plays")


def q_top_artist_per_cluster(spark, sf_dir):
    return _Slice(spark, sf_dir).cluster_artist()


def q_audience(spark, sf_dir):
    return _Slice(spark, sf_dir).audience()


def q_audience_bag(spark, sf_dir):
    return _Slice(spark, sf_dir).audience_bag()


def q_notified(spark, sf_dir):
    return _Slice(spark, sf_dir).notified()


def q_notified_clicks(spark, sf_dir):
    return _Slice(spark, sf_dir).clicked()


def q_notified_clicks_bag(spark, sf_dir):
    """J5 with the reference's bag audience and repeated clicks kept: the
    reference's notified-clicks rows, duplicates included."""
    s = _Slice(spark, sf_dir)
    return clicked_audience(s.inputs.notification_clicks, s.inputs.notification_artist, cut_lineage(s.audience_bag(), "audience-bag"),
                            dedupe_clicks=False)


def q_notified_clicks_join(spark, sf_dir):
    s = _Slice(spark, sf_dir)
    return notified_clicks(s.notified(), s.inputs.notification_clicks)


def q_artist_salts(spark, sf_dir):
    """J4's salts: per artist with more than 100 users in its audience, one for each 100."""
    return salt_table(_Slice(spark, sf_dir).audience(), ["ArtistId"], rows_per_task=100).withColumnRenamed("_salts", "salts")


def q_notified_salted(spark, sf_dir):
    """J4 where most artists are hot: 100 users a task."""
    s = _Slice(spark, sf_dir)
    return notified_users(s.inputs.notification_artist, s.audience(), rows_per_task=100)


def q_notified_clicks_salted(spark, sf_dir):
    """J5 by the other way, for notifications too many to broadcast and an audience too large for the filter."""
    s = _Slice(spark, sf_dir)
    c = s.inputs.notification_clicks.select("NotificationId", "UserId").distinct()
    aimed = salted_join(c, s.inputs.notification_artist.distinct(), ["NotificationId"], spread_by="UserId", rows_per_task=100)
    return aimed.join(s.audience(), ["UserId", "ArtistId"]).select("NotificationId", "ArtistId", "UserId", "cluster", "artistCluster")


def q_clicks_past_the_filter(spark, sf_dir):
    """J5's Bloom filter: per notification its clicks, those by users of its audience, and whether the filter
    let all of those through and fewer than all clicks overall."""
    s = _Slice(spark, sf_dir)
    keys, on = ["UserId", "ArtistId"], ["NotificationId", "UserId", "ArtistId"]
    members = s.audience().select(*keys)
    na = s.inputs.notification_artist.distinct()
    aimed = cut_lineage(s.inputs.notification_clicks.select("NotificationId", "UserId").distinct().join(na, "NotificationId"), "aimed")
    passed = cut_lineage(bloom_semi_join(aimed, members, keys, bloom_words(members.count())), "passed")
    lost = aimed.join(members, keys, "left_semi").join(passed, on, "left_anti").groupBy("NotificationId").agg(F.count(F.lit(1)).alias("lost"))
    inside = aimed.join(members, keys, "left_semi").groupBy("NotificationId").agg(F.count(F.lit(1)).alias("inside"))
    fewer = 2 * passed.count() < aimed.count()
    every = aimed.groupBy("NotificationId").agg(F.count(F.lit(1)).alias("clicks"))
    return every.join(inside, "NotificationId", "left").join(lost, "NotificationId", "left").select(
        "NotificationId", "clicks", F.coalesce("inside", F.lit(0)).alias("inside"),
        (F.col("lost").isNull() & F.lit(fewer)).alias("filter_holds"))


def q_click_counts(spark, sf_dir):
    return click_counts(_Slice(spark, sf_dir).clicked())


def q_target_counts(spark, sf_dir):
    s = _Slice(spark, sf_dir)
    return target_counts(s.inputs.notification_artist, s.audience(), audience_is_set=True)


def q_target_counts_bag(spark, sf_dir):
    s = _Slice(spark, sf_dir)
    return target_counts(s.inputs.notification_artist, s.audience_bag())


def q_target_counts_notified(spark, sf_dir):
    return target_counts_from_notified(_Slice(spark, sf_dir).notified())


def q_ctr_reference(spark, sf_dir):
    return _Slice(spark, sf_dir).ctr("reference")


def q_ctr_exact(spark, sf_dir):
    return _Slice(spark, sf_dir).ctr("exact")


def q_ctr_keep_zero(spark, sf_dir):
    return _Slice(spark, sf_dir).ctr("exact", keep_zero_click=True)


def q_top5(spark, sf_dir):
    return top_notifications(_Slice(spark, sf_dir).ctr("reference"), n=CFG.top_n)


def q_top5_by_ctr(spark, sf_dir):
    return top_notifications(_Slice(spark, sf_dir).ctr("reference"), n=CFG.top_n, rank_by="ctr")


def q_sink_partitioned(spark, sf_dir):
    """K2: notified clicks partitioned by notification, read back."""
    path = scratch_path(spark, "notifications")
    write_partitioned_csv(cut_lineage(_Slice(spark, sf_dir).clicked(), "clicked"), path, rows_per_file=CFG.rows_per_file)
    return (spark.read.schema("ArtistId bigint, UserId string, cluster int, artistCluster int, NotificationId bigint")
            .csv(path)
            .select("NotificationId", "ArtistId", "UserId", "cluster", "artistCluster"))


def q_sink_audience(spark, sf_dir):
    """K1: the audience in files of a bounded number of rows, read back."""
    path = scratch_path(spark, "audience-csv")
    write_files(_Slice(spark, sf_dir).audience(), path, rows_per_file=CFG.audience_rows_per_file)
    return (spark.read.option("header", True)
            .schema("UserId string, cluster int, ArtistId bigint, artistCluster int").csv(path))


def q_sink_single(spark, sf_dir):
    """K3 + T6: top notifications as one CSV file with a header, read back."""
    path = scratch_path(spark, "top5")
    write_single_csv(top_notifications(_Slice(spark, sf_dir).ctr("reference"), n=CFG.top_n), path)
    schema = "NotificationId bigint, notificationClicks bigint, notificationTotalCounts bigint, CTR double, rowNumber int"
    return spark.read.schema(schema).option("header", True).csv(path)


def q_job_on_customer_groups(spark, sf_dir):
    """C2-C6 exactly as the job runs them (``analyse``), on the data-derived
    clusters instead of K-means, so the composite has a SQL twin."""
    s = _Slice(spark, sf_dir)
    activity = s.activity
    built = s._built
    listeners = ClusteredListeners(activity=activity, users=s.users, user_cluster=s.user_cluster,
                                   als=None, kmeans=None, by_song=built.by_song, song_salts=built.song_salts)
    return analyse(listeners, s.inputs, CFG).top


def q_job_resumed(spark, sf_dir):
    """C7's recovery: C2-C6 run once with their tables as named stages; the last ones are then deleted
    (as a killed driver leaves them unwritten) and the job is run again on the rest."""
    s = _Slice(spark, sf_dir)
    folder = scratch_path(spark, "resumable")
    listeners = ClusteredListeners(activity=s.activity, users=s.users, user_cluster=s.user_cluster, als=None, kmeans=None)
    with resumable(folder):
        cut_lineage(analyse(listeners, s.inputs, CFG).top, "result")
    drop_tables(spark, [f"{folder}/audience", f"{folder}/result"])
    with resumable(folder):
        return cut_lineage(analyse(listeners, s.inputs, CFG).top, "result")


def q_job_against_reference(spark, sf_dir):
    """C1, C2-C7 on the fitted clusters: per notification, how many of its CTR rows differ
    between the job and the reference's formulation (bag audience, notified relation)."""
    inputs = inputs_from_tables(spark, sf_dir)
    job = run(inputs, CFG)
    listeners = job.listeners
    clustered = attach_clusters(listeners.activity, listeners.user_cluster)
    top = top_artist_per_cluster(cluster_artist_hits_from_clustered(clustered, inputs.song_artist))
    notified = cut_lineage(notified_users(inputs.notification_artist, build_audience(clustered, top, distinct=False)), "notified")
    clicked = notified_clicks(notified, inputs.notification_clicks, dedupe_clicks=False)
    plain = notification_ctr(click_counts(clicked), target_counts_from_notified(notified))
    columns = ["notificationClicks", "notificationTotalCounts", "CTR"]
    both = (job.ctr.select("NotificationId", F.struct(*columns).alias("a"))
            .join(plain.select("NotificationId", F.struct(*columns).alias("b")), "NotificationId", "full"))
    off = both.where(~F.col("a").eqNullSafe(F.col("b"))).groupBy("NotificationId").agg(F.count(F.lit(1)).alias("differing"))
    every = inputs.notification_artist.select("NotificationId").distinct()
    return every.join(off, "NotificationId", "left").select("NotificationId", F.coalesce("differing", F.lit(0)).cast("bigint").alias("differing"))


def q_full_pipeline(spark, sf_dir):
    """The whole job with K-means clusters - top notifications."""
    return run(inputs_from_tables(spark, sf_dir), CFG).top


QUERIES: dict[str, Query] = {name: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
