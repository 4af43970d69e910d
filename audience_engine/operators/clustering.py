"""Clustering (M9-M12, A6): K-means, silhouette, within-set squared error and
the reference's search over k."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ..functions.vectors import squared_distance
from ..session import cut_lineage

#: Fits of a sweep that run side by side.
FITS_AT_ONCE = 3


def layout_points(vectors: DataFrame, id_col: str = "id", partitions: int = 8) -> DataFrame:
    """Points hash-partitioned by id into a fixed number of partitions and
    sorted in each: a layout that depends on the points alone, so k-means||
    sampling gives the same centres on any cluster."""
    return vectors.repartition(partitions, id_col).sortWithinPartitions(id_col)


def fit_kmeans(vectors: DataFrame, k: int = 275, seed: int = 1, max_iter: int = 20, tol: float = 1e-4,
               features_col: str = "features", id_col: str | None = "id", partitions: int = 8) -> KMeansModel:
    """M9 fit: spark.ml K-means (k-means|| initialisation).  k above the
    number of distinct points yields fewer centres, never an error.

    k-means|| samples each partition with a seed derived from the partition
    index, so a fit depends on which rows sit in which partition and in what
    order - and a table read back from files has no fixed order.  With an
    ``id_col`` the points are hash-partitioned by id into ``partitions`` and
    sorted inside each first, so the same points, seed and ``partitions`` give
    the same centres, whatever the number of cores."""
    if id_col and id_col in vectors.columns:
        vectors = layout_points(vectors, id_col, partitions)
    km = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol=features_col, predictionCol="prediction")
    return km.fit(vectors)


def assign_clusters(model: KMeansModel, vectors: DataFrame, id_col: str = "id") -> DataFrame:
    """M9 assign: (UserIndex, features, cluster int)."""
    return (model.transform(vectors)
            .select(F.col(id_col).alias("UserIndex"), "features", F.col("prediction").cast("int").alias("cluster")))


def cluster_users(vectors: DataFrame, k: int = 275, seed: int = 1, max_iter: int = 20,
                  tol: float = 1e-4) -> tuple[KMeansModel, DataFrame]:
    """M9: fit and assign."""
    model = fit_kmeans(vectors, k=k, seed=seed, max_iter=max_iter, tol=tol)
    return model, assign_clusters(model, vectors)


def silhouette(predictions: DataFrame, features_col: str = "features", prediction_col: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distance.  spark.ml computes
    it from per-cluster sums (k rows), never from point pairs."""
    ev = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return ev.evaluate(predictions)


def model_silhouette(model: KMeansModel, vectors: DataFrame) -> float | None:
    """Silhouette of a fitted model's assignment; None (undefined) when the
    fit found a single centre: the evaluator needs two clusters."""
    if len(model.clusterCenters()) < 2:
        return None
    return float(silhouette(assign_clusters(model, vectors)))


def centres_frame(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """(cluster, centre array<double>) - k rows from the fitted model."""
    schema = StructType([StructField("cluster", IntegerType(), False),
                         StructField("centre", ArrayType(DoubleType(), False), False)])
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, schema)


def _as_array(df: DataFrame, col: str):
    """A vector or array column as array<double>."""
    if dict(df.dtypes).get(col) == "vector":
        return vector_to_array(col)
    return F.col(col).cast("array<double>")


def _as_vector(df: DataFrame, col: str):
    """A vector or array column as a vector."""
    if dict(df.dtypes).get(col) == "vector":
        return F.col(col)
    return array_to_vector(col)


def squared_errors(assigned: DataFrame, centres: DataFrame, features_col: str = "features",
                   prediction_col: str = "cluster") -> DataFrame:
    """Per-row squared distance to the assigned centre.  ``centres`` has one
    row per cluster (at most k), so it is broadcast."""
    pts = assigned.select(F.col(prediction_col).alias("cluster"), _as_array(assigned, features_col).alias("_x"))
    return (pts.join(F.broadcast(centres), "cluster")
            .select("cluster", squared_distance("_x", "centre").alias("sq_error")))


def wssse(assigned: DataFrame, centres: DataFrame, features_col: str = "features",
          prediction_col: str = "cluster") -> DataFrame:
    """Within-set sum of squared errors as a one-row DataFrame.

    ``computeCost`` is gone from KMeansModel in Spark 4; for the training set
    ``model.summary.trainingCost`` is the same number."""
    return squared_errors(assigned, centres, features_col, prediction_col).agg(F.sum("sq_error").alias("wssse"))


def nearest_centre(point: Column, centres: list[tuple[int, list[float]]]) -> Column:
    """The label of the centre with the least squared distance to an array
    column; ties go to the lower label.  The k centres are constants of the
    expression: no join."""
    def constant(c: list[float]) -> Column:  # one literal per centre; repr keeps every bit
        return F.split(F.lit(",".join(repr(float(x)) for x in c)), ",").cast("array<double>")

    apart = [F.struct(squared_distance(point, constant(c)).alias("d"), F.lit(int(label)).alias("label")) for label, c in centres]
    return F.array_min(F.array(*apart))["label"]


def mean_centres(assigned: DataFrame, features_col: str = "features", prediction_col: str = "cluster") -> DataFrame:
    """(cluster, centre array<double>): the mean point of each labelled
    cluster, for the WSSSE of a fixed labelling.  One aggregation (map-side
    partial sums), k output rows."""
    x = _as_vector(assigned, features_col)
    means = assigned.groupBy(F.col(prediction_col).alias("cluster")).agg(Summarizer.mean(x).alias("_m"))
    return means.select("cluster", vector_to_array("_m").alias("centre"))


def cluster_sizes(user_cluster: DataFrame) -> DataFrame:
    """A6 + T3: users per cluster, ordered by cluster."""
    return user_cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("count")).orderBy("cluster")


@dataclass(frozen=True)
class KChoice:
    metrics: DataFrame  # k, silhouette, wssse, silhouette_change, chosen
    k: int
    labels: DataFrame   # id, features, one column k<k> for each k: the written labels


def choose_k(rows: list[tuple[int, float | None, float]]) -> tuple[list[tuple], int]:
    """M12's rule on (k, silhouette, wssse) rows in sweep order.

    The first k is chosen; a later k is chosen when its relative change of
    silhouette (against the previous k's) exceeds that of the last chosen k
    and its WSSSE is below the last chosen one's.  The first k's change is 0.
    A change against an undefined silhouette or one of 0 is undefined (None)
    and never chosen."""
    out, chosen_k = [], None
    prev_sil, best_change, best_wssse = None, None, None
    for k, sil, cost in rows:
        first = chosen_k is None
        change = 0.0 if first else None if sil is None or not prev_sil else (sil - prev_sil) / prev_sil
        pick = first or (change is not None and change > best_change and cost < best_wssse)
        if pick:
            chosen_k, best_change, best_wssse = k, change, cost
        out.append((k, sil, cost, change, pick))
        prev_sil = sil
    return out, chosen_k


def label_models(vectors: DataFrame, models: dict[int, KMeansModel]) -> DataFrame:
    """(id, features, k<k>...): the points with every model's label, in one pass."""
    out = vectors.select("id", "features")
    for k, model in models.items():
        out = model.copy().setPredictionCol(f"k{k}").transform(out)
    return out


def score_models(labelled: DataFrame, models: dict[int, KMeansModel]) -> dict[int, tuple[float | None, float]]:
    """{k: (silhouette, WSSSE)} of all models over ``label_models``' points, in two passes for the whole sweep
    instead of two for every k.

    1. Per (k, cluster): points, sum and squared norm, summed map-side; as many rows as the models have
       centres.
    2. Per point and model, its silhouette and its squared distance to its centre, from those sums (the
       mean squared distance to a cluster follows from them); one row of sums per model and Arrow batch.

    The silhouette is spark.ml's (squared Euclidean): a point alone in its cluster scores 0, and one
    cluster alone has none (None)."""
    width = len(next(iter(models.values())).clusterCenters()[0])
    dims = [f"x{i}" for i in range(width)]
    x = vector_to_array("features")
    plain = labelled.select(*[x[i].alias(c) for i, c in enumerate(dims)], *[f"k{k}" for k in models])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("cluster")) for k in models]))
    squares = sum((F.col(c) * F.col(c) for c in dims), F.lit(0.0))
    sums = plain.select(*dims, squares.alias("sq"), each.alias("of")).groupBy("of.k", "of.cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sq").alias("sq"), *[F.sum(c).alias(c) for c in dims]).collect()
    tables = {}
    for k, model in models.items():
        centres = np.array(model.clusterCenters())
        n, sq, total = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(centres.shape)
        for r in sums:
            if r["k"] == k:
                n[r["cluster"]], sq[r["cluster"]], total[r["cluster"]] = r["n"], r["sq"], [r[c] for c in dims]
        tables[k] = centres, n, sq, total

    def run(batches):
        for b in batches:
            points = b[dims].to_numpy(dtype=float)
            own_sq = (points * points).sum(axis=1)
            rows = []
            for k, (centres, n, sq, total) in tables.items():
                label = b[f"k{k}"].to_numpy()
                cost = ((points - centres[label]) ** 2).sum()
                score = 0.0
                with np.errstate(divide="ignore", invalid="ignore"):
                    for at in range(0, len(points), 1000):  # bounds the matrix of points and clusters
                        p, l, i = points[at:at + 1000], label[at:at + 1000], np.arange(len(label[at:at + 1000]))
                        far = own_sq[at:at + 1000, None] + sq / n - 2 * (p @ total.T) / n
                        inside = far[i, l] * n[l] / (n[l] - 1)
                        far[:, n == 0] = np.inf
                        far[i, l] = np.inf
                        other = far.min(axis=1)
                        s = np.where(inside < other, 1 - inside / other, np.where(inside > other, other / inside - 1, 0.0))
                        score += s[n[l] > 1].sum()
                rows.append((k, len(points), score, cost))
            yield pd.DataFrame(rows, columns=["k", "n", "score", "cost"])

    scored = plain.mapInPandas(run, "k int, n long, score double, cost double")
    got = scored.groupBy("k").agg(F.sum("n").alias("n"), F.sum("score").alias("score"), F.sum("cost").alias("cost")).collect()
    alone = {k for k, (_, n, _, _) in tables.items() if (n > 0).sum() < 2}
    return {r["k"]: (None if r["k"] in alone else r["score"] / r["n"], r["cost"]) for r in got}


def select_k(vectors: DataFrame, ks, seed: int = 1, max_iter: int = 20, tol: float = 1e-4,
             partitions: int = 8) -> KChoice:
    """Fit K-means for each k of the sweep, score all fits together, apply the rule.

    The loop is over parameters (a handful of k values), not data: each fit is a
    distributed job over the vectors, which are written
    to the shared folder first so that a lost executor mid-sweep rereads
    them instead of recomputing whatever produced them (e.g. ALS).  The points are then labelled
    by all models in one pass, and ``score_models`` reads those labels."""
    spark = vectors.sparkSession
    vectors = cut_lineage(vectors, "k-search-vectors")
    laid_out = layout_points(vectors, partitions=partitions).persist(StorageLevel.MEMORY_AND_DISK)  # once for every k
    # a fit has ``partitions`` tasks and steps on the driver between its jobs, so several fits share the cores
    def fit(k: int) -> KMeansModel:
        return fit_kmeans(laid_out, k=k, seed=seed, max_iter=max_iter, tol=tol, id_col=None)

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        models = {int(k): model for k, model in zip(ks, pool.map(inheritable_thread_target(spark)(fit), ks), strict=True)}
    labels = cut_lineage(label_models(laid_out, models), "k-search-labels")
    laid_out.unpersist()
    scores = score_models(labels, models)
    scored, chosen = choose_k([(k, *scores[k]) for k in models])
    schema = "k int, silhouette double, wssse double, silhouette_change double, chosen boolean"
    return KChoice(metrics=spark.createDataFrame(scored, schema), k=chosen, labels=labels)
