"""Co-partitioned activity, exact salts, the Bloom filter before the shuffle, the joint scoring of
the k sweep and the job's stages."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from audience_engine.config import PipelineConfig
from audience_engine.operators import (
    als_blocks,
    bloom_filter,
    bloom_semi_join,
    bloom_words,
    build_activity,
    clicked_audience,
    cluster_artist_hits,
    fit_kmeans,
    fit_taste_factors,
    label_models,
    nearest_centre,
    notified_users,
    salt_table,
    salted_join,
    score_models,
    silhouette,
    wssse,
)
from audience_engine.operators.clustering import centres_frame
from audience_engine.plans import pipeline
from audience_engine.session import cut_lineage, drop_stale_jobs, job_folder, resumable, scratch_path, stage
from audience_engine.sinks import write_partitioned_csv
from audience_engine.sources import clean_song_artist, inputs_from_tables
from audience_engine.sources.tables import read_table, song_artist_from_tables

from .conftest import ROOT, SF_SMALL
from .test_skew import conf

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


# -- J2: the activity bucketed by song --------------------------------------------------

def exchanges_over(plan: str, scan_column: str) -> list[str]:
    """Exchange lines above the scan that reads ``scan_column``, by the tree's indentation."""
    lines = plan.splitlines()

    def depth(x):
        return len(x) - len(x.lstrip(" :+-|"))
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and scan_column in x)
    out, level = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < level:
            level = depth(x)
            if "Exchange" in x:
                out.append(x)
    return out


@pytest.mark.parametrize("rows_per_task", [1_000_000, 5])
def test_popularity_reads_the_activity_without_a_shuffle_by_song(spark, rows_per_task):
    plays = inputs_from_tables(spark, SF_SMALL).plays
    meta = clean_song_artist(song_artist_from_tables(spark, SF_SMALL))
    act = build_activity(plays, song_buckets=6, rows_per_task=rows_per_task)
    uc = act.users.select("UserIndex", (F.col("UserIndex") % 7).alias("cluster"))
    plain = rows(cluster_artist_hits(act.activity, uc, meta))
    with conf(spark, NO_BROADCAST):
        hits = cluster_artist_hits(act.by_song, uc, meta, song_salts=act.song_salts)
        plan = final_plan(hits)
        assert rows(hits) == plain
    over = exchanges_over(plan, "_salt")
    # up from the activity: the sum per (user, artist), the join with the clusters, the sum per cluster - and no shuffle by song
    assert over and not any("SongId" in x for x in over), over
    assert "Bucketed: true" in plan
    assert act.song_salts.count() == (0 if rows_per_task > 5 else rows_count(act, 5))


def rows_count(act, n):
    return act.activity.groupBy("SongId").count().where(f"count > {n}").count()


def test_a_hot_song_is_spread_over_buckets(spark):
    plays = spark.range(6000).selectExpr("cast(id as string) as UserId", "cast(if(id % 3 = 0, 1, id % 50) as string) as SongId")
    act = build_activity(plays, song_buckets=8, rows_per_task=300)
    per_file = act.by_song.where("SongId = '1'").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= 4 and sum(r["count"] for r in per_file) == act.activity.where("SongId = '1'").count()
    assert act.activity.count() == 6000


# -- J4, K2: salts from exact counts ------------------------------------------------------

def test_salts_follow_each_keys_rows(spark):
    keyed = spark.range(10_000).selectExpr("if(id < 3000, 1, if(id < 3010, 2, id)) as k", "id as u")
    assert rows(salt_table(keyed, ["k"], 250)) == [(1, 12)]
    small = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c"), (4000, "d")], "k long, v string")
    for per_task in (3, 250, 10**6):
        got = rows(salted_join(keyed, small, ["k"], "u", rows_per_task=per_task).select("k", "u", "v"))
        assert got == rows(keyed.join(small, "k").select("k", "u", "v"))
    nulls = keyed.union(spark.createDataFrame([(None, 1)], "k long, u long"))
    assert salted_join(nulls, small, ["k"], "u", rows_per_task=5).count() == 3000 * 2 + 10 + 1


def test_notification_list_spreads_by_audience_size(spark):
    na = spark.createDataFrame([(1, 10), (2, 20)], "NotificationId bigint, ArtistId bigint")
    aud = spark.range(1000).selectExpr("cast(id as string) as UserId", "0 as cluster", "cast(if(id < 990, 10, 20) as bigint) as ArtistId", "1 as artistCluster")
    with conf(spark, NO_BROADCAST | {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        listed = notified_users(na, aud, rows_per_task=50)
        held = listed.withColumn("task", F.spark_partition_id()).groupBy("NotificationId").agg(F.countDistinct("task").alias("tasks"), F.count(F.lit(1)).alias("n"))
        got = {r.NotificationId: (r.tasks, r.n) for r in held.collect()}
    assert got[1][1] == 990 and got[1][0] > 4 and got[2] == (1, 10)


def test_partitioned_sink_writes_files_by_count(spark, tmp_path):
    data = [(1, 10, f"u{i}") for i in range(900)] + [(n, 20, f"u{i}") for n in range(2, 12) for i in range(10)] + [(None, 1, "x")]
    df = spark.createDataFrame(data, "NotificationId bigint, ArtistId bigint, UserId string").repartition(16)
    with conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = write_partitioned_csv(df, str(tmp_path / "n"), rows_per_file=100)
    files = {d: [f for f in os.listdir(os.path.join(out, d)) if f.startswith("part-")] for d in os.listdir(out) if d.startswith("NotificationId=")}
    assert 4 <= len(files.pop("NotificationId=1")) <= 9
    assert all(len(f) == 1 for f in files.values()) and len(files) == 11
    assert spark.read.csv(out).count() == len(data)


# -- J5: the Bloom filter ------------------------------------------------------------------

def test_bloom_filter_is_bounded_and_loses_nothing(spark):
    assert [bloom_words(n) for n in (0, 512, 513, 8 << 20)] == [64, 64, 128, 1 << 20]
    assert bloom_words(16 << 20) == 1 << 20 and bloom_words((16 << 20) + 1) is None and bloom_words(100, 4) is None
    members = spark.range(4000).selectExpr("cast(id as string) as u", "id % 7 as a")
    large = spark.range(40_000).selectExpr("cast(id as string) as u", "id % 7 as a", "id")
    words = bloom_words(4000)
    assert bloom_filter(members, ["u", "a"], words).count() <= words
    kept = bloom_semi_join(large, members, ["u", "a"], words)
    assert kept.columns == large.columns
    assert kept.where("id < 4000").count() == 4000 and kept.count() < 4000 + 36_000 * 0.06
    assert bloom_semi_join(large, members.where("a < 0"), ["u", "a"], 64).count() == 0


def test_clicks_leave_before_the_shuffle(spark):
    inputs = inputs_from_tables(spark, "/root/testdata/sf0.01")
    users = read_table(spark, "/root/testdata/sf0.01", "customer").selectExpr("cast(c_custkey as string) as UserId", "c_nationkey as cluster")
    audience = cut_lineage(users.selectExpr("UserId", "cast(cluster as int) cluster", "cast(cluster + 1 as bigint) ArtistId", "cast(cluster as int) artistCluster"), "audience")
    args = inputs.notification_clicks, inputs.notification_artist, audience

    def shuffled(df):
        """Rows written by the exchange above the click scan, from Spark's own metrics."""
        df.collect()
        found = []

        def walk(node):
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                return walk(node.executedPlan())
            if "QueryStage" in name:
                return walk(node.plan())
            if name == "Exchange":
                found.append((node.metrics().apply("shuffleRecordsWritten").value(), node.toString()))
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))
        walk(df._jdf.queryExecution().executedPlan())
        return max(n for n, text in found if "NotificationId" in text)

    with conf(spark, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        filtered, plain = clicked_audience(*args), clicked_audience(*args, prefilter=False)
        assert rows(filtered) == rows(plain)
        assert shuffled(filtered) * 4 < shuffled(plain)
    # the other ways give the same rows: salted notifications, no filter
    assert rows(clicked_audience(*args, salts=4)) == rows(plain)


# -- M12, M9, M4 --------------------------------------------------------------------------

def test_joint_scores_equal_spark_mls(spark):
    emb = read_table(spark, SF_SMALL, "embeddings")
    from pyspark.ml.functions import array_to_vector
    points = emb.select(F.col("vec_id").alias("id"), array_to_vector("embedding").alias("features")).cache()
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(10)], "id long, x array<double>").select("id", array_to_vector("x").alias("features"))
    for frame, ks in ((points, (2, 5, 9)), (same, (2, 3))):
        models = {k: fit_kmeans(frame, k=k) for k in ks}
        labelled = label_models(frame, models)
        scores = score_models(labelled, models)
        for k, model in models.items():
            if len(model.clusterCenters()) > 1:
                assert scores[k][0] == pytest.approx(silhouette(labelled, prediction_col=f"k{k}"), abs=1e-9)
                assert scores[k][1] == pytest.approx(wssse(labelled, centres_frame(spark, model), prediction_col=f"k{k}").first()[0])
            else:
                assert scores[k][0] is None and scores[k][1] == pytest.approx(0)
    points.unpersist()


def test_fits_at_64_partitions(spark):
    act = build_activity(inputs_from_tables(spark, SF_SMALL).plays).activity
    model = fit_taste_factors(act, blocks=64)
    users, songs = model.userFactors, model.itemFactors
    assert users.count() == act.select("UserIndex").distinct().count() and songs.count() == act.select("SongIndex").distinct().count()
    from audience_engine.operators import factor_vectors, standardise
    vectors = cut_lineage(standardise(factor_vectors(users)), "vectors-64")
    fits = [fit_kmeans(vectors, k=12, partitions=64) for _ in range(2)]
    centres = [[list(map(float, c)) for c in f.clusterCenters()] for f in fits]
    assert centres[0] == centres[1]
    from pyspark.ml.functions import vector_to_array
    nearest = nearest_centre(vector_to_array("features"), list(enumerate(centres[0])))
    assert fits[0].transform(vectors).where(F.col("prediction") != nearest).count() == 0


def test_als_blocks_grow_with_the_rows(spark):
    """A block is built on the heap of one task, so above 40 million rows there are more than the ten of spark.ml."""
    assert [als_blocks(n) for n in (0, 35_961_060, 40_000_000, 40_000_001, 215_766_360)] == [10, 10, 10, 11, 54]
    plays = spark.createDataFrame([(str(u), str(u * s % 37)) for u in range(90) for s in range(1, 12)], "UserId string, SongId string")
    act = build_activity(plays).activity
    n = act.count()

    def users(df):
        return sorted((r["id"], tuple(r["features"])) for r in df.collect())
    per_block = -(-n // 12)
    blocks = als_blocks(n, 10, per_block)
    assert blocks == 12 and act.groupBy(F.col("UserIndex") % blocks).count().agg(F.max("count")).first()[0] <= 2 * per_block
    wanted = users(fit_taste_factors(act, max_iter=1, blocks=blocks).userFactors)
    assert users(fit_taste_factors(act, max_iter=1).userFactors) != wanted
    job = pipeline.cluster_listeners(plays, PipelineConfig(k=3, max_iter=1, als_rows_per_block=per_block, evaluate=False))
    assert users(job.als.userFactors) == wanted


# -- C7: stages ------------------------------------------------------------------------------

def test_stages_are_named_read_again_and_replaced_if_unfinished(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    folder = str(tmp_path / "job-x")
    with resumable(folder):
        assert stage(spark, "a", build).count() == 5 and stage(spark, "a", build).count() == 5
    assert sorted(os.listdir(folder)) == ["a", "a-2"] and len(calls) == 2
    os.remove(f"{folder}/a-2/_SUCCESS")  # as after a lost driver
    with resumable(folder):
        assert scratch_path(spark, "b") == f"{folder}/b"
        stage(spark, "a", build)
        assert len(calls) == 2
        assert stage(spark, "a", build).count() == 5
    assert len(calls) == 3
    assert stage(spark, "a", build).count() == 5 and len(calls) == 4  # outside: always made
    assert drop_stale_jobs(spark, str(tmp_path), 3600) == [] and os.path.isdir(folder)
    (tmp_path / "other").mkdir()
    assert len(drop_stale_jobs(spark, str(tmp_path), 0)) == 1 and os.listdir(tmp_path) == ["other"]
    assert drop_stale_jobs(spark, str(tmp_path / "none"), 0) == []


def test_job_folders_follow_input_and_settings(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))

    def read():
        return spark.read.parquet(str(tmp_path / "t"))
    one = job_folder(spark, "/r", [read()], PipelineConfig())
    assert one == job_folder(spark, "/r/", [read()], PipelineConfig()) and one.startswith("/r/job-")
    assert one != job_folder(spark, "/r", [read()], PipelineConfig(k=5))
    spark.range(6).write.mode("overwrite").parquet(str(tmp_path / "t"))
    assert one != job_folder(spark, "/r", [read()], PipelineConfig())
    with pytest.raises(ValueError):
        job_folder(spark, "/r", [spark.range(3)], PipelineConfig())


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from audience_engine import session
from audience_engine.config import PipelineConfig
from audience_engine.plans import pipeline
from audience_engine.session import local_session
from audience_engine.sources import inputs_from_tables
spark = local_session(4, shuffle_partitions=4, driver_memory="2g")
path = session.scratch_path
def until(spark, name):
    if name == "cluster-artist":
        os._exit(9)  # the driver is gone
    return path(spark, name)
session.scratch_path = until
pipeline.run(inputs_from_tables(spark, {sf!r}), PipelineConfig(k=10), resume_dir={resume!r})
"""


def test_a_job_goes_on_after_its_driver_was_killed(spark, tmp_path, monkeypatch):
    resume = str(tmp_path / "resume")
    code = KILLED.format(root=ROOT, sf=SF_SMALL, resume=resume)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert done.returncode == 9, done.stderr[-2000:]
    job, = os.listdir(resume)
    finished = {d for d in os.listdir(f"{resume}/{job}") if os.path.exists(f"{resume}/{job}/{d}/_SUCCESS")}
    assert {"pairs", "activity", "factors", "vectors", "user-cluster", "quality"} <= finished and "audience" not in finished
    inputs, cfg = inputs_from_tables(spark, SF_SMALL), PipelineConfig(k=10)
    fresh = pipeline.run(inputs, cfg)

    def never(*a, **b):
        raise AssertionError("a finished stage was made again")
    for name in ("fit_taste_factors", "fit_kmeans", "standardise"):
        monkeypatch.setattr(pipeline, name, never)
    again = pipeline.run(inputs, cfg, resume_dir=resume)
    assert os.listdir(resume) == [job]
    assert rows(again.top) == rows(fresh.top) and rows(again.ctr) == rows(fresh.ctr) and rows(again.quality()) == rows(fresh.quality())
    assert again.listeners.als is None and fresh.listeners.als is not None
    assert rows(again.listeners.activity) == rows(fresh.listeners.activity)
    again.release()
    assert not os.listdir(resume)  # nothing is left
