"""Session helpers, lineage cuts and the command line."""

import os

from pyspark.sql import functions as F

from audience_engine.__main__ import main
from audience_engine.session import checkpoint_root, cluster_conf, cut_lineage, scratch_path
from audience_engine.sources.tables import (
    notification_artist_from_tables,
    notification_clicks_from_tables,
    plays_from_tables,
    song_artist_from_tables,
)

from .conftest import SF_SMALL


def test_checkpoint_root_comes_from_the_session(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/tables/x-")
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        assert root.startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/"))


def test_cut_lineage_reads_back_a_table(spark):
    df = spark.range(100).withColumn("r", F.monotonically_increasing_id())
    cut = cut_lineage(df, "probe")
    first = sorted(tuple(r) for r in cut.collect())
    assert first == sorted(tuple(r) for r in cut.collect())  # fixed, not recomputed
    assert "parquet" in cut._jdf.queryExecution().executedPlan().toString().lower()


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(4000)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 100 * 1024
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_cli_on_csv_inputs(spark, tmp_path, capsys):
    paths = {}
    for name, fn in (("plays", plays_from_tables), ("song-artist", song_artist_from_tables),
                     ("notification-artist", notification_artist_from_tables),
                     ("notification-clicks", notification_clicks_from_tables)):
        p = str(tmp_path / name)
        df = fn(spark, SF_SMALL)
        df.select(*[F.col(c).cast("string") for c in df.columns]).write.csv(p)
        paths[name] = p
    out = str(tmp_path / "out")
    tables = checkpoint_root(spark).removeprefix("file:") + "/tables"
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    persisted = set(spark.sparkContext._jsc.getPersistentRDDs().keys())
    main(["--plays", paths["plays"], "--song-artist", paths["song-artist"],
          "--notification-artist", paths["notification-artist"],
          "--notification-clicks", paths["notification-clicks"], "--out", out, "--k", "10"])
    assert os.path.isdir(os.path.join(out, "notifications"))
    top = spark.read.option("header", True).csv(os.path.join(out, "top5", "CTR.csv"))
    assert 0 < top.count() <= 5
    shown = capsys.readouterr().out
    assert "rowNumber" in shown and "silhouette" in shown and "wssse" in shown
    # the job leaves neither tables nor persisted frames behind
    assert set(os.listdir(tables)) <= before
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keys()) <= persisted


def test_cli_local_mode_arguments(spark, tmp_path, capsys):
    src = tmp_path / "src"
    src.mkdir()
    for name, fn in (("plays", plays_from_tables), ("meta", song_artist_from_tables),
                     ("nclicks", notification_clicks_from_tables), ("nartist", notification_artist_from_tables)):
        df = fn(spark, SF_SMALL)
        df.select(*[F.col(c).cast("string") for c in df.columns]).write.csv(str(src / name))
    main(["local", str(src), "plays", "meta", "nclicks", "nartist", "--k", "10"])
    assert "rowNumber" in capsys.readouterr().out
