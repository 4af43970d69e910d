"""K1-K3, T6."""

import os

from audience_engine.sinks import write_files, write_partitioned_csv, write_single_csv


def test_single_csv_has_one_file_and_header(spark, tmp_path):
    df = spark.createDataFrame([(i, f"u{i}") for i in range(50)], "n bigint, u string").repartition(4)
    out = write_single_csv(df, str(tmp_path / "top.csv"))
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    back = spark.read.option("header", True).schema("n bigint, u string").csv(out)
    assert back.count() == 50


def test_partitioned_csv_moves_the_column_to_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, 10, "u1"), (1, 10, "u2"), (2, 20, "u3")],
                               "NotificationId bigint, ArtistId bigint, UserId string")
    out = write_partitioned_csv(df, str(tmp_path / "n"))
    assert sorted(d for d in os.listdir(out) if d.startswith("NotificationId=")) == \
        ["NotificationId=1", "NotificationId=2"]
    first = open(next(os.path.join(out, "NotificationId=1", f) for f in os.listdir(os.path.join(out, "NotificationId=1"))
                      if f.startswith("part-"))).readline()
    assert first.startswith("10,")  # no header row


def test_partitioned_sink_writes_few_files_and_spreads_a_hot_value(spark, tmp_path):
    rows = [(1, 10, f"u{i}") for i in range(600)] + [(n, 20, f"u{i}") for n in range(2, 12) for i in range(30)]
    df = spark.createDataFrame(rows, "NotificationId bigint, ArtistId bigint, UserId string").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = write_partitioned_csv(df, str(tmp_path / "n"), salts=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {d: [f for f in os.listdir(os.path.join(out, d)) if f.startswith("part-")]
             for d in os.listdir(out) if d.startswith("NotificationId=")}
    assert len(files) == 11 and all(len(f) <= 4 for f in files.values())
    assert len(files["NotificationId=1"]) > 1  # the hot notification was not written by one task
    assert spark.read.csv(out).count() == len(rows)


def test_files_of_bounded_rows(spark, tmp_path):
    df = spark.range(100).coalesce(1)
    out = write_files(df, str(tmp_path / "a"), rows_per_file=30)
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 4
    assert spark.read.option("header", True).csv(out).count() == 100


def test_partitioned_sink_in_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, 10, "u1"), (2, 20, "u3")], "NotificationId bigint, ArtistId bigint, UserId string")
    out = write_partitioned_csv(df, str(tmp_path / "n"), fmt="parquet")
    back = spark.read.parquet(out)
    assert sorted(tuple(r) for r in back.select("NotificationId", "ArtistId", "UserId").collect()) == \
        [(1, 10, "u1"), (2, 20, "u3")]
