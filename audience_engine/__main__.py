"""Run the whole job from the command line (for spark-submit or python -m).

    python -m audience_engine --plays P --song-artist S --notification-artist N \\
        --notification-clicks C [--out DIR] [--k 275] [--fanout exact] ...
    python -m audience_engine --tables /root/testdata/sf0.01 --out DIR
    python -m audience_engine local SOURCE PLAYS SONG_ARTIST NOTIFICATION_CLICKS NOTIFICATION_ARTIST

The last form takes the reference job's local-mode arguments in their order:
a source folder and the four input names under it.

Inputs are headerless CSV files, folders or globs on any Hadoop file system.
With ``--out`` the notified clicks (partitioned by notification) and the top
notifications (one CSV with a header) are written there.  The fit's k, silhouette
and WSSSE and the top notifications are always shown on the console.
"""

from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import SparkSession

from .config import PipelineConfig
from .plans.pipeline import run
from .sources.csv import read_notification_artist, read_notification_clicks, read_plays, read_song_artist
from .sources.tables import Inputs, inputs_from_tables


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="audience_engine", description=__doc__.split("\n\n")[0])
    p.add_argument("--tables", help="folder of the parquet test tables instead of CSV inputs")
    for name in ("plays", "song-artist", "notification-artist", "notification-clicks"):
        p.add_argument(f"--{name}", nargs="+")
    p.add_argument("--infer", action="store_true", help="infer CSV column types as the reference did")
    p.add_argument("--input-format", default="csv", help="csv (headerless, by position) or parquet/orc/json (by name)")
    p.add_argument("--out", help="output folder for the sinks")
    p.add_argument("--resume", help="shared folder for the job's stages: started again after a lost driver, the job goes on there")
    for f in fields(PipelineConfig):
        flag = "--" + f.name.replace("_", "-")
        if f.type in ("bool", bool):
            p.add_argument(flag, type=lambda s: s.lower() in ("1", "true", "yes"), default=None)
        elif f.type in ("int", int, "int | None"):
            p.add_argument(flag, type=int, default=None)
        elif f.type in ("float", float):
            p.add_argument(flag, type=float, default=None)
        else:
            p.add_argument(flag, default=None)
    return p


def _local_mode(argv: list[str]) -> list[str]:
    """``local SOURCE PLAYS META CLICKS NOTIFICATION_ARTIST [options]`` ->
    the equivalent flags (names are joined to the folder with a separator)."""
    if len(argv) < 6:
        raise SystemExit("local mode needs: local SOURCE PLAYS SONG_ARTIST NOTIFICATION_CLICKS NOTIFICATION_ARTIST")
    src, plays, meta, clicks, notif = argv[1:6]
    join = lambda name: f"{src.rstrip('/')}/{name.lstrip('/')}"
    return (["--plays", join(plays), "--song-artist", join(meta), "--notification-clicks", join(clicks),
             "--notification-artist", join(notif)] + argv[6:])


def main(argv: list[str] | None = None) -> None:
    import sys
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0].lower() == "local":
        argv = _local_mode(argv)
    args = _parser().parse_args(argv)
    overrides = {f.name: getattr(args, f.name) for f in fields(PipelineConfig)
                 if getattr(args, f.name, None) is not None}
    cfg = PipelineConfig(**overrides)
    spark = SparkSession.builder.appName("audience_engine").getOrCreate()
    if args.tables:
        inputs = inputs_from_tables(spark, args.tables)
    else:
        missing = [n for n in ("plays", "song_artist", "notification_artist", "notification_clicks")
                   if not getattr(args, n)]
        if missing:
            raise SystemExit(f"missing inputs: {', '.join(missing)}")
        fmt = args.input_format
        inputs = Inputs(plays=read_plays(spark, args.plays, args.infer, fmt),
                        song_artist=read_song_artist(spark, args.song_artist, args.infer, fmt),
                        notification_artist=read_notification_artist(spark, args.notification_artist, args.infer, fmt),
                        notification_clicks=read_notification_clicks(spark, args.notification_clicks, args.infer, fmt))
    print(f"als_blocks {cfg.als_blocks} (more above {cfg.als_rows_per_block} rows a block), kmeans_partitions {cfg.kmeans_partitions}, song_buckets {cfg.song_buckets}")
    result = run(inputs, cfg, sink_dir=args.out, resume_dir=args.resume)
    result.quality().show(truncate=False)  # k, silhouette, WSSSE of the fit
    result.top.orderBy("rowNumber").show(truncate=False)  # K5
    result.release()


if __name__ == "__main__":
    main()
