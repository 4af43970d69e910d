"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "audience_engine",
                  driver_memory: str = "16g") -> SparkSession:
    """A local session configured like the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_cores: int, shuffle_bytes: int = 100 * 2**40) -> dict[str, str]:
    """Settings for a large cluster, to pass to ``SparkSession.builder.config``
    or spark-submit ``--conf``.

    Shuffle partitions start at ~3 per core and at least one per 1 GiB of the
    largest expected shuffle (``shuffle_bytes``, default 100 TiB), so that no
    reduce task spills heavily; AQE then coalesces small ones to
    ``advisoryPartitionSizeInBytes`` and splits skewed join partitions.  A shuffle
    has map tasks x partitions blocks: pass the largest shuffle of the job at
    hand, not the size of the input."""
    partitions = max(3 * total_cores, shuffle_bytes // 2**30)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 2**20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 2**20),
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(256 * 2**20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 2**20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.shuffle.service.enabled": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
    }


def _setting(spark: SparkSession, key: str) -> str | None:
    return spark.sparkContext.getConf().get(key, None) or spark.conf.get(key, None)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from the session: the context's checkpoint dir, else
    ``spark.checkpoint.dir``, else a folder under ``spark.sql.warehouse.dir``.
    The warehouse is shared on a cluster; where a cluster session names neither,
    its default would be a folder of the driver's machine, so we refuse.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = _setting(spark, "spark.checkpoint.dir")
    if not root:
        if not sc.master.startswith("local") and not sc.getConf().get("spark.sql.warehouse.dir", None):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


# The tables written inside the innermost ``scratch_tables`` block first.
_WRITTEN: list[list[str]] = []


@contextmanager
def scratch_tables() -> Iterator[list[str]]:
    """Collects the paths of the intermediate tables written inside the block,
    for ``drop_tables``."""
    _WRITTEN.append([])
    try:
        yield _WRITTEN[-1]
    finally:
        _WRITTEN.pop()


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Deletes intermediate tables.  Frames that read them are of no use afterwards."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    paths.clear()


@contextmanager
def released_blocks(spark: SparkSession) -> Iterator[None]:
    """Releases what the block leaves persisted (spark.ml keeps factors and
    training points), so a long session does not fill executor storage."""
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keys())
    try:
        yield
    finally:
        for key, rdd in dict(spark.sparkContext._jsc.getPersistentRDDs()).items():
            if key not in before:
                rdd.unpersist(False)


# The folder of the innermost ``resumable`` block, and how often each name was used in it.
_STAGES: list[tuple[str, Counter]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table; inside ``resumable``,
    the stage's path, the same in every run."""
    if _STAGES:
        folder, used = _STAGES[-1]
        used[name] += 1
        path = f"{folder}/{name}" if used[name] == 1 else f"{folder}/{name}-{used[name]}"
    else:
        path = f"{checkpoint_root(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    for written in _WRITTEN:
        written.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a stage's table was written to its end (Spark's committer then leaves _SUCCESS)."""
    if not _STAGES:
        return False
    fs, where = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(where)


def stage(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``build`` returns, written to the shared folder and read back.  Inside
    ``resumable``, a table that an earlier run finished is only read, and ``build`` is not called;
    what an earlier run left unfinished is replaced."""
    path = scratch_path(spark, name)
    if not _finished(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read
    it back (never a local checkpoint).  A lost executor then rereads the
    files instead of recomputing the lineage, so values that depend on
    partition order stay fixed, and later plans see the table's real size."""
    return stage(df.sparkSession, name, lambda: df)


def cut_lineage_bucketed(df: DataFrame, name: str, buckets: int, by: list[str]) -> DataFrame:
    """``cut_lineage`` as a table bucketed by ``by``: later joins on these columns read it without
    a shuffle.  ``df`` should come partitioned the same way (``repartition(buckets, *by)``), so that
    each bucket is one file.  The catalog entry is only needed to tell Spark the buckets, and is dropped."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"bucketed_{uuid.uuid4().hex}"
    if not _finished(spark, path):
        df.write.mode("overwrite").bucketBy(buckets, *by).option("path", path).saveAsTable(table)
    else:
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(by)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    read = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # an external table: the files stay
    return read


def job_folder(spark: SparkSession, root: str, inputs: Iterable[DataFrame], settings: object) -> str:
    """The stage folder of a job: ``root`` and a digest of the settings and of the input files (paths,
    lengths, times of change).  Another input or setting gives another folder, so no
    run reads stages of different data.  Inputs must be files: rows in memory have no such identity."""
    digest = hashlib.sha256(repr(settings).encode())
    for df in inputs:
        files = sorted(df.inputFiles())
        if not files:
            raise ValueError("a resumable job needs inputs that are read from files")
        for path in files:
            fs, where = _file_system(spark, path)
            status = fs.getFileStatus(where)
            digest.update(f"{path} {status.getLen()} {status.getModificationTime()}\n".encode())
        digest.update(df.schema.json().encode())
    return f"{root.rstrip('/')}/job-{digest.hexdigest()[:32]}"


@contextmanager
def resumable(folder: str) -> Iterator[None]:
    """Inside the block, stage tables lie in ``folder`` under their own names, and those that an
    earlier run finished are read instead of made again."""
    _STAGES.append((folder.rstrip("/"), Counter()))
    try:
        yield
    finally:
        _STAGES.pop()


def in_resumable() -> bool:
    return bool(_STAGES)


def drop_stale_jobs(spark: SparkSession, root: str, older_than_seconds: float) -> list[str]:
    """Deletes the stage folders under ``root`` in which nothing was written for that long, such as
    those of a killed run whose input or settings have changed since; returns their paths."""
    fs, where = _file_system(spark, root)
    dropped = []
    for job in fs.listStatus(where) if fs.exists(where) else []:
        if job.getPath().getName().startswith("job-"):
            stages = list(fs.listStatus(job.getPath()))
            last = max([job.getModificationTime(), *(s.getModificationTime() for s in stages)])
            if time.time() - last / 1000 >= older_than_seconds:
                fs.delete(job.getPath(), True)
                dropped.append(job.getPath().toString())
    return dropped


__all__ = ["local_session", "cluster_conf", "checkpoint_root", "scratch_path", "cut_lineage", "cut_lineage_bucketed", "stage",
           "scratch_tables", "drop_tables", "released_blocks", "resumable", "in_resumable", "job_folder", "drop_stale_jobs"]
