"""Session settings and shared-storage helpers.

The library never builds its own cluster configuration: a caller hands in a
``SparkSession``.  ``local_session`` exists for tests and the bench only.
Scratch output (round-trip files, lineage cuts) goes under the folder the
cluster names in ``spark.checkpoint.dir``.  A session on this machine alone
(master ``local[...]``) gets a local folder if it has none; any other session
without one is an error, as executors could not read a local folder.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: adaptive re-planning (coalescing and
# skew-join splitting) and UTC dates so year/day arithmetic is stable.
# The adaptive broadcast threshold applies to the *measured* size of a
# finished shuffle stage (e.g. the needed item pairs of the neighbour plan),
# so a side is broadcast only when it is proven under 64 MB; anything larger
# stays a sort-merge join.  The static, estimate-based threshold keeps its
# default.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


#: Whether an execution's shuffle files are deleted at its end.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ratesmith") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def share_package(spark: SparkSession) -> None:
    """Python workers import this package from where it is installed."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, _ROOT]))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Raises ``ValueError`` if none is set on a session with executors on other
    machines; a ``local[...]`` session gets a temporary folder, removed at exit.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ratesmith-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "ratesmith", f"{name}-{uuid.uuid4().hex}")


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`scratch_path` named, on whatever store it is."""
    if "/ratesmith/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a scratch table and read back: for a derived table
    with several readers, each of which would shuffle the inputs again.  The
    shuffles behind it are not read again, and go when it is written."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to shared storage, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
