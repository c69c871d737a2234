"""Session helpers.

The library never picks ``master`` or memory sizes: those belong to the
cluster.  It only pins what changes results (UTC session time zone) and turns
on adaptive execution, which re-plans joins and coalesces/splits shuffle
partitions from runtime statistics.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Settings that affect results or that every job relies on.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for scale: adaptive re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # checkpoint files of tables that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "scenecast",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the library's settings applied.

    ``master`` is only set when given (tests pass ``local[*]``); on a cluster
    the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**RESULT_CONF, **SCALE_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin result-affecting settings on an existing session."""
    for k, v in RESULT_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The running checkpoint folder comes first, then ``spark.checkpoint.dir``.
    Without either the call fails: a folder of one machine would lose rows.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return base.rstrip("/")


def default_checkpoint_dir(spark: SparkSession) -> None:
    """Where neither a folder nor the setting is given, use one beside the warehouse.

    For entry points only: the warehouse is shared wherever tables can be written.
    """
    if not (spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        spark.sparkContext.setCheckpointDir(f"{warehouse}/_checkpoints")


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder name under :func:`checkpoint_dir`."""
    return f"{checkpoint_dir(spark)}/{name or 'work'}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``checkpoint()`` has the shared folder."""
    base = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df):
    """Write ``df`` once with a reliable checkpoint and cut its lineage.

    For small tables that are expensive to derive (e.g. per-scene rows built
    from all pixels) and read by several branches of later plans.  The
    checkpoint lands in the shared ``spark.checkpoint.dir``, so it survives
    the loss of any executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def side_by_side(spark: SparkSession, tasks: dict[str, Callable[[], T]], threads: int = 4
                 ) -> dict[str, T]:
    """Results of independent calls that run Spark jobs, up to ``threads`` at a time.

    Jobs with fewer tasks than the cluster has cores then overlap; what each call returns
    does not depend on the others.  An error in one call is raised again here.
    """
    if threads < 2 or len(tasks) < 2:
        return {name: task() for name, task in tasks.items()}
    with ThreadPool(min(threads, len(tasks))) as pool:
        runs = {name: pool.apply_async(inheritable_thread_target(spark)(task))
                for name, task in tasks.items()}
        return {name: run.get() for name, run in runs.items()}
