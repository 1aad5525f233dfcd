"""Session construction and shared-folder helpers.

Scratch data (round trips through text/JSON/libsvm sinks, saved models, lineage cuts) is
written below ``spark.checkpoint.dir`` -- the shared folder the cluster names.  A folder of
our own is only chosen when the session leaves that setting unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "tweetlake",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set one of our own only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        # Unset in local mode (tests, ad-hoc runs): one machine, one private folder.
        configured = tempfile.mkdtemp(prefix="tweetlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tweetlake-scratch", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss; never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df`` cached for the jobs of a ``with`` block and released when the block ends, by an error
    too.  What is built inside and read later is computed again from ``df``'s own plan."""
    cached = df.select("*").persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for functions that run in tasks."""
    sc = spark.sparkContext
    if getattr(sc, "_tweetlake_sent", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tweetlake-send-"), "tweetlake_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.join("tweetlake", os.path.relpath(os.path.join(folder, n), top)))
    sc.addPyFile(path)
    sc._tweetlake_sent = True
