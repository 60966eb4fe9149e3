"""Session construction for tests/bench, and the shared scratch location.

Library code never builds its own session: every public function takes the
caller's ``SparkSession``.  ``build_session`` exists for tests, the bench and
command-line use on a single machine.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session should carry; the cluster may override them.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "lakepipe",
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("LAKEPIPE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when the setting is absent (local tests) a
    fresh private folder is created and registered, so lineage cuts and
    scratch tables always land on storage every executor can reach.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a folder every "
                "executor can reach (HDFS / object store)"
            )
        root = tempfile.mkdtemp(prefix="lakepipe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_listing = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory name under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/lakepipe/{name}-{uuid.uuid4().hex[:12]}"
    for paths in getattr(_listing, "now", []):
        paths.append(path)
    return path


@contextmanager
def scratch_listed(paths: list[str]) -> Iterator[None]:
    """Inside, and in this thread, new scratch paths are put down in ``paths``, so that a step can remove what it made
    once its rows are stored."""
    _listing.now = [*getattr(_listing, "now", []), paths]
    try:
        yield
    finally:
        _listing.now = _listing.now[:-1]


def remove_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or folders, through the file system classes that Spark itself writes with."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        to = jvm.org.apache.hadoop.fs.Path(path)
        to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(to, True)


_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_removing, _removing_lock = {}, threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when the query ends, not when the driver happens to collect its garbage.

    For steps that store what they find.  A frame run again makes its shuffle
    files again.  May be nested and used by several threads: the last one out
    puts the setting back.
    """
    key = spark._jsparkSession.sessionUUID()
    with _removing_lock:
        before, users = _removing.get(key, (spark.conf.get(_REMOVAL, None), 0))
        _removing[key] = before, users + 1
        spark.conf.set(_REMOVAL, "true")
    try:
        yield
    finally:
        with _removing_lock:
            before, users = _removing.pop(key)
            if users > 1:
                _removing[key] = before, users - 1
            elif before is None:
                spark.conf.unset(_REMOVAL)
            else:
                spark.conf.set(_REMOVAL, before)
