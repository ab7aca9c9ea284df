"""Session helpers: a tuned session for local runs and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", app: str = "truegrain", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster use the session the cluster provides: nothing in this package
    needs settings of its own there.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back on a folder of this machine; on a cluster
    such a folder would be invisible to the other hosts, so its absence is an error.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="truegrain-"))
    return context.getCheckpointDir()


# Paths handed out inside each open ``scratch``, innermost last.
_handed_out: list[list[str]] = []


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses.

    Outside a :func:`scratch` it belongs to the caller, who deletes it or leaves it.
    """
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _handed_out:
        _handed_out[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what :func:`new_shared_path` named inside.

    For jobs whose results are collected or written before they end; frames that are
    still to be computed must not leave it. Checkpoints are not touched: the engine
    removes them once nothing refers to them, if its cleaner is set to.
    """
    _handed_out.append([])
    try:
        yield
    finally:
        for path in _handed_out.pop():
            delete_folder(spark, path)


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    named = context._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(context._jsc.hadoopConfiguration()), named


def delete_folder(spark: SparkSession, path: str) -> None:
    files, named = _file_system(spark, path)
    files.delete(named, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, named = _file_system(spark, path)
    return files.exists(named)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` where ``path`` is, which is deleted only now."""
    files, source = _file_system(spark, new)
    target = _file_system(spark, path)[1]
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"cannot move {new} to {path}")


def settle(df):
    """Write ``df`` to the shared folder and cut its lineage.

    The reliable checkpoint survives lost executors and fixes the row order and
    partitioning of the result.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
