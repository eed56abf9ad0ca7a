"""Session options and the shared working folder."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "flowsift", master: str | None = None, **options: str) -> SparkSession:
    """Get or create a session with the options above; `options` win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (`spark.checkpoint.dir`).

    Only where the cluster names none and the master is local (tests) a temporary folder is made and set: on a cluster the
    executors would write to their own disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="flowsift-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scope:
    """Owner of the temporary tables that are written while it is the innermost one."""

    def __init__(self, spark: SparkSession, outer: "Scope | None" = None):
        self.spark, self.outer, self.folders = spark, outer, []

    def keep(self, *frames: DataFrame) -> DataFrame | tuple[DataFrame, ...]:
        """Hand tables (as `materialize` returned them) to the scope around this one, so that they outlive it."""
        for frame in frames:
            folder = frame.temporary_folder
            self.folders.remove(folder)
            (self.outer or session_scope(self.spark)).folders.append(folder)
        return frames[0] if len(frames) == 1 else frames

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that nothing will read again; a table of another scope is left to its owner."""
        for frame in frames:
            folder = getattr(frame, "temporary_folder", None)
            if folder in self.folders:
                self.folders.remove(folder)
                _delete(self.spark, folder)

    def close(self) -> None:
        """Delete all tables of this scope, the newest first."""
        while self.folders:
            _delete(self.spark, self.folders.pop())


_SESSION_SCOPES: dict[str, Scope] = {}
_INNERMOST: contextvars.ContextVar[Scope | None] = contextvars.ContextVar("innermost", default=None)


def _delete(spark: SparkSession, folder: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def session_scope(spark: SparkSession) -> Scope:
    """The scope around all others; its tables stay until `release`."""
    return _SESSION_SCOPES.setdefault(spark.sparkContext.applicationId, Scope(spark))


def current_scope(spark: SparkSession) -> Scope:
    scope = _INNERMOST.get()
    return scope if scope is not None and scope.spark.sparkContext is spark.sparkContext else session_scope(spark)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[Scope]:
    """A scope for the tables written in the block: on leaving it, with or without an error, all that it did not `keep` are deleted.

    Frames are lazy, so a result of the block must be a table that is kept, or numbers. A scope is seen by the thread that opened it;
    tables of threads started inside belong to the session.
    """
    scope = Scope(spark, current_scope(spark))
    token = _INNERMOST.set(scope)
    try:
        yield scope
    finally:
        _INNERMOST.reset(token)
        scope.close()


def release(spark: SparkSession) -> None:
    """Delete the tables that this session still owns; results that read them are lost."""
    _SESSION_SCOPES.pop(spark.sparkContext.applicationId, Scope(spark)).close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run below the shared folder, owned by the innermost scope."""
    folder = f"{shared_dir(spark)}/flowsift/{uuid.uuid4().hex}"
    current_scope(spark).folders.append(folder)
    return f"{folder}/{name}"


def materialize(df: DataFrame, name: str = "stage", partition_by: Sequence[str] = (), spent: Sequence[DataFrame] = ()) -> DataFrame:
    """Cut lineage by writing `df` to the shared folder and reading it back.

    The table outlives lost executors, so iterative jobs restart from it and not from the source. `spent` are tables that `df`
    was the last to read: once it is written they are deleted, so a loop holds two rounds at most.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.temporary_folder = path.rpartition("/")[0]
    current_scope(spark).drop(*spent)
    return table
