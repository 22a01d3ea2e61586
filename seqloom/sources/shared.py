"""Written tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``, on the store that the cluster resolves it to.

    Only where a session has none one is made for it: a temporary one in a local session, else one below the warehouse.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
        found = f"file://{tempfile.mkdtemp(prefix='shared-')}" if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
        spark.sparkContext.setCheckpointDir(found)
    path, store = _file_system(spark, found)
    return store.makeQualified(path).toString()


def move(spark: SparkSession, source: str, target: str, again: bool = False) -> bool:
    """Renames a folder; the target's parent is made. Where the target is there already nothing is moved: that is an error, or, with
    ``again``, False, and the source goes."""
    path, store = _file_system(spark, source)
    to, _ = _file_system(spark, target)
    store.mkdirs(to.getParent())
    done = not store.exists(to) and store.rename(path, to)
    if done and not store.exists(path):
        return True
    if not again:
        raise OSError(f"{source} could not be moved to {target}")
    store.delete(path, True)
    return False


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it isn't there."""
    found, store = _file_system(spark, path)
    return [x.getPath().getName() for x in store.listStatus(found) if x.isDirectory()] if store.exists(found) else []


#: Workspaces of this process that are still there.
_made: list[Workspace] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Removes the workspaces that were made inside, at its end: for callers that have written their result by then."""
    before = len(_made)
    try:
        yield
    finally:
        for ws in _made[before:]:
            ws.remove()
        del _made[before:]


def _remove_all() -> None:
    for ws in _made:
        with suppress(Exception):  # the session may be gone
            ws.remove()


atexit.register(_remove_all)


class Workspace:
    """A fresh folder below the shared one. ``save`` writes a table there and reads it back.

    Lineage ends at the files, so a lost executor costs the tasks it ran and no more. A result that is read lazily needs the
    folder, so it goes with the process that made it, or at the end of ``scratch``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _made.append(self)

    def remove(self) -> None:
        path, store = _file_system(self.spark, self.root)
        store.delete(path, True)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def make(self, name: str) -> str:
        """The path of a folder that is there."""
        path, store = _file_system(self.spark, self.path(name))
        store.mkdirs(path)
        return self.path(name)

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        df.write.option("compression", codec).mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path, store = _file_system(self.spark, self.path(name))
            store.delete(path, True)
