"""Session helpers: the shared work folder, and tables written there to cut lineage."""

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDER_KEY = "snapmart.local.work.folder"

class _Blocks(threading.local):
    """Paths made inside each open `work_tables` block of a thread."""

    def __init__(self):
        self.open: list[list[str]] = []


_blocks = _Blocks()


def work_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session's ``spark.checkpoint.dir`` names it.

    Only a local master may fall back on a temporary folder; a cluster without the setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = spark.conf.get(_LOCAL_FOLDER_KEY, None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="snapmart-")
        spark.conf.set(_LOCAL_FOLDER_KEY, folder)
    return folder


def new_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in the work folder; one to ``keep`` outlives the innermost ``work_tables`` block."""
    path = f"{work_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    blocks = _blocks.open[:-1] if keep else _blocks.open
    if blocks:
        blocks[-1].append(path)
    return path


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete_folder(spark: SparkSession, path: str):
    """Deletes the folder, if there is one; gives its path and file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(target, True)
    return target, system


def _delete(spark: SparkSession, path: str) -> None:
    """Deletes the folder, and the application's own once nothing is left in it."""
    target, system = delete_folder(spark, path)
    above = target.getParent()
    if above.getName() == spark.sparkContext.applicationId and system.exists(above) and not len(system.listStatus(above)):
        system.delete(above, True)


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the work tables that the block makes at its end, but for those made to keep.

    Frames that read the others must not be used later.
    """
    _blocks.open.append([])
    try:
        yield
    finally:
        for path in _blocks.open.pop():
            _delete(spark, path)


def drop_work_tables(spark: SparkSession) -> None:
    """Delete all of this application's tables in the work folder, once nothing reads them any more."""
    _delete(spark, f"{work_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What the block writes has its shuffle files deleted when it is written, not when the driver next collects garbage.

    Otherwise the shuffles of all tables that a job writes one after another lie on the executors' disks together.
    """
    with _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def smaller_partitions(spark: SparkSession, times: int) -> Iterator[None]:
    """What the block shuffles is dealt to tasks in partitions of so many ``times`` fewer bytes, as each byte holds more rows."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))
    with _set(spark, setting, f"{max(1, usual // times)}b"):
        yield


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    Later steps then survive lost executors without recomputing the inputs, and the planner knows the
    table's real size, so it broadcasts only what is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, name, keep)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
