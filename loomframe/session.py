"""Shared scratch space: where jobs may cut lineage or hand files to a later step."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 200_000  # rows of a task that :func:`spread` makes, at most

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()
_shipping = threading.Lock()
_staged: dict[str, list[str]] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed by the few functions that run Python code in tasks; a package that came in an
    archive (``--py-files``) is there already.
    """
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    with _shipping:  # models of a grid are fitted by several threads
        if sc.applicationId in _shipped or not os.path.isdir(package):
            return
        target = os.path.join(tempfile.mkdtemp(prefix="loomframe-zip-"), "loomframe")
        sc.addPyFile(
            shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
        )
        _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own; a cluster
    without it is an error, because a driver-local folder is invisible to the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="loomframe-")
    return _local_dirs[sc.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses; :func:`drop_staged` deletes it."""
    path = f"{shared_dir(spark)}/loomframe/{label}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    The rows are then fixed: later branches see the same values even if an executor is lost,
    and each branch reads only the columns it needs.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, n: int | None = None) -> DataFrame:
    """``df``, which has ``n`` rows, in a task for each so many ``rows``.

    For work that is heavy for its bytes, which alone decide how Spark cuts files and shuffles. No
    more tasks than run side by side, unless they would be very large.
    """
    n = df.count() if n is None else n
    most = max(df.sparkSession.sparkContext.defaultParallelism, n // TASK_ROWS)
    tasks = min(most, -(-n // rows))
    return df.repartition(tasks) if tasks > 1 else df


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs.

    Spark removes them when the driver collects its garbage, which it is asked to do here.
    """
    spark.sparkContext._jvm.System.gc()


def discard(staged: DataFrame) -> None:
    """Delete one staged copy that nothing reads any more, and :func:`sweep`."""
    spark = staged.sparkSession
    folders = {name.rsplit("/", 1)[0] for name in staged.inputFiles()}
    held = _staged.get(spark.sparkContext.applicationId, [])
    for name in [n for n in held if any(f.endswith(n.split("://")[-1].split(":", 1)[-1]) for f in folders)]:
        held.remove(name)
        _delete(spark, name)
    sweep(spark)


def drop_staged(spark: SparkSession) -> int:
    """Delete every :func:`new_path` of this application, and return the number of folders.

    To be called once the results are stored elsewhere; DataFrames that read a staged copy can
    no longer run afterwards.
    """
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        _delete(spark, name)
    return len(paths)
