"""The folder that driver and executors share, and the intermediate tables in it.

Tables of an application lie below one folder of its own, which goes when the driver's program ends; `scratch` deletes those of a block of code at its end, and `drop_scratch` all so far.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
#: Folders of applications, with the Hadoop configuration that reaches them.
_ROOTS: dict[str, object] = {}
#: Lists of the folders written inside open scratch() blocks, the innermost last.
_OPEN: list[list[str]] = []


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Leaves spark.checkpoint.dir alone if it is set; in local mode takes a scratch folder otherwise."""
    context = spark.sparkContext
    if context.getConf().get("spark.checkpoint.dir") or context.applicationId in _OWN:
        return
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _OWN[context.applicationId] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(_OWN[context.applicationId])


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the scratch folder of local mode."""
    ensure_checkpoint_dir(spark)
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir") or _OWN[spark.sparkContext.applicationId]).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the application's own folder."""
    root = f"{shared_dir(spark)}/claimlake-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS[root] = spark
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def materialise(rows: DataFrame, name: str) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads it back: its lineage is cut, and a lost executor loses nothing."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Deletes at its end the intermediate tables written inside; results needed afterwards must be written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            delete(spark, path)


def drop_scratch(spark: SparkSession) -> None:
    """Deletes all intermediate tables of the application; no DataFrame made of them may be in use."""
    root = f"{shared_dir(spark)}/claimlake-{spark.sparkContext.applicationId}"
    if _ROOTS.pop(root, None) is not None:
        delete(spark, root)


@atexit.register
def _at_exit() -> None:
    for root, spark in _ROOTS.items():
        with contextlib.suppress(Exception):  # the application may be gone, with its file systems
            delete(spark, root)
