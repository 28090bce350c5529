"""Python code for the workers, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import sys
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def ship() -> None:
    """Let Spark send this package's functions to Python workers by value.

    Executors then need no copy of the package on their path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


@cache
def _own_folder() -> str:
    """Stands in where no shared folder is named: tests and single machines."""
    return tempfile.mkdtemp(prefix="gridlark-")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` has executors of its own)."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder stands in on a single machine; on a cluster that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "local")
        if not is_local(master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        shared = _own_folder()
    return shared.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new name under the shared folder."""
    return f"{shared_folder(spark)}/gridlark-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back, for results used several times.

    Its folder goes with ``released``, or with the shared folder.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    _FOLDERS.append(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_FOLDERS: list[str] = []


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a scratch folder through Spark's file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, what ``stored`` has written meanwhile: for results that were written elsewhere."""
    before = len(_FOLDERS)
    try:
        yield
    finally:
        for folder in _FOLDERS[before:]:
            remove(spark, folder)
        del _FOLDERS[before:]
