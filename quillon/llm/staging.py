"""Tables written between the steps of an operator.

A staged table replaces lineage: it lies in the folder that the cluster names in
``spark.checkpoint.dir`` (every executor and the driver can read it), so a lost
executor costs a task and not a recomputation of all that came before.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folder: str | None = None
_scopes: list[list[str]] = []  # paths to delete at the end of each scope


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Only where it is unset (tests, a
    laptop in local mode) a temporary folder of this process takes its place."""
    global _own_folder
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = "file://" + tempfile.mkdtemp(prefix="quillon-")
    return _own_folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path, whose files go at the end of the scope, if there is one."""
    path = new_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    return path


def stage(df: DataFrame, name: str, compression: str = "zstd", keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back. Within ``temporary``
    the table goes at the end of it; one to ``keep`` goes with the scope around, if any."""
    path = new_path(df.sparkSession, name)
    scopes = _scopes[:-1] if keep else _scopes
    if scopes:
        scopes[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """A scope whose staged tables are deleted at its end. What leaves the scope must have
    been computed within it or be kept."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def free_name(taken: Iterable[str], name: str) -> str:
    """``name`` with as many underscores as it takes to be none of ``taken``."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name += "_"
    return name
