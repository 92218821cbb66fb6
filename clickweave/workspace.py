"""Where intermediate tables go: the folder every executor can reach, and when they go away again."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_scopes: list[list[tuple[SparkSession, str, str]]] = [[]]  # the first one lasts as long as the process


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; where it is not set, the session's warehouse, which is shared as well."""
    return (spark.conf.get(_SETTING, None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def _forget(made: list[tuple[SparkSession, str, str]]) -> None:
    while made:
        spark, kind, name = made.pop()
        if spark.sparkContext._jsc is None:  # the session has ended
            continue
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            remove_dir(spark, name)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Folders and tables made inside are removed at its end; read or write the result before."""
    made: list[tuple[SparkSession, str, str]] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        _forget(made)


@atexit.register
def _at_exit() -> None:
    for made in _scopes:
        try:
            _forget(made)
        except Exception:  # the JVM may be gone already; nothing is left to remove it with
            made.clear()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody has used yet; it belongs to the innermost scope."""
    path = f"{shared_root(spark)}/clickweave/{label}-{uuid.uuid4().hex}"
    _scopes[-1].append((spark, "folder", path))
    return path


def fresh_name(spark: SparkSession, label: str) -> str:
    """A catalog table name that nobody has used yet; it belongs to the innermost scope."""
    name = f"{label}_{uuid.uuid4().hex}"
    _scopes[-1].append((spark, "table", name))
    return name


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the files, so that lost executors never recompute it.

    ``path``, made by ``fresh_dir`` before a scope begins, outlives that scope.
    """
    spark = df.sparkSession
    path = path or fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
