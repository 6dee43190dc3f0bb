"""How long staged tables live.

Operators write intermediate tables under the shared folder and read them
lazily, so nobody but the caller knows when the last reader is done. A scope
says so: what is staged inside it is deleted when it ends. Tables that several
runs can use are staged under a key of their content (the query and the files it
reads); every scope that uses such a table holds it, and the last one to end
deletes it, so a second run meanwhile reads what the first has written.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections import Counter
from contextlib import contextmanager
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from metrolens import session

_LOCK = threading.Lock()
_HOLDERS: Counter[str] = Counter()  # of this driver: shared table -> scopes that use it


class Scope:
    """Staged tables of one piece of work: its own folder, and the shared tables it holds."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.held: set[str] = set()

    def close(self) -> None:
        _delete(self.spark, self.root)
        with _LOCK:
            _HOLDERS.subtract(self.held)
            gone = [path for path in self.held if _HOLDERS[path] <= 0]
            for path in gone:
                del _HOLDERS[path]
                _delete(self.spark, path)
        self.held.clear()


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _path(spark, path)
    fs.delete(at, True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[Scope]:
    """Everything staged inside is deleted at the end, also after a failure. Use
    (collect, write) what is built inside before it ends. Scopes may be nested."""
    root = f"{session.checkpoint_dir(spark).rstrip('/')}/staging/scope-{uuid.uuid4().hex}"
    scope = Scope(spark, root)
    token = session.CURRENT_SCOPE.set(scope)
    try:
        yield scope
    finally:
        session.CURRENT_SCOPE.reset(token)
        scope.close()


def content_key(df: DataFrame) -> str:
    """A key of the query (its canonical plan) and of the files it reads (name, size, time of change)."""
    spark = df.sparkSession
    digest = hashlib.sha256(df._jdf.queryExecution().analyzed().canonicalized().toString().encode())
    for name in sorted(df.inputFiles()):
        fs, at = _path(spark, name)
        status = fs.getFileStatus(at)
        digest.update(f"{name}\0{status.getLen()}\0{status.getModificationTime()}\0".encode())
    return digest.hexdigest()


def stage_shared(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under its content key and read back; within a scope
    only. If a scope that is still open has staged the same content, its table
    is read instead. A table appears by one rename, so a half-written one is never read."""
    scope = session.CURRENT_SCOPE.get()
    if scope is None:
        raise RuntimeError("shared tables are staged inside a staging_scope")
    spark = df.sparkSession
    path = f"{session.checkpoint_dir(spark).rstrip('/')}/staging/shared/{name}-{content_key(df)}"
    with _LOCK:
        if path not in scope.held:
            scope.held.add(path)
            _HOLDERS[path] += 1
    fs, place = _path(spark, path)
    if not fs.exists(place):
        making = f"{path}.making-{uuid.uuid4().hex}"
        df.write.parquet(making)
        _, made = _path(spark, making)
        if fs.exists(place) or not fs.rename(made, place):  # another thread was first
            fs.delete(made, True)
    return spark.read.schema(df.schema).parquet(path)
