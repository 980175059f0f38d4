"""Intermediate tables that outlive executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders that are still there, by path.
_written: dict[str, SparkSession] = {}
#: What the innermost ``scratch`` of this thread has written so far.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder; a cluster has to
    name one, as nothing else is known to be shared there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    now = sc._jsc.sc().getCheckpointDir()
    if not now.isEmpty():
        return now.get().rstrip("/")
    if not (sc.master.startswith("local[") or sc.master == "local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="ontoloom-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage durably: a lost executor loses none of it. The files go with
    the ``scratch`` they were written in, or when the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ontoloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written[path] = spark
    if (scope := _scope.get()) is not None:
        scope.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._ontoloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialize`` returned and that nothing reads any more."""
    for t in tables:
        _delete(t._ontoloom_path)


def _delete(path: str) -> None:
    spark = _written.pop(path, None)
    if spark is not None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """What this thread writes inside goes at the end, but for the tables that are put into the list.

    Results that are computed later may read those only; they belong to the
    scratch around this one, if there is any.
    """
    own: list[str] = []
    kept: list[DataFrame] = []
    outer = _scope.get()
    token = _scope.set(own)
    try:
        yield kept
    finally:
        _scope.reset(token)
    stays = [t._ontoloom_path for t in kept]
    for path in own:
        if path not in stays:
            _delete(path)
    if outer is not None:
        outer += stays


def _sweep() -> None:
    for path in list(_written):
        try:
            _delete(path)
        except Exception:  # noqa: BLE001  the JVM may be gone
            return


atexit.register(_sweep)
