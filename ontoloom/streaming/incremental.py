"""Incremental runs as a stream: fragments that arrive are laid over the index.

``availableNow`` reads what has come since the last run, once; each micro-batch
is one overlay, written as a new version of the index, so that a batch that is
replayed gives the same version again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ontoloom.operators import catalog
from ontoloom.sources.tables import INDEX, exists


def version(path: str, k: int) -> str:
    return f"{path}/v={k:08d}"


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of the index, None if there is none."""
    if not exists(spark, path):
        return None
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    found = sorted(s.getPath().getName() for s in at.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(at) if s.getPath().getName().startswith("v="))
    return spark.read.schema(INDEX).parquet(f"{path}/{found[-1]}") if found else None


def run(spark: SparkSession, fragments: str, index: str, checkpoint: str, asset_prefix: str) -> StreamingQuery:
    """Start a run; fragments are Parquet files of index rows."""

    def lay(batch: DataFrame, k: int) -> None:
        s = batch.sparkSession
        base = s.read.schema(INDEX).parquet(version(index, k - 1)) if k else s.createDataFrame([], INDEX)
        one = catalog.last_of_each(batch.withColumn("_pos", batch.id), "id", "_pos").drop("_pos")
        catalog.index_overlay(base, one, asset_prefix).write.mode("overwrite").parquet(version(index, k))

    stream = spark.readStream.schema(INDEX).parquet(fragments)
    return stream.writeStream.foreachBatch(lay).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
