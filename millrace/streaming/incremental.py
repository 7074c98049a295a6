"""Loading what arrives, once: a file stream checked against the manifest of what has been loaded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def load_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    key: str = "sha256",
    source_format: str = "json",
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Records whose key the target doesn't hold yet are appended to it, the first of equal keys in a batch.

    A batch that is run again after a failure finds its keys loaded, so nothing is doubled. Records without a key are
    appended as they come, under their batch's own folder, which a second run replaces.
    """

    def append(batch: DataFrame, number: int) -> None:
        path = f"{target}/batch={number}"
        earlier = [p for p in _parts(spark, target) if p != path]
        keyed = batch.filter(F.col(key).isNotNull()).dropDuplicates([key])
        if earlier:
            keyed = keyed.join(spark.read.parquet(*earlier).select(key).distinct(), key, "left_anti")
        out = keyed.select(*batch.columns).unionByName(batch.filter(F.col(key).isNull()))
        transform(out).write.mode("overwrite").parquet(path)

    stream = spark.readStream.format(source_format).schema(schema).load(source)
    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _parts(spark: SparkSession, target: str) -> list[str]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [f"{target}/{s.getPath().getName()}" for s in files.listStatus(folder) if s.getPath().getName().startswith("batch=")]


def windowed_counts(events: DataFrame, time: str, group: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events per window and group; a stream drops what comes later than allowed, a table counts all."""
    watched = events.withWatermark(time, late) if events.isStreaming else events
    return watched.groupBy(F.window(time, window).alias("w"), group).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), group, "n")
