"""Incremental merging with Structured Streaming: files of records arrive, each micro-batch extends the accepted state.

The state is Parquet in one folder per committed batch (`state/batch=N`), so a restarted query overwrites an
unfinished batch and never reads it: exactly once by batch id. References to what has not arrived are dropped for good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relations import resolve


def stream_of(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """A stream over the Parquet files of a folder, in order of arrival."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_wins(stream: DataFrame, keys: list[str], order: list[str], state: str, checkpoint: str):
    """Start a query that keeps, for each key, the first row that ever arrived; within a batch the smallest in order."""
    schema = stream.schema

    def accept(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = committed_before(spark, state, schema, batch_id).select(*keys).distinct()
        rest = [c for c in batch.columns if c not in keys]
        first = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("x")).select(*keys, "x.*").select(*batch.columns)
        first.join(known, keys, "left_anti").select(*batch.columns).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(accept)


def committed_before(spark: SparkSession, state: str, schema, batch_id: int) -> DataFrame:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(state)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = []
    for n in range(batch_id):
        p = f"{state}/batch={n}"
        if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS")):
            done.append(p)
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)


def state_of(spark: SparkSession, state: str, schema) -> DataFrame:
    """All accepted rows."""
    return spark.read.schema(schema).parquet(f"{state}/batch=*")


def relations_stream(stream: DataFrame, inverses: dict[str, str], state: str, checkpoint: str):
    """Start a query that resolves relations (source, target, type, seq, resource) batch by batch: what earlier batches
    stored decides conflicts, so the final state equals one resolution of everything in order of seq."""

    def accept(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = committed_before(spark, state, batch.schema, batch_id)
        # Only explicit rows of pairs that this batch touches can matter.
        pair = lambda df: df.select(F.least("source", "target").alias("_l"), F.greatest("source", "target").alias("_h"))
        touched = pair(batch).distinct()
        old = known.join(touched, (F.least("source", "target") == F.col("_l")) & (F.greatest("source", "target") == F.col("_h")), "left_semi")
        stored, _ = resolve(old.unionByName(batch), inverses)
        kept = batch.join(stored.filter("NOT generated").select("source", "target", "type", "seq"), ["source", "target", "type", "seq"], "left_semi")
        kept.select(*batch.columns).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(accept)


def run_to_end(writer) -> None:
    """Process what is there and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
