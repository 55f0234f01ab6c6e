"""Tables in the folder that driver and executors share; they cut lineage between rounds and phases."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, or a folder of our own where that is unset (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexweave-"))
        at = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return at


class Scratch:
    """Parquet tables in the shared folder: a lost executor costs no recomputation of earlier rounds."""

    roots: list[str] = []

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
        self.count = 0
        Scratch.roots.append(self.root)

    def cut(self, df: DataFrame) -> DataFrame:
        """Write df and give back the written table."""
        self.count += 1
        at = f"{self.root}/{self.count:03d}"
        # Zstandard works in heap buffers; the default codec leaves direct ones behind for each file until a full collection.
        df.write.option("compression", "zstd").parquet(at)
        back = self.spark.read.schema(df.schema).parquet(at)
        back._scratch = at
        return back

    def drop(self, df: DataFrame | None) -> None:
        """Delete a table that no later step reads."""
        at = getattr(df, "_scratch", None)
        if at:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete all scratch tables of this process; results that read them must have been written or collected before."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while Scratch.roots:
        path = hadoop(Scratch.roots.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
