"""Helpers shared by the training-data operators: scratch tables, row keys, settings."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: The six ASCII white-space characters that separate words in every word-based operator.
WHITE = "\\x20\\x09-\\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Only where the setting is absent (a local session in tests) a temporary folder is made and
    registered as the checkpoint folder of the context.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = found.get() if found.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        local = tempfile.mkdtemp(prefix="lakeloom-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        found = f"file://{local}"
        spark.sparkContext.setCheckpointDir(found)
    return found


class Scratch:
    """Intermediate tables in the shared folder.

    Writing a table cuts the lineage: a lost executor costs a re-read, not a re-computation, and
    what has been written survives it. ``drop`` frees tables that no later step reads; tables that
    feed a returned (lazy) DataFrame stay until the application's checkpoint folder is cleaned.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/lakeloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(*cols: str) -> Column:
    """A key of a row's content, 128 bits as binary; equal rows share it. Used beside the id, never instead of it."""
    half = lambda *seed: F.lpad(F.hex(F.xxhash64(*seed, *cols)), 16, "0")
    return F.unhex(F.concat(half(), half(F.lit(1), F.lit("second"))))


def md5_unit(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an md5, the same in Spark and in ANSI SQL engines."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4503599627370496.0)
