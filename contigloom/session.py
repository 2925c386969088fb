"""Where intermediate data may live, and how a side of a join is sized."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side of a join is broadcast up to this many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; unset, a folder beside the session's warehouse.

    Raises on a cluster where neither names a shared file system: a folder of one machine is none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-contigloom"
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local" and re.match("file:|/|[^:]*$", base):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; {base} is on one")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def _until_exit(spark: SparkSession, path: str) -> None:
    """Have the file system delete the folder when this session's JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(folder)  # only what exists can be registered
    system.deleteOnExit(folder)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, which goes when the session's JVM ends."""
    base = shared_dir(spark)
    if "://" not in base and not base.startswith("file:"):
        base = os.path.abspath(base)
    own = f"{base.rstrip('/')}/contigloom-{spark.sparkContext.applicationId}"
    _until_exit(spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder; survives lost executors, and goes when the session's JVM ends."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    _until_exit(df.sparkSession, context.getCheckpointDir())  # a folder of this context alone
    return df.checkpoint(eager=True)


# Bytes of an Arrow batch between Spark and Python: rows are counted by default, and ten thousand long texts are a lot of memory.
ARROW_BATCH_BYTES = 2 * 1024 * 1024


def bound_arrow_batches(spark: SparkSession) -> None:
    """Have Arrow batches end at ``ARROW_BATCH_BYTES``, unless the session names a size itself."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size, None) is None:
        spark.conf.set(size, ARROW_BATCH_BYTES)


def _bytes_of(field: T.StructField) -> str:
    """SQL for about how many bytes a value of the column takes."""
    if isinstance(field.dataType, T.StringType):
        return f"coalesce(octet_length(`{field.name}`), 0) + 8"
    if isinstance(field.dataType, T.ArrayType) and not isinstance(field.dataType.elementType, T.StringType):
        return f"coalesce(size(`{field.name}`), 0) * 8 + 8"
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return f"coalesce(length(to_json(struct(`{field.name}`))), 0)"
    return "8"


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[bool, int]:
    """Whether ``df`` is measured to be small, and its number of rows.

    Rows and bytes are summed where the rows are; no row moves for it.
    """
    size = " + ".join(_bytes_of(f) for f in df.schema.fields)
    found = df.agg(F.count("*").alias("n"), F.expr(f"coalesce(sum({size}), 0)").alias("size")).first()
    return found["n"] <= limit and found["size"] <= BROADCAST_BYTES, found["n"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` is measured to be small.

    A larger side comes back as it is, and the join shuffles both sides on its keys.
    """
    return F.broadcast(df) if fits_broadcast(df, limit)[0] else df
