"""Live progress from a stream of status events.

The table on disk is a base, all cells as of some micro-batch, and the cells that later micro-batches changed. A micro-batch writes the
changed cells alone; every ``COMPACT`` of them, base and changes become a new base.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from contigloom.operators.status import stage_progress
from contigloom.schemas import STEPS

COMPACT = 20  # micro-batches; reading joins as many small folders at most
CELLS = "sample string, step string, status string, ts timestamp, seq_no bigint"


def stream_status(events: DataFrame) -> DataFrame:
    """Current status of each sample and step; state is one row per cell, at most 16 per sample."""
    at = F.struct("ts", "seq_no")
    return (events.filter(F.col("step").isin(STEPS)).groupBy("sample", "step")
            .agg(F.max_by("status", at).alias("status"), F.max(at).alias("at")))


def _folders(spark: SparkSession, out: str) -> dict[str, list[int]]:
    """The numbers of the finished folders of each kind, ``base`` and ``change``."""
    found: dict[str, list[int]] = {"base": [], "change": []}
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/cells/*/_SUCCESS")
    system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.globStatus(pattern) or []:
        kind, number = re.fullmatch("(base|change)-([0-9]+)", status.getPath().getParent().getName()).groups()
        found[kind].append(int(number))
    return {kind: sorted(numbers) for kind, numbers in found.items()}


def _drop(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _cells(spark: SparkSession, out: str, upto: int | None = None) -> DataFrame:
    """The cells of the newest base, overlaid with what changed after it."""
    there = _folders(spark, out)
    numbers = {k: [n for n in ns if upto is None or n <= upto] for k, ns in there.items()}
    base = numbers["base"][-1:]
    paths = [f"{out}/cells/base-{n:012d}" for n in base] + [f"{out}/cells/change-{n:012d}" for n in numbers["change"] if not base or n > base[0]]
    if not paths:
        return spark.createDataFrame([], CELLS)
    at = F.struct("ts", "seq_no")
    return (spark.read.schema(CELLS).parquet(*paths).groupBy("sample", "step").agg(F.max_by("status", at).alias("status"), F.max(at).alias("at"))
            .select("sample", "step", "status", "at.ts", "at.seq_no"))


def write_progress(events: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, compact: int = COMPACT) -> StreamingQuery:
    """Keep the status of all samples up to date under ``out``.

    ``trigger`` is what ``DataStreamWriter.trigger`` takes, such as ``{"processingTime": "10 seconds"}`` for a live table; by default
    the query ends when it has taken what is there. The state store emits the cells that a micro-batch touched; these alone are written,
    to a folder of the batch's number, which a repeated micro-batch replaces. Every ``compact`` batches the table is written as a whole; the
    base before it and its changes stay for those who still read them, older folders go.
    """
    def save(cells: DataFrame, batch: int) -> None:
        spark = cells.sparkSession
        changed = cells.select("sample", "step", "status", "at.ts", "at.seq_no")
        changed.write.mode("overwrite").parquet(f"{out}/cells/change-{batch:012d}")
        if batch % compact == compact - 1:
            _cells(spark, out, batch).write.mode("overwrite").parquet(f"{out}/cells/base-{batch:012d}")
            bases = [n for n in _folders(spark, out)["base"] if n <= batch]
            for kind, numbers in _folders(spark, out).items():
                for n in numbers:
                    if len(bases) > 1 and (n < bases[-2] if kind == "base" else n <= bases[-2]):
                        _drop(spark, f"{out}/cells/{kind}-{n:012d}")

    return (stream_status(events).writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_progress(spark: SparkSession, out: str) -> DataFrame:
    """The status table as of the last finished micro-batch."""
    return _cells(spark, out)


def read_stage_progress(spark: SparkSession, out: str) -> DataFrame:
    """The stage counts as of the last finished micro-batch."""
    return stage_progress(_cells(spark, out))
