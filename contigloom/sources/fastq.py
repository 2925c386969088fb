"""FASTQ files, plain or compressed, as a read table, through Spark's own text reader.

A record is four lines, and nothing but the number of a line in its file tells which of the four it is. Spark reads a plain file in
blocks, so lines are counted per block first, and the counts are summed up along each file: after that each block knows
the number of its first line. Tasks put lines together to records batch by batch; of a record that a block's end cuts, the rest is
among the next blocks' first three lines, which the counting has kept. No line is shuffled, and only Spark opens files,
so any file system that Spark reads will do. Compressed files cannot be split; each is one block, and needs no counting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigloom.session import BROADCAST_BYTES, broadcast_if_small, fits_broadcast, settle
from contigloom.sources.files import literal, plain_path
from contigloom.sources.text import source_path

# Blocks whose numbers each task may be sent: 640 TB at Spark's usual 128 MB.
BLOCKS = 5_000_000
RECORD = ["head", "seq", "plus", "qual"]
# Fixed value: how names of files end that are read in blocks.
PLAIN = "[.](?:fq|fastq)$"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """((file, block), start, end) of the rows of one block after another."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    if not len(file):
        return
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(file)]):
        yield (int(file[a]), int(block[a])), int(a), int(b)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block, lines in it, and its first three lines."""
    last, lines, first = None, 0, []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int64()), pa.array([lines], pa.int64()),
                                           pa.array([first], pa.list_(pa.binary()))], names=["file", "block", "lines", "first"])

    for batch in batches:
        value = batch.column("value")
        for key, a, b in _runs(batch):
            if key != last:
                if last is not None:
                    yield row()
                last, lines, first = key, 0, []
            if len(first) < 3:
                first += value.slice(a, min(b - a, 3 - len(first))).to_pylist()
            lines += b - a
    if last is not None:
        yield row()


_RECORDS = "file long, block long, read_no long, head binary, seq binary, plus binary, qual binary"


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from lines in order; the last one of a block may lack lines."""
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    last, held, number = None, pa.array([], pa.binary()), 0  # held: lines of a record that is not whole yet; number: its first line's

    def records(key: tuple[int, int], lines: pa.Array, first_line: int) -> pa.RecordBatch:
        n = -(-len(lines) // 4)
        place = np.arange(n) * 4
        parts = [lines.take(pa.array(np.where(place + k < len(lines), place + k, -1), pa.int64(), mask=place + k >= len(lines))) for k in range(4)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])), pa.array(first_line // 4 + np.arange(n)), *parts], names=names)

    for batch in batches:
        value, first_lines = batch.column("value"), batch.column("first_line")
        for key, a, b in _runs(batch):
            if key != last:
                if len(held):
                    yield records(last, held, number)
                last, held = key, pa.array([], pa.binary())
                number = first_lines[a].as_py()
            skipped = min(-number % 4, b - a) if not len(held) else 0  # the end of the record before
            number += skipped
            lines = pa.concat_arrays([held, value.slice(a + skipped, b - a - skipped)])
            whole = len(lines) // 4 * 4
            if whole:
                yield records(key, lines.slice(0, whole), number)
                number += whole
            held = lines.slice(whole)
    if len(held):
        yield records(last, held, number)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file (a hash of its path), block and line, as Spark reads them."""
    return spark.read.option("lineSep", "\n").text([literal(p) for p in paths]).select(
        F.xxhash64(source_path()).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def _pin_blocks(spark: SparkSession) -> None:
    """Have files cut alike in every pass, whatever cores come and go; unless the session says how itself."""
    cut = "spark.sql.files.minPartitionNum"
    if spark.conf.get(cut, None) is None:
        spark.conf.set(cut, spark.sparkContext.defaultParallelism)


def _in_blocks(spark: SparkSession, paths: list[str], files: DataFrame) -> DataFrame:
    """Records of files that Spark may cut."""
    _pin_blocks(spark)
    lines = _lines(spark, paths)
    blocks = settle(lines.mapInArrow(_measured, "file long, block long, lines long, first array<binary>"))
    along = Window.partitionBy("file").orderBy("block")
    start = F.coalesce(F.sum("lines").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first_line")
    after = F.flatten(F.collect_list("first").over(along.rowsBetween(1, 3))).alias("after")
    numbered = blocks.select("file", "block", "lines", start, after)
    torn = (-(F.col("first_line") + F.col("lines"))) % 4 + 4  # lines that the block's last record lacks
    numbered = settle(numbered.select("file", "block", "first_line", F.slice("after", 1, torn % 4).alias("after")))
    starts = numbered.select("file", "block", "first_line")
    if not fits_broadcast(starts, BLOCKS)[0]:  # lines have to stay in order, so they can't be shuffled to their numbers
        raise ValueError(f"more than {BLOCKS} blocks or {BROADCAST_BYTES} bytes for them: read fewer files at once or raise spark.sql.files.maxPartitionBytes")
    message = F.lit("a file was cut otherwise when its lines were counted: set spark.sql.files.minPartitionNum")
    known = lines.join(F.broadcast(starts), ["file", "block"], "left")
    first_line = F.when(F.col("first_line").isNull(), F.raise_error(message).cast("long")).otherwise(F.col("first_line"))
    found = known.select("file", "block", first_line.alias("first_line"), "value").mapInArrow(_assembled, _RECORDS)
    ends = numbered.filter(F.size("after") > 0).select("file", "block", "after")
    return found.join(broadcast_if_small(ends, BLOCKS), ["file", "block"], "left").join(files, "file")


def _whole(spark: SparkSession, paths: list[str], files: DataFrame) -> DataFrame:
    """Records of files that are one block."""
    lines = _lines(spark, paths).withColumn("first_line", F.lit(0).cast("long"))
    none = F.array().cast("array<binary>")
    return lines.mapInArrow(_assembled, _RECORDS).withColumn("after", none).join(files, "file")


def _completed(found: DataFrame) -> DataFrame:
    """Records with the lines that their block lacked, checked, as reads."""
    there = sum(F.col(c).isNotNull().cast("int") for c in RECORD)
    rows = found.withColumn("there_", there)
    filled = {}
    for k, name in enumerate(RECORD):
        rest = F.get("after", F.lit(k) - F.col("there_"))
        line = F.coalesce(F.col(name), F.when(F.col("there_") <= k, rest)).cast("string")
        filled[name] = F.rtrim(line, F.lit("\r"))
    rows = rows.withColumns(filled)
    rows = rows.filter(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in RECORD]) != "")  # blank lines at a file's end

    def say(text: str) -> Column:
        return F.raise_error(F.concat("path", F.lit(f": {text}: "), F.substring("head", 1, 80))).cast("boolean")

    shape = F.col("head").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual"))
    rows = rows.filter(F.when(F.col("qual").isNull(), say("last record is incomplete")).when(~shape, say("not a FASTQ record")).otherwise(F.lit(True)))
    read_id = F.regexp_extract("head", r"^@\s*(\S*?)(?:/[12])?(?:\s.*)?$", 1)
    return rows.select("sample", "mate", "read_no", read_id.alias("read_id"), "seq", "qual")


def read_fastq(spark: SparkSession, read_files: DataFrame) -> DataFrame:
    """Reads of ``read_files(sample, mate, path, length)``, numbered from 0 along each file.

    Where a mate comes in several files (parts Spark wrote), numbers repeat: pair by ``read_id`` then. Plain files are counted
    first, in a pass of its own. Line ends ``\\r\\n`` are taken off, blank lines at the end of a file are passed over; any other departure from
    four lines a record raises. The driver holds the paths, as Spark does for any files it reads.
    """
    rows = read_files.filter("length > 0").select("sample", F.col("mate").cast("int").alias("mate"), plain_path("path").alias("path"))
    rows = settle(rows.withColumn("file", F.xxhash64("path")))
    paths = [r["path"] for r in rows.select("path").distinct().collect()]
    if len(paths) != rows.select("file").distinct().count():
        raise ValueError("two paths have one hash: read them apart")
    files = broadcast_if_small(rows)
    plain = F.col("path").rlike(PLAIN)
    found = []
    for part, group in ((plain, _in_blocks), (~plain, _whole)):
        own = [r["path"] for r in rows.filter(part).select("path").distinct().collect()]
        if own:
            found.append(_completed(group(spark, own, files)))
    if not found:
        return spark.createDataFrame([], "sample string, mate int, read_no bigint, read_id string, seq string, qual string")
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])
