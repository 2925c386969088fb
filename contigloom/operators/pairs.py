"""Read and contig files of a cohort: pair mates, find gaps, choose among duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.functions import names
from contigloom.schemas import FASTA_EXTENSIONS


def parse_mate_name(files: DataFrame, name: str = "name") -> DataFrame:
    """Add ``sample, mate``; files that are not named like a read file are dropped."""
    return (files.withColumns({"sample": names.mate_sample(name), "mate": names.mate_number(name)})
            .filter("sample is not null"))


def latest_wins(files: DataFrame, keys: list[str], order: str = "path") -> DataFrame:
    """One row per key: the one that comes last in ``order``."""
    rest = [c for c in files.columns if c not in keys and c != order]
    if not rest:
        return files.groupBy(*keys).agg(F.max(order).alias(order)).select(files.columns)
    last = F.max(F.struct(order, *rest)).alias("_last")
    return files.groupBy(*keys).agg(last).select(*keys, "_last.*").select(files.columns)


def pair_mates(read_files: DataFrame) -> DataFrame:
    """``sample, r1_path, r2_path``; among files of the same sample and mate the greatest path wins."""
    return read_files.groupBy("sample").agg(
        F.max(F.when(F.col("mate") == 1, F.col("path"))).alias("r1_path"),
        F.max(F.when(F.col("mate") == 2, F.col("path"))).alias("r2_path"))


def missing_mates(read_files: DataFrame) -> DataFrame:
    """``sample, missing`` for each sample without a file of mate 1 or 2."""
    present = read_files.groupBy("sample").agg(
        F.max(F.col("mate") == 1).alias("has1"), F.max(F.col("mate") == 2).alias("has2"))
    return (present.select("sample", F.explode(F.array(
        F.when(~F.col("has1"), 1), F.when(~F.col("has2"), 2))).alias("missing"))
        .filter("missing is not null"))


def require_mates(read_files: DataFrame, named: int = 20) -> None:
    """Raise when any sample lacks a mate.

    The message gives the full number and names the first few; :func:`missing_mates` is the whole list.
    """
    gaps = missing_mates(read_files)
    total = gaps.count()
    if total:
        first = gaps.orderBy("sample", "missing").limit(named).collect()
        listed = ", ".join(f"{r['sample']} (R{r['missing']})" for r in first)
        more = f", and {total - named} more" if total > named else ""
        raise ValueError(f"{total} read files missing: {listed}{more}")


def distinct_samples(read_files: DataFrame) -> DataFrame:
    return read_files.select("sample").distinct()


def pick_contig_file(files: DataFrame) -> DataFrame:
    """``sample, path``: among files of one sample the first extension in sorted order.

    Of files with one name in several folders the greatest path counts.
    """
    extension = F.lower(F.element_at(F.split("path", "[.]"), -1))
    rank = F.array_position(F.array(*[F.lit(e) for e in FASTA_EXTENSIONS]), extension)
    named = latest_wins(files.select("sample", "path", names.base_name("path").alias("name"), rank.alias("rank")), ["sample", "name"])
    first = F.min_by("path", F.struct("rank", "name")).alias("path")
    return named.groupBy("sample").agg(first).select("sample", "path")


def natural_sort(table: DataFrame, name: str = "sample") -> DataFrame:
    """Sorted so that s2 comes before s10."""
    return table.orderBy(names.natural_key(name), name)


def batch_manifest(files: DataFrame, layout: str) -> DataFrame:
    """Two columns per genome file: (path, stem), (stem_before, path) or (stem, path)."""
    stem, path = names.stem("path"), F.col("path")
    layouts = {
        "path_stem": (path, stem),
        "before_path": (F.concat(stem, F.lit("_before")), path),
        "stem_path": (stem, path),
    }
    first, second = layouts[layout]
    return files.select(first.alias("first"), second.alias("second"))


def tail_lines(lines: DataFrame, n: int = 5, keys: list[str] | None = None) -> DataFrame:
    """Last ``n`` lines of each log. Spark keeps only ``n`` per log before the shuffle."""
    keys = keys or ["file"]
    newest = Window.partitionBy(*keys).orderBy(F.desc("line_no"))
    return (lines.withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") <= n).drop("_rank"))
