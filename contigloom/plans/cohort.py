"""Whole runs: a folder of contig files, or a folder of read files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.operators import contigs as co
from contigloom.operators import pairs as pa
from contigloom.operators import reads as re
from contigloom.operators.status import select_steps
from contigloom.plans.filter_effect import filter_effect
from contigloom.schemas import FASTA_EXTENSIONS, OK, SKIPPED
from contigloom.session import broadcast_if_small, fits_broadcast, settle
from contigloom.sinks import files as sinks
from contigloom.sources.fastq import read_fastq
from contigloom.sources.files import absolute, any_case, scan_contig_files, scan_read_files
from contigloom.sources.text import fasta_files, plain_path, read_fasta, read_removal_list


def _globs(spark: SparkSession, root: str, depth: int, files: DataFrame | None = None) -> list[str]:
    """A glob for each level under ``root`` that has contig files."""
    root = absolute(root)
    files = scan_contig_files(spark, root, depth) if files is None else files
    above = len([p for p in root.split("/") if p])
    level = F.size(F.filter(F.split("path", "/"), lambda p: p != "")) - above
    levels = sorted(r["level"] for r in files.select(level.alias("level")).distinct().collect())  # at most depth
    if not levels:
        raise FileNotFoundError(f"no contig files in {root}")
    ending = ".{" + ",".join(any_case(e) for e in FASTA_EXTENSIONS) + "}"
    return [root.rstrip("/") + "/*" * n + ending for n in levels]


def cohort_contigs(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """Contigs of every sample under ``root``; of several files of a sample one is taken."""
    files = settle(scan_contig_files(spark, root, depth))
    contigs = read_fasta(spark, _globs(spark, root, depth, files))
    # the files that lost are few or none, so no sequence is shuffled to drop them
    picked = pa.pick_contig_file(files).select("path")
    lost = files.select("path").join(picked, "path", "left_anti").select(plain_path("path").alias("path"))
    small, count = fits_broadcast(lost)
    if not count:
        return contigs
    return contigs.join(F.broadcast(lost) if small else lost, "path", "left_anti")


#: What a run has made, from which files and with which thresholds.
MADE = "sample string, path string, length long, min_cov double, min_len long, filtered boolean"


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing this folder."""
    done = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def run_contigs(spark: SparkSession, root: str, out: str, depth: int = 1, min_cov: float = 10,
                min_len: int = 500, skip: tuple[str, ...] = (), resume: bool = True) -> DataFrame:
    """Filter a folder of contig files and report what that did.

    Writes ``out/contigs`` (Parquet, parsed once), ``out/contigs_filtered`` (FASTA), ``out/reports/filter_effect``, per sample the
    state of the FILTER step in ``out/status``, and ``out/made``: from which files, and with which thresholds; returns the report.
    With ``resume`` what an earlier run has finished is kept: samples that came since are added, those whose file has another path or
    length are made anew, other thresholds filter all samples again, and a part that is missing is made anew. Samples whose
    files are gone stay. ``skip=("FILTER",)`` leaves the filter out and marks it.
    """
    def wanted(path: str) -> bool:
        return not (resume and is_written(spark, path))

    skipped = not select_steps(spark.createDataFrame([("FILTER",)], "step string"),
                               spark.createDataFrame([(s,) for s in skip], "name string")).take(1)
    files = scan_contig_files(spark, root, depth).select("path", "length")
    listed = settle(pa.pick_contig_file(scan_contig_files(spark, root, depth)).join(files, "path").select("sample", "path", "length"))
    anew = wanted(f"{out}/contigs")
    if anew or wanted(f"{out}/made"):
        made = spark.createDataFrame([], MADE)
    else:
        made = settle(spark.read.parquet(f"{out}/made"))
    todo = settle(listed.join(made, ["sample", "path", "length"], "left_anti"))
    fresh, changed = todo, False
    if anew:
        cohort_contigs(spark, root, depth).write.mode("overwrite").parquet(f"{out}/contigs")
    elif todo.take(1):
        stored = spark.read.parquet(f"{out}/contigs")
        known = made.select("sample").union(stored.select("sample")).distinct()
        fresh = settle(todo.join(known, "sample", "left_anti"))
        changed = bool(todo.join(known, "sample", "left_semi").take(1))
        # only the new files are read
        added = fasta_files(spark, [r["path"] for r in todo.select("path").collect()]).select(*stored.columns)
        if changed:
            added = settle(stored.join(todo.select("sample"), "sample", "left_anti").select(*stored.columns)).unionByName(added)
        added.write.mode("overwrite" if changed else "append").parquet(f"{out}/contigs")
    contigs = spark.read.parquet(f"{out}/contigs")
    new = bool(todo.take(1))
    other = bool(made.filter((F.col("min_cov") != min_cov) | (F.col("min_len") != min_len)).take(1))
    whole = anew or changed or other or wanted(f"{out}/contigs_filtered")
    if not skipped and (whole or new or made.filter("not filtered").take(1)):
        whole = whole or bool(made.filter("not filtered").take(1))
        rows = contigs if whole else contigs.join(fresh.select("sample"), "sample", "left_semi").select(*contigs.columns)
        sinks.write_fasta(co.filter_contigs(rows, min_cov, min_len), f"{out}/contigs_filtered", mode="overwrite" if whole else "replace")
    elif skipped:
        whole = True
    if wanted(f"{out}/status") or skipped or whole and (anew or changed or other) or new:
        samples = contigs.select("sample").distinct()
        if not whole:
            samples = samples.join(fresh.select("sample"), "sample", "left_semi")
        samples.select("sample", F.lit("FILTER").alias("step"), F.lit(SKIPPED if skipped else OK).alias("status"),
                       F.current_timestamp().alias("ts"), F.lit(0).cast("long").alias("seq_no")).write.mode("append").parquet(f"{out}/status")
    if wanted(f"{out}/reports/filter_effect") or anew or new or other:
        sinks.write_report_tsv(filter_effect(contigs, min_cov, min_len), f"{out}/reports/filter_effect", order=["sample"])
    filtered = not skipped
    if new or other or made.filter(F.col("filtered") != filtered).take(1):  # last, so what broke off is made anew
        gone = made.join(listed, "sample", "left_anti").select("sample", "path", "length")
        rows = listed.unionByName(gone).withColumns({"min_cov": F.lit(float(min_cov)), "min_len": F.lit(min_len).cast("long"), "filtered": F.lit(filtered)})
        rows.write.mode("overwrite").parquet(f"{out}/made")
    return filter_effect(contigs, min_cov, min_len)


def run_removal(spark: SparkSession, removal_list: str, root: str, out: str, depth: int = 1, repeated: str = "last") -> DataFrame:
    """Remove listed contigs from the files under ``root`` and write them to ``out`` with ``_removed`` in their names.

    Returns the listed paths that are not there (``path``), to warn about.
    """
    removals = settle(read_removal_list(spark, removal_list, repeated)).withColumn("path", plain_path("path"))
    files = scan_contig_files(spark, root, depth).select(plain_path("path").alias("path"))
    missing = settle(co.listed_files_missing(removals, files))
    contigs = read_fasta(spark, _globs(spark, root, depth))
    sinks.write_removed_fasta(co.remove_contigs(contigs, removals), out)
    return missing


def run_reads(spark: SparkSession, root: str, out: str, depth: int = 1, trim: dict | None = None,
              keep: dict | None = None) -> DataFrame:
    """Trim and filter a folder of read pairs and report qualities before and after.

    Raises when a sample lacks a mate. ``trim`` and ``keep`` are the options of ``trim_reads`` and
    ``filter_reads``. Writes ``out/reads`` (Parquet, parsed once), ``out/reads_trimmed`` (FASTQ), ``out/reports/read_quality`` and
    ``out/reports/lone_mates``, the reads without a mate. Mates are matched by their numbers, so letters are not shuffled for it.
    """
    files = settle(pa.latest_wins(scan_read_files(spark, root, depth), ["sample", "mate"]))
    pa.require_mates(files)
    read_fastq(spark, files).write.mode("overwrite").parquet(f"{out}/reads")
    reads = spark.read.parquet(f"{out}/reads")
    cleaned = re.filter_reads(re.trim_reads(reads, **(trim or {})), **(keep or {}))
    sinks.write_fastq(cleaned, f"{out}/reads_trimmed")
    lone = re.lone_mates(reads)
    ids = reads.select("sample", "mate", "read_no", "read_id").join(broadcast_if_small(lone), ["sample", "read_no", "mate"], "left_semi")
    sinks.write_report_tsv(ids.select("sample", "mate", "read_no", "read_id"), f"{out}/reports/lone_mates", order=["sample", "read_no"])
    report = re.qc_before_and_after(reads, cleaned)
    sinks.write_report_tsv(report, f"{out}/reports/read_quality", order=["sample", "mate", "stage"])
    return report
