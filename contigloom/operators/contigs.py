"""Contig tables: measure, filter, remove, and describe assemblies.

A contig row has at least ``sample, header, seq``; ``path``, ``stage``, ``rec_no``, ``coverage`` and
``length`` are used where an operator names them. Sequences are measured where they are read and
take no part in a shuffle unless the result itself needs them moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contigloom.functions import bases, names
from contigloom.session import BROADCAST_ROWS, broadcast_if_small, fits_broadcast, settle

# Length thresholds of the usual assembly report.
LENGTH_THRESHOLDS = (1000, 5000, 10000, 25000, 50000)


def with_measures(contigs: DataFrame) -> DataFrame:
    """Add ``coverage`` and ``length`` unless the table already stores them."""
    new = {}
    if "coverage" not in contigs.columns:
        new["coverage"] = names.coverage_from_header("header")
    if "length" not in contigs.columns:
        new["length"] = names.contig_length("seq")
    return contigs.withColumns(new) if new else contigs


def filter_min_coverage(contigs: DataFrame, min_cov: float = 10) -> DataFrame:
    """Contigs with a known coverage of at least ``min_cov``."""
    return with_measures(contigs).filter(F.col("coverage") >= min_cov)


def filter_min_length(contigs: DataFrame, min_len: int = 500) -> DataFrame:
    return with_measures(contigs).filter(F.col("length") >= min_len)


def passes(min_cov: float, min_len: int) -> Column:
    return (F.col("coverage") >= min_cov) & (F.col("length") >= min_len)


def samples_without_survivor(contigs: DataFrame, min_cov: float = 10, min_len: int = 500) -> DataFrame:
    """Samples of which no contig passes both thresholds."""
    kept = F.coalesce(passes(min_cov, min_len), F.lit(False))
    return (with_measures(contigs)
            .groupBy("sample").agg(F.max(kept).alias("any_kept"))
            .filter(~F.col("any_kept")).select("sample"))


def filter_contigs(contigs: DataFrame, min_cov: float = 10, min_len: int = 500,
                   broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Contigs that pass both thresholds; a sample left with none keeps all of its contigs.

    ``used_fallback`` tells the two apart. The samples that fall back are found first, from
    coverage and length alone. Usually there are none or few, and the contigs then need no
    shuffle. Beyond ``broadcast_rows`` such samples only the contigs that failed are shuffled.
    """
    measured = with_measures(contigs)
    fallback = settle(samples_without_survivor(measured, min_cov, min_len))
    small, count = fits_broadcast(fallback, broadcast_rows)
    kept = measured.filter(passes(min_cov, min_len)).withColumn("used_fallback", F.lit(False))
    if count == 0:
        return kept
    if small:
        marked = fallback.withColumn("used_fallback", F.lit(True))
        joined = measured.join(F.broadcast(marked), "sample", "left")
        return (joined.withColumn("used_fallback", F.coalesce("used_fallback", F.lit(False)))
                .filter(passes(min_cov, min_len) | F.col("used_fallback"))
                .select(kept.columns))
    failed = measured.filter(~F.coalesce(passes(min_cov, min_len), F.lit(False)))
    restored = failed.join(fallback, "sample", "left_semi").withColumn("used_fallback", F.lit(True))
    return kept.unionByName(restored)


def remove_contigs(contigs: DataFrame, removals: DataFrame,
                   broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Contigs of the listed files, without the listed contigs.

    ``removals`` has ``path, contig_id``; a NULL id lists the file and removes nothing. Files that are
    not listed give no rows.
    """
    listed = removals.select("path").filter("path is not null").distinct()
    dropped = removals.select("path", "contig_id").filter("contig_id is not null").distinct()
    ids = contigs if "contig_id" in contigs.columns else (
        contigs.withColumn("contig_id", names.contig_id("header")))
    return (ids.join(broadcast_if_small(listed, broadcast_rows), "path", "left_semi")
            .join(broadcast_if_small(dropped, broadcast_rows), ["path", "contig_id"], "left_anti")
            .select(contigs.columns))


def listed_files_missing(removals: DataFrame, files: DataFrame) -> DataFrame:
    """Listed paths that are not among ``files(path)``; the caller warns about them."""
    return removals.select("path").distinct().join(files.select("path"), "path", "left_anti")


def removed_path(path) -> Column:
    """Output name of a cleaned file: ``_removed`` before the last extension."""
    return F.regexp_replace(path, "[.]([^./]*)$", "_removed.$1")


def length_counts(contigs: DataFrame, keys: list[str]) -> DataFrame:
    """Contigs per key and length, with their G/C and N letters: all that assembly statistics need.

    Counting by length first spreads a large sample over every task. A sample with D different
    lengths has at least D * (D + 1) / 2 bases, so even 100 TB of one sample leave at most 15
    million rows of four numbers for the running sum.
    """
    measured = contigs.select(
        *keys, names.contig_length("seq").cast("long").alias("length"),
        bases.count_letters("seq", "GC").cast("long").alias("gc"),
        bases.count_letters("seq", "N").cast("long").alias("unknown"))
    return measured.groupBy(*keys, "length").agg(
        F.count("*").alias("n"), F.sum("gc").alias("gc"), F.sum("unknown").alias("unknown"))


def running_length(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Running bases and contigs from the longest length down, and the totals, per key."""
    whole = Window.partitionBy(*keys)
    down = whole.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("length") * F.col("n")
    return counts.select(
        "*", F.sum(size).over(down).alias("cum_bases"), F.sum("n").over(down).alias("cum_contigs"),
        F.sum(size).over(whole).alias("total_bases"))


def length_cumsum(contigs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["sample", "stage"]
    return running_length(length_counts(contigs, keys), keys).drop("gc", "unknown")


def stats_of_counts(counts: DataFrame, keys: list[str], ref_len: int | None = None) -> DataFrame:
    """Assembly statistics from :func:`length_counts`.

    N50 is the largest length such that contigs of it and longer hold half of all bases, L50 the
    number of contigs needed for that; N90/L90 likewise. NG50 takes half of ``ref_len`` instead.
    """
    rows = running_length(counts, keys)

    def nx(percent: int, total: str) -> str:
        return f"max(case when cum_bases * 100 >= {total} * {percent} then length end)"

    def lx(percent: int, total: str) -> str:
        # Contigs of one length share a row: those past the mark do not count.
        spare = f"least((cum_bases * 100 - {total} * {percent}) div nullif(length * 100, 0), n - 1)"
        return f"min(case when cum_bases * 100 >= {total} * {percent} then cum_contigs - {spare} end)"

    total = "total_bases"
    columns = [
        "sum(n) as n_contigs", "max(total_bases) as total_length", "max(length) as largest",
        f"{nx(50, total)} as n50", f"{lx(50, total)} as l50", f"{nx(90, total)} as n90", f"{lx(90, total)} as l90",
        "sum(gc) as gc_bases", "sum(unknown) as n_bases",
    ]
    columns += [f"coalesce(sum(case when length >= {t} then n end), 0L) as contigs_ge_{t}" for t in LENGTH_THRESHOLDS]
    if ref_len is not None:
        columns.append(f"{nx(50, str(int(ref_len)))} as ng50")
    return (rows.groupBy(*keys).agg(*[F.expr(c) for c in columns])
            .withColumn("gc_pct", bases.rate(F.col("gc_bases") * 100, "total_length", 2))
            .withColumn("n_per_100kbp", bases.rate(F.col("n_bases") * 100000, "total_length", 2)))


def assembly_stats(contigs: DataFrame, ref_len: int | None = None,
                   keys: list[str] | None = None) -> DataFrame:
    """Length and composition statistics over all contigs of each sample and stage."""
    keys = keys or ["sample", "stage"]
    return stats_of_counts(length_counts(contigs, keys), keys, ref_len)


def compare_before_after(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """One row per sample: each metric before, after, and after minus before.

    ``metrics`` has one row per sample and stage. One shuffle, on sample.
    """
    sides = [F.expr(f"max(case when stage = '{stage}' then `{c}` end) as `{c}_{stage}`")
             for c in columns for stage in ("before", "after")]
    wide = metrics.groupBy("sample").agg(*sides)
    return wide.selectExpr("*", *[f"`{c}_after` - `{c}_before` as `{c}_delta`" for c in columns])
