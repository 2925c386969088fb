"""What filtering does to each genome, in one pass over the contigs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.functions import bases
from contigloom.operators import contigs as ops

COMPARED = ["n_contigs", "total_length", "largest", "n50", "l50", "n90", "l90", "gc_bases", "n_bases"]


def stats_before_and_after(contigs: DataFrame, min_cov: float = 10, min_len: int = 500) -> DataFrame:
    """Assembly statistics of each sample unfiltered and filtered.

    Equal to ``assembly_stats`` of the contigs and of ``filter_contigs``, but each sequence is read and
    measured once. Contigs are counted per sample, verdict and length; both stages, and the rule that
    a sample without survivors stays whole, follow from those counts.
    """
    measured = ops.with_measures(contigs).select(
        "sample",
        F.coalesce(ops.passes(min_cov, min_len), F.lit(False)).alias("kept"),
        F.col("length").cast("long").alias("length"),
        bases.count_letters("seq", "GC").cast("long").alias("gc"),
        bases.count_letters("seq", "N").cast("long").alias("unknown"))
    counts = measured.groupBy("sample", "kept", "length").agg(
        F.count("*").alias("n"), F.sum("gc").alias("gc"), F.sum("unknown").alias("unknown"))
    any_kept = F.max("kept").over(Window.partitionBy("sample"))
    stages = F.when(F.col("kept") | ~F.col("any_kept"), F.array(F.lit("before"), F.lit("after")))
    staged = (counts.withColumn("any_kept", any_kept)
              .withColumn("stage", F.explode(stages.otherwise(F.array(F.lit("before"))))))
    keys = ["sample", "stage"]
    merged = staged.groupBy(*keys, "length").agg(
        F.sum("n").alias("n"), F.sum("gc").alias("gc"), F.sum("unknown").alias("unknown"))
    return ops.stats_of_counts(merged, keys)


def filter_effect(contigs: DataFrame, min_cov: float = 10, min_len: int = 500) -> DataFrame:
    """Side-by-side statistics per sample, with deltas."""
    return ops.compare_before_after(stats_before_and_after(contigs, min_cov, min_len), COMPARED)
