"""Filter genomes as their files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.operators.contigs import filter_contigs, with_measures
from contigloom.operators.pairs import pick_contig_file
from contigloom.session import broadcast_if_small
from contigloom.sources.text import ROW_IN_PARTITION, fasta_records, is_fasta_name, source_path, without_preamble


def incremental_filter(spark: SparkSession, source: str, out: str, checkpoint: str,
                       min_cov: float = 10, min_len: int = 500, check_start: bool = True) -> None:
    """Filter the FASTA files that are new since the last call into ``out/batch=N`` (Parquet).

    The checkpoint remembers which files were done. The fallback is decided per file, and a file is never divided between
    micro-batches; a folder that Spark wrote (``file=NAME``) counts as one file and has to arrive whole. Other extensions are passed
    over. A repeated batch replaces its folder. :func:`read_arrived` takes one file per sample.
    """
    lines = (spark.readStream.option("lineSep", "\n>").text(source)
             .select("value", source_path().alias("path"),
                     F.col("_metadata.file_block_start").alias("block")).filter(is_fasta_name()))

    def process(batch: DataFrame, number: int) -> None:
        row = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_PARTITION))
        pieces = batch.select("path", (F.col("block") + row).alias("rec_no"), F.col("value").alias("piece"), "block")
        contigs = with_measures(fasta_records(without_preamble(pieces, check_start))).withColumnsRenamed({"sample": "name"})
        by_file = contigs.withColumn("sample", F.regexp_replace("path", "/(file=[^/]+)/[^/]+$", "/$1"))
        kept = filter_contigs(by_file, min_cov, min_len).withColumnsRenamed({"sample": "file", "name": "sample"})
        kept.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (lines.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def read_arrived(spark: SparkSession, out: str) -> DataFrame:
    """All filtered contigs so far, of one file per sample: the first extension in sorted order, then the greatest path."""
    contigs = spark.read.parquet(out)
    picked = pick_contig_file(contigs.select("sample", F.col("file").alias("path")).distinct()).select(F.col("path").alias("file"))
    return contigs.join(broadcast_if_small(picked), "file", "left_semi")
