"""Gene-hit tables: clean, filter, and merge hits over databases and stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.functions import names
from contigloom.schemas import SENTINEL_SAMPLES


def union_hits(*tables: DataFrame) -> DataFrame:
    """All hits of all tables, duplicates included."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def project_hit_columns(hits: DataFrame) -> DataFrame:
    """Sample, gene, database and resistance; empty cells become ``NA``."""
    return hits.select(
        names.na_fill(names.sample_from_hit_file("file")).alias("sample"),
        names.na_fill("gene").alias("gene"),
        names.na_fill("database").alias("database"),
        names.na_fill("resistance").alias("resistance"))


def drop_sentinel_samples(hits: DataFrame) -> DataFrame:
    """Drop rows whose sample is really a folder or stage name; nothing else is dropped."""
    return hits.filter(~F.col("sample").isin(SENTINEL_SAMPLES))


def filter_hits(hits: DataFrame, min_id: float = 80, min_cov: float = 80) -> DataFrame:
    return hits.filter((F.col("pct_identity") >= min_id) & (F.col("pct_coverage") >= min_cov))


def combine_gene_hits(hits: DataFrame) -> DataFrame:
    """Sorted distinct genes and resistances per sample and database.

    Rows are made distinct first, on all four columns: that spreads a hot sample over all tasks
    and leaves the second step no more than the genes a database has.
    """
    rows = drop_sentinel_samples(project_hit_columns(hits)).distinct()

    def joined(c: str, name: str):
        return F.array_join(F.array_sort(F.collect_set(c)), "; ").alias(name)

    merged = rows.groupBy("sample", "database").agg(joined("gene", "Genes"), joined("resistance", "Resistance"))
    return merged.select(F.col("sample").alias("Sample"), F.col("database").alias("Database"),
                         "Genes", "Resistance")


def hit_summary(hits: DataFrame, min_id: float | None = None) -> DataFrame:
    """Long presence table: per database, file and gene the coverages, largest first, ``;``-joined.

    ``n_genes`` is the number of genes found in the file. :func:`presence_matrix` makes it wide.
    """
    rows = hits if min_id is None else hits.filter(F.col("pct_identity") >= min_id)
    counted = rows.groupBy("database", "file", "gene", "pct_coverage").agg(F.count("*").alias("n"))
    cells = counted.groupBy("database", "file", "gene").agg(
        F.sort_array(F.collect_list(F.struct("pct_coverage", "n")), asc=False).alias("found"))
    text = F.array_join(F.flatten(F.transform(
        "found", lambda x: F.array_repeat(x["pct_coverage"].cast("string"), x["n"].cast("int")))), ";")
    per_file = Window.partitionBy("database", "file")
    return cells.select("database", "file", "gene", text.alias("coverages"),
                        F.count("*").over(per_file).alias("n_genes"))


def presence_matrix(summary: DataFrame, genes: list[str]) -> DataFrame:
    """Wide form of :func:`hit_summary` for the given genes; an absent gene shows ``.``."""
    wide = (summary.groupBy("database", "file", "n_genes").pivot("gene", genes)
            .agg(F.first("coverages")))
    return wide.fillna(".", subset=genes)
