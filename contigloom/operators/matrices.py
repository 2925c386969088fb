"""Resistance matrices: sample rows, drug-class columns that differ from file to file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_stage_reports(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of both tables; a column one of them lacks is NULL there."""
    return before.unionByName(after, allowMissingColumns=True)


def merge_amr_cells(amr_long: DataFrame) -> DataFrame:
    """``sample, drug_class, value``: cells of all files merged.

    Within the first file (``file_ord`` 0) the last row of a sample wins, empty cells included. Later
    files append their non-empty cells with ``;`` in file and row order, without deduplication. A
    cell without a value is NULL.
    """
    value = F.coalesce("value", F.lit(""))
    first = F.col("file_ord") == 0
    # One value of the first file per cell, and all of the later ones.
    last_of_first = F.max(F.when(first, F.struct("row_no", value.alias("value"))))
    later = F.collect_list(F.when(~first & (value != ""), F.struct("file_ord", "row_no", value.alias("value"))))
    cells = amr_long.groupBy("sample", "drug_class").agg(last_of_first.alias("_first"), later.alias("_later"))
    start = F.filter(F.array(F.col("_first.value")), lambda v: v != "")
    rest = F.transform(F.array_sort("_later"), lambda s: s["value"])
    parts = F.concat(F.coalesce(start, F.array().cast("array<string>")), rest)
    return cells.select("sample", "drug_class",
                        F.nullif(F.array_join(parts, ";"), F.lit("")).alias("value"))


def matrix_columns(amr_long: DataFrame) -> list[str]:
    """Column names in order: those of the first file, then new ones. Bounded by the file headers."""
    rows = (amr_long.filter("drug_class is not null").groupBy("drug_class").agg(F.min(F.struct("file_ord", "col_no")).alias("at"))
            .orderBy("at").collect())
    return [r["drug_class"] for r in rows]


def merge_amr_matrices(amr_long: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Wide merged matrix, one row per sample of any file; samples and columns without a value stay."""
    columns = matrix_columns(amr_long) if columns is None else columns
    cells = merge_amr_cells(amr_long)
    if not columns:
        return cells.select("sample").distinct()
    # A conditional maximum per column: one shuffle on the sample, where a pivot takes two.
    wide = [F.max(F.when(F.col("drug_class") == c, F.col("value"))).alias(c) for c in columns]
    return cells.groupBy("sample").agg(*wide)
