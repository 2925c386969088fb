"""Cohort report tables: build, search, select, page."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE_ROWS = 25


def cohort_report(*reports: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row per sample and stage with the columns of every report.

    Each report has ``sample, stage`` once per pair; a repeated pair raises. Columns that two reports share get their report's
    name in front, from ``names``; without names they raise. Stacking and grouping takes one shuffle where
    chained outer joins take one per report; a report without the pair leaves its columns NULL.
    """
    count = Counter(c for r in reports for c in r.columns if c not in ("sample", "stage"))
    shared = sorted(c for c, n in count.items() if n > 1)
    if shared and not names:
        raise ValueError(f"columns in more than one report, so the reports need names: {shared}")
    tagged = [r.withColumnsRenamed({c: f"{names[i]}_{c}" for c in shared if c in r.columns} if shared else {}).withColumn("_report", F.lit(i))
              for i, r in enumerate(reports)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    values = [c for c in stacked.columns if c not in ("sample", "stage", "_report")]
    grouped = stacked.groupBy("sample", "stage").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in values],
        *[F.count_if(F.col("_report") == i).alias(f"_n{i}") for i in range(len(reports))])
    twice = F.greatest(*[F.col(f"_n{i}") for i in range(len(reports))], F.lit(0)) > 1
    message = F.concat(F.lit("a report has more than one row of "), F.coalesce("sample", F.lit("NULL")), F.lit(", "), F.coalesce("stage", F.lit("NULL")))
    checked = grouped.filter(F.when(twice, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.select("sample", "stage", *values)


def report_search(table: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Rows whose column holds all words of the text, in any order and case; columns combine with and."""
    for column, text in texts.items():
        for word in text.lower().split():
            table = table.filter(F.contains(F.lower(F.col(column).cast("string")), F.lit(word)))
    return table


def report_select(table: DataFrame, chosen: dict[str, list]) -> DataFrame:
    """Rows whose column equals one of the chosen values; no values means all rows."""
    for column, values in chosen.items():
        if values:
            table = table.filter(F.col(column).isin(list(values)))
    return table


def facet_values(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, value``: distinct non-empty values of each column, sorted."""
    columns = columns or table.columns
    text = table.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], columns, "column", "value")
    return long.filter("value is not null and value <> ''").distinct().orderBy("column", "value")


def sort_report(table: DataFrame, *keys: str) -> DataFrame:
    """Rows in byte order of the keys."""
    return table.orderBy(*keys)


def limit_report(table: DataFrame, keys: list[str], rows: int = PAGE_ROWS, page: int = 0) -> DataFrame:
    """One page of the sorted table. ``keys`` should tell all rows apart.

    For a first look: page n sorts out all pages before it. To page through a table, :func:`store_pages` once.
    """
    return table.orderBy(*keys).limit(rows * (page + 1)).offset(rows * page)


def store_pages(table: DataFrame, keys: list[str], out: str) -> None:
    """Keep the sorted table under ``out`` (Parquet), with how many rows each of its files has, for :func:`read_page`."""
    table.orderBy(*keys).write.mode("overwrite").parquet(f"{out}/rows")
    stored = table.sparkSession.read.parquet(f"{out}/rows")
    held = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"))  # names grow with the order
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    held.select("file", "n", F.coalesce(before, F.lit(0)).alias("first")).write.mode("overwrite").parquet(f"{out}/files")


def read_page(spark: SparkSession, out: str, rows: int = PAGE_ROWS, page: int = 0) -> DataFrame:
    """One page of a table that :func:`store_pages` keeps, in order. Reads the files that hold it, and of these its rows' groups."""
    begin, end = rows * page, rows * (page + 1)
    held = spark.read.parquet(f"{out}/files").filter((F.col("first") < end) & (F.col("first") + F.col("n") > begin)).collect()  # rows / a file's rows + 2
    if not held:
        return spark.read.parquet(f"{out}/rows").limit(0)
    parts = [f"{out}/rows/{r['file']}" for r in held]
    first = F.create_map(*[F.lit(x) for r in held for x in (r["file"], r["first"])])
    place = (F.try_element_at(first, F.col("_metadata.file_name")) + F.col("_metadata.row_index")).alias("_place")
    page_ = spark.read.schema(spark.read.parquet(f"{out}/rows").schema).parquet(*parts).select("*", place)
    return page_.filter(F.col("_place").between(begin, end - 1)).orderBy("_place").drop("_place")
