"""The corpus pipeline: documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.llm import leaks, near, packing, quality, secrets
from contigloom.llm.queries import table, tokenizer_path
from contigloom.session import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have no words and go; a null language or source is a group of its own. Repeated rows are judged alike. An
    empty table stays empty. Other columns, whatever their names, are kept.
    """
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id.

    A null doc_id counts as the greatest; of rows with one doc_id and one text a single one stays. Texts without words are alike to
    none but equal texts. An empty table stays empty. Other columns are kept.
    """
    return near.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go.

    Null and empty texts hold none and stay. Rows with one doc_id (null too) go together. An empty table stays empty, and an empty benchmark
    takes nothing. Other columns are kept.
    """
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text where it changed.

    Null texts stay null. Repeated rows change alike. An empty table stays empty. Other columns, whatever their names, are kept.
    """
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row_"), "text")  # each text once
    clean = secrets.with_redaction(held, secrets.train(secrets.findings(held.select("text"))))
    changed = F.col("redacted_").isNotNull()
    own = {c: F.coalesce("redacted_", "text") if c == "text" else F.col("row_").getField(c) for c in docs.columns}
    if "n_chars" in own:
        own["n_chars"] = F.when(changed, F.length("redacted_").cast("long")).otherwise(own["n_chars"])
    return clean.select(*[column.alias(c) for c, column in own.items()])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in the training sequences.

    A null or empty text is a document of the closing id alone. Repeated rows are packed each. An empty table gives an empty result. Other
    columns than doc_id and text are left out.
    """
    pieces = packing.tokenise(docs.select("doc_id", "text"), tokenizer_path())
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [("quality", quality_stage), ("near duplicates", near_duplicate_stage), ("benchmark", benchmark_stage),
          ("secrets", secret_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The quality estimates, the secrets' model and the packing are not for SQL.
ORACLE_SQL = None
