"""Tab-separated tables written by the tools of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.schemas import GENE_HITS, PENDING, STEPS
from contigloom.sources.files import is_missing
from contigloom.sources.text import record_order, source_path

TSV = {"sep": "\t", "quote": "", "escape": "\x00"}

# Where each tool leaves its table under the output folder, and its columns.
TOOL_REPORTS = {
    "quast": {
        "globs": ["raw/quast_before/*/report.tsv", "raw/quast_after/*/report.tsv"],
        "sample": "/quast_(?:before|after)/([^/]+)/", "stage": "/quast_(before|after)/",
        "header": False, "schema": "metric string, value string"},
    "checkm2": {
        "globs": ["raw/checkm2_before/*/quality_report.tsv", "raw/checkm2_after/*/quality_report.tsv"],
        "sample": "/checkm2_(?:before|after)/([^/]+)/", "stage": "/checkm2_(before|after)/",
        "header": True,
        "schema": "name string, completeness double, contamination double, completeness_model_used string, translation_table_used int, "
                  "coding_density double, contig_n50 bigint, average_gene_length double, genome_size bigint, gc_content double, "
                  "total_coding_sequences bigint, total_contigs bigint, max_contig_length bigint, additional_notes string"},
    "kraken2": {
        "globs": ["raw/kraken2/*.report"],
        "sample": "/kraken2/([^/]+?)(?:_filtered)?[.]report$", "stage": "(_filtered)[.]report$",
        "header": False,
        "schema": "pct double, clade bigint, direct bigint, rank string, taxid int, name string"},
    "kraken2_contigs": {
        "globs": ["raw/kraken2/*.output"],
        "sample": "/kraken2/([^/]+?)(?:_filtered)?[.]output$", "stage": "(_filtered)[.]output$",
        "header": False,
        "schema": "verdict string, contig_id string, taxon string, length string, kmers string"},
    "gtdbtk": {
        "globs": ["raw/gtdbtk/before/classify/*.summary.tsv", "raw/gtdbtk/after/classify/*.summary.tsv"],
        "sample": None, "stage": "/gtdbtk/(before|after)/",
        "header": True,
        "schema": "user_genome string, classification string, closest_genome_reference string, closest_genome_reference_radius double, "
                  "closest_genome_taxonomy string, closest_genome_ani double, closest_genome_af double, closest_placement_reference string, "
                  "closest_placement_radius double, closest_placement_taxonomy string, closest_placement_ani double, closest_placement_af double, "
                  "pplacer_taxonomy string, classification_method string, note string, other_related_references string, msa_percent double, "
                  "translation_table int, red_value double, warnings string"},
}


def read_gene_hits(spark: SparkSession, path: str, pattern: str = "*.tsv") -> DataFrame:
    """Hit tables of a folder, the per-database summaries left out. Columns go by position."""
    return (spark.read.schema(GENE_HITS).options(**TSV, header=True, pathGlobFilter=pattern,
                                                 recursiveFileLookup=True).csv(path)
            .filter(~F.col("_metadata.file_name").endswith(".summary.tsv")))


def read_amr_matrix(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """``stage, file_ord, sample, row_no, col_no, drug_class, value`` of wide matrices.

    ``files`` are (stage, path) in merge order; absent and empty ones are passed over. The first column
    is the sample, whatever it is called.
    """
    parts = []
    for stage, path in files:
        try:
            wide = spark.read.options(**TSV, header=True).csv(path)
        except AnalysisException as error:
            if is_missing(error):
                continue
            raise
        if not wide.columns:
            continue
        key, *classes = wide.columns
        header = spark.read.text(path).head()[0].rstrip("\r").split("\t")
        # Spark renames repeated names; of these the last column counts
        last = dict(zip(header[1:] if len(header) == len(wide.columns) else classes, enumerate(classes, 1)))
        cells = [F.struct(F.lit(i).alias("col_no"), F.lit(name).alias("drug_class"), F.coalesce(F.col(f"`{c}`"), F.lit("")).alias("value"))
                 for name, (i, c) in last.items()]
        # a sample without any class is a row without one
        none = F.struct(F.lit(None).cast("int").alias("col_no"), F.lit(None).cast("string").alias("drug_class"), F.lit(None).cast("string").alias("value"))
        parts.append(wide.select(
            F.lit(stage).alias("stage"), F.lit(len(parts)).alias("file_ord"), F.col(f"`{key}`").alias("sample"),
            record_order().alias("row_no"), F.explode(F.array(*cells or [none])).alias("cell"))
            .select("stage", "file_ord", "sample", "row_no", "cell.*"))
    if not parts:
        return spark.createDataFrame([], "stage string, file_ord int, sample string, row_no bigint, "
                                         "col_no int, drug_class string, value string")
    return reduce(DataFrame.unionByName, parts)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Wide status table as ``sample, step, status``.

    Steps are found by the names in the header, the sample is the first column. A step without a column, and an empty cell, is pending;
    other columns are passed over.
    """
    wide = spark.read.options(**TSV, header=True).csv(path)
    sample, *columns = wide.columns
    cells = [F.coalesce(F.col(f"`{s}`"), F.lit(PENDING)).alias(s) if s in columns else F.lit(PENDING).alias(s) for s in STEPS]
    return wide.select(F.col(f"`{sample}`").alias("sample"), *cells).unpivot("sample", STEPS, "step", "status")


def read_tool_report(spark: SparkSession, root: str, tool: str) -> DataFrame:
    """``sample, stage`` and the columns of one tool's reports, of all samples and both stages.

    Where a report has a header, columns are found by name in any case; absent ones are NULL, unknown ones follow as strings.
    """
    spec = TOOL_REPORTS[tool]
    tables = []
    for glob in spec["globs"]:
        try:
            tables.append(_report(spark, f"{root.rstrip('/')}/{glob}", spec))
        except AnalysisException as error:
            if not is_missing(error):
                raise
    if not tables:
        return spark.createDataFrame([], f"sample string, stage string, {spec['schema']}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _report(spark: SparkSession, path: str, spec: dict) -> DataFrame:
    reader = spark.read.options(**TSV, header=spec["header"], ignoreTrailingWhiteSpace=True)
    fields = [tuple(part.split()) for part in spec["schema"].split(", ")]
    if spec["header"]:
        table = reader.csv(path)
        found = {c.lower(): c for c in table.columns}
        known = [(F.expr(f"try_cast(nullif(`{found[n]}`, 'N/A') as {kind})") if n in found else F.lit(None).cast(kind)).alias(n) for n, kind in fields]
        extra = [F.col(f"`{c}`").alias(n) for n, c in found.items() if n not in dict(fields)]
        columns = known + extra
    else:
        table = reader.schema(spec["schema"]).csv(path)
        columns = [F.col(n) for n, _ in fields]
    file = source_path()
    label = F.regexp_extract(file, spec["stage"], 1)
    stage = F.when(label.isin("after", "_filtered"), "after").otherwise("before")
    table = table.select(*columns, file.alias("_file"), stage.alias("stage"))
    if spec["sample"] is None:
        sample = F.regexp_replace(F.col("user_genome"), "_filtered$", "")
    else:
        sample = F.regexp_extract("_file", spec["sample"], 1)
    return table.select(sample.alias("sample"), "stage", *[c for c in table.columns if c not in ("_file", "stage")])
