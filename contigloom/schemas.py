"""Table shapes and the fixed names every module shares."""

from pyspark.sql import types as T

READS = T.StructType([
    T.StructField("sample", T.StringType()),
    T.StructField("mate", T.IntegerType()),
    T.StructField("read_no", T.LongType()),
    T.StructField("read_id", T.StringType()),
    T.StructField("seq", T.StringType()),
    T.StructField("qual", T.StringType()),
])

GENE_HITS = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("sequence", T.StringType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("strand", T.StringType()),
    T.StructField("gene", T.StringType()),
    T.StructField("coverage", T.StringType()),
    T.StructField("coverage_map", T.StringType()),
    T.StructField("gaps", T.StringType()),
    T.StructField("pct_coverage", T.DoubleType()),
    T.StructField("pct_identity", T.DoubleType()),
    T.StructField("database", T.StringType()),
    T.StructField("accession", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("resistance", T.StringType()),
])

# The sixteen steps, in the order of the status table's columns.
STEPS = [
    "FASTP", "SPADES", "QUAST-b", "CHECKM2-b", "FILTER", "QUAST-a", "CHECKM2-a",
    "KRAKEN2-b", "KRAKEN2-a", "GTDBTK-b", "GTDBTK-a", "ABRITAMR-b", "ABRITAMR-a",
    "ABRICATE-b", "ABRICATE-a", "MULTIQC",
]

# Which steps the four counted stages are made of.
STAGES = {
    1: ["FASTP", "SPADES"],
    2: ["QUAST-b", "CHECKM2-b", "FILTER"],
    3: ["QUAST-a", "CHECKM2-a"],
    4: ["KRAKEN2-b", "KRAKEN2-a"],
}

# Steps of tools that only run when the user turns them on.
OPTIONAL_TOOLS = {
    "ABRITAMR": ["ABRITAMR-b", "ABRITAMR-a"],
    "ABRICATE": ["ABRICATE-b", "ABRICATE-a"],
    "KRAKEN2": ["KRAKEN2-b", "KRAKEN2-a"],
    "GTDBTK": ["GTDBTK-b", "GTDBTK-a"],
}

# Status cells.
PENDING, RUNNING, OK, FAIL, SKIPPED = "-", "RUNNING", "OK", "FAIL", "SKIPPED"

# FASTA extensions, in the order in which one file per sample is picked.
FASTA_EXTENSIONS = ["fa", "fas", "fasta", "ffn", "fna"]

# Extensions stripped from the file column of a gene-hit table.
HIT_FILE_EXTENSIONS = ["fasta", "fa", "fna", "ffn", "faa", "fas"]

# Names that are a folder or stage rather than a sample.
SENTINEL_SAMPLES = ["abricate", "before", "filtered"]
