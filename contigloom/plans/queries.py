"""One query per operator, over the driver's tables seen through the views of this domain.

Sources and sinks are exercised on files that Spark first writes from those tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contigloom.functions import names
from contigloom.operators import contigs as co
from contigloom.operators import hits as hi
from contigloom.operators import matrices as ma
from contigloom.operators import pairs as pa
from contigloom.operators import reads as re
from contigloom.operators import reports as rp
from contigloom.operators import status as st
from contigloom.operators import taxonomy as tx
from contigloom.plans import filter_effect as fe
from contigloom.plans.views import SPARK_VIEWS, table, views
from contigloom.schemas import GENE_HITS
from contigloom.session import scratch_dir, settle
from contigloom.sinks import files as sinks
from contigloom.sources import fastq, files as listing, tables, text
from contigloom.streaming import arrivals, progress

K = 11  # k-mer size of the screening queries: texts spelled as bases share few longer ones

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def md5(c: str):
    return F.md5(F.col(c).cast("binary"))


# ---- sources -------------------------------------------------------------------------------


def _write_named(spark: SparkSession, files: DataFrame, name: str) -> str:
    root = scratch_dir(spark, name)
    sinks.write_named_files(files, root)
    return root


@query
def scan_contig_files(spark, sf):
    ext = F.element_at(F.array(*[F.lit(e) for e in (".fa", ".FASTA", ".fna", ".fas", ".ffn", ".txt")]),
                       (F.col("rec_no") % 6 + 1).cast("int"))
    folder = F.when(F.col("rec_no") % 3 == 0, "").when(F.col("rec_no") % 3 == 1, "a/").otherwise("a/b/")
    files = views(spark, sf)("contigs_v").select(
        F.concat(folder, "sample", F.lit("_"), "rec_no", ext).alias("name"),
        F.concat(F.lit(">"), "header").alias("content"))
    root = _write_named(spark, files, "contig-files")
    return listing.scan_contig_files(spark, root, depth=2).select("sample", "name", "length")


@query
def scan_read_files(spark, sf):
    files = views(spark, sf)("read_names_v").select("name", F.lit("@").alias("content"))
    root = _write_named(spark, files, "read-files")
    return listing.scan_read_files(spark, root, depth=1).select("sample", "mate", "name")


@query
def read_fasta(spark, sf):
    out = scratch_dir(spark, "fasta")
    sinks.write_fasta(views(spark, sf)("contigs_v"), out, suffix="")
    return text.read_fasta(spark, out).select("sample", "header", "contig_id", "coverage", "length",
                                              md5("seq").alias("seq_md5"))


@query
def read_fastq(spark, sf):
    out = scratch_dir(spark, "fastq")
    reads = views(spark, sf)("reads_v").withColumn("read_id", F.concat("sample", F.lit("."), "read_no"))
    for mate, compression in ((1, "gzip"), (2, "none")):
        sinks.write_fastq(reads.filter(F.col("mate") == mate), out, "append", compression)
    files = spark.read.format("binaryFile").load(out).select(
        "path", "length", F.regexp_extract("file", "^(.*)_trimmed_R[12]", 1).alias("sample"),
        F.regexp_extract("file", "_trimmed_R([12])", 1).cast("int").alias("mate"))
    return fastq.read_fastq(spark, files).select("sample", "mate", "read_id", "seq", "qual")


@query
def read_removal_list(spark, sf):
    out = scratch_dir(spark, "removals")
    v = views(spark, sf)
    lines = v("contigs_v").select(
        F.when(F.col("rec_no") % 11 == 0, F.concat(F.col("path"), F.lit("\t "), F.col("header"), F.lit(" , extra_"),
                                                   F.col("rec_no"), F.lit(" ")))
        .when(F.col("rec_no") % 11 == 1, "# comment").otherwise("").alias("value"))
    lines.write.text(out)
    return text.read_removal_list(spark, out, repeated="merge")


@query
def read_gene_hits(spark, sf):
    out = scratch_dir(spark, "hits")
    hits = views(spark, sf)("hits_v")
    wide = hits.select(*[(F.col(f.name) if f.name in hits.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in GENE_HITS])
    sinks.write_report_tsv(wide, out)
    got = tables.read_gene_hits(spark, out, "*.csv")
    return got.groupBy("file", "gene", "database").agg(
        F.count("*").alias("n"), F.sum(F.col("pct_identity").cast("long")).alias("identity"),
        F.count("resistance").alias("n_resistance"))


def _write_matrix(spark, sf, stage: str) -> str:
    out = scratch_dir(spark, f"matrix-{stage}")
    letter = {"before": "F", "after": "O"}[stage]
    rows = views(spark, sf)("amr_v").filter(F.col("stage") == letter)
    classes = [f"{letter}_A", f"{letter}_N", f"{letter}_R", "SHARED"]
    wide = [F.max(F.when(F.col("drug_class") == c, F.col("value"))).alias(c) for c in classes]
    sinks.write_report_tsv(rows.groupBy(F.col("sample").alias("Isolate")).agg(*wide), out)
    return out


@query
def read_amr_matrix(spark, sf):
    files = [(s, _write_matrix(spark, sf, s)) for s in ("before", "after")]
    files.insert(1, ("absent", files[0][1] + "-absent"))
    return tables.read_amr_matrix(spark, files).select("stage", "file_ord", "sample", "drug_class", "value")


@query
def read_status(spark, sf):
    out = scratch_dir(spark, "status")
    sinks.write_report_tsv(st.status_matrix(st.latest_status(views(spark, sf)("status_v"))), out)
    return tables.read_status(spark, out)


@query
def read_tool_reports(spark, sf):
    stats = settle(fe.stats_before_and_after(views(spark, sf)("contigs_v")).select("sample", "stage", "n_contigs", "n50"))
    suffix = F.when(F.col("stage") == "after", "_filtered").otherwise("")

    def lines(*rows: list) -> Column:
        """Tab-separated lines of columns, names of columns and other words."""
        cells = [[(F.col(c) if c in stats.columns else F.lit(c)) if isinstance(c, str) else c for c in row] for row in rows]
        return F.concat(F.concat_ws("\n", *[F.concat_ws("\t", *row) for row in cells]), F.lit("\n"))

    genome = F.concat("sample", suffix)
    files = {
        "quast": (F.concat(F.lit("raw/quast_"), "stage", F.lit("/"), "sample", F.lit("/report.tsv")),
                  lines(["Assembly", "sample"], ["# contigs", "n_contigs"], ["N50", "n50"])),
        "checkm2": (F.concat(F.lit("raw/checkm2_"), "stage", F.lit("/"), "sample", F.lit("/quality_report.tsv")),
                    lines(["Name", "Contamination", "Completeness", "Genome_Size", "Own"], [genome, F.col("n_contigs") % 10, F.col("n_contigs") % 90 + F.lit(0.5), "n50", "x"])),
        "kraken2": (F.concat(F.lit("raw/kraken2/"), genome, F.lit(".report")),
                    lines(["100.00", "n_contigs", "0", "R", "1", "root"], [" 50.00", "n50", "n_contigs", "S", "562", "  E. coli"])),
        "kraken2_contigs": (F.concat(F.lit("raw/kraken2/"), genome, F.lit(".output")), lines(["C", F.concat(F.lit("c"), "n50"), "562", "n50", "562:7"], ["U", "c2", "0", "9", "0:1"])),
        "gtdbtk": (F.concat(F.lit("raw/gtdbtk/"), "stage", F.lit("/classify/"), "sample", F.lit(".summary.tsv")),
                   lines(["classification", "user_genome", "red_value"], [F.concat(F.lit("d__B;s__"), "n50"), genome, "N/A"])),
    }
    root = _write_named(spark, reduce(DataFrame.unionByName, [stats.select(name.alias("name"), text.alias("content")) for name, text in files.values()]), "reports")
    told = {"quast": ["metric", "value"], "checkm2": ["completeness", "contamination", "genome_size", "own"], "kraken2": ["rank", "taxid", "clade", "direct"],
            "kraken2_contigs": ["verdict", "contig_id", "taxon", "length"], "gtdbtk": ["classification", "red_value"]}
    parts = [tables.read_tool_report(spark, root, tool).select(F.lit(tool).alias("tool"), "sample", "stage", F.concat_ws("|", *columns).alias("row")) for tool, columns in told.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def read_step_logs(spark, sf):
    out = scratch_dir(spark, "logs")
    kind = F.col("line_no") % 4
    name = F.when(kind == 0, F.concat("file", F.lit("_fastp.log"))).when(kind == 1, F.concat("file", F.lit("_kraken2_filtered.log"))).when(
        kind == 2, "gtdbtk.log").otherwise("multiqc.log")
    lines = views(spark, sf)("log_lines_v").select(
        name.alias("file"), F.replace("line", F.lit("\n"), F.lit("\\n")).alias("value"), "line_no")
    sinks.write_many_logs(lines, out, "line_no")
    return text.read_step_logs(spark, out).select("sample", "step", "line")


# ---- sinks ---------------------------------------------------------------------------------


def _written_lines(spark, out: str) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", True).text(out)
    file = F.regexp_extract(F.col("_metadata.file_path"), "/file=([^/]+)/", 1)
    return lines.select(file.alias("file"), md5("value").alias("line_md5"))


@query
def write_fasta(spark, sf):
    out = scratch_dir(spark, "filtered")
    sinks.write_fasta(co.filter_contigs(views(spark, sf)("contigs_v")), out)
    return _written_lines(spark, out)


@query
def write_removed_fasta(spark, sf):
    contigs = views(spark, sf)("contigs_v")
    out = scratch_dir(spark, "removed")
    sinks.write_removed_fasta(co.remove_contigs(contigs, _removals(contigs)), out)
    return _written_lines(spark, out)


@query
def write_report_tsv(spark, sf):
    out = scratch_dir(spark, "combined")
    sinks.write_report_tsv(hi.combine_gene_hits(views(spark, sf)("hits_v")), out)
    return spark.read.csv(out, sep="\t", header=True, quote="",
                          schema="Sample string, Database string, Genes string, Resistance string")


@query
def batch_manifest(spark, sf):
    files = table(spark, sf, "pages").select(F.col("url").alias("path"))
    parts = [pa.batch_manifest(files, layout).withColumn("layout", F.lit(layout))
             for layout in ("path_stem", "before_path", "stem_path")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def error_digest(spark, sf):
    v = views(spark, sf)
    number = F.col("seq_no") % 400
    path = F.when(number % 9 == 0, F.concat(F.lit("no such tool: "), number)).otherwise(F.concat(F.lit("C"), number))
    status = st.latest_status(v("status_v")).withColumn("log_path", path)
    log = F.substring("file", 2, 20).try_cast("long")
    lines = v("log_lines_v").filter(log % 7 != 0)  # these logs are empty
    own = lines.filter(log % 5 != 0).withColumns({"sample": F.lit("s"), "step": F.lit("FASTP")})
    cohort = lines.filter(log % 5 == 0).withColumn("sample", F.lit(None).cast("string")).withColumn(
        "step", F.explode(F.array(F.lit("ABRICATE-b"), F.lit("ABRICATE-a"))))  # read once for each of its steps
    files = v("log_lines_v").select(F.col("file").alias("path")).distinct()
    return st.error_digest(status, own.unionByName(cohort), files=files)


# ---- projections ---------------------------------------------------------------------------


@query
def parse_mate_name(spark, sf):
    return pa.parse_mate_name(views(spark, sf)("read_names_v")).select("name", "sample", "mate")


@query
def sample_from_path(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", names.sample_from_path(url).alias("sample"),
        names.sample_from_hit_file(F.concat(url, F.lit(".faa"))).alias("hit_sample"))


@query
def contig_id(spark, sf):
    header = F.concat("header", F.when(F.col("rec_no") % 2 == 0, " a b").otherwise("\tc"))
    return views(spark, sf)("contigs_v").select("rec_no", names.contig_id(header).alias("contig_id"))


@query
def coverage_from_header(spark, sf):
    return views(spark, sf)("contigs_v").select("header", names.coverage_from_header("header").alias("coverage"))


@query
def contig_length(spark, sf):
    return views(spark, sf)("contigs_v").select("rec_no", names.contig_length("seq").alias("length"))


@query
def na_fill(spark, sf):
    return (views(spark, sf)("hits_v").groupBy(names.na_fill("resistance").alias("resistance"))
            .agg(F.count("*").alias("n")))


@query
def stage_tag(spark, sf):
    name = names.sample_from_hit_file("file")
    return (views(spark, sf)("hits_v")
            .select(names.without_stage_tag(name).alias("sample"),
                    F.coalesce(names.stage_tag(name), F.lit("before")).alias("stage"))
            .groupBy("sample", "stage").agg(F.count("*").alias("n")))


@query
def project_hit_columns(spark, sf):
    return hi.project_hit_columns(views(spark, sf)("hits_v"))


@query
def format_duration(spark, sf):
    spans = st.step_durations(views(spark, sf)("status_v"))
    return spans.select("sample", "seconds", names.format_duration("seconds").alias("duration"))


# ---- filters -------------------------------------------------------------------------------


@query
def filter_min_coverage(spark, sf):
    return co.filter_min_coverage(views(spark, sf)("contigs_v"), 10).select("sample", "header", "coverage")


@query
def filter_min_length(spark, sf):
    return co.filter_min_length(views(spark, sf)("contigs_v"), 500).select("sample", "header", "length")


@query
def filter_contigs(spark, sf):
    return (co.filter_contigs(views(spark, sf)("contigs_v"), 10, 500)
            .select("sample", "rec_no", "header", md5("seq").alias("seq_md5"), "used_fallback"))


@query
def drop_sentinel_samples(spark, sf):
    rows = hi.drop_sentinel_samples(hi.project_hit_columns(views(spark, sf)("hits_v")))
    return rows.groupBy("sample").agg(F.count("*").alias("n"))


@query
def drop_comments(spark, sf):
    kind = F.col("line_no") % 4
    line = F.when(kind == 0, F.concat(F.lit("#"), "line")).when(kind == 1, F.concat(F.lit(" #"), "line")).when(kind == 2, "  ").otherwise(F.col("line"))
    return text.drop_comments(views(spark, sf)("log_lines_v").withColumn("line", line))


@query
def select_steps(spark, sf):
    v = views(spark, sf)
    return st.select_steps(v("status_v").select("step").distinct(), v("skips_v"))


@query
def filter_hits(spark, sf):
    return hi.filter_hits(views(spark, sf)("hits_v"), 80, 80)


@query
def report_search(spark, sf):
    combined = hi.combine_gene_hits(views(spark, sf)("hits_v"))
    return rp.report_search(combined, {"Genes": "brand#11 BRAND#3", "Database": "r"}).select("Sample", "Database")


@query
def report_select(spark, sf):
    combined = hi.combine_gene_hits(views(spark, sf)("hits_v"))
    return rp.report_select(combined, {"Database": ["db_A", "db_N"], "Sample": []}).select("Sample", "Database")


# ---- joins ---------------------------------------------------------------------------------


def _read_files(v) -> DataFrame:
    return pa.parse_mate_name(v("read_names_v")).withColumn("path", F.concat(F.lit("/in/"), "name"))


@query
def pair_mates(spark, sf):
    return pa.pair_mates(_read_files(views(spark, sf)))


@query
def missing_mates(spark, sf):
    return pa.missing_mates(_read_files(views(spark, sf)))


def _removals(contigs: DataFrame) -> DataFrame:
    """Every eleventh contig; the files of two samples are not listed, those of one remove nothing."""
    rows = contigs.filter(~F.col("sample").isin("src1", "src2"))
    wanted = (F.col("rec_no") % 11 == 0) & (F.col("sample") != "src3")
    return rows.select("path", F.when(wanted, names.contig_id("header")).alias("contig_id"))


@query
def remove_contigs(spark, sf):
    contigs = views(spark, sf)("contigs_v")
    return co.remove_contigs(contigs, _removals(contigs)).select("sample", "header", md5("seq").alias("seq_md5"))


def _amr_long(v) -> DataFrame:
    return v("amr_v").select(
        "stage", F.when(F.col("stage") == "F", 0).otherwise(1).alias("file_ord"), "sample",
        F.lit(0).cast("long").alias("row_no"), "drug_class", "value")


AMR_COLUMNS = ["F_A", "F_N", "F_R", "SHARED", "O_A", "O_N", "O_R"]


@query
def merge_amr_matrices(spark, sf):
    return ma.merge_amr_matrices(_amr_long(views(spark, sf)), AMR_COLUMNS)


@query
def expand_sample_steps(spark, sf):
    return st.expand_sample_steps(views(spark, sf)("status_v").select("sample").distinct())


def _dense_status(v) -> DataFrame:
    latest = st.latest_status(v("status_v"))
    every = st.expand_sample_steps(latest.select("sample").distinct()).drop("status")
    return (every.join(latest.select("sample", "step", "status"), ["sample", "step"], "left")
            .withColumn("status", F.coalesce("status", F.lit("-"))))


@query
def reconcile_skips(spark, sf):
    v = views(spark, sf)
    return st.reconcile_skips(_dense_status(v), v("skips_v"), ["KRAKEN2"])


@query
def compare_before_after(spark, sf):
    return fe.filter_effect(views(spark, sf)("contigs_v"))


@query
def cohort_report(spark, sf):
    v = views(spark, sf)
    assembly = fe.stats_before_and_after(v("contigs_v")).select("sample", "stage", "n_contigs", "n50")
    low = (v("contigs_v").groupBy("sample", "stage")
           .agg(F.count_if(names.coverage_from_header("header") < 10).alias("n_low_coverage")))
    name = names.sample_from_hit_file("file")
    found = (v("hits_v").groupBy(names.without_stage_tag(name).alias("sample"),
                                 F.coalesce(names.stage_tag(name), F.lit("before")).alias("stage"))
             .agg(F.count("*").alias("n_hits")))
    return rp.cohort_report(assembly, low, found)


# ---- k-mers and taxa -----------------------------------------------------------------------


def _kmer_taxa(v) -> DataFrame:
    # Stands for a stored table, so it is computed once.
    return settle(tx.kmers(v("references_v"), ["taxid"], K).groupBy("kmer").agg(F.min("taxid").alias("taxid")))


def _hits(v) -> DataFrame:
    return tx.screen_kmers(v("contigs_v"), _kmer_taxa(v), K)


@query
def screen_kmers(spark, sf):
    return _hits(views(spark, sf))


@query
def classify_contigs(spark, sf):
    v = views(spark, sf)
    return tx.classify_contigs(_hits(v), tx.lineages(v("taxonomy_v")), v("contigs_v"))


@query
def taxonomy_report(spark, sf):
    v = views(spark, sf)
    taxa = tx.lineages(v("taxonomy_v"))
    return tx.taxonomy_report(tx.classify_contigs(_hits(v), taxa, v("contigs_v")), taxa)


@query
def contaminants_to_removals(spark, sf):
    v = views(spark, sf)
    taxa = tx.lineages(v("taxonomy_v"))
    contigs = v("contigs_v").select("sample", "rec_no", "path", names.contig_id("header").alias("contig_id"))
    placed = contigs.join(tx.classify_contigs(_hits(v), taxa), ["sample", "rec_no"])
    return tx.contaminants_to_removals(placed, taxa, 11)


# ---- aggregations --------------------------------------------------------------------------


@query
def combine_gene_hits(spark, sf):
    return hi.combine_gene_hits(views(spark, sf)("hits_v"))


@query
def stage_progress(spark, sf):
    return st.stage_progress(st.latest_status(views(spark, sf)("status_v")))


@query
def status_counts(spark, sf):
    return st.status_counts(st.latest_status(views(spark, sf)("status_v")))


@query
def distinct_samples(spark, sf):
    return pa.distinct_samples(_read_files(views(spark, sf)))


@query
def assembly_stats(spark, sf):
    return co.assembly_stats(views(spark, sf)("contigs_v"), ref_len=20000)


@query
def read_qc_stats(spark, sf):
    reads = views(spark, sf)("reads_v")
    return re.qc_before_and_after(reads, re.filter_reads(re.trim_reads(reads, 4, 27, tail=True)))


@query
def per_cycle_quality(spark, sf):
    return re.per_cycle_quality(views(spark, sf)("reads_v"))


@query
def hit_summary(spark, sf):
    return hi.hit_summary(views(spark, sf)("hits_v"))


@query
def facet_values(spark, sf):
    return rp.facet_values(hi.project_hit_columns(views(spark, sf)("hits_v")))


# ---- windows, sorts, sets ------------------------------------------------------------------


@query
def last_incomplete_step(spark, sf):
    return st.last_incomplete_step(_dense_status(views(spark, sf)))


@query
def tail_lines(spark, sf):
    return pa.tail_lines(views(spark, sf)("log_lines_v"), 5)


@query
def pick_contig_file(spark, sf):
    ext = F.element_at(F.array(*[F.lit(e) for e in ("fna", "fasta", "ffn", "FAS", "fa")]),
                       (F.col("rec_no") % 5 + 1).cast("int"))
    sample = F.concat("sample", F.lit("_"), F.floor(F.col("rec_no") / 3))
    folder = F.explode(F.array(F.lit("/in/a/"), F.lit("/in/b/")))  # one name in two folders
    files = views(spark, sf)("contigs_v").select(sample.alias("sample"), ext.alias("ext"), folder.alias("folder"))
    return pa.pick_contig_file(files.select("sample", F.concat("folder", "sample", F.lit("."), "ext").alias("path")))


@query
def latest_wins(spark, sf):
    files = _read_files(views(spark, sf)).select(
        F.concat(F.lit("S"), F.length("sample")).alias("sample"), "mate", "path")
    return pa.latest_wins(files, ["sample", "mate"])


@query
def length_cumsum(spark, sf):
    return co.length_cumsum(views(spark, sf)("contigs_v"))


@query
def natural_sort(spark, sf):
    samples = pa.distinct_samples(_read_files(views(spark, sf)))
    return pa.natural_sort(samples).select("sample", F.array_join(names.natural_key("sample"), "|").alias("sort_key"))


@query
def sort_report(spark, sf):
    return rp.sort_report(hi.combine_gene_hits(views(spark, sf)("hits_v")), "Sample", "Database")


@query
def limit_report(spark, sf):
    combined = hi.combine_gene_hits(views(spark, sf)("hits_v"))
    out = scratch_dir(spark, "pages")
    rp.store_pages(combined, ["Sample", "Database"], out)
    return rp.read_page(spark, out, page=1)


@query
def union_hits(spark, sf):
    hits = views(spark, sf)("hits_v")
    stages = [hits.filter((F.col("database") == f"db_{d}") & (F.col("file").contains("_filtered") == after))
              for d in ("A", "N", "R") for after in (True, False)]
    return hi.union_hits(*stages).groupBy("file", "database").agg(
        F.count("*").alias("n"), F.sum(F.col("pct_identity").cast("long")).alias("identity"))


@query
def union_stage_reports(spark, sf):
    rows = views(spark, sf)("amr_v")

    def wide(stage: str, classes: list[str]) -> DataFrame:
        return rows.filter(F.col("stage") == stage).groupBy("stage", "sample").agg(
            *[F.max(F.when(F.col("drug_class") == c, F.col("value"))).alias(c) for c in classes])

    return ma.union_stage_reports(wide("F", AMR_COLUMNS[:4]), wide("O", AMR_COLUMNS[3:]))


@query
def dedupe_skips(spark, sf):
    return st.dedupe_skips(views(spark, sf)("skips_v"))


# ---- reads ---------------------------------------------------------------------------------


@query
def trim_reads(spark, sf):
    return re.trim_reads(views(spark, sf)("reads_v"), 4, 30, front=True, tail=True)


@query
def filter_reads(spark, sf):
    return re.filter_reads(views(spark, sf)("reads_v"), q=20, u=31, e=25, l=40)


# ---- state and streams ---------------------------------------------------------------------


@query
def upsert_status(spark, sf):
    events = views(spark, sf)("status_v")
    old = events.filter(F.col("step") != "FILTER")
    new = events.filter(F.col("step") == "FILTER")
    unknown = new.withColumn("step", F.lit("NOT-A-STEP"))
    return st.status_matrix(st.upsert_status(old, new.unionByName(unknown)))


@query
def steps_to_run(spark, sf):
    v = views(spark, sf)
    status = st.reconcile_skips(_dense_status(v), v("skips_v"), ["KRAKEN2"])
    out = F.concat(F.lit("/out/"), "sample", F.lit("/"), "step")
    required = status.select("sample", "step", out.alias("path"))
    files = (v("status_v").filter(F.col("seq_no") % 3 != 0).groupBy(out.alias("path"))
             .agg(F.max(F.col("seq_no") % 4).alias("length")))
    needs = required.filter(F.col("step") == "FILTER").select(
        "sample", "step", F.concat(F.lit("/out/"), "sample", F.lit("/SPADES")).alias("path"))
    return st.steps_to_run(status, required, files, v("skips_v"), needs)


@query
def stream_status(spark, sf):
    arriving, out = scratch_dir(spark, "events"), scratch_dir(spark, "progress")
    events = table(spark, sf, "events")
    events.repartitionByRange(5, "ts").write.parquet(arriving)  # five files, so several micro-batches
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    progress.write_progress(spark.sql(SPARK_VIEWS["status_v"], events=stream), out, out + "-checkpoint", compact=2).awaitTermination()
    return progress.read_progress(spark, out).select("sample", "step", "status", "seq_no")


@query
def incremental_filter(spark, sf):
    source, out = scratch_dir(spark, "arrivals"), scratch_dir(spark, "arrived")
    sinks.write_fasta(views(spark, sf)("contigs_v"), source, suffix="")
    arrivals.incremental_filter(spark, source, out, out + "-checkpoint")
    return arrivals.read_arrived(spark, out).select("sample", "header", md5("seq").alias("seq_md5"), "used_fallback")
