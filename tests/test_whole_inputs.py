"""Readers and operators keep all that ordinary inputs hold."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from contigloom.operators import matrices, pairs, reads, reports, status, taxonomy
from contigloom.sources import tables, text
from tests.conftest import as_tuples


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_compressed_fasta_keeps_its_first_record(spark, tmp_path):
    put(tmp_path, "c.fasta.gz", gzip.compress(b">c1\nAC\n>c2\nGT\n"))
    put(tmp_path, "d.fa", "text before\n>d1\nA\nC\n")
    put(tmp_path, "readme.txt", ">not a contig\nA\n")
    got = text.read_fasta(spark, str(tmp_path))
    assert as_tuples(got, "sample", "header", "seq") == [("c", "c1", "AC"), ("c", "c2", "GT"), ("d", "d1", "AC")]


def test_a_file_given_by_name_may_have_any_extension(spark, tmp_path):
    path = put(tmp_path, "contigs.txt", ">a\nAC\n")
    assert as_tuples(text.read_fasta(spark, path), "header") == [("a",)]


@pytest.mark.parametrize("name", ["_x.fasta", ".x.fna"])
def test_hidden_fasta_names_raise(spark, tmp_path, name):
    put(tmp_path, name, ">a\nAC\n")
    put(tmp_path, "y.fa", ">a\nAC\n")
    with pytest.raises(ValueError, match="starts with"):
        text.read_fasta(spark, str(tmp_path))


def test_status_columns_are_found_by_name(spark, tmp_path):
    put(tmp_path, "s.tsv", "Sample\tSPADES\tFASTP\tNOTE\nA\tOK\tFAIL\tx\nB\t\tOK\ty\n")
    got = {(r["sample"], r["step"]): r["status"] for r in tables.read_status(spark, str(tmp_path / "s.tsv")).collect()}
    assert len(got) == 32
    assert (got["A", "SPADES"], got["A", "FASTP"], got["A", "MULTIQC"], got["B", "SPADES"], got["B", "FASTP"]) == ("OK", "FAIL", "-", "-", "OK")


def test_matrices_without_classes_and_with_a_repeated_one(spark, tmp_path):
    one = put(tmp_path, "one.tsv", "Isolate\nA\nB\n")
    two = put(tmp_path, "two.tsv", "Isolate\tX\tY\tX\nA\tp\tq\tr\n")
    long = tables.read_amr_matrix(spark, [("before", one), ("after", two)])
    merged = matrices.merge_amr_matrices(long)
    assert merged.columns == ["sample", "Y", "X"]
    assert as_tuples(merged.fillna(""), "sample", "X", "Y") == [("A", "r", "q"), ("B", "", "")]
    assert as_tuples(matrices.merge_amr_matrices(tables.read_amr_matrix(spark, [("before", one)])), "sample") == [("A",), ("B",)]


def test_reports_keep_all_columns_by_name(spark, tmp_path):
    put(tmp_path, "raw/checkm2_before/A/quality_report.tsv", "Name\tContamination\tCompleteness\tGenome_Size\tOwn\nA\t1.5\t99.1\t4000\tz\n")
    put(tmp_path, "raw/gtdbtk/after/classify/x.summary.tsv", "classification\tuser_genome\tred_value\nd__B\tA_filtered\tN/A\n")
    row = tables.read_tool_report(spark, str(tmp_path), "checkm2").first()
    assert (row["completeness"], row["contamination"], row["genome_size"], row["own"], row["contig_n50"]) == (99.1, 1.5, 4000, "z", None)
    row = tables.read_tool_report(spark, str(tmp_path), "gtdbtk").first()
    assert (row["sample"], row["stage"], row["classification"], row["red_value"]) == ("A", "after", "d__B", None)


def test_reports_with_one_column_name_keep_both_values(spark):
    a = spark.createDataFrame([("s", "before", "n1")], "sample string, stage string, name string")
    b = spark.createDataFrame([("s", "before", "n2", 1)], "sample string, stage string, name string, x int")
    with pytest.raises(ValueError, match="name"):
        reports.cohort_report(a, b)
    row = reports.cohort_report(a, b, names=["checkm2", "kraken2"]).first().asDict()
    assert row == {"sample": "s", "stage": "before", "checkm2_name": "n1", "kraken2_name": "n2", "x": 1}
    with pytest.raises(Exception, match="more than one row"):
        reports.cohort_report(a.union(a)).collect()


def test_cohort_logs_and_empty_logs(spark, tmp_path):
    put(tmp_path, "gtdbtk.log", "one\ntwo\n")
    put(tmp_path, "a_fastp.log", "")
    lines = text.read_step_logs(spark, str(tmp_path))
    assert as_tuples(lines, "step", "line") == [("GTDBTK-a", "one"), ("GTDBTK-a", "two"), ("GTDBTK-b", "one"), ("GTDBTK-b", "two")]
    rows = [("a", "GTDBTK-b", "FAIL", f"{tmp_path}/gtdbtk.log"), ("a", "FASTP", "FAIL", f"{tmp_path}/a_fastp.log"), ("a", "SPADES", "FAIL", "no such tool")]
    failed = spark.createDataFrame(rows, "sample string, step string, status string, log_path string")
    files = spark.createDataFrame([(f"{tmp_path}/gtdbtk.log",), (f"{tmp_path}/a_fastp.log",)], "path string")
    got = status.error_digest(failed, lines, 1, files=files)
    assert as_tuples(got, "step", "line") == [("GTDBTK-b", "two"), ("SPADES", "no such tool")]


def test_lone_mates_go_and_are_listed(spark):
    rows = [("s", 1, 1, "r1", "ACGTACGTACGTACGT", "I" * 16), ("s", 2, 1, "r1", "ACGTACGTACGTACGT", "I" * 16), ("s", 1, 2, "r2", "ACGTACGTACGTACGT", "I" * 16)]
    frame = spark.createDataFrame(rows, "sample string, mate int, read_no long, read_id string, seq string, qual string")
    assert as_tuples(reads.filter_reads(frame), "read_no", "mate") == [(1, 1), (1, 2)]
    assert as_tuples(reads.lone_mates(frame), "read_no", "mate") == [(2, 1)]
    with pytest.raises(Exception, match="different ids"):
        reads.filter_reads(frame.withColumn("read_id", F.concat("read_id", "mate"))).collect()


def test_among_files_of_one_name_the_greatest_path_counts(spark):
    files = spark.createDataFrame([("s", "/in/a/s.fa"), ("s", "/in/b/s.fa"), ("s", "/in/z/s.fasta")], "sample string, path string")
    assert as_tuples(pairs.pick_contig_file(files), "path") == [("/in/b/s.fa",)]


def test_all_gaps_are_counted(spark):
    files = spark.range(30).select(F.concat(F.lit("s"), "id").alias("sample"), F.lit(1).alias("mate"))
    with pytest.raises(ValueError, match="30 read files missing: .*and 10 more"):
        pairs.require_mates(files)


def test_lineages_of_more_taxa_than_a_recursion_may_have(spark):
    n = 1_200_000
    taxa = spark.range(1, n + 1).select(F.col("id").cast("int").alias("taxid"), F.when(F.col("id") > 1, F.floor(F.col("id") / 4).cast("int") + 1).alias("parent_taxid"),
                                        F.lit("t").alias("name")).withColumn("parent_taxid", F.when(F.col("taxid") > 1, F.least(F.col("parent_taxid"), F.col("taxid") - 1)))
    found = taxonomy.lineages(taxa)
    assert found.count() == n
    assert found.filter((F.col("lineage")[0] != 1) | (F.element_at("lineage", -1) != F.col("taxid"))).count() == 0


def test_a_cycle_of_taxa_is_reported_and_strays_are_left_out(spark):
    rows = [(1, None, "r"), (2, 1, "a"), (3, 2, "b"), (9, 77, "stray")]
    schema = "taxid int, parent_taxid int, name string"
    got = taxonomy.lineages(spark.createDataFrame(rows, schema))
    assert as_tuples(got, "taxid", "lineage") == [(1, [1]), (2, [1, 2]), (3, [1, 2, 3])]
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.lineages(spark.createDataFrame([*rows, (4, 6, "x"), (5, 4, "y"), (6, 5, "z"), (7, 6, "w")], schema))


LONG = "ACGT" * 150


def test_arriving_files_decide_for_themselves_and_one_counts(spark, tmp_path):
    from contigloom.streaming import arrivals

    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    put(tmp_path, "in/s.fasta", f">a_cov_1\n{LONG}\n>b_cov_99\n{LONG}\n")
    put(tmp_path, "in/note.txt", ">x\nA\n")
    arrivals.incremental_filter(spark, source, out, checkpoint)
    put(tmp_path, "in/s.fa", f">c_cov_1\n{LONG}\n")
    put(tmp_path, "in/t.fna", f">d_cov_50\n{LONG}\n>e_cov_2\n{LONG}\n")
    arrivals.incremental_filter(spark, source, out, checkpoint)
    assert as_tuples(arrivals.read_arrived(spark, out), "sample", "header", "used_fallback") == [("s", "c_cov_1", True), ("t", "d_cov_50", False)]


def test_a_second_run_keeps_what_is_there_and_makes_what_is_not(spark, tmp_path):
    import shutil

    from contigloom.plans import cohort

    put(tmp_path, "in/a.fa", f">n1_cov_20\n{LONG}\n>n2_cov_2\n{LONG}\n")
    source, out = str(tmp_path / "in"), tmp_path / "out"
    cohort.run_contigs(spark, source, str(out))
    first = {p: p.stat().st_mtime_ns for p in out.rglob("*") if p.is_file()}
    cohort.run_contigs(spark, source, str(out))
    assert {p: p.stat().st_mtime_ns for p in out.rglob("*") if p.is_file()} == first
    shutil.rmtree(out / "contigs_filtered")
    cohort.run_contigs(spark, source, str(out))
    assert as_tuples(text.read_fasta(spark, str(out / "contigs_filtered")), "header") == [("n1_cov_20",)]
    cohort.run_contigs(spark, source, str(tmp_path / "skipped"), skip=("filter",))
    assert not (tmp_path / "skipped/contigs_filtered").exists()
    assert as_tuples(spark.read.parquet(str(tmp_path / "skipped/status")), "sample", "step", "status") == [("a", "FILTER", "SKIPPED")]


def test_removal_run_from_list_to_files(spark, tmp_path):
    from contigloom.plans import cohort

    path = put(tmp_path, "in/a.fasta", ">x\nA\n>y\nC\n")
    put(tmp_path, "in/b.fasta", ">z\nA\n")
    listed = put(tmp_path, "list.tab", f"{path}\tx\n{tmp_path}/in/gone.fa\tq\n")
    missing = cohort.run_removal(spark, listed, str(tmp_path / "in"), str(tmp_path / "out"))
    assert as_tuples(missing, "path") == [(f"{tmp_path}/in/gone.fa",)]
    lines = spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "out"))
    assert sorted(r["value"] for r in lines.collect()) == [">y", "C"]


def test_sorted_reports_and_live_stage_counts(spark, tmp_path):
    from contigloom.sinks import files as sinks
    from contigloom.streaming import progress

    table = spark.range(100).select((99 - F.col("id")).alias("id")).repartition(7)
    sinks.write_report_tsv(table, str(tmp_path / "t"), header=False, order=["id"])
    parts = sorted((tmp_path / "t").glob("part-*"))
    assert [int(x) for p in parts for x in p.read_text().split()] == list(range(100))
    events = "sample string, step string, status string, ts timestamp, seq_no long"
    for k, (state, expected) in enumerate((("OK", 1), ("FAIL", 2))):
        rows = spark.sql(f"select 's{k}' as sample, 'FASTP' as step, '{state}' as status, timestamp '2024-01-01' as ts, {k}L as seq_no")
        rows.write.mode("append").parquet(str(tmp_path / "events"))
        stream = spark.readStream.schema(events).parquet(str(tmp_path / "events"))
        progress.write_progress(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        counts = {r["stage"]: (r["n_run"], r["n_total"]) for r in progress.read_stage_progress(spark, str(tmp_path / "out")).collect()}
        assert counts[1] == (expected, expected) and counts[2][0] == 0
    assert as_tuples(progress.read_progress(spark, str(tmp_path / "out")), "sample", "status") == [("s0", "OK"), ("s1", "FAIL")]


def test_a_micro_batch_writes_changed_cells_alone(spark, tmp_path):
    from contigloom.streaming import progress

    events = "sample string, step string, status string, ts timestamp, seq_no long"
    out = str(tmp_path / "out")

    def arrive(*rows):
        frame = spark.createDataFrame(list(rows), "sample string, step string, status string, at string, seq_no long")
        frame.selectExpr("sample", "step", "status", "cast(at as timestamp) as ts", "seq_no").coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
        stream = spark.readStream.schema(events).parquet(str(tmp_path / "events"))
        progress.write_progress(stream, out, str(tmp_path / "cp"), compact=3).awaitTermination()

    want = {}
    for k in range(8):
        rows = [(f"s{k}", "FASTP", "RUNNING", "2024-01-01", k), (f"s{k // 2}", "SPADES", f"OK{k}", "2024-01-02", k), ("old", "QUAST-b", f"x{k}", "2024-01-03", -k), (f"s{k}", "NOT-A-STEP", "OK", "2024-01-01", k)]
        arrive(*rows)
        want |= {(s, t): v for s, t, v, _, _ in rows[:2]} | {("old", "QUAST-b"): "x0"}  # the greatest number counts, here the first
        assert {(r["sample"], r["step"]): r["status"] for r in progress.read_progress(spark, out).collect()} == want
        changed = spark.read.parquet(f"{out}/cells/change-{k:012d}")
        assert {r["sample"] for r in changed.collect()} <= {f"s{k}", f"s{k // 2}", "old"}
    names = sorted(os.listdir(tmp_path / "out" / "cells"))
    assert names == ["base-000000000002", "base-000000000005", *[f"change-{k:012d}" for k in (3, 4, 5, 6, 7)]]
    counts = {r["stage"]: (r["n_run"], r["n_total"]) for r in progress.read_stage_progress(spark, out).collect()}
    assert counts[1] == (8, 9)
    assert progress.read_progress(spark, str(tmp_path / "nothing")).count() == 0


def test_a_session_leaves_no_intermediate_files(tmp_path):
    import os
    import subprocess
    import sys

    code = f"""
from pyspark.sql import SparkSession
from contigloom.session import scratch_dir, settle
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", r"{tmp_path}/shared").getOrCreate()
settle(spark.range(5)).write.parquet(scratch_dir(spark, "x"))
import os
print("FOUND", sum(len(f) for _, _, f in os.walk(r"{tmp_path}")))
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=200)
    assert int(done.stdout.split("FOUND")[1]) > 0
    assert [f for _, _, names in os.walk(tmp_path) for f in names] == []


def test_pairs_in_one_row_are_cleaned_without_a_shuffle(spark, tmp_path):
    rows = [("s", m, i, f"r{i}", "ACGTACGTACGTACGTAC", "I" * 18 if i % 3 or m == 1 else "!" * 18) for i in range(30) for m in (1, 2)][:-1]
    frame = spark.createDataFrame(rows, "sample string, mate int, read_no long, read_id string, seq string, qual string")
    reads.pair_reads(frame).write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    trim, keep = {"tail": True}, {"l": 10, "e": 20}
    cleaned = reads.unpair_reads(reads.clean_pairs(pairs, trim, keep))
    columns = ("sample", "read_no", "mate", "read_id", "seq", "qual")
    assert as_tuples(cleaned, *columns) == as_tuples(reads.filter_reads(reads.trim_reads(frame, **trim), **keep), *columns)
    assert "Exchange" not in cleaned._jdf.queryExecution().executedPlan().toString()
    assert as_tuples(reads.unpair_reads(pairs), *columns) == as_tuples(frame, *columns)
    torn = pairs.withColumn("r2", F.struct(F.lit("other").alias("read_id"), "r2.seq", "r2.qual"))
    with pytest.raises(Exception, match="different ids"):
        reads.clean_pairs(torn).collect()
