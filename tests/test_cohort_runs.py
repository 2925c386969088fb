import gzip

import pytest
from conftest import as_tuples
from test_files import put

from contigloom import session
from contigloom.operators import contigs as co
from contigloom.operators import taxonomy as tx
from contigloom.plans import cohort
from contigloom.sources.text import fasta_files, read_fasta, read_removal_list

LONG = "ACGT" * 150


def test_contig_run(spark, tmp_path):
    put(tmp_path, "in/a.fasta", f">late_cov_1\n{LONG}\n")
    put(tmp_path, "in/a.FA", f">n1_cov_20\n{LONG}\n>n2_cov_2\n{LONG}\n")
    put(tmp_path, "in/sub/b c%20.fna", f"junk\n>n3_cov_1\n{LONG}\n")
    put(tmp_path, "in/sub/sub/d.fa", f">n4_cov_99\n{LONG}\n")
    put(tmp_path, "in/note.txt", "not contigs")
    report = cohort.run_contigs(spark, str(tmp_path / "in"), str(tmp_path / "out"), depth=2)
    assert as_tuples(report, "sample", "n_contigs_before", "n_contigs_after", "n50_after") == [
        ("a", 2, 1, 600), ("b c%20", 1, 1, 600)]
    back = read_fasta(spark, str(tmp_path / "out" / "contigs_filtered"))
    assert as_tuples(back, "header", "length") == [("n1_cov_20", 600), ("n3_cov_1", 600)]
    with pytest.raises(FileNotFoundError):
        cohort.cohort_contigs(spark, str(tmp_path / "out" / "contigs"))


def test_a_second_run_takes_new_samples_changed_files_and_other_thresholds(spark, tmp_path):
    def run(**options):
        report = cohort.run_contigs(spark, str(tmp_path / "in"), str(tmp_path / "out"), **options)
        written = spark.read.csv(str(tmp_path / "out/reports/filter_effect"), sep="\t", header=True)
        assert {r["sample"] for r in written.collect()} == {r["sample"] for r in report.collect()}
        assert as_tuples(report, "sample", "n_contigs_after") == sorted((r["sample"], r["n_contigs_after"]) for r in
                                                                       written.selectExpr("sample", "int(n_contigs_after) n_contigs_after").collect())
        return as_tuples(read_fasta(spark, str(tmp_path / "out/contigs_filtered")), "header")

    put(tmp_path, "in/a.fasta", f">a1_cov_20\n{LONG}\n>a2_cov_5\n{LONG}\n")
    assert run() == [("a1_cov_20",)]
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("file=a_filtered.fasta/part-*")}
    put(tmp_path, "in/b.fasta", f">b1_cov_30\n{LONG}\n")
    assert run() == [("a1_cov_20",), ("b1_cov_30",)]
    assert kept and {p: p.stat().st_mtime_ns for p in kept} == kept  # the first sample is not made again
    assert run(min_cov=4) == [("a1_cov_20",), ("a2_cov_5",), ("b1_cov_30",)]
    put(tmp_path, "in/b.fasta", f">b1_cov_30\n{LONG}\n>b2_cov_40\n{LONG}\n")
    assert run() == [("a1_cov_20",), ("b1_cov_30",), ("b2_cov_40",)]
    assert as_tuples(spark.read.parquet(str(tmp_path / "out/status")).select("sample").distinct(), "sample") == [("a",), ("b",)]


def test_a_second_run_reads_only_new_files(spark, tmp_path, monkeypatch):
    put(tmp_path, "in/a.fasta", f">a1_cov_20\n{LONG}\n")
    put(tmp_path, "in/b.fasta", f">b1_cov_20\n{LONG}\n")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    cohort.run_contigs(spark, source, out)
    seen = []
    monkeypatch.setattr(cohort, "fasta_files", lambda spark_, paths: seen.append([p.rpartition("/")[2] for p in paths]) or fasta_files(spark_, paths))
    monkeypatch.setattr(cohort, "cohort_contigs", None)
    put(tmp_path, "in/c [1].fasta", f"; text\n>c1_cov_2\n{LONG}\n")
    put(tmp_path, "in/b.fasta", f">b1_cov_20\n{LONG}\n>b2_cov_30\n{LONG}\n")
    report = cohort.run_contigs(spark, source, out)
    assert sorted(seen[0]) == ["b.fasta", "c [1].fasta"] and len(seen) == 1
    assert as_tuples(report, "sample", "n_contigs_before") == [("a", 1), ("b", 2), ("c [1]", 1)]


def test_removal_by_the_paths_people_write(spark, tmp_path):
    path = put(tmp_path, "in/s 1.fasta", ">x one\nA\n>y\nC\n")
    removals = read_removal_list(spark, put(tmp_path, "list.tab", f"{path}\tx\n"))
    left = co.remove_contigs(read_fasta(spark, str(tmp_path / "in")), removals)
    assert as_tuples(left, "header") == [("y",)]


def test_read_run(spark, tmp_path):
    good, bad = "ACGTACGTACGTACGTAC", "I" * 18
    for mate in (1, 2):
        text = f"@r1/{mate}\n{good}\n+\n{bad}\n@r2/{mate}\n{good}\n+\n{('!' if mate == 1 else 'I') * 18}\n"
        put(tmp_path, f"in/s_R{mate}.fastq.gz", gzip.compress(text.encode()))
    report = cohort.run_reads(spark, str(tmp_path / "in"), str(tmp_path / "out"), trim={"tail": True}, keep={"l": 10})
    assert as_tuples(report, "stage", "mate", "reads") == [("after", 1, 1), ("after", 2, 1), ("before", 1, 2), ("before", 2, 2)]
    put(tmp_path, "in/t_1.fq", "@r\nA\n+\nI\n")
    with pytest.raises(ValueError, match="t .R2."):
        cohort.run_reads(spark, str(tmp_path / "in"), str(tmp_path / "out2"))


def test_size_check(spark):
    table = spark.createDataFrame([("a" * 100, [1, 2], None), (None, None, ["x"])], "s string, i array<int>, t array<string>")
    assert session.fits_broadcast(table, 2) == (True, 2) and session.fits_broadcast(table, 1) == (False, 2)
    assert session.fits_broadcast(table.limit(0), 0) == (True, 0)


class Session:
    """As much of a session as the shared folder asks for."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda k, *d: settings.get(k, *d)), "set": staticmethod(settings.__setitem__)})


def test_the_shared_folder_is_never_one_machines_on_a_cluster():
    unset = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}
    assert session.shared_dir(Session("local[4]", dict(unset))) == "file:/home/me/spark-warehouse-contigloom"
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint.dir"):
            session.shared_dir(Session(master, dict(unset)))
        assert session.shared_dir(Session(master, {"spark.sql.warehouse.dir": "s3a://bucket/w"})) == "s3a://bucket/w-contigloom"
        assert session.shared_dir(Session(master, unset | {"spark.checkpoint.dir": "file:/mnt/shared"})) == "file:/mnt/shared"


def test_nothing_fits_a_broadcast(spark, monkeypatch):
    """The shuffle paths give the same results as the broadcast ones."""
    nodes = spark.createDataFrame([(1, None, "r"), (2, 1, "a"), (3, 1, "b")], "taxid int, parent_taxid int, name string")
    hits = spark.createDataFrame([("s", 1, 2, 5), ("s", 1, 3, 5), ("s", 2, 3, 1)], "sample string, rec_no bigint, taxid int, n bigint")
    rows = spark.createDataFrame([("s", 1, "/p", "c1"), ("s", 2, "/p", "c2")], "sample string, rec_no bigint, path string, contig_id string")
    results = []
    for size in (session.BROADCAST_BYTES, -1):
        monkeypatch.setattr(session, "BROADCAST_BYTES", size)
        taxa = tx.lineages(nodes)
        classified = tx.classify_contigs(hits, taxa)
        report = tx.taxonomy_report(classified, taxa)
        removals = tx.contaminants_to_removals(classified.join(rows, ["sample", "rec_no"]), taxa, 2)
        contigs = spark.createDataFrame([("s", "/p", "c1", "A"), ("s", "/p", "c2", "C")], "sample string, path string, header string, seq string")
        results.append((as_tuples(report, *report.columns), as_tuples(removals, "path", "contig_id"),
                        as_tuples(co.remove_contigs(contigs, removals), "header")))
    assert results[0] == results[1]
    assert results[0][1:] == ([("/p", "c2")], [("c1",)])
