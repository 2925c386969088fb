import gzip
import os
import random

import pytest
from conftest import SF, as_tuples, plan_of
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from contigloom.operators import contigs as co
from contigloom.plans import queries
from contigloom.sinks import files as sinks
from contigloom.sources import fastq, tables, text
from contigloom.sources import files as listing
from contigloom.sources.files import scan_contig_files, scan_read_files
from contigloom.streaming import arrivals


def put(root, name, content=">a\nACGT\n"):
    path = os.path.join(str(root), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    mode = "wb" if isinstance(content, bytes) else "w"
    with open(path, mode, **({} if mode == "wb" else {"newline": ""})) as f:
        f.write(content)
    return path


def test_scan_depth_and_extensions(spark, tmp_path):
    for name in ["a.fa", "b.FASTA", "c.txt", "sub/d.fna", "sub/sub/e.fas", "f.x.ffn"]:
        put(tmp_path, name)
    assert as_tuples(scan_contig_files(spark, str(tmp_path), 1), "sample", "name") == [
        ("a", "a.fa"), ("b", "b.FASTA"), ("f.x", "f.x.ffn")]
    assert [r[0] for r in as_tuples(scan_contig_files(spark, str(tmp_path), 2), "sample")] == ["a", "b", "d", "f.x"]
    assert scan_contig_files(spark, str(tmp_path), 3).count() == 5


def test_scan_reads_is_case_sensitive(spark, tmp_path):
    for name in ["A_R1.fastq.gz", "A_R2.fastq.gz", "B.1.FQ", "x.fastq", "sub/C_1.fq"]:
        put(tmp_path, name, "@")
    assert as_tuples(scan_read_files(spark, str(tmp_path), 1), "sample", "mate") == [("A", 1), ("A", 2)]
    assert as_tuples(scan_read_files(spark, str(tmp_path), 2), "sample", "mate")[-1] == ("C", 1)


def test_hidden_names_are_an_error(spark, tmp_path):
    put(tmp_path, "_x.fasta")
    with pytest.raises(Exception, match="starts with _ or"):
        scan_contig_files(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("name, depth", [("_old/x.fasta", 2), ("a/.b/x.fna", 3), ("a/_x.fa", 2), ("_a/_b/x.fa", 3)])
def test_hidden_folders_are_an_error_down_to_the_depth(spark, tmp_path, name, depth):
    put(tmp_path, name)
    put(tmp_path, "y.fa")
    with pytest.raises(ValueError, match="starts with _ or"):
        scan_contig_files(spark, str(tmp_path), depth)
    assert as_tuples(scan_contig_files(spark, str(tmp_path), depth - 1), "sample") == [("y",)]


def test_folders_below_the_depth_are_not_listed(spark, tmp_path):
    put(tmp_path, "a.fa")
    put(tmp_path, "sub/b.fa")
    locked = tmp_path / "sub" / "deep"
    put(locked, "c.fa")
    found = scan_contig_files(spark, str(tmp_path), 2)
    assert sorted(os.path.basename(p) for p in found.inputFiles()) == ["a.fa", "b.fa"]
    assert as_tuples(found, "sample") == [("a",), ("b",)]


def test_names_with_pattern_letters_folders_that_look_like_files_and_nothing_at_all(spark, tmp_path):
    root = tmp_path / "in [1] {a,b} *"
    put(root, "x.fa")
    put(root, "y.fa/z.fa")
    assert as_tuples(scan_contig_files(spark, str(root), 1), "name") == [("x.fa",)]
    assert as_tuples(scan_contig_files(spark, str(root), 2), "name") == [("x.fa",), ("z.fa",)]
    assert scan_read_files(spark, str(root), 2).count() == 0
    with pytest.raises(FileNotFoundError):
        scan_contig_files(spark, str(tmp_path / "gone"))


def test_fasta_parsing(spark, tmp_path):
    put(tmp_path, "p.fasta", "junk\nmore\n>a one_cov_3\nAC\nGT\n>b >odd\r\nAAA\r\nCC\r\n>c\n")
    put(tmp_path, "q.fna", ">z\nACGT")
    got = text.read_fasta(spark, str(tmp_path))
    rows = [tuple(r) for r in got.orderBy("sample", "rec_no").select("sample", "header", "contig_id", "seq").collect()]
    assert rows == [("p", "a one_cov_3", "a", "ACGT"), ("p", "b >odd", "b", "AAACC"), ("p", "c", "c", ""),
                    ("q", "z", "z", "ACGT")]
    assert as_tuples(got.filter("header like 'a%'"), "coverage", "length") == [(3.0, 4)]


@pytest.mark.parametrize("block", ["64", "100", "1000", "100000"])
def test_fasta_is_the_same_however_it_is_split(spark, tmp_path, block):
    rng = random.Random(3)
    wanted, lines = [], ["; preamble", "of two lines"]
    for i in range(300):
        seq = "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 150)))
        wanted.append((f"c{i} >x", seq))
        lines += [f">c{i} >x"] + [seq[j:j + 40] for j in range(0, len(seq), 40)]
    put(tmp_path, "s.fa", "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opening = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = text.read_fasta(spark, str(tmp_path)).select("header", "seq", "rec_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", opening)
    assert [(r["header"], r["seq"]) for r in sorted(rows, key=lambda r: r["rec_no"])] == wanted
    assert len({r["rec_no"] for r in rows}) == len(rows)


def test_write_fasta_round_trip_keeps_order(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"s{i % 3}", i, f"c{i}_cov_{i}", "".join(rng.choice("ACGT") for _ in range(20))) for i in range(400)]
    table = spark.createDataFrame(rows, "sample string, rec_no bigint, header string, seq string").repartition(7)
    out = str(tmp_path / "out")
    sinks.write_fasta(table, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("file=")) == [f"file=s{i}_filtered.fasta" for i in range(3)]
    got = {}
    for folder in sorted(os.listdir(out)):
        if folder.startswith("file="):
            for part in sorted(p for p in os.listdir(f"{out}/{folder}") if p.startswith("part")):
                got.setdefault(folder[5:7], []).extend(open(f"{out}/{folder}/{part}").read().split("\n")[:-1])
    for s in ("s0", "s1", "s2"):
        assert got[s] == [x for r in rows if r[0] == s for x in (">" + r[2], r[3])]
    back = text.read_fasta(spark, out)
    assert as_tuples(back, "header", "seq") == sorted((r[2], r[3]) for r in rows)


def written(out):
    """Lines of each file, its parts in the order of their names."""
    got = {}
    for folder, _, names in sorted(os.walk(out)):
        for part in sorted(n for n in names if n.startswith("part")):
            got.setdefault(os.path.basename(folder), []).extend(open(os.path.join(folder, part)).read().split("\n")[:-1])
    return got


@pytest.fixture
def executed(spark):
    """Plans of the jobs that write, by listening to the session."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_files_that_lie_in_order_are_written_where_they_are(spark, tmp_path, monkeypatch, executed):
    rng = random.Random(8)
    wanted = {}
    for i, n in enumerate([3, 40, 1, 25]):  # some in one block, some in many
        records = [(f">c{k}_cov_9", "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 90)))) for k in range(n)]
        put(tmp_path, f"in/s{i}.fa", "".join(f"{h}\n{s}\n" for h, s in records))
        wanted[f"file=s{i}_filtered.fasta"] = [x for r in records for x in r]
    contigs = text.read_fasta(spark, str(tmp_path / "in"))
    ordered = contigs.withColumn("file", F.col("sample"))
    assert contigs.rdd.getNumPartitions() > 4 and sinks._stays_in_place(contigs)
    scattered = {r["file"] for r in sinks.file_layout(ordered, ["file"], "rec_no").filter("scattered").collect()}
    ranged = []
    by_range = type(contigs).repartitionByRange
    monkeypatch.setattr(type(contigs), "repartitionByRange", lambda self, *a: ranged.append({r["file"] for r in self.select("file").distinct().collect()}) or by_range(self, *a))
    sinks.write_fasta(contigs, str(tmp_path / "out"))
    assert written(tmp_path / "out") == wanted
    assert ranged == ([{f"{s}_filtered.fasta" for s in scattered}] if scattered else [])
    assert not {"s0", "s2"} & scattered  # a file in one task is never moved
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10 ** 8)
    sinks.write_fasta(text.read_fasta(spark, str(tmp_path / "in")), str(tmp_path / "whole"))
    assert written(tmp_path / "whole") == wanted and len(ranged) == bool(scattered)


def test_rows_that_were_shuffled_and_null_names_are_written_in_order_too(spark, tmp_path):
    rows = [(f"s{i % 3}" if i % 4 else None, i, f"c{i}", "ACGT"[i % 4]) for i in range(200)]
    table = spark.createDataFrame(rows, "sample string, rec_no bigint, header string, seq string")
    assert not sinks._stays_in_place(table.repartition(5))
    for k, frame in enumerate((table.repartition(5), table, table.coalesce(1))):
        sinks.write_fasta(frame, str(tmp_path / str(k)))
    assert written(tmp_path / "0") == written(tmp_path / "1") == written(tmp_path / "2")
    assert written(tmp_path / "0")["file=s1_filtered.fasta"] == [x for s, _, h, q in rows if s == "s1" for x in (">" + h, q)]


def test_removed_files_of_equal_names_stay_apart(spark, tmp_path):
    table = spark.createDataFrame([("s", "/a/s.fa", 0, "x", "A"), ("s", "/b/s.fa", 0, "y", "C")],
                                  "sample string, path string, rec_no bigint, header string, seq string")
    out = str(tmp_path / "out")
    sinks.write_removed_fasta(table, out)
    names = [os.path.join(d, f) for d, _, fs in os.walk(out) for f in fs if f.startswith("part")]
    assert len(names) == 2 and all("file=s_removed.fa" in n for n in names)


def test_removal_list(spark, tmp_path):
    path = put(tmp_path, "list.tab", "#column1\tcolumn2\n\n/x.fa\t a , b,,c \tnote\r\n/y.fa\t\n/z.fa\n/x.fa\td\n")
    last = as_tuples(text.read_removal_list(spark, path).fillna("-"), "path", "contig_id")
    assert last == [("/x.fa", "d"), ("/y.fa", "-"), ("/z.fa", "-")]
    merged = as_tuples(text.read_removal_list(spark, path, repeated="merge").fillna("-"), "path", "contig_id")
    assert merged == [("/x.fa", "a"), ("/x.fa", "b"), ("/x.fa", "c"), ("/x.fa", "d"), ("/y.fa", "-"), ("/z.fa", "-")]


def test_removal_list_round_trip(spark, tmp_path):
    removals = spark.createDataFrame([("/x.fa", "a"), ("/x.fa", "b"), ("/y.fa", None)], "path string, contig_id string")
    sinks.write_removal_list(removals, str(tmp_path / "out"))
    back = text.read_removal_list(spark, str(tmp_path / "out"), repeated="merge")
    assert as_tuples(back.fillna("-"), "path", "contig_id") == [("/x.fa", "a"), ("/x.fa", "b"), ("/y.fa", "-")]


def fastq_text(rng, n, name="r", mate=1):
    reads = []
    for i in range(n):
        size = rng.randint(1, 60)
        seq = "".join(rng.choice("ACGTN") for _ in range(size))
        qual = "".join(rng.choice("@@+I5!>") for _ in range(size))
        reads.append((f"{name}{i}", seq, qual))
    return reads, "".join(f"@{r} {mate}:N:0\n{s}\n+\n{q}\n" for r, s, q in reads)


@pytest.mark.parametrize("block", [1, 5, 37, 200, 5000, 10**8])
def test_fastq_is_the_same_however_it_is_split(spark, tmp_path, block):
    rng = random.Random(6)
    n = 12 if block < 37 else 150
    first, content = fastq_text(rng, n)
    second, other = fastq_text(rng, n, mate=2)
    p1 = put(tmp_path, "s_R1.fastq", content.rstrip("\n"))
    p2 = put(tmp_path, "s_R2.fastq.gz", gzip.compress(other.encode()))
    p3 = put(tmp_path, "t [1]_R1.fq", (content + "\n\n").replace("\n", "\r\n"))
    files = spark.createDataFrame([("s", 1, p1, os.path.getsize(p1)), ("s", 2, "file:" + p2, os.path.getsize(p2)), ("t", 1, p3, os.path.getsize(p3)), ("u", 1, "/none", 0)],
                                  "sample string, mate int, path string, length bigint")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        frame = fastq.read_fastq(spark, files)
        rows = frame.collect()
        assert "Exchange hash" not in plan_of(frame) and "Exchange range" not in plan_of(frame)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for sample, mate, reads in (("s", 1, first), ("s", 2, second), ("t", 1, first)):
        got = sorted((r for r in rows if (r["sample"], r["mate"]) == (sample, mate)), key=lambda r: r["read_no"])
        assert [r["read_no"] for r in got] == list(range(n))
        assert [(r["read_id"], r["seq"], r["qual"]) for r in got] == reads
    assert len(rows) == 3 * n


def test_broken_fastq_is_an_error(spark, tmp_path):
    for name, content in [("a.fq", "@r\nACGT\n+\nII\n"), ("b.fq", "@r\nACGT\n+\nIIII\n@s\nAC\n"), ("c.fq", "r\nA\n+\nI\n"), ("d.fq", "@r\nA\n-\nI\n"),
                          ("e.fq", "\n@r\nA\n+\nI\n")]:
        path = put(tmp_path, name, content)
        files = spark.createDataFrame([("s", 1, path, len(content))], "sample string, mate int, path string, length bigint")
        with pytest.raises(Exception, match="FASTQ record|incomplete"):
            fastq.read_fastq(spark, files).collect()


def test_gene_hits_by_position(spark, tmp_path):
    head = "#FILE\tSEQUENCE\tSTART\tEND\tSTRAND\tGENE\tCOVERAGE\tCOVERAGE_MAP\tGAPS\t%COVERAGE\t%IDENTITY\tDATABASE\tACCESSION\tPRODUCT\tRESISTANCE\n"
    row = "/o/s1.fasta\tc1\t1\t9\t+\tblaA\t1-9/9\t====\t0/0\t100.00\t99.5\tcard\tX\ta \"b\" c\t\n"
    put(tmp_path, "before_card.tsv", head + row)
    put(tmp_path, "filtered_card.tsv", head + row.replace("s1", "s1_filtered"))
    put(tmp_path, "before_card.summary.tsv", "#FILE\tNUM_FOUND\nx\t1\n")
    got = tables.read_gene_hits(spark, str(tmp_path))
    assert as_tuples(got.fillna("-"), "file", "gene", "pct_identity", "product", "resistance") == [
        ("/o/s1.fasta", "blaA", 99.5, 'a "b" c', "-"), ("/o/s1_filtered.fasta", "blaA", 99.5, 'a "b" c', "-")]


def test_tool_reports(spark, tmp_path):
    put(tmp_path, "raw/checkm2_before/s1/quality_report.tsv", "Name\tCompleteness\tContamination\tModel\ns1\t99.5\t0.1\tx\n")
    put(tmp_path, "raw/checkm2_after/s1/quality_report.tsv", "Name\tCompleteness\tContamination\tModel\ns1_filtered\t98\t0.0\tx\n")
    put(tmp_path, "raw/kraken2/s1.report", " 99.00\t9\t1\tS\t562\t  Escherichia coli\n")
    put(tmp_path, "raw/kraken2/s1_filtered.report", "100.00\t8\t1\tS\t562\t  Escherichia coli\n")
    put(tmp_path, "raw/gtdbtk/after/classify/after.bac120.summary.tsv", "user_genome\tclassification\tother\ns1_filtered\td__B\tz\n")
    root = str(tmp_path)
    assert as_tuples(tables.read_tool_report(spark, root, "checkm2"), "sample", "stage", "completeness") == [
        ("s1", "after", 98.0), ("s1", "before", 99.5)]
    assert as_tuples(tables.read_tool_report(spark, root, "kraken2"), "sample", "stage", "clade", "taxid") == [
        ("s1", "after", 8, 562), ("s1", "before", 9, 562)]
    assert as_tuples(tables.read_tool_report(spark, root, "gtdbtk"), "sample", "stage", "classification") == [
        ("s1", "after", "d__B")]
    assert tables.read_tool_report(spark, root, "quast").count() == 0


def test_step_logs(spark, tmp_path):
    put(tmp_path, "a_b_quast_before.log", "one\ntwo\n")
    put(tmp_path, "a_b_kraken2_filtered.log", "x\n")
    put(tmp_path, "multiqc.log", "y\n")
    got = text.read_step_logs(spark, str(tmp_path))
    assert as_tuples(got.fillna("", ["sample"]), "sample", "step", "line") == [
        ("", "MULTIQC", "y"), ("a_b", "KRAKEN2-a", "x"), ("a_b", "QUAST-b", "one"), ("a_b", "QUAST-b", "two")]
    assert [r["line"] for r in got.filter("step = 'QUAST-b'").orderBy("line_no").collect()] == ["one", "two"]


def test_report_has_a_header_and_joined_arrays(spark, tmp_path):
    table = spark.createDataFrame([("s", ["b", "c"], None)], "Sample string, Genes array<string>, x string").coalesce(1)
    for rows, name in ((table, "full"), (table.limit(0), "empty")):
        sinks.write_report_tsv(rows, str(tmp_path / name))
    read = {n: [line for f in sorted(os.listdir(tmp_path / n)) if f.endswith(".csv")
                for line in open(tmp_path / n / f).read().splitlines()] for n in ("full", "empty")}
    assert read == {"full": ["Sample\tGenes\tx", "s\tb; c\t"], "empty": ["Sample\tGenes\tx"]}


def test_arriving_files_are_filtered_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    put(source, "a.fasta", "junk\n>c1_cov_50\n" + "A" * 600 + "\n>c2_cov_1\nAC\n")
    put(source, "b.fasta", ">c3_cov_1\nAC\n")
    arrivals.incremental_filter(spark, source, out, checkpoint)
    assert as_tuples(spark.read.parquet(out), "sample", "header", "used_fallback") == [
        ("a", "c1_cov_50", False), ("b", "c3_cov_1", True)]
    put(source, "c.fasta", ">c4_cov_30\n" + "C" * 500 + "\n")
    arrivals.incremental_filter(spark, source, out, checkpoint)
    assert as_tuples(spark.read.parquet(out), "sample", "batch") == [("a", 0), ("b", 0), ("c", 1)]


def test_read_filter_remove_write(spark, tmp_path):
    put(tmp_path, "in/s1.fasta", ">n1_cov_20\n" + "A" * 500 + "\n>n2_cov_30\n" + "C" * 600 + "\n>n3_cov_2\nAC\n")
    kept = co.filter_contigs(text.read_fasta(spark, str(tmp_path / "in")))
    removals = kept.filter("contig_id = 'n1_cov_20'").select("path", "contig_id")
    sinks.write_removed_fasta(co.remove_contigs(kept, removals), str(tmp_path / "out"))
    lines = spark.read.option("recursiveFileLookup", True).text(str(tmp_path / "out")).collect()
    assert [r[0] for r in lines] == [">n2_cov_30", "C" * 600]
    assert kept.filter(F.col("used_fallback")).count() == 0


def test_many_files_are_listed_by_tasks_as_spark_lists_few(spark, tmp_path, monkeypatch):
    root = tmp_path / "in [1] {a,b} *"
    for name in ["a.fa", "b b%20.FASTA", "c.txt", "_no.txt", ".d.fa.crc", "sub/d.fna", "sub/y.fa/z.fa", "sub/sub/deep/e.fas", "f.x.ffn", "x.fa/k=1.fa"]:
        put(root, name, "x" * len(name))
    os.symlink(tmp_path / "gone", root / "gone.fa")
    os.symlink(root / "a.fa", root / "link.fa")
    for depth in (1, 2, 3):
        monkeypatch.setattr(listing, "READER_FILES", 20_000)
        few = scan_contig_files(spark, str(root), depth)
        monkeypatch.setattr(listing, "READER_FILES", 1)
        many = scan_contig_files(spark, f"file:{root}", depth)
        assert few.schema == many.schema and "MapInPandas" in plan_of(many) and "MapInPandas" not in plan_of(few)
        assert as_tuples(many, *many.columns) == as_tuples(few, *few.columns)
    put(root, "sub/_old/x.fa")
    assert scan_contig_files(spark, str(root), 2).count() > 0
    with pytest.raises(ValueError, match="starts with _ or"):
        scan_contig_files(spark, str(root), 3)


def test_named_files_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    files = spark.range(2_000).select(F.concat(F.lit("s"), F.col("id") % 3, F.lit("/"), "id", F.lit(".txt")).alias("name"), F.col("id").cast("string").alias("content"))
    tasks, write = [], type(files).mapInPandas
    monkeypatch.setattr(type(files), "mapInPandas", lambda rows, *rest: (tasks.append(rows.rdd.getNumPartitions()), write(rows, *rest))[1])
    root = str(tmp_path / "out")
    sinks.write_named_files(files.coalesce(1), root)
    assert tasks == [spark.sparkContext.defaultParallelism]
    assert sorted(n for _, _, names in os.walk(root) for n in names) == sorted(f"{i}.txt" for i in range(2_000))
    assert sorted(os.listdir(root)) == ["s0", "s1", "s2"] and open(f"{root}/s1/1999.txt").read() == "1999"


def test_the_driver_asks_spark_for_no_listing_of_many_files(spark, tmp_path, monkeypatch):
    for name in ["a.fa", "sub/b.fa", "sub/sub/c.fa"]:
        put(tmp_path, name)
    asked, ask = [], listing._matches
    monkeypatch.setattr(listing, "READER_FILES", 1)
    monkeypatch.setattr(listing, "_matches", lambda session, pattern: (asked.append(pattern), ask(session, pattern))[1])
    found = scan_contig_files(spark, str(tmp_path), 2)
    assert as_tuples(found, "sample", "length") == [("a", 8), ("b", 8)]
    assert asked == [str(tmp_path)] and found.inputFiles() == []


def test_many_logs_are_written_as_spark_writes_them_without_its_commit(spark, tmp_path, monkeypatch):
    rows = [(f, i, f"{f} {i}" if i % 7 else None) for f in ("a_fastp.log", "b_spades.log", "odd [1]=%.log", "", None) for i in range(30)]
    rows += [("multiqc.log", i, f"line é {i}") for i in range(3_000)]
    lines = spark.createDataFrame(rows, "file string, line_no long, value string").repartition(5)
    spark_out, own = str(tmp_path / "spark"), str(tmp_path / "own")
    lines.repartitionByRange("file", "line_no").sortWithinPartitions("file", "line_no").drop("line_no").write.partitionBy("file").text(spark_out)
    sinks.write_many_logs(lines, own, "line_no")

    def held(out):
        return {f: "".join(open(f"{out}/{f}/{p}").read() for p in sorted(os.listdir(f"{out}/{f}")) if p.startswith("part-")) for f in os.listdir(out) if "=" in f}

    assert held(own) == held(spark_out) and sorted(os.listdir(own)) == sorted(held(own))
    assert len(os.listdir(f"{own}/file=multiqc.log")) > 1
    sinks.write_many_logs(lines.limit(0), str(tmp_path / "none"), "line_no")


def test_the_log_query_writes_no_file_by_sparks_committer(spark, monkeypatch):
    made = []
    monkeypatch.setattr(DataFrameWriter, "text", lambda writer, path, *rest, **named: made.append(path))
    assert queries.read_step_logs(spark, SF).count() > 0 and not made


def test_many_small_logs_are_read_in_few_tasks(spark, tmp_path):
    for i in range(100):
        put(tmp_path, f"s{i}_fastp.log", f"one {i}\ntwo\n")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in kept:
        spark.conf.set(k, "4m")
    try:
        got = text.read_step_logs(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() == 8 * spark.sparkContext.defaultParallelism
        rows = [(r["sample"], r["line"]) for r in got.orderBy("sample", "line_no").collect()]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert rows == sorted((f"s{i}", line) for i in range(100) for line in (f"one {i}", "two"))
