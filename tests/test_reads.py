import functools
import random
import re as re_

import pytest
from conftest import as_tuples, plan_of

from contigloom.functions import kernels
from contigloom.operators import pairs as pa
from contigloom.operators import reads as re

COLUMNS = "sample string, mate int, read_no bigint, seq string, qual string"


def reads_of(rng, n, longest=30):
    rows = []
    for i in range(n):
        for mate in (1, 2):
            size = rng.randint(0, longest)
            rows.append((f"s{i % 3}", mate, i, "".join(rng.choice("ACGTN") for _ in range(size)),
                         "".join(chr(33 + rng.choice([2, 10, 14, 15, 20, 30, 40])) for _ in range(size))))
    return rows


def trim_by_hand(qual, w, q, front, tail):
    """First kept position and length, by trying each window."""
    scores = [ord(c) - 33 for c in qual]
    good = [i for i in range(len(scores) - w + 1) if sum(scores[i:i + w]) >= q * w]
    if not (front or tail):
        return 0, len(scores)
    if not good:
        return 0, 0
    start = good[0] if front else 0
    end = good[-1] + w if tail else len(scores)
    return start, end - start


@pytest.mark.parametrize("window,front,tail", [(1, True, True), (4, True, False), (4, False, True), (4, True, True), (7, True, True)])
@pytest.mark.parametrize("slice_bases", [10, 4_000_000])
def test_trim_against_trying_each_window(spark, monkeypatch, window, front, tail, slice_bases):
    monkeypatch.setattr(kernels, "SLICE_BASES", slice_bases)
    rows = reads_of(random.Random(window), 60)
    import pyarrow
    for quals in ([r[4] for r in rows], ["", "IIII", ""], [""], []):
        got = re._by_slices(lambda p: kernels.window_trim(p, window, 18.5, front, tail), pyarrow.array(quals, pyarrow.string()))
        for qual, cut in zip(quals, got.to_pylist()):
            start, kept = trim_by_hand(qual, window, 18.5, front, tail)
            assert cut["kept"] == kept, (qual, cut)
            if kept:
                assert cut["start"] == start + 1
    out = re.trim_reads(spark.createDataFrame(rows, COLUMNS), window, 18.5, front, tail).collect()
    assert len(out) == len(rows)
    for r in out:
        assert len(r["seq"]) == len(r["qual"])


def test_trim_changes_letters_and_qualities_alike(spark):
    table = spark.createDataFrame([("s", 1, 0, "ACGTACGT", "!!IIII!!")], COLUMNS)
    assert as_tuples(re.trim_reads(table, 2, 30, front=True, tail=True), "seq", "qual") == [("GTAC", "IIII")]
    assert "Exchange" not in plan_of(re.trim_reads(table, 2, 30, front=True))


def test_filter_reads_drops_pairs(spark):
    rows = reads_of(random.Random(9), 200, 40)

    def good(qual):
        scores = [ord(c) - 33 for c in qual]
        low = sum(s < 15 for s in scores)
        return len(scores) >= 10 and low * 100 <= 45 * len(scores) and sum(scores) >= 16 * len(scores)

    failed = {r[2] for r in rows if not good(r[4])}
    wanted = sorted(r for r in rows if r[2] not in failed)
    table = spark.createDataFrame(rows, COLUMNS)
    got = re.filter_reads(table, q=15, u=45, e=16, l=10)
    assert as_tuples(got, *table.columns) == wanted and 0 < len(wanted) < len(rows)
    assert "Exchange hashpartitioning" not in plan_of(got)


@pytest.mark.parametrize("limits, shuffled", [([True], False), ([False, True], False), ([False, False], True)])
def test_failing_pairs_travel_as_rows_or_bits_and_letters_only_beyond_that(spark, monkeypatch, limits, shuffled):
    rows = [(s, m, n * 977 - 90_000, *r[3:]) for r in reads_of(random.Random(3), 150, 40) for s, m, n in [r[:3]]]
    rows += [(None, m, 5, "A" * 20, "I" * 20) for m in (1, 2)] + [("s0", 1, 10 ** 12, "A" * 20, "I" * 20)]  # no sample; no mate
    table = spark.createDataFrame(rows, COLUMNS)
    wanted = as_tuples(re.filter_reads(table.fillna("none", ["sample"]), 15, 45, 16, 10), *table.columns)
    sizes = iter(limits)
    monkeypatch.setattr(re, "fits_broadcast", lambda df, *a: (next(sizes), df.count()))
    got = re.filter_reads(table, 15, 45, 16, 10)
    assert as_tuples(got.fillna("none", ["sample"]), *table.columns) == wanted and len(wanted) > 20
    assert ("Exchange hashpartitioning" in plan_of(got)) == shuffled


def test_only_numbers_are_shuffled_to_find_failing_pairs(spark):
    table = spark.createDataFrame([("s", m, 1, "r1", "ACGT" * 5, "I" * 20) for m in (1, 2)], "sample string, mate int, read_no long, read_id string, seq string, qual string")
    plan = re.pair_verdicts(table, re.read_passes())._jdf.queryExecution().optimizedPlan()
    shuffled = re.pair_verdicts(table, re.read_passes())._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" in plan.toString() and "partial_min(seq" not in shuffled and "partial_min(qual" not in shuffled


def test_read_qc_stats(spark):
    table = spark.createDataFrame([("s", 1, 0, "GCAT", "5?+I"), ("s", 1, 1, "NN", "!!"), ("s", 2, 0, "", "")], COLUMNS)
    rows = {r["mate"]: r for r in re.read_qc_stats(table).collect()}
    one = rows[1]
    assert (one["reads"], one["bases"], one["q20_bases"], one["q30_bases"], one["gc_bases"]) == (2, 6, 3, 2, 2)
    assert one["mean_length"] == 3.0 and rows[2]["q20_rate"] is None


def test_per_cycle_quality_against_counting(spark):
    rows = reads_of(random.Random(4), 40) + [("s0", 1, 900, "acgn", "IIII")]
    wanted = {}
    for s, m, _, seq, qual in rows:
        for i, (b, q) in enumerate(zip(seq.upper(), qual), 1):
            cell = wanted.setdefault((s, m, i), [0, 0, 0, 0])
            cell[0] += 1
            cell[1] += ord(q) - 33
            cell[2] += b == "N"
            cell[3] += b == "G"
    got = re.per_cycle_quality(spark.createDataFrame(rows, COLUMNS))
    assert {(r["sample"], r["mate"], r["pos"]): [r["n"], r["sum_q"], r["n_other"], r["n_g"]] for r in got.collect()} == wanted
    assert "WholeStageCodegen" in got._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))


def test_unequal_lengths_are_an_error(spark):
    table = spark.createDataFrame([("s", 1, 0, "ACG", "II")], COLUMNS)
    with pytest.raises(Exception, match="differ in length"):
        re.per_cycle_quality(table).collect()


NAMES = ["A_R1.fastq.gz", "A_S1_L001_R2_001.fastq.gz", "B.1.fq", "B-2.fq", "C_1_2.fq", "x.fastq", "D_R3.fq", "E_1.FQ", "A_R2_1.fq.gz"]


def test_mate_names(spark):
    files = spark.createDataFrame([(n,) for n in NAMES], "name string")
    assert as_tuples(pa.parse_mate_name(files), "sample", "mate") == [
        ("A", 1), ("A_R2", 1), ("A_S1_L001", 2), ("B", 1), ("B", 2), ("C_1", 2)]


def test_pairs_and_gaps(spark):
    files = spark.createDataFrame([("A", 1, "/x/A_R1.fq"), ("A", 1, "/y/A_R1.fq"), ("A", 2, "/x/A_R2.fq"), ("B", 1, "/x/B_R1.fq")],
                                  "sample string, mate int, path string")
    assert as_tuples(pa.pair_mates(files).fillna("-"), "sample", "r1_path", "r2_path") == [
        ("A", "/y/A_R1.fq", "/x/A_R2.fq"), ("B", "/x/B_R1.fq", "-")]
    assert as_tuples(pa.missing_mates(files), "sample", "missing") == [("B", 2)]
    with pytest.raises(ValueError, match="B .R2."):
        pa.require_mates(files)
    assert as_tuples(pa.latest_wins(files, ["sample", "mate"]), "path") == [("/x/A_R2.fq",), ("/x/B_R1.fq",), ("/y/A_R1.fq",)]


def test_one_file_per_sample(spark):
    files = spark.createDataFrame([("s", "/i/s.fasta"), ("s", "/i/s.fa"), ("t", "/i/t.fna"), ("t", "/i/t.FAS")],
                                  "sample string, path string")
    assert as_tuples(pa.pick_contig_file(files), "sample", "path") == [("s", "/i/s.fa"), ("t", "/i/t.FAS")]


def test_natural_order(spark):
    wanted = ["2b", "10a", "s1", "s1a", "s2", "s10", "s" + "9" * 25, "s1" + "0" * 25]
    table = spark.createDataFrame([(n,) for n in reversed(wanted)], "sample string")
    assert [r[0] for r in pa.natural_sort(table).collect()] == wanted


def version_order(a, b):
    """-1, 0 or 1: text compared letter by letter, numbers as numbers, as version sort has it."""
    def rank(text, i):
        if i >= len(text):
            return -1
        c = text[i]
        return 0 if c.isdigit() else -2 if c == "~" else ord(c) if c.isalpha() else ord(c) + 1000

    def parts(x, y):
        i = j = 0
        while i < len(x) or j < len(y):
            while i < len(x) and not x[i].isdigit() or j < len(y) and not y[j].isdigit():
                if rank(x, i) != rank(y, j):
                    return -1 if rank(x, i) < rank(y, j) else 1
                i, j = i + 1, j + 1
            m, n = (re_.match("[0-9]*", s[k:])[0] for s, k in ((x, i), (y, j)))
            if int(m or 0) != int(n or 0):
                return -1 if int(m or 0) < int(n or 0) else 1
            i, j = i + len(m), j + len(n)
        return 0

    special = ["", ".", ".."]
    for x, y, sign in ((a, b, -1), (b, a, 1)):
        if x in special and (y not in special or special.index(x) < special.index(y)) or x.startswith(".") and y not in special and not y.startswith("."):
            return sign
    if a in special and b in special:
        return 0
    a, b = (s[1:] if s.startswith(".") else s for s in (a, b))
    ending = re_.compile(r"(\.[A-Za-z~][A-Za-z0-9~]*)+$")
    return parts(ending.sub("", a), ending.sub("", b)) or parts(a, b)


def test_natural_order_equals_a_comparison_of_versions(spark):
    rng = random.Random(21)
    names_ = {"".join(rng.choices("ab01.~-_9A", k=rng.randrange(0, 7))) for _ in range(500)}
    names_ |= {"s1", "s01", "s001", "s1~", "s1~rc", "s1.tar.gz", "s10.fa", "s9.fa", "a.b", "a1.b", "", ".", "..", ".x", "9" * 30, "1" + "0" * 30, "a" + "0" * 40 + "7"}
    table = spark.createDataFrame([(n,) for n in names_], "sample string")
    got = [r[0] for r in pa.natural_sort(table).collect()]
    assert got == sorted(names_, key=lambda n: (functools.cmp_to_key(version_order)(n), n))


def test_manifests(spark):
    files = spark.createDataFrame([("/o/s.v1.fasta",)], "path string")
    got = {n: tuple(pa.batch_manifest(files, n).collect()[0]) for n in ("path_stem", "before_path", "stem_path")}
    assert got == {"path_stem": ("/o/s.v1.fasta", "s.v1"), "before_path": ("s.v1_before", "/o/s.v1.fasta"),
                   "stem_path": ("s.v1", "/o/s.v1.fasta")}


def test_tail_lines_limits_before_the_shuffle(spark):
    lines = spark.createDataFrame([(f"f{i % 2}", i, str(i)) for i in range(40)], "file string, line_no bigint, line string")
    tail = pa.tail_lines(lines, 3)
    assert as_tuples(tail, "line_no") == [(34,), (35,), (36,), (37,), (38,), (39,)]
    assert "WindowGroupLimit" in plan_of(tail)


def test_timestamp_text(spark):
    table = spark.createDataFrame([(90061,)], "s bigint")
    from contigloom.functions import names
    assert table.select(names.timestamp_text("s")).collect()[0][0] == "1970-01-02 01:01:01"


def test_fastq_round_trip_keeps_pairs_in_step(spark, tmp_path):
    import os

    from contigloom.sinks import files as sinks
    from contigloom.sources import fastq
    rows = [r for r in reads_of(random.Random(2), 90) if r[3]]
    table = spark.createDataFrame(rows, COLUMNS).repartition(5)
    sinks.write_fastq(table, str(tmp_path / "out"))
    found = []
    for folder, _, names in os.walk(tmp_path / "out"):
        for n in names:
            if n.startswith("part"):
                assert n.endswith(".gz")
                stem = folder.rsplit("file=", 1)[1]
                found.append((stem[:2], int(stem[-7]), f"{folder}/{n}", os.path.getsize(f"{folder}/{n}")))
    files = spark.createDataFrame(found, "sample string, mate int, path string, length bigint")
    got = fastq.read_fastq(spark, files)
    assert as_tuples(got, "sample", "mate", "read_id", "seq", "qual") == sorted((r[0], r[1], str(r[2]), r[3], r[4]) for r in rows)
