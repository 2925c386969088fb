import datetime

import pytest
from conftest import as_tuples
from pyspark.sql import functions as F

from contigloom import session
from contigloom.functions import names
from contigloom.operators import status as st
from contigloom.schemas import STEPS
from contigloom.streaming import progress

EVENTS = "sample string, step string, status string, ts timestamp, seq_no bigint"


def at(minute):
    return datetime.datetime(2024, 1, 1, 0, minute)


def test_last_write_wins_and_prefixes_do_not_matter(spark):
    old = spark.createDataFrame([("S10", "FASTP", "OK", at(1), 1)], EVENTS)
    new = [("S1", "SPADES", "RUNNING", at(2), 2), ("S1", "SPADES", "OK", at(2), 3), ("S10", "FASTP", "FAIL", at(0), 9),
           ("S1", "NOPE", "OK", at(5), 5)]
    tables = [st.status_matrix(st.upsert_status(old, spark.createDataFrame(rows, EVENTS))) for rows in (new, new[::-1])]
    for table in tables:
        assert table.columns == ["Sample"] + STEPS
        rows = {r["Sample"]: r for r in table.collect()}
        assert rows["S1"]["SPADES"] == "OK" and rows["S1"]["FASTP"] == "-" and rows["S10"]["FASTP"] == "OK"
        assert sorted(rows) == ["S1", "S10"]


def status(spark, rows):
    return spark.createDataFrame(rows, "sample string, step string, status string")


def skips(spark, *asked):
    return spark.createDataFrame([(n,) for n in asked], "name string")


def test_skip_names(spark):
    asked = skips(spark, "fastp", "FASTP", "quast-A", "nonsense")
    assert as_tuples(st.dedupe_skips(asked), "step") == [("FASTP",), ("QUAST-a",)]
    assert as_tuples(st.unknown_skips(asked), "name") == [("nonsense",)]
    steps = spark.createDataFrame([(s,) for s in STEPS], "step string")
    kept = {r[0] for r in as_tuples(st.select_steps(steps, asked), "step")}
    assert kept == set(STEPS) - {"FASTP", "QUAST-a"}


def test_reconcile(spark):
    table = status(spark, [("s", "FASTP", "OK"), ("s", "SPADES", "SKIPPED"), ("s", "KRAKEN2-a", "SKIPPED"), ("s", "GTDBTK-b", "OK")])
    got = st.reconcile_skips(table, skips(spark, "fastp"), ["KRAKEN2"])
    assert as_tuples(got, "step", "status") == [
        ("FASTP", "SKIPPED"), ("GTDBTK-b", "SKIPPED"), ("KRAKEN2-a", "-"), ("SPADES", "-")]


def test_last_incomplete_step(spark):
    full = [("a", s, "FAIL" if s == "FASTP" else "-" if s == "MULTIQC" else "OK") for s in STEPS]
    full += [("b", s, "SKIPPED" if s == "MULTIQC" else "OK") for s in STEPS]
    full += [("c", s, "RUNNING" if s == "FILTER" else "OK") for s in STEPS]
    got = st.last_incomplete_step(status(spark, full + [("d", "FASTP", "OK")]))
    assert as_tuples(got.fillna("none"), "sample", "step") == [("a", "MULTIQC"), ("b", "none"), ("c", "FILTER"), ("d", "MULTIQC")]


def test_stage_progress_counts_samples(spark):
    table = status(spark, [("a", "FASTP", "OK"), ("a", "SPADES", "FAIL"), ("b", "FASTP", "-"), ("b", "SPADES", "SKIPPED"),
                           ("c", "FILTER", "RUNNING"), ("c", "KRAKEN2-b", "SKIPPED"), ("c", "MULTIQC", "OK")])
    assert as_tuples(st.stage_progress(table), "stage", "n_run", "n_total") == [(1, 1, 3), (2, 1, 3), (3, 0, 3), (4, 0, 3)]


def test_steps_to_run(spark):
    rows = [("a", s, "OK") for s in STEPS if s not in ("SPADES", "FILTER", "QUAST-a")]
    rows += [("a", "SPADES", "FAIL"), ("a", "FILTER", "OK"), ("a", "QUAST-a", "OK"), ("b", "FASTP", "OK"), ("b", "QUAST-b", "OK"),
             ("b", "FILTER", "SKIPPED")]
    required = spark.createDataFrame([(r[0], r[1], f"/{r[0]}/{r[1]}") for r in rows], "sample string, step string, path string")
    files = required.select("path", F.when(F.col("path").isin("/a/FILTER", "/b/FASTP"), 0).otherwise(9).alias("length"))
    files = files.filter("path <> '/a/QUAST-a'")
    needs = spark.createDataFrame([("b", "QUAST-b", "/b/contigs")], "sample string, step string, path string")
    run = st.steps_to_run(status(spark, rows), required, files, skips(spark, "multiqc"), needs)
    got = {(r["sample"], r["step"]): r["decision"] for r in run.collect()}
    assert got["a", "SPADES"] == "RUN"  # the last step that is not done
    assert got["a", "FILTER"] == "RUN" and got["a", "QUAST-a"] == "RUN"  # output empty, output absent
    assert got["a", "MULTIQC"] == "SKIPPED" and got["b", "QUAST-b"] == "SKIPPED" and got["b", "FILTER"] == "SKIPPED"
    assert got["a", "FASTP"] == "KEEP" and got["b", "FASTP"] == "RUN"


def test_failed_step_with_output_is_kept_unless_asked(spark):
    rows = [("a", "FASTP", "FAIL"), ("a", "MULTIQC", "-")]
    required = spark.createDataFrame([("a", "FASTP", "/f")], "sample string, step string, path string")
    files = spark.createDataFrame([("/f", 1)], "path string, length bigint")
    for rerun, wanted in ((False, "KEEP"), (True, "RUN")):
        got = st.steps_to_run(status(spark, rows), required, files, skips(spark, "x"), rerun_failed=rerun)
        assert as_tuples(got.filter("step = 'FASTP'"), "decision") == [(wanted,)]


@pytest.mark.parametrize("size", [session.BROADCAST_BYTES, -1])
def test_error_digest(spark, monkeypatch, size):
    monkeypatch.setattr(session, "BROADCAST_BYTES", size)
    table = spark.createDataFrame([("a", "FASTP", "FAIL", "l1"), ("b", "FASTP", "FAIL", "went wrong"), ("c", "FASTP", "OK", "l1"),
                                   ("d", "GTDBTK-b", "FAIL", "l1")], "sample string, step string, status string, log_path string")
    lines = spark.createDataFrame([("l1", i, f"x{i}") for i in range(9)] + [("l2", 0, "y")], "file string, line_no bigint, line string")
    got = st.error_digest(table, lines, 2)
    assert as_tuples(got.fillna(-1), "sample", "step", "line_no", "line") == [
        ("a", "FASTP", 7, "x7"), ("a", "FASTP", 8, "x8"), ("b", "FASTP", -1, "went wrong"),
        ("d", "GTDBTK-b", 7, "x7"), ("d", "GTDBTK-b", 8, "x8")]


def test_duration(spark):
    table = spark.createDataFrame([(90061,), (59,), (360000,)], "s int")
    assert [r[0] for r in table.select(names.format_duration("s")).collect()] == ["25:01:01", "00:00:59", "100:00:00"]


def test_get_status_and_counts(spark):
    table = status(spark, [("a", "FASTP", "OK"), ("b", "FASTP", "OK"), ("b", "FILTER", "-")])
    assert st.get_status(table, "b", "FILTER").collect()[0][0] == "-"
    assert as_tuples(st.status_counts(table), "step", "status", "n") == [("FASTP", "OK", 2), ("FILTER", "-", 1)]


def test_streamed_status_equals_batch_over_several_batches(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("events", "out", "checkpoint"))
    rows = [("a", "FASTP", "RUNNING", at(1), 1), ("b", "FASTP", "RUNNING", at(1), 2), ("a", "FASTP", "OK", at(3), 3),
            ("a", "FASTP", "FAIL", at(2), 4), ("a", "OTHER", "OK", at(9), 5), ("b", "FASTP", "OK", at(1), 6)]
    for i in range(0, 6, 2):
        spark.createDataFrame(rows[i:i + 2], EVENTS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENTS).parquet(source)
        progress.write_progress(stream, out, checkpoint).awaitTermination()
    batch = st.latest_status(spark.createDataFrame(rows, EVENTS))
    columns = ("sample", "step", "status", "seq_no")
    assert as_tuples(progress.read_progress(spark, out), *columns) == as_tuples(batch, *columns) == [
        ("a", "FASTP", "OK", 3), ("b", "FASTP", "OK", 6)]
