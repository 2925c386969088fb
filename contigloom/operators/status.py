"""Progress of samples through the sixteen steps.

Inside, status is long: ``sample, step, status`` (``ts, seq_no, log_path`` where an operator names
them), pending written ``-``. A (sample, step) without a row is pending. The wide table is a view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contigloom.operators.pairs import tail_lines
from contigloom.schemas import FAIL, OK, OPTIONAL_TOOLS, PENDING, SKIPPED, STAGES, STEPS
from contigloom.session import fits_broadcast


def expand_sample_steps(samples: DataFrame, steps: list[str] = STEPS) -> DataFrame:
    """Every sample with every step, pending."""
    return samples.select(
        "sample", F.explode(F.lit(list(steps))).alias("step"),
        F.lit(PENDING).alias("status"))


def known_steps(skip: DataFrame) -> DataFrame:
    """Requested names that are steps, spelled as the steps are; at most sixteen rows."""
    spelled = F.expr("map(" + ", ".join(f"'{s.upper()}', '{s}'" for s in STEPS) + ")")
    return (skip.select(F.try_element_at(spelled, F.upper("name")).alias("step"))
            .filter("step is not null").distinct())


def dedupe_skips(skip: DataFrame) -> DataFrame:
    return known_steps(skip)


def unknown_skips(skip: DataFrame) -> DataFrame:
    """Requested names that are no step; the caller warns about them."""
    return skip.filter(~F.upper("name").isin([s.upper() for s in STEPS])).select("name").distinct()


def select_steps(steps: DataFrame, skip: DataFrame) -> DataFrame:
    """Steps that are not skipped, in any spelling of the names."""
    return steps.join(F.broadcast(known_steps(skip)), "step", "left_anti")


def latest_status(events: DataFrame) -> DataFrame:
    """The last status of each sample and step, by ``ts`` and then ``seq_no``."""
    at = F.struct("ts", "seq_no")
    return (events.filter(F.col("step").isin(STEPS)).groupBy("sample", "step")
            .agg(F.max_by("status", at).alias("status"), F.max(at).alias("_at"))
            .select("sample", "step", "status", "_at.ts", "_at.seq_no"))


def upsert_status(status: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply updates: the last write of a cell wins, unknown steps are ignored."""
    return latest_status(status.unionByName(updates))


def status_matrix(status: DataFrame) -> DataFrame:
    """One row per sample, one column per step; a cell without a row is pending."""
    cells = [F.expr(f"coalesce(max(case when step = '{s}' then status end), '{PENDING}') as `{s}`") for s in STEPS]
    return status.groupBy(F.col("sample").alias("Sample")).agg(*cells)


def get_status(status: DataFrame, sample: str, step: str) -> DataFrame:
    return status.filter((F.col("sample") == sample) & (F.col("step") == step)).select("status")


def reconcile_skips(status: DataFrame, skip: DataFrame, enabled_tools: list[str]) -> DataFrame:
    """Skipped steps and steps of tools not enabled become ``SKIPPED``; others lose that mark."""
    disabled = [s for tool, steps in OPTIONAL_TOOLS.items() if tool not in enabled_tools for s in steps]
    asked = F.broadcast(known_steps(skip).withColumn("_asked", F.lit(True)))
    skipped = F.col("_asked").isNotNull() | F.col("step").isin(disabled)
    new = (F.when(skipped, F.lit(SKIPPED)).when(F.col("status") == SKIPPED, F.lit(PENDING))
           .otherwise(F.col("status")))
    return status.join(asked, "step", "left").withColumn("status", new).select(status.columns)


def done(status: str = "status") -> Column:
    return F.col(status).isin(OK, SKIPPED)


def _latest_left(finished: str) -> Column:
    """The latest step that is not among ``finished``."""
    latest_first = F.expr("array(" + ", ".join(f"'{s}'" for s in reversed(STEPS)) + ")")
    return F.get(F.array_except(latest_first, F.col(finished)), F.lit(0))


def last_incomplete_step(status: DataFrame) -> DataFrame:
    """Per sample the latest step that is neither OK nor skipped; NULL when none is left."""
    finished = F.collect_set(F.when(done(), F.col("step")))  # at most sixteen names
    return status.groupBy("sample").agg(finished.alias("_done")).select("sample", _latest_left("_done").alias("step"))


def stage_progress(status: DataFrame) -> DataFrame:
    """Per counted stage: samples with any step neither pending nor skipped, and all samples."""
    active = ~F.col("status").isin(PENDING, SKIPPED)
    seen = status.withColumn("_active", active)
    per_sample = seen.groupBy("sample").agg(*[
        F.max(F.col("_active") & F.col("step").isin(steps)).alias(f"s{stage}") for stage, steps in STAGES.items()])
    totals = per_sample.agg(F.count("*").alias("n_total"),
                            *[F.count_if(f"s{stage}").alias(f"s{stage}") for stage in STAGES])
    rows = F.explode(F.array(*[
        F.struct(F.lit(stage).alias("stage"), F.col(f"s{stage}").alias("n_run")) for stage in STAGES]))
    return totals.select(rows.alias("r"), "n_total").select("r.stage", "r.n_run", "n_total")


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("step", "status").agg(F.count("*").alias("n"))


def steps_to_run(status: DataFrame, required: DataFrame, files: DataFrame, skip: DataFrame,
                 needs: DataFrame | None = None, rerun_failed: bool = False) -> DataFrame:
    """``sample, step, decision`` for every row of ``status``, taken after :func:`reconcile_skips`.

    ``SKIPPED`` when the step is skipped or an input named in ``needs`` is missing or empty; else ``RUN``
    when it is the sample's last incomplete step or a required output is missing or empty; else
    ``KEEP``. ``required`` and ``needs`` are ``sample, step, path``; ``files`` is ``path, length``. A failed
    step whose outputs exist is kept unless it is the last one, or ``rerun_failed`` is set.
    """
    present = files.filter("length > 0").select("path").distinct()
    wanted = required.select("sample", "step", "path", F.lit(True).alias("_made"))
    if needs is not None:
        wanted = wanted.unionByName(needs.select("sample", "step", "path", F.lit(False).alias("_made")))
    absent = wanted.join(present, "path", "left_anti").select(
        "sample", "step", F.lit(None).cast("string").alias("status"), F.lit(False).alias("_row"), F.col("_made").alias("_no_output"), (~F.col("_made")).alias("_no_input"))
    rows = status.select("sample", "step", "status", F.lit(True).alias("_row"), F.lit(False).alias("_no_output"), F.lit(False).alias("_no_input"))
    # all is known of a sample where its rows meet: one shuffle, and the cells are parts of it
    sample, cell = Window.partitionBy("sample"), Window.partitionBy("sample", "step")
    known = rows.unionByName(absent).withColumn("_done", F.collect_set(F.when(F.col("_row") & done(), F.col("step"))).over(sample))  # sixteen names at most
    known = known.withColumns({c: F.max(c).over(cell) for c in ("_no_output", "_no_input")}).filter("_row")
    asked = F.broadcast(known_steps(skip).withColumn("_asked", F.lit(True)))
    known = known.join(asked, "step", "left")
    blocked = F.col("_asked").isNotNull() | (F.col("status") == SKIPPED) | F.col("_no_input")
    run = F.coalesce(F.col("step") == _latest_left("_done"), F.lit(False)) | F.col("_no_output")
    if rerun_failed:
        run = run | (F.col("status") == FAIL)
    decision = F.when(blocked, "SKIPPED").when(run, "RUN").otherwise("KEEP")
    return known.select("sample", "step", decision.alias("decision"))


def error_digest(status: DataFrame, log_lines: DataFrame, n: int = 5, files: DataFrame | None = None) -> DataFrame:
    """For each failed step the last ``n`` lines of its log.

    ``log_path`` is matched to ``log_lines.file``; a cohort log, read once per step, counts once. When it is no log file, it is the
    message itself and gives one row with ``line_no`` NULL. ``files(path)`` lists the log files that there are: one without lines
    gives no row. Without it, the files are those with lines. Unless few logs are wanted, which a broadcast picks out, lines are
    cut to ``n`` per log before any join, so a huge log is never shuffled.
    """
    failed = status.filter((F.col("status") == FAIL) & (F.col("log_path") != "")).select(
        "sample", "step", "log_path")
    logs = failed.select(F.col("log_path").alias("file")).distinct()
    lines = log_lines.select("file", "line_no", "line")
    if "step" in log_lines.columns:  # a cohort log comes once for each of its steps
        first = F.min("step").over(Window.partitionBy("file", "line_no"))
        lines = log_lines.filter("sample is not null").select("file", "line_no", "line").unionByName(
            log_lines.filter("sample is null").withColumn("_first", first).filter("step = _first").select("file", "line_no", "line"))
    if fits_broadcast(logs)[0]:
        lines = lines.join(F.broadcast(logs), "file", "left_semi")
    tails = tail_lines(lines, n)
    joined = failed.join(tails, failed["log_path"] == tails["file"], "left")
    if files is not None:
        empty = files.select(F.col("path").alias("log_path")).distinct().withColumn("_empty", F.lit(True))
        joined = joined.join(empty, "log_path", "left").filter("file is not null or _empty is null")
    return joined.select("sample", "step", "line_no",
                         F.when(F.col("file").isNull(), F.col("log_path")).otherwise(F.col("line")).alias("line"))


def step_durations(events: DataFrame) -> DataFrame:
    """Seconds from the first to the last event of each sample."""
    span = F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))
    return events.groupBy("sample").agg(span.alias("seconds"))
