"""Quality rules: base word rules, then robust multivariate outliers per language and source.

The transformed statistics of a document form a vector. Per (lang, source) the minimum covariance determinant estimate
is found by concentration steps run as Spark aggregates: distances of all documents, the group's quantile of them, and
mean and covariance of the documents within it. Steps start from medians and from disjoint random eighths of the group, go on
until no determinant falls any more, and the start with the least determinant is taken. Documents with a large Mahalanobis
distance are rejected. All documents count at every step; a group is never gathered. A source with few documents is judged with
its language, a language with few with all documents, so every document that passes the base rule has a distance.

Null or empty text: no words, so the base rule fails it. Null language or source: the group of the empty name. Equal rows
get equal verdicts. An empty table gives an empty result. Extra columns pass through; columns with this module's own
names are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigloom.llm.wordhash import in_chunks, mix, windows, words_of
from contigloom.session import bound_arrow_batches, broadcast_if_small, settle

STATS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
#: Least standard deviation of each feature: smaller differences between documents say nothing about quality.
#: Small enough that each feature alone can reach the cutoff.
LEAST_SD = (0.10, 0.35, 0.15, 0.11)
SHARE = 0.75  # of a group's documents that the estimate rests on
RANDOM_STARTS = 2
SETTLED = 0.01  # steps end when no group's log determinant falls by more
MOST_STEPS = 25  # steps always end by themselves; sketched quantiles may make one waver about its end
MIN_GROUP = 50  # documents; smaller groups are judged by the next wider one
CUTOFF = 0.99999  # quantile of the distance that a document of the group has


def text_statistics(texts: list[str | None]) -> pd.DataFrame:
    """The counts in ``STATS`` of each text."""
    n = len(texts)
    out = {c.split()[0]: np.zeros(n, dtype=np.int64) for c in STATS.split(", ")}
    for first, part in in_chunks(texts):
        words = words_of(part)
        out["n_words"][first:first + len(part)] = np.bincount(words.text, minlength=len(part))
        value, at = windows(words, 3)
        if len(at):
            value = mix(value + words.text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(value, kind="stable")
            same = value[order][1:] == value[order][:-1]
            twice = np.zeros(len(value), dtype=bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            covered = np.zeros(len(words.hash), dtype=bool)
            for j in range(3):
                covered[at[twice] + j] = True
            out["n_repeat_words"][first:first + len(part)] = np.bincount(words.text[covered], minlength=len(part))
        for i, text in enumerate(part, first):
            if text:
                out["word_chars"][i] = len(text) - sum(text.count(c) for c in BLANKS)
                out["n_symbols"][i] = sum(text.count(c) for c in SYMBOLS)
                lines = [x for x in text.split("\n") if x.strip(BLANKS)]
                out["n_lines"][i] = len(lines)
                out["n_dup_lines"][i] = len(lines) - len(set(lines))
    return pd.DataFrame(out)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts and ``base_failed``. Each text is measured once, whatever is done with the counts."""

    @F.pandas_udf(STATS)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield text_statistics(texts.tolist())

    bound_arrow_batches(docs.sparkSession)
    names = [c.split()[0] for c in STATS.split(", ")]
    taken = docs.drop(*names, "base_failed", "quality_stats").withColumn("quality_stats", measure.asNondeterministic()(F.col(text)))
    return (taken.withColumns({c: F.col(f"quality_stats.{c}") for c in names}).drop("quality_stats")
            .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def _features() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "symbols": F.log1p(100 * F.col("n_symbols") / words),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
    }


def _chi2(x: float, p: int) -> float:
    """Distribution function for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(p // 2))


def _chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(80):
        low, high = ((low + high) / 2, high) if _chi2((low + high) / 2, p) < q else (low, (low + high) / 2)
    return low


KEYS = ["g_level", "g_lang", "g_source"]
LEVELS = ("source", "language", "all")  # a wider level has empty names


def _keyed(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"g_lang": F.coalesce("lang", F.lit("")), "g_source": F.coalesce("source", F.lit(""))})


def _distance(value, mean: Column, inverse: Column) -> Column:
    """Squared distance of the features, each given by ``value(name)``."""
    p = len(FEATURES)
    gap = [value(f) - mean[i] for i, f in enumerate(FEATURES)]
    return sum(gap[i] * gap[j] * inverse[i * p + j] for i in range(p) for j in range(p))


def _inverted(groups: DataFrame) -> DataFrame:
    """Groups with ``mean`` and ``cov`` to groups with ``mean``, ``inverse`` and ``log_det``; one small matrix per row."""
    p, least = len(FEATURES), np.diag(np.square(LEAST_SD))

    @F.pandas_udf("inverse array<double>, log_det double")
    def inverse(cov: pd.Series) -> pd.DataFrame:
        full = [np.asarray(c, dtype=float).reshape(p, p) + least for c in cov]
        return pd.DataFrame({"inverse": [np.linalg.inv(c).ravel() for c in full], "log_det": [np.linalg.slogdet(c)[1] for c in full]})

    return groups.filter("mean[0] is not null").withColumn("m_", inverse.asNondeterministic()("cov")).select(*KEYS, "start", "mean", "m_.*")


def fit_groups(stats: DataFrame) -> DataFrame:
    """One row per group that is judged: g_level, g_lang, g_source, mean, inverse. Kept in the shared folder.

    ``stats``: rows with lang, source and the counts. Documents that fail the base rule don't count. The sources of a language
    that hold fewer than ``MIN_GROUP`` documents are judged with all of the language, and languages that do with all documents.

    The estimates are broadcast if measured small (one row of 22 numbers for each group and start), so only partial sums and
    quantile sketches are shuffled, however many documents a group has.
    """
    p = len(FEATURES)
    rows = settle(_keyed(stats.filter(~F.col("base_failed"))).withColumns(_features()).select("g_lang", "g_source", *FEATURES))
    none = F.lit("")
    level = F.explode(F.array(*[F.struct(F.lit(name).alias("g_level"), (none if name == "all" else F.col("g_lang")).alias("g_lang"),
                                         (F.col("g_source") if name == "source" else none).alias("g_source")) for name in LEVELS]))
    both = rows.select(level.alias("g_"), *FEATURES).select("g_.*", *FEATURES)  # each document counts on every level
    middle = both.groupBy(*KEYS).agg(F.count("*").alias("n"), F.array(*[F.percentile_approx(f, 0.5, 10000) for f in FEATURES]).alias("mean"))
    middle = settle(middle.filter((F.col("n") >= MIN_GROUP) | (F.col("g_level") == "all")).drop("n"))
    gaps = [F.abs(F.col(f) - F.col("mean")[i]) for i, f in enumerate(FEATURES)]
    spread = both.join(broadcast_if_small(middle), KEYS).groupBy(*KEYS).agg(
        F.first("mean").alias("mean"), *[F.percentile_approx(g, 0.5, 10000).alias(f"mad{i}") for i, g in enumerate(gaps)])
    cov = F.array(*[F.pow(F.col(f"mad{i}") * 1.4826, 2) if i == j else F.lit(0.0) for i in range(p) for j in range(p)])
    robust = spread.select(*KEYS, F.lit(0).alias("start"), "mean", cov.alias("cov"))
    # makes the covariance of the inner documents that of all, if they are normal
    factor = SHARE / _chi2(_chi2_quantile(SHARE, p), p + 2)
    sums = [F.array(*[F.avg(f) for f in FEATURES]).alias("mean"),
            F.array(*[F.covar_pop(a, b) * factor for a in FEATURES for b in FEATURES]).alias("cov")]
    eighth = both.withColumn("start", 1 + F.pmod(F.xxhash64(*FEATURES), F.lit(8)).cast("int")).filter(F.col("start") <= RANDOM_STARTS)
    random = eighth.join(broadcast_if_small(middle.select(*KEYS)), KEYS).groupBy(*KEYS, "start").agg(*sums)
    groups = settle(_inverted(robust.unionByName(random)))
    far = _distance(F.col, F.col("mean"), F.col("inverse"))
    for _ in range(MOST_STEPS):
        near = both.join(broadcast_if_small(groups), KEYS)
        edge = settle(near.groupBy(*KEYS, "start").agg(F.percentile_approx(far, SHARE, 10000).alias("edge")))
        inner = both.join(broadcast_if_small(groups.join(edge, [*KEYS, "start"])), KEYS).filter(far <= F.col("edge"))
        after = settle(_inverted(inner.groupBy(*KEYS, "start").agg(*sums)))
        fallen = groups.select(*KEYS, "start", F.col("log_det").alias("before")).join(after, [*KEYS, "start"])
        most = fallen.agg(F.max(F.col("before") - F.col("log_det"))).first()[0]
        groups = after
        if most is None or most <= SETTLED:
            break
    best = groups.groupBy(*KEYS).agg(F.min_by(F.struct("mean", "inverse"), F.struct("log_det", "start")).alias("b_"))
    return settle(best.select(*KEYS, "b_.*"))


def judged(stats: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with ``distance`` (squared; null if no document passes the base rule) and ``kept``."""
    rows = _keyed(stats).withColumn("est_f", F.struct(*[e.alias(c) for c, e in _features().items()])).withColumn("est_any", F.lit(1))
    for name, on in zip(LEVELS, (["g_lang", "g_source"], ["g_lang"], ["est_any"])):
        own = groups.filter(F.col("g_level") == name).select(*KEYS[1:], F.lit(1).alias("est_any"), F.struct("mean", "inverse").alias(f"est_{name}"))
        rows = rows.join(broadcast_if_small(own.select(*on, f"est_{name}")), on, "left")
    rows = rows.withColumn("est_", F.coalesce(*[f"est_{name}" for name in LEVELS]))
    rows = rows.withColumn("distance", _distance(lambda f: F.col(f"est_f.{f}"), F.col("est_.mean"), F.col("est_.inverse")))
    near = F.coalesce(F.col("distance") <= _chi2_quantile(CUTOFF, len(FEATURES)), F.lit(True))
    rows = rows.withColumn("kept", ~F.col("base_failed") & near)
    return rows.drop("g_lang", "g_source", "est_any", "est_f", "est_", *[f"est_{name}" for name in LEVELS])


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns.

    The statistics are measured twice, once for the estimates and once with the text at hand, so that no text is shuffled: the
    estimates are broadcast as long as they are measured to be small.
    """
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row_"), "lang", "source")
    groups = fit_groups(settle(with_statistics(docs.select("text", "lang", "source")).drop("text")))
    return judged(with_statistics(held, "row_.text"), groups).filter("kept").select("row_.*")


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, distance and kept of each document."""
    stats = settle(with_statistics(docs.select("doc_id", "text", "lang", "source")).drop("text"))
    return judged(stats, fit_groups(stats))
