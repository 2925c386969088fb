import re
from collections import Counter

from pyspark.sql import functions as F

from contigloom.llm import quality
from tests.conftest import plan_of
from tests.llm.cases import DOCS, ODD, docs, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_counts_match_brute_force(spark):
    texts = [*ODD, "a b c a b c", "l1\nl1\n \nl2 # *\nl1", prose(80, 1) + "\n" + prose(80, 1), "é\x0bü\x0cß " * 40]
    got = quality.quality_rules(docs(spark, texts)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[c] for c in names) for r in got} == {i: brute(t) for i, t in enumerate(texts)}


def test_outliers_of_a_group_go_and_clean_documents_stay(spark):
    good = [prose(120 + i % 40, i) for i in range(120)]
    noisy = [" | ".join(prose(60, 1000 + i).split()) for i in range(5)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs(spark, good + noisy)).collect()}
    assert all(got[i] for i in range(120))
    assert not any(got[i] for i in range(120, 125))


def test_small_groups_share_their_language_and_null_names_are_a_group(spark):
    rows = docs(spark, [prose(100, i) for i in range(60)]).withColumn("source", F.when(F.col("doc_id") > 55, F.lit("small")))
    rows = rows.unionByName(docs(spark, [" | ".join(prose(80, 7).split())], first=100, source="small"))
    rows = rows.unionByName(docs(spark, [" | ".join(prose(80, 8).split())], first=101, lang="xx"))
    got = {r["doc_id"]: (r["kept"], r["distance"]) for r in quality.quality_rules(rows).collect()}
    assert not got[100][0]  # judged with all English documents
    assert not got[101][0] and got[101][1] > 28  # the only one of its language: judged with all documents


def test_every_feature_can_reject_alone(spark):
    good = [f"{prose(60, i)}\n{prose(60, 500 + i)}" for i in range(120)]
    long_words = " ".join("w" * 14 for _ in range(1)) + " " + " ".join(f"{w}{'x' * 12}" for w in prose(119, 901).split())
    symbols = " ".join(f"{w}#" for w in prose(120, 902).split())
    lines = "\n".join([prose(100, 903)] + ["w1 w2"] * 12)
    part = prose(20, 904)
    repeats = " ".join([part, prose(25, 905), part, prose(25, 906)])
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.quality_rules(docs(spark, good + [long_words, symbols, lines, repeats])).collect()}
    assert all(got[i] == (False, True) for i in range(120))
    assert [got[i] for i in range(120, 124)] == [(False, False)] * 4


def test_a_language_of_three_documents_is_judged(spark):
    rows = docs(spark, [prose(100, i) for i in range(60)]).unionByName(
        docs(spark, [prose(90, 77), " ".join(["######"] * 100 + prose(99, 5).split()), prose(95, 78)], lang="xx", first=200))
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(rows).collect()}
    assert [got[i] for i in (200, 201, 202)] == [True, False, True]


def test_no_text_is_shuffled_and_each_is_measured_once(spark):
    rows = docs(spark, [prose(70 + i, i) for i in range(80)])
    plan = plan_of(quality.keep_good(rows))
    assert "Exchange hashpartitioning" not in plan and plan.count("ArrowEvalPython") == 1


def test_keep_good_keeps_columns_and_takes_clashing_names(spark):
    rows = docs(spark, [*ODD, *[prose(70, i) for i in range(3)], prose(70, 0)]).withColumns(
        {"kept": F.lit("mine"), "n_words": F.lit(-1), "row_": F.lit(1), "mean": F.lit(2.0)})
    kept = quality.keep_good(rows)
    assert kept.columns == rows.columns
    assert {(r["doc_id"], r["kept"], r["n_words"]) for r in kept.collect()} == {(len(ODD) + i, "mine", -1) for i in range(4)}


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert quality.quality_rules(none).count() == 0
    assert quality.keep_good(none).count() == 0
