import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from contigloom.llm import spelling
from contigloom.llm.queries import table
from tests.conftest import SF, plan_of
from tests.llm.cases import DOCS, ODD, docs


def brute_counts(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def brute_groups(counts):
    """By all words that one edit makes of each word."""
    letters = sorted({c for w in counts for c in w})
    near = defaultdict(set)
    for w in counts:
        for i in range(len(w) + 1):
            own = {w[:i] + c + w[i:] for c in letters} | {w[:i] + c + w[i + 1:] for c in letters if i < len(w)} | {w[:i] + w[i + 1:]}
            near[w] |= {v for v in own if v in counts and v != w}
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: b for w, b in best.items() if counts[b] >= 10 * counts[w]}
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None)
    return out


def collected(frame):
    rows = frame.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_words_and_groups_of_the_documents_match_brute_force(spark):
    rows = table(spark, SF, "documents")
    counts = spelling.word_counts(rows)
    want = brute_counts([(r["doc_id"], r["text"]) for r in rows.collect()])
    assert {r["word"]: r["n"] for r in counts.collect()} == want
    assert collected(spelling.variant_groups(counts)) == brute_groups(want)


def vocabulary(seed, stems=40, letters="abcdé"):
    """Words in clusters of near ones, anagrams among them, with counts of all sizes."""
    rng, out = random.Random(seed), {}
    for _ in range(stems):
        word = "".join(rng.choices(letters, k=rng.randrange(7, 12)))
        for _ in range(8):
            i, c = rng.randrange(len(word)), rng.choice(letters)
            word = rng.choice([word[:i] + c + word[i:], word[:i] + c + word[i + 1:], word[:i] + word[i + 1:], "".join(rng.sample(word, len(word)))])
            if len(word) >= 7:
                out[word] = rng.choice([2, 3, 20, 25, 300, 4000])
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_clusters_match_brute_force_with_small_and_large_buckets(spark, block, monkeypatch):
    counts = vocabulary(1)
    counts |= {"x" * 60: 2, "x" * 61: 30, "x" * 59 + "y": 40, "x" * 62: 400}  # longer than what is compared at once
    monkeypatch.setattr(spelling.near_words, "__defaults__", (block,))
    got = collected(spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute_groups(counts)
    assert any(form != root for form, root, *_ in got.values() if form)  # ways of more than one step


def test_every_near_pair_shares_a_signature():
    rng = random.Random(4)
    for _ in range(300):
        word = bytes(rng.choices(range(97, 110), k=rng.randrange(7, 20)))
        i, c = rng.randrange(len(word)), bytes([rng.randrange(97, 123)])
        for other in (word[:i] + c + word[i:], word[:i] + c + word[i + 1:], word[:i] + word[i + 1:]):
            if len(other) >= spelling.LEAST and other != word:
                a, b = spelling.signatures([word, other])
                assert (a == b).any() and spelling.near(word, other)


def test_hot_buckets_are_spread_by_patterns_that_few_words_share():
    counts = Counter(p for w in vocabulary(2, 200, "abcdefgh") for p in spelling.patterns_of(w.encode("latin-1")))
    longest = max(len(w) for w in vocabulary(2, 200, "abcdefgh"))
    assert max(counts.values()) <= 1 + (longest + 1) * 8


def test_odd_texts_ties_repeats_and_clashing_columns(spark):
    texts = [*ODD, "Wonderful wonderful WONDERFUL wonderfuls ÀÉÎÕÜ×÷ àéîõüß× x" * 5, "tie" * 5 + "a " + "tie" * 5 + "b"]
    rows = [*enumerate(texts, 1), (None, "wonderful wonderful"), (7, texts[6]), (99, "q" * 40_000 + " " + "q" * 40_000)]
    frame = docs(spark, rows).withColumns({"word": F.lit(1), "n": F.lit("x"), "sig": F.lit(2.0), "id": F.lit("y")})
    want = brute_counts(rows)
    counts = spelling.word_counts(frame)
    assert {r["word"]: r["n"] for r in counts.collect()} == want
    wide = spark.createDataFrame([("abcdefgh", 40), ("abcdefgi", 40), ("abcdefgj", 2)], "word string, n long").withColumn("form", F.lit(9))
    assert collected(spelling.variant_groups(wide))["abcdefgj"] == ("abcdefgh", "abcdefgh", 2, 2, 40)


def test_empty_tables(spark):
    assert spelling.word_counts(spark.createDataFrame([], DOCS)).count() == 0
    got = spelling.variant_groups(spark.createDataFrame([], "word string, n long"))
    assert got.count() == 0 and got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_no_cross_join(spark):
    plan = plan_of(spelling.variant_groups(spark.createDataFrame([("abcdefgh", 4)], "word string, n long")))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
