import itertools
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from contigloom.llm import repeats, wordhash
from tests.llm.cases import DOCS, ODD, docs, prose


def brute(rows):
    """(doc_id, text) pairs to sorted (doc_id, n_words, n_removed, kept)"""
    split = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, float("inf")), float("inf") if i is None else i)
    out = []
    for i, w in split:
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < (float("inf") if i is None else i) for j in range(k, k + 13)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def check(spark, rows, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 3_000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    got = repeats.without_repeats(docs(spark, rows).withColumns({"batch": F.lit("x"), "n_words": F.lit(0)}))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_the_cover_brings_any_two_places_together():
    for a, b in itertools.product(range(repeats.PERIOD), repeat=2):
        assert any((a + d) % 7 in repeats.COVER and (b + d) % 7 in repeats.COVER for d in range(repeats.PERIOD))


def test_shared_passages_match_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    shared = [prose(n, 900 + n) for n in (12, 13, 14, 25, 60)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randrange(5, 60), i, 50_000)]
        for s in rng.sample(shared, 2):
            parts += [s, prose(rng.randrange(0, 9), 500 + i, 50_000)]
        rows.append((i * 3, "  \n".join(parts)))
    check(spark, rows, monkeypatch)


def test_odd_texts_ties_and_nulls(spark, monkeypatch):
    text = prose(40, 1)
    rows = [*enumerate(ODD, 10), (5, text), (5, text), (None, text), (None, text), (4, prose(20, 2)), (8, prose(20, 2)), (6, "é " * 20), (7, "é " * 14)]
    check(spark, rows, monkeypatch)


def test_empty_table(spark):
    assert repeats.without_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_words_of_one_sum_are_no_repeats(spark):
    """Two words that every sum of bytes times powers takes for each other, modulo two to the sixty-fourth."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    texts = [" ".join([w, *prose(12, 3).split()]) for w in (one, two)]
    got = {r["doc_id"]: r["n_removed"] for r in repeats.without_repeats(docs(spark, texts)).collect()}
    assert got == {0: 0, 1: 0}
    assert len(set(wordhash.words_of([one + " " + two]).hash.tolist())) == 2


def test_equal_hashes_of_different_words_are_told_apart(spark, monkeypatch):
    docs_ = pd.DataFrame({"doc_id": [1, 2, 3], "text": [prose(40, 1), prose(40, 2), prose(40, 1)], "batch": [0, 0, 0], "no_id": [False] * 3})
    batch = repeats._Batch(docs_)
    value, at = wordhash.windows(batch.words, repeats.WINDOW)
    own = repeats._distinct(np.zeros(len(value), np.uint64), batch.digests(at), batch.id_of_word[at])  # all of one hash
    assert len(own.value) == 2 * 28 and own.least.min() == 1 and sorted(set(own.least.tolist())) == [1, 2]


def test_hashes_of_words_of_all_lengths_differ():
    words = ["a" * n for n in range(1, 600)] + [f"w{i}" for i in range(5000)] + ["x" * 300 + str(i) for i in range(50)] + ["b" * n + "\0" for n in range(1, 30)]
    assert len(set(wordhash.words_of([" ".join(words), "  ".join(words)]).hash.tolist())) == len(words)
