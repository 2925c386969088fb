"""Small document tables with the odd cases that every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, lang="en", source="s", first=0):
    """One document per text, numbered; a (doc_id, text) pair gives its own number."""
    rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t)) for i, t in rows], DOCS)


def prose(words: int, seed: int, vocabulary: int = 5000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


ODD = [None, "", " \t\n ", "one", "é", "a b c d", "x " * 30_000]
