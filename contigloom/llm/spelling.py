"""Spelling variants of the corpus's words, grouped by PartEnum signatures of letter multisets.

A word's letters, each with its number among equal letters, are a binary vector. One inserted or deleted letter changes one of its
places, a replaced letter two, so near words are vectors at a Hamming distance of at most two. The places are dealt to ``PARTS``
partitions; two such vectors agree on at least ``PARTS`` - 2 of them, so a signature is enumerated for every choice of that
many partitions. As the one edit touches a word in one place, near words of ``LEAST`` letters or more also have the same first or
the same last ``AFFIX`` letters; signatures carry one or the other. Words that share a signature meet, and are verified letter by
letter, so no near pair is lost and none is wrong. A pair counts in the first signature that it shares only.

Buckets of more than ``BLOCK`` words aren't gathered: their words go on as patterns (one letter left open, or left out), which only
near words share. Each pattern belongs to at most as many words as there are letters to put in, so no group grows with the corpus.

Words are longest runs of letters ``A`` to ``Z`` in either case and U+00C0 to U+00FF, so each is one byte in Latin-1, and byte order
is code-point order. Null and empty texts have no words; a null doc_id is the empty text where typing errors are made. Repeated rows
count again. Ties between forms: the smallest word in code-point order. An empty table gives an empty result. Extra columns are left
out. Very long runs are words like others; texts are taken whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.llm.wordhash import mix
from contigloom.session import bound_arrow_batches, settle

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST = 7  # letters of a word
LEAST_COUNT = 2
TIMES = 10  # a form is at least so many times as frequent
TYPO = 31  # one run in so many has a letter deleted
PARTS, AFFIX = 4, 3
CHOICES = list(combinations(range(PARTS), PARTS - 2))
SIGNATURES = 2 * len(CHOICES)
BLOCK = 256
HELD_WORDS = 200_000  # counts that a task holds before it passes them on
PAIRS = 2_000_000  # that are compared at once


def counted_runs(doc_id: int | None, text: str | None) -> Counter:
    """The words of one text, each with its typing error if its hash says so."""
    lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # only A-Z
    out: Counter = Counter()
    name = "" if doc_id is None else str(doc_id)
    for run, n in Counter(r for r in RUN.findall(lowered) if len(r) >= LEAST).items():
        h = zlib.crc32(f"{name}:{run}".encode())
        word = run if h % TYPO else run[:h % len(run)] + run[h % len(run) + 1:]
        if len(word) >= LEAST:
            out[word] += n
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of each word that occurs at least ``LEAST_COUNT`` times. Kept in the shared folder."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for frame in frames:
            for doc_id, text in zip(frame["id"], frame["text"]):
                held.update(counted_runs(doc_id, text))
                if len(held) >= HELD_WORDS:
                    yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})

    bound_arrow_batches(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInPandas(count, "word string, n long")
    return settle(found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT))


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and letters (a row per word) of the words of each length, some thousand letters at a time."""
    length = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(length, kind="stable")
    at = 0
    while at < len(order):
        size = int(length[order[at]])
        end = int(np.searchsorted(length[order], size, side="right"))
        end = min(end, at + max(1, 4_000_000 // size))
        rows = order[at:end]
        yield rows, np.frombuffer(b"".join([words[i] for i in rows]), dtype=np.uint8).reshape(len(rows), size)
        at = end


def signatures(words: list[bytes]) -> np.ndarray:
    """The signatures of each word, one row each."""
    out = np.zeros((len(words), SIGNATURES), dtype=np.uint64)
    for rows, letters in _by_length(words):
        ordered = np.sort(letters, axis=1)
        first = np.zeros(ordered.shape, dtype=np.int64)  # where the run of equal letters begins
        new = ordered[:, 1:] != ordered[:, :-1]
        first[:, 1:] = np.where(new, np.arange(1, ordered.shape[1]), 0)
        place = np.arange(ordered.shape[1]) - np.maximum.accumulate(first, axis=1)  # number among equal letters
        element = mix(ordered.astype(np.uint64) << np.uint64(32) | place.astype(np.uint64) + np.uint64(1))
        part = (ordered.astype(np.int64) * 5 + place) % PARTS
        sums = [np.where(part == p, element, np.uint64(0)).sum(axis=1, dtype=np.uint64) for p in range(PARTS)]
        ends = []
        for side, affix in enumerate((letters[:, :AFFIX], letters[:, -AFFIX:])):
            code = np.full(len(rows), side + 1, dtype=np.uint64)
            for j in range(AFFIX):
                code = code * np.uint64(256) + affix[:, j].astype(np.uint64)
            ends.append(mix(code))
        for k, choice in enumerate(CHOICES):
            own = np.full(len(rows), k + 1, dtype=np.uint64)
            for p in choice:
                own = mix(own ^ mix(sums[p] + np.uint64(p + 1)))
            for side in (0, 1):
                out[rows, 2 * k + side] = mix(own + ends[side])
    return out


def near(a: bytes, b: bytes) -> bool:
    """Whether one letter inserted, deleted or replaced makes one of the other."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def _near_pairs(words: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``near`` for pairs of places in ``words``."""
    length = np.array([len(w) for w in words], dtype=np.int64)
    good = np.zeros(len(left), dtype=bool)
    likely = np.flatnonzero(np.abs(length[left] - length[right]) <= 1)
    width = 40
    wide = (length[left[likely]] > width) | (length[right[likely]] > width)
    for k in likely[wide]:
        good[k] = near(words[left[k]], words[right[k]])
    likely = likely[~wide]
    if len(likely):
        short = np.flatnonzero(length <= width)
        place = np.full(len(words), -1, dtype=np.int64)
        place[short] = np.arange(len(short))
        table = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in short]), dtype=np.uint8).reshape(len(short), width)
        for k in range(0, len(likely), PAIRS // width):
            own = likely[k:k + PAIRS // width]
            swap = length[left[own]] > length[right[own]]
            i, j = np.where(swap, right[own], left[own]), np.where(swap, left[own], right[own])
            a, b = table[place[i]], table[place[j]]
            differ = a != b
            at = np.where(differ.any(axis=1), differ.argmax(axis=1), width)  # where the first difference is
            replaced = (length[i] == length[j]) & (differ.sum(axis=1) == 1)
            rest = np.arange(width - 1) >= at[:, None]
            inserted = (length[i] + 1 == length[j]) & ~((a[:, :-1] != b[:, 1:]) & rest).any(axis=1)
            good[own] = replaced | inserted
    return good


_LINKS = "word binary, n_near long, least long, form binary"


def _links(words: list[bytes], counts: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
    """Per word of the near pairs given: how many, and the most frequent one as (minus its count, word)."""
    links: dict[bytes, list] = {}
    for i, j in zip(left.tolist(), right.tolist()):
        for a, b in ((i, j), (j, i)):
            best = (-int(counts[b]), words[b])
            own = links.get(words[a])
            if own is None:
                links[words[a]] = [1, best]
            else:
                own[0] += 1
                own[1] = min(own[1], best)
    return pd.DataFrame([(w, n, least, form) for w, (n, (least, form)) in links.items()], columns=["word", "n_near", "least", "form"])


def _first_shared(words: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The first signature that both words of each pair have."""
    used, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    sigs = signatures([words[i] for i in used])
    return (sigs[place[:len(left)]] == sigs[place[len(left):]]).argmax(axis=1)


def _runs(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches sorted by ``keys``, cut anew so that rows of one key stay together. Groups are bounded."""
    held: pd.DataFrame | None = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        last = np.logical_and.reduce([(frame[k] == frame[k].iloc[-1]).to_numpy() for k in keys])
        cut = int(np.argmax(last))  # sorted: from here on all are of the last key
        held = frame.iloc[cut:]
        if cut:
            yield frame.iloc[:cut]
    if held is not None:
        yield held


def _starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(frame), dtype=bool)
    for k in keys:
        own = frame[k].to_numpy()
        new[1:] |= own[1:] != own[:-1]
    new[0] = True
    return np.append(np.flatnonzero(new), len(frame))


def _all_pairs(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places within each (bounded) group, about ``PAIRS`` at a time."""
    lefts, rights, held = [], [], 0
    for a, b in zip(starts, starts[1:]):
        if b - a > 1:
            i, j = np.triu_indices(b - a, 1)
            lefts.append(i + a)
            rights.append(j + a)
            held += len(i)
            if held >= PAIRS:
                yield np.concatenate(lefts), np.concatenate(rights)
                lefts, rights, held = [], [], 0
    if held:
        yield np.concatenate(lefts), np.concatenate(rights)


def _small_buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near words within the buckets of (which, sig)."""
    for frame in _runs(frames, ["which", "sig"]):
        words, counts, which = frame["word"].tolist(), frame["n"].to_numpy(), frame["which"].to_numpy()
        for left, right in _all_pairs(_starts(frame, ["which", "sig"])):
            good = _near_pairs(words, left, right)
            left, right = left[good], right[good]
            if len(left):
                first = _first_shared(words, left, right) == which[left]
                yield _links(words, counts, left[first], right[first])


def patterns_of(word: bytes) -> list[tuple[int, bytes]]:
    """(kind, pattern): with one letter open (0); whole, and with one letter left out (1). Distinct."""
    open_ = [(0, word[:i] + b"\0" + word[i + 1:]) for i in range(len(word))]
    return [*open_, (1, word), *{(1, word[:i] + word[i + 1:]) for i in range(len(word))}]


def _patterns(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for a in range(0, len(frame), 1000):
            rows = [(w, s, k, p, word, n) for w, s, word, n in frame[["which", "sig", "word", "n"]].iloc[a:a + 1000].itertuples(index=False)
                    for k, p in patterns_of(word)]
            yield pd.DataFrame(rows, columns=["which", "sig", "kind", "pattern", "word", "n"])


def _by_pattern(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near words among those of each pattern: all where a letter is open, those with a letter more than the whole word else."""
    keys = ["which", "sig", "kind", "pattern"]
    for frame in _runs(frames, keys):
        words, counts, which = frame["word"].tolist(), frame["n"].to_numpy(), frame["which"].to_numpy()
        whole = np.array([k == 1 and w == p for k, p, w in zip(frame["kind"], frame["pattern"], words)])
        open_ = frame["kind"].to_numpy() == 0
        for left, right in _all_pairs(_starts(frame, keys)):
            good = open_[left] | (whole[left] != whole[right])
            left, right = left[good], right[good]
            if len(left):
                first = _first_shared(words, left, right) == which[left]
                yield _links(words, counts, left[first], right[first])


def near_words(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """word (Latin-1), n_near, least (minus the count of the most frequent near word) and form (that word)."""

    @F.pandas_udf("array<long>")
    def signed(words: pd.Series) -> pd.Series:
        return pd.Series(list(signatures(words.tolist()).view(np.int64)))

    parts = counts.sparkSession.sparkContext.defaultParallelism * 4
    rows = counts.select(F.encode("word", "ISO-8859-1").alias("word"), "n")
    rows = rows.select("word", "n", F.posexplode(signed.asNondeterministic()("word")).alias("which", "sig"))
    sizes = rows.groupBy("which", "sig").agg(F.count("*").alias("size"))
    shared = settle(rows.join(sizes.filter("size > 1"), ["which", "sig"]))
    small = shared.filter(F.col("size") <= block).drop("size").repartition(parts, "which", "sig").sortWithinPartitions("which", "sig")
    links = small.mapInPandas(_small_buckets, _LINKS)
    large = shared.filter(F.col("size") > block).drop("size")
    if not large.isEmpty():
        spread = large.mapInPandas(_patterns, "which int, sig long, kind int, pattern binary, word binary, n long")
        keys = ["which", "sig", "kind", "pattern"]
        links = links.unionByName(spread.repartition(parts, *keys).sortWithinPartitions(*keys).mapInPandas(_by_pattern, _LINKS))
    best = F.min(F.struct("least", "form")).alias("best_")
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best_.*")


def variant_groups(counts: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``counts`` (word, n).

    A form is at least ``TIMES`` as frequent as its word, so a way to the root has no more steps than the greatest count has digits.
    """
    links = near_words(counts).select(F.decode("word", "ISO-8859-1").alias("word"), "n_near", F.decode("form", "ISO-8859-1").alias("best"), (-F.col("least")).alias("best_n"))
    good = F.col("best_n") >= TIMES * F.col("n")
    rows = settle(counts.join(links, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")))
    steps = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps that are taken
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next_"))
        taken = settle(steps.join(on, "root", "left").select("word", F.coalesce("next_", "root").alias("root"), F.col("next_").isNotNull().alias("moved_")))
        steps = taken.drop("moved_")
        if taken.filter("moved_").isEmpty():
            break
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
