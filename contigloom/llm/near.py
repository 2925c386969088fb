"""N-gram Jaccard join by a MinHash LSH forest, with exact verification.

A document is the set of its five-word shingles (words as they are; a shorter text is one shingle). ``TREES`` sorted tries
hold the documents' signatures, ``DEPTH`` values each. Two documents are candidates if they share a prefix in some tree. A pair
of similarity s shares k values in one of L trees with the chance 1 - (1 - s^k)^L. Prefixes are shortened step by step to the
longest at which that chance reaches ``RECALL`` for a pair right at the threshold, so the bound holds for every wanted pair,
whatever the others are like. All candidates seen are verified on their whole shingle sets.

Copies (equal texts) are one vertex: they are counted, not expanded. Buckets are split into blocks of at most ``BLOCK`` documents,
and each pair of blocks is a task's work of its own, so no bucket meets in one task. A pair that shares several buckets is
verified in the first of its trees only; both signatures show which. Pairs are counted where they are found: what leaves
a task is one row per document, with its links there and a representative of those it is linked with.

Null and empty texts have no shingles: no links, a class of their own each. Documents with equal text and repeated rows are
in one class. Ties: the class has the id of its smallest doc_id (null counts as greatest). An empty table gives an
empty result. Extra columns are left out by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.llm.components import components
from contigloom.llm.wordhash import in_chunks, windows, words_of
from contigloom.session import settle

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 6
RECALL = 0.9999
BLOCK = 1024
SURE = 0.25  # a pair whose signatures agree by this much less than the threshold is no match (six standard deviations)
GROUP = ["tree", "key", "bi", "bj"]


def chance(similarity: float, depth: int, trees: int = TREES) -> float:
    """That a pair shares a prefix of so many values in at least one tree."""
    return 1 - (1 - similarity ** depth) ** trees


def shortest_depth(threshold: float, recall: float) -> int:
    return max([k for k in range(1, DEPTH + 1) if chance(threshold, k) >= recall], default=1)


_SEEDS = np.random.default_rng(20240229).integers(1, 2 ** 63, (2, TREES * DEPTH), dtype=np.uint64)


def shingles_of(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for _, part in in_chunks(texts):
        words = words_of(part)
        value, at = windows(words, SHINGLE)
        bounds = words.bounds(len(part))
        cut = np.searchsorted(at, bounds)
        for i in range(len(part)):
            own = value[cut[i]:cut[i + 1]]
            n = bounds[i + 1] - bounds[i]
            if 0 < n < SHINGLE:
                short = words._replace(hash=words.hash[bounds[i]:bounds[i + 1]], text=words.text[bounds[i]:bounds[i + 1]])
                own = windows(short, n)[0] + np.uint64(n)
            out.append(np.unique(own))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The forest's values of each set that isn't empty, one row each."""
    if not sets:
        return np.zeros((0, TREES * DEPTH), dtype=np.uint16)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), TREES * DEPTH), dtype=np.uint16)
    for j in range(TREES * DEPTH):
        least = np.minimum.reduceat((flat ^ _SEEDS[0, j]) * (_SEEDS[1, j] | np.uint64(1)), starts)
        out[:, j] = (least >> np.uint64(17)).astype(np.uint16)  # bits that being the least says nothing about
    return out


def signed(docs: DataFrame) -> DataFrame:
    """uid, doc_id, digest of the text, sig (null without words). Kept in the shared folder."""

    @F.pandas_udf("binary")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out: list[bytes | None] = [None] * len(texts)
            for first, part in in_chunks(texts.tolist()):
                sets = shingles_of(part)
                full = [i for i, s in enumerate(sets) if len(s)]
                for i, row in zip(full, signatures([sets[i] for i in full])):
                    out[first + i] = row.tobytes()
            yield pd.Series(out, dtype=object)

    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), sign("text").alias("sig"))
    return settle(rows.withColumn("uid", F.monotonically_increasing_id()))


def _shared(sig: np.ndarray, i: int, others: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of document i with each of ``others``: first tree with a common prefix of ``depth``, greatest common prefix, agreement."""
    same = sig[others] == sig[i]
    runs = np.cumprod(same.reshape(len(others), TREES, DEPTH), axis=2, dtype=np.uint8).sum(axis=2)
    return (runs >= depth).argmax(axis=1), runs.max(axis=1), same.mean(axis=1)


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each group, from batches sorted by it. A group is at most two blocks."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[GROUP].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts, len(batch)]
        for a, b in zip(bounds, bounds[1:]):
            part = batch.iloc[a:b]
            if held and (held[-1][GROUP].iloc[-1].to_numpy() != part[GROUP].iloc[0].to_numpy()).any():
                yield held[0] if len(held) == 1 else pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held)


def _pairs(group: pd.DataFrame, shortest: int, threshold: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(i, its later partners, common prefix, agreement): candidates that belong to this group's tree and blocks."""
    sig = np.frombuffer(b"".join(group["sig"]), dtype=np.uint16).reshape(len(group), -1)
    tree, bi, bj = (int(group[c].iloc[0]) for c in ("tree", "bi", "bj"))
    side = group["side"].to_numpy()
    if bi == bj:
        firsts, rest = range(len(sig) - 1), None
    else:
        firsts, rest = np.flatnonzero(side == bi), np.flatnonzero(side == bj)
    for i in firsts:
        others = np.arange(i + 1, len(sig)) if rest is None else rest
        if not len(others):
            continue
        first, depth, agree = _shared(sig, i, others, shortest)
        good = (first == tree) & (depth >= shortest) & (agree >= threshold - SURE)
        if good.any():
            yield int(i), others[good], depth[good], agree[good]


def bucketed(reps: DataFrame, shortest: int) -> DataFrame:
    """Documents (uid, sig, ...) in the blocks of every bucket that more than one of them shares."""

    @F.pandas_udf("array<long>")
    def keys(sigs: pd.Series) -> pd.Series:
        sig = np.frombuffer(b"".join(sigs), dtype=np.uint16).reshape(len(sigs), TREES, DEPTH)[:, :, :shortest].astype(np.uint64)
        key = np.zeros((len(sigs), TREES), dtype=np.uint64)
        for j in range(shortest):
            key = (key ^ sig[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return pd.Series(list(key.view(np.int64)))

    small = settle(reps.select("uid", F.posexplode(keys.asNondeterministic()("sig")).alias("tree", "key")))
    shared = small.groupBy("tree", "key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = small.join(shared, ["tree", "key"]).select("uid", "tree", "key", blocks.alias("blocks"))
    rows = rows.join(reps, "uid").withColumn("side", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"bi": F.least("side", "other"), "bj": F.greatest("side", "other")}).drop("other", "blocks")


def near_links(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signed documents, copies, links).

    Copies: digest, rep (uid), copies. Links: uid of a representative, links (documents with another text that are near),
    root (the representative of the linked ones of one group).
    """
    base = signed(docs)
    order = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.col("uid"))
    copies = settle(base.filter("sig is not null").groupBy("digest").agg(F.min(order).getField("uid").alias("rep"), F.count("*").alias("copies")))
    reps = base.select("uid", "sig").join(copies.select(F.col("rep").alias("uid"), "copies"), "uid")
    shortest = shortest_depth(threshold, recall)

    def survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The documents with a likely partner."""
        for group in _groups(batches):
            likely = np.zeros(len(group), dtype=bool)
            for i, others, _, _ in _pairs(group, shortest, threshold):
                likely[i] = likely[others] = True
            if likely.any():
                yield group[likely]

    placed = bucketed(reps, shortest)
    found = settle(placed.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInPandas(survey, placed.schema))

    @F.pandas_udf("binary")
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([s.tobytes() for s in shingles_of(texts.tolist())], dtype=object)

    # the text's digest goes along, as one doc_id may have two texts; both joins have one key, so rows move once
    own = ["doc_key", "digest"]
    wanted = found.join(base.select("uid", F.coalesce("doc_id", F.lit(-1)).alias("doc_key"), "digest"), "uid")
    texts = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_key"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    texts = texts.join(wanted.select(*own).distinct(), own, "left_semi").select(*own, sets("text").alias("set"))
    full = wanted.join(texts, own).drop(*own)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches):
            group = group.drop_duplicates("uid").reset_index(drop=True)
            own = [np.frombuffer(s, dtype=np.uint64) for s in group["set"]]
            size = np.array([len(s) for s in own])
            _, place = np.unique(np.concatenate(own), return_inverse=True)
            first = np.concatenate([[0], np.cumsum(size)])
            mark = np.zeros(place.max() + 1, dtype=bool)
            copies, links = group["copies"].to_numpy(), np.zeros(len(group), dtype=np.int64)
            root = np.arange(len(group))
            for i, others, _, _ in _pairs(group, shortest, threshold):
                mark[place[first[i]:first[i + 1]]] = True
                inter = np.array([np.count_nonzero(mark[place[first[j]:first[j + 1]]]) for j in others])
                mark[place[first[i]:first[i + 1]]] = False
                near = others[inter >= threshold * (size[i] + size[others] - inter) - 1e-9]
                if len(near):
                    links[i] += copies[near].sum()
                    links[near] += copies[i]
                    tops = np.unique(root[np.append(near, i)])
                    root[np.isin(root, tops)] = tops[0]
            hit = links > 0
            if hit.any():
                uid = group["uid"].to_numpy()
                yield pd.DataFrame({"uid": uid[hit], "links": links[hit], "root": uid[root[hit]]})

    links = settle(full.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInPandas(verify, "uid long, links long, root long"))
    return base, copies, links


def choose_depth(counts: list[tuple[int, float, int]], threshold: float, recall: float, shortest: int) -> int:
    """The longest prefix at which the pairs seen are estimated to be enough of all, from (prefix, agreement, pairs).

    An estimate over all pairs: where most are much alike, those at the threshold hardly count. The join doesn't use it.
    """
    for k in range(DEPTH, shortest, -1):
        seen = [(s, n) for d, s, n in counts if d >= k and s >= threshold]
        total = sum(n / chance(s, k) for s, n in seen)
        if seen and sum(n for _, n in seen) >= recall * total:
            return k
    return shortest


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """uid, doc_id, digest, rep, class_id (smallest doc_id of the class), first (its row is the class's first), n_copies, n_links."""
    base, copies, links = near_links(docs, threshold)
    labels = components(links.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    total = links.groupBy(F.col("uid").alias("rep")).agg(F.sum("links").alias("links"))
    reps = copies.join(labels.withColumnRenamed("v", "rep"), "rep", "left").join(total, "rep", "left")
    reps = reps.select("digest", "copies", F.coalesce("label", "rep").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    rows = base.drop("sig").join(reps, "digest", "left").withColumn("label", F.coalesce("label", "uid"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("uid").alias("u"))
    firsts = rows.groupBy("label").agg(F.min(order).alias("f"), F.min("doc_id").alias("class_id"))
    rows = rows.join(firsts, "label")
    n = F.coalesce("copies", F.lit(1))
    return rows.select("uid", "doc_id", "digest", "class_id", (F.col("f.u") == F.col("uid")).alias("first"), n.alias("n_copies"),
                       (n - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_copies (documents with this text) and n_links (other documents at least so similar)."""
    return near_classes(docs.select("doc_id", "text"), threshold).select("doc_id", "class_id", "n_copies", "n_links")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The first document of each class, by doc_id, with its own columns."""
    first = near_classes(docs.select("doc_id", "text"), threshold).filter("first")
    key = {"near_key_": F.coalesce("doc_id", F.lit(-1)), "near_digest_": F.md5(F.coalesce("text", F.lit("")))}
    first = first.select(F.coalesce("doc_id", F.lit(-1)).alias("near_key_"), F.col("digest").alias("near_digest_"))
    # rows that agree in id and text are copies: one stays
    return docs.withColumns(key).join(first, list(key), "left_semi").dropDuplicates(list(key)).drop(*key)
