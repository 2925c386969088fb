import random
from collections import defaultdict

from pyspark.sql import functions as F

from contigloom.llm import near
from tests.llm.cases import DOCS, ODD, docs, prose


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(texts, threshold=0.8):
    """doc_id: (class_id, n_links)"""
    sets = [shingles(t) for t in texts]
    parent, links = list(range(len(texts))), [0] * len(texts)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both >= threshold * (len(a) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: (top(i), links[i]) for i in range(len(texts))}


def changed(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10 ** 6)}"
    return " ".join(words)


def found(frame):
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in frame.collect()}


def test_links_and_classes_match_brute_force(spark):
    base = [prose(200, i) for i in range(12)]
    texts = [*ODD, *base, *[changed(base[i % 12], i % 7, i) for i in range(80)], base[0], base[0], "a b c d", "a b c"]
    want = brute(texts)
    assert found(near.near_duplicates(docs(spark, texts))) == want
    assert sum(n for _, n in want.values()) > 100


def test_a_large_group_is_worked_on_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 20)
    base = prose(150, 5)
    texts = [changed(base, 2, i) for i in range(130)]
    assert found(near.near_duplicates(docs(spark, texts).repartition(3))) == brute(texts)


def test_recall_at_the_threshold():
    depth = near.shortest_depth(near.THRESHOLD, near.RECALL)
    assert near.chance(near.THRESHOLD, depth) >= near.RECALL > near.chance(near.THRESHOLD, depth + 1)
    # pairs that are all alike let longer prefixes do, pairs at the threshold don't
    assert near.choose_depth([(6, 1.0, 50)], 0.8, near.RECALL, depth) == 6
    assert near.choose_depth([(6, 0.8, 50), (3, 0.8, 50)], 0.8, near.RECALL, depth) == depth
    assert near.choose_depth([], 0.8, near.RECALL, depth) == depth


def test_a_group_of_near_copies_costs_no_pair_at_the_threshold(spark):
    def prefix(a, b):
        x, y = near.signatures(near.shingles_of([a, b])).reshape(2, near.TREES, near.DEPTH)
        return (x == y).cumprod(axis=1).sum(axis=1).max()

    base = prose(300, 1)
    made = ((text, changed(text, 6, i)) for i in range(1000) for text in [prose(300, 10_000 + i)])
    pair = next((a, b) for a, b in made if brute([a, b])[0][1] and prefix(a, b) < near.DEPTH)
    texts = [*pair, *[changed(base, 1, i) for i in range(50)]]
    assert found(near.near_duplicates(docs(spark, texts))) == brute(texts)


def test_keep_one_keeps_the_first_of_each_class_and_all_columns(spark):
    base = [prose(100, i) for i in range(3)]
    rows = docs(spark, [(7, base[0]), (3, base[0]), (5, changed(base[0], 1, 1)), (9, base[1]), (9, base[1]), (None, base[2]), (11, base[2]), (12, None), (13, "")])
    rows = rows.withColumns({"uid": F.lit("mine"), "label": F.lit(0), "first": F.lit(1)})
    kept = near.keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 9, 11, 12, 13]


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert near.near_duplicates(none).count() == 0 and near.keep_one(none).count() == 0


def test_components(spark):
    from contigloom.llm.components import components

    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (200, 200)]
    got = defaultdict(set)
    for r in components(spark.createDataFrame(chain, "a long, b long")).collect():
        got[r["label"]].add(r["v"])
    assert dict(got) == {0: set(range(41)), 100: {100, 101, 102}}
