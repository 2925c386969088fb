import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from contigloom.llm import toxic
from contigloom.llm.queries import table
from tests.llm.cases import DOCS, ODD, docs, prose

LABELS = "doc_id long, quality int, toxic int"


def clause(text, learned=None):
    found, _ = toxic.clause_scores(text, toxic.Lexicon(learned or {}), toxic.grammar())
    return [(score, [c for c, _ in parts]) for _, _, score, parts in found]


def test_the_grammar_tells_clauses_apart():
    weight = toxic.SEED_WEIGHT
    assert clause("You are such an idiot") == [(1.6 * weight, ["It"])]
    assert clause("What an idiot") == [(weight, ["I"])]
    assert clause("An idiot, that is you") == [(1.6 * weight, ["It"])]  # the target comes later
    assert clause("He is not an idiot") == [(0.3 * weight, ["In"])]
    assert clause("The paper wrote that some idiot was elected") == [(0.6 * weight, ["Ir"])]
    assert clause("I will kill you") == [(1.5, ["Ht"])]
    assert clause("I will never hurt you") == [(0.1, ["Hn"])]
    assert clause("How to kill a process") == [(0.2, ["H"])]
    assert clause("not today. An idiot") == [(weight, ["I"])]  # a negation ends with its clause
    assert clause("a fine day; nothing else") == [] and clause("") == [] and clause(None) == []


def test_clauses_carry_their_place_and_stems_their_inflections():
    text = "Ein Satz.\nSo ein Quatschkopfgerede! Gut"
    (start, end, score, parts), = toxic.clause_scores(text, toxic.Lexicon({"quatsch": 3.0, "quatschk": 4.0, "so": 9.0}), toxic.grammar())[0]
    assert text[start:end] == "So ein Quatschkopfgerede" and parts[-1] == ("I", 4.0)


def test_best_path_equals_brute_force_over_the_chain():
    chain = [toxic.negation(), toxic.reported(), toxic.aimed(), toxic.weighed()]
    machine, rng = toxic.grammar(), random.Random(3)

    def outputs(transducer, symbols):
        """All (written symbols, weight) of one transducer."""
        held = [(transducer.start, (), 0.0, 0)]
        for s in symbols:
            held = [(a.to, (*w, a.write), t + a.weight, 0) for state, w, t, _ in held for a in transducer.arcs[state] if a.read == s]
        return {w for state, w, _, _ in held if state in transducer.finals}

    for _ in range(150):
        symbols = rng.choices(".IHTNR", weights=[4, 3, 2, 2, 1, 1], k=rng.randrange(1, 11))
        factors = [rng.choice([1.0, 2.5]) for _ in symbols]
        written = {tuple(symbols)}
        for transducer in chain:
            written = set(itertools.chain(*[outputs(transducer, w) for w in written]))
        want = max(sum(toxic.RULES.get(c, 0.0) * f for c, f in zip(w, factors)) for w in written)
        assert machine.best(symbols, factors)[0] == pytest.approx(want)


def test_held_out_labels_are_predicted(spark):
    folder = "/root/testdata/sf0.1"
    rows = toxic.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    got = rows.filter("held_out").join(table(spark, folder, "labels"), "doc_id").select("toxic", "score", "predicted").toPandas()
    ranks, y = got["score"].rank().to_numpy(), got["toxic"].to_numpy()
    auc = (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert auc > 0.95
    caught = ((got["predicted"] == 1) & (y == 1)).sum()
    assert caught >= 0.9 * y.sum() and (got["predicted"] == 1).sum() <= 1.05 * caught


def labelled(spark, n=120):
    """Half of the documents hold an invented insult, in several forms."""
    rng = random.Random(1)
    texts = []
    for i in range(n):
        words = prose(40, i).split()
        if i % 2:
            for ending in rng.choices(["", "s", "ing"], k=3):
                words.insert(rng.randrange(40), "gronk" + ending)
        texts.append(" ".join(words))
    return docs(spark, texts), spark.createDataFrame([(i, 1, i % 2) for i in range(n)], LABELS)


def test_held_out_rows_and_their_labels_do_not_train(spark):
    rows, labels = labelled(spark)
    model = toxic.train(rows, labels)
    out = [i for i in range(120) if zlib.crc32(str(i).encode()) % 5 == 0]
    turned = labels.withColumn("toxic", F.when(F.col("doc_id").isin(out), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxic.train(rows, turned) == model
    got = {r["doc_id"]: (r["held_out"], r["predicted"]) for r in toxic.toxicity(rows, turned).collect()}
    assert got == {i: (i in out, i % 2) for i in range(120)}


def test_odd_texts_repeats_clashing_columns_and_extra_inputs(spark):
    rows, labels = labelled(spark)
    odd = docs(spark, [*enumerate([*ODD, "gronk gronk you", "gronk gronk you"], 900), (900, None), (None, "gronk gronks")])
    every = rows.unionByName(odd)
    got = toxic.toxicity(every, labels).filter("doc_id >= 900 or doc_id is null").collect()
    assert len(got) == len(ODD) + 4 and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (900, 901, 902, 903)}
    assert len(blank) == 1 and {r["predicted"] for r in got if r["doc_id"] in (907, 908) or r["doc_id"] is None} == {1}
    model = toxic.train(rows, labels)
    wide = odd.withColumns({"score": F.lit("x"), "toxic_": F.lit(1), "features": F.lit(None).cast("int"), "mine": F.lit(4)})
    other = wide.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string"), "doc_id": F.lit(1).cast("long")})
    assert sorted(r["score"] for r in toxic.scored(wide, model).collect()) == sorted(r["score"] for r in toxic.scored(other, model).collect())
    assert {"mine", "score", "clauses", "features"} < set(toxic.scored(wide, model).columns)


def test_empty_tables_and_labels_of_one_kind(spark):
    rows, labels = labelled(spark, 20)
    none = spark.createDataFrame([], DOCS)
    assert toxic.toxicity(none, labels).count() == 0
    for few in (labels.limit(0), labels.filter("toxic = 1"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        got = toxic.toxicity(rows.unionByName(docs(spark, ["you idiot. you idiot"], first=99)), few).collect()
        assert {r["doc_id"] for r in got if r["predicted"]} == {99}
