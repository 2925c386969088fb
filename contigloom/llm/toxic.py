"""Toxicity by a grammar of weighted finite-state transducers over clauses.

Words are mapped to a few symbols: insult, harm, target, negation, reporting, other. Four transducers are composed into one machine:
negation marks insults and threats in its scope, reported speech those after a reporting word, the target transducer those with
somebody addressed nearby (before or after, so it guesses and has to keep its word), and the last one weighs what is left. The
best path through a clause is its score; single words outside the grammar score nothing.

The insult lexicon is a trie of word beginnings, each weighted by a lower bound of its log odds among labelled training rows,
so inflected and compound forms of a stem count too; a few seed words are in it from the start. A logistic function of the
clause scores gives the document's score. It is trained on scores by lexicons that did not see the row (two folds).

Learned from at most ``TRAIN_ROWS`` labelled rows, picked by a hash; rows whose crc32(doc_id as text) modulo ``FOLDS`` is 0 are held
out and never among them. lang, source, doc_id and labels are no inputs of a score. Null and empty texts have no clause and get the
score of a text without a match. A null doc_id counts as the empty text for the hash. Equal texts get equal scores; repeated rows
are scored each. An empty table gives an empty result; without labels of both kinds the grammar's own weights decide. Extra columns
pass through ``scored``; columns with its own names are replaced. Texts are scored whole, clause by clause.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigloom.llm.sample import first_by_hash
from contigloom.llm.transducers import Arc, Machine, Transducer
from contigloom.session import bound_arrow_batches, settle

FOLDS = 5
TRAIN_ROWS = 8_000
TRAIN_PARTS = 16
LEXICON = 20_000  # word beginnings at most, the strongest first
LEAST_DOCS = 4  # toxic training rows that a word beginning must be in
LEAST_WEIGHT = 1.0
SHORTEST, LONGEST = 4, 12  # letters of a word beginning; whole words of any length are entries too
SEED_WEIGHT = 2.0
SAME = 0.95
CACHED_WORDS = 200_000

# Words that the grammar knows before it has seen a label.
INSULTS = ("arsehole asshole bastard bitch cretin dickhead dumbass fool idiot imbecile jerk loser moron scumbag stupid worthless "
           "arschloch blödmann depp dummkopf idiotin schwachkopf trottel connard crétin imbécile salaud estúpido gilipollas idiota imbécil").split()
HARM = ("beat burn destroy hang hurt kill murder punch shoot slap stab strangle ermorden erschießen schlagen töten umbringen verprügeln "
        "assassiner frapper tuer apuñalar golpear matar").split()
TARGETS = ("you your yours yourself he him his she her they them their du dich dir dein deine ihr euch sie tu te toi ton vous votre "
           "tú ti usted ustedes tuyo").split()
NEGATIONS = "not no never neither nor without hardly isn aren wasn weren don doesn didn won cannot nicht kein keine nie niemals pas jamais nunca jamás".split()
REPORTING = ("said says say called calls wrote writes claimed reported quoted quote allegedly according sagte nannte schrieb laut "
             "dit disait écrit selon dijo llamó escribió según").split()

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[^.!?;:\n]+")

OTHER, INSULT, HARMS, TARGET, NEGATION, REPORT = ".IHTNR"
SCOPE = 3  # words after a negation
REACH = 4  # words between an insult and its target
#: Weight of each thing the grammar says; ``n`` negated, ``r`` reported, ``t`` with a target.
RULES = {"I": 1.0, "It": 1.6, "In": 0.3, "Ir": 0.6, "Irt": 0.9, "H": 0.2, "Ht": 1.5, "Hn": 0.1, "Hr": 0.1, "Hrt": 0.6}
FEATURES = ("total", "greatest", "rate", "aimed")

OWN = "clauses array<struct<start: int, end: int, score: double, parts: array<string>>>, features array<double>, score double"


def negation() -> Transducer:
    """Insults and harm in the scope of a negation are written as negated."""
    def step(left: int, symbol: str) -> Arc:
        scoped = left > 0 and symbol in (INSULT, HARMS)
        return Arc(symbol, symbol + "n" if scoped else symbol, 0.0, SCOPE if symbol == NEGATION else max(left - 1, 0))

    states = range(SCOPE + 1)
    return Transducer(0, {s: [step(s, c) for c in ".IHTNR"] for s in states}, states)


def reported() -> Transducer:
    """Insults and harm after a reporting word are written as reported; negated ones stay negated."""
    symbols = [*".IHTNR", "In", "Hn"]
    arcs = {s: [Arc(c, c + "r" if s and c in (INSULT, HARMS) else c, 0.0, 1 if c == REPORT else s) for c in symbols] for s in (0, 1)}
    return Transducer(0, arcs, arcs)


def aimed() -> Transducer:
    """Insults and harm with a target within ``REACH`` words are written with ``t``.

    A state is (words that the last target still reaches, words left until a promised target).
    """
    symbols = [*".IHTNR", "In", "Hn", "Ir", "Hr"]
    arcs: dict[tuple[int, int], list[Arc]] = {}
    for since in range(REACH + 1):
        for due in range(REACH + 1):
            own = arcs[since, due] = []
            for c in symbols:
                if c == TARGET:
                    own.append(Arc(c, c, 0.0, (REACH, 0)))
                    continue
                on = (max(since - 1, 0), due - 1 if due else 0)
                broken = due == 1  # the promised target had to be here
                if c in ("I", "H", "Ir", "Hr"):
                    if since and not broken:
                        own.append(Arc(c, c + "t", 0.0, on))
                    elif due > 1:
                        own.append(Arc(c, c + "t", 0.0, on))
                    elif not due:
                        own += [Arc(c, c, 0.0, on), Arc(c, c + "t", 0.0, (on[0], REACH))]
                elif not broken:
                    own.append(Arc(c, c, 0.0, on))
    return Transducer((0, 0), arcs, [s for s in arcs if not s[1]])


def weighed() -> Transducer:
    """What each symbol counts."""
    return Transducer(0, {0: [Arc(c, c, RULES.get(c, 0.0), 0) for c in [*".TNR", *RULES]]}, [0])


def grammar() -> Machine:
    return negation().compose(reported()).compose(aimed()).compose(weighed()).compiled()


class Lexicon:
    """Symbols and weights of words: fixed words, and the best of the learned beginnings of a word."""

    def __init__(self, learned: dict[str, float]):
        self.learned = learned
        self.fixed = {w: (s, 1.0) for s, ws in ((REPORT, REPORTING), (NEGATION, NEGATIONS), (TARGET, TARGETS), (HARMS, HARM)) for w in ws}
        self.fixed |= {w: (INSULT, max(SEED_WEIGHT, learned.get(w + "$", 0.0))) for w in INSULTS}
        self.cache: dict[str, tuple[str, float]] = {}
        self.trie: dict = {}
        for entry, weight in learned.items():
            node = self.trie
            for letter in entry:
                node = node.setdefault(letter, {})
            node[""] = weight

    def symbol(self, word: str) -> tuple[str, float]:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= CACHED_WORDS:
                self.cache.clear()
            got = self.cache[word] = self.fixed.get(word) or self._learned(word)
        return got

    def _learned(self, word: str) -> tuple[str, float]:
        node, best = self.trie, 0.0
        for letter in (*word, "$"):
            node = node.get(letter)
            if node is None:
                break
            best = max(best, node.get("", 0.0))
        return (INSULT, best) if best else (OTHER, 0.0)


def clause_scores(text: str | None, lexicon: Lexicon, machine: Machine) -> tuple[list[tuple[int, int, float, list[tuple[str, float]]]], int]:
    """(start, end, score, parts) of each clause in which the grammar finds something, and the number of words of the text."""
    text = text or ""
    words = WORD.findall(text.lower())
    hot = {w for w in set(words) if lexicon.symbol(w)[0] in (INSULT, HARMS)}
    found = []
    for m in CLAUSE.finditer(text) if hot else ():
        own = WORD.findall(m[0].lower())
        if not hot.isdisjoint(own):
            said = [lexicon.symbol(w) for w in own]
            score, parts = machine.best([s for s, _ in said], [f for _, f in said])
            if parts:
                found.append((m.start(), m.end(), score, parts))
    return found, len(words)


def document_features(found: list, n_words: int) -> list[float]:
    """The numbers named in ``FEATURES``."""
    total = sum(s for _, _, s, _ in found)
    parts = [(c, f * RULES[c]) for _, _, _, own in found for c, f in own]
    return [math.log1p(total), max([s for _, _, s, _ in found], default=0.0), math.log1p(100 * total / max(n_words, 1)),
            math.log1p(sum(w for c, w in parts if c.endswith("t")))]


class Model(NamedTuple):
    lexicon: dict[str, float]
    weights: list[float]  # one for each feature, then the constant


#: Without labels of both kinds.
UNTRAINED = [1.0, 0.3, 0.3, 0.5, -2.5]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def beginnings(text: str) -> set[str]:
    """The beginnings of the text's words, and the words, which end in ``$``."""
    out = set()
    for word in set(WORD.findall(text.lower())):
        out.add(word + "$")
        out.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
    return out


_COUNTS = ["p0", "p1", "n0", "n1"]  # toxic and other rows of each fold


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """gram and how many rows of each kind and fold hold it, summed within each batch."""
    for frame in frames:
        counts: dict[int, Counter] = {k: Counter() for k in range(4)}
        for text, toxic, fold in zip(frame["text"], frame["toxic"], frame["fold"]):
            counts[int(fold) + (0 if toxic else 2)].update(beginnings(text))
        grams = list(set().union(*counts.values()))
        yield pd.DataFrame({"gram": pd.Series(grams, dtype=object), **{c: np.array([counts[k][g] for g in grams], dtype=np.int64) for k, c in enumerate(_COUNTS)}})


def _weight(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """A lower bound (one standard error) of the log odds of each entry."""
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    return odds - np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))


def _entries(table: pd.DataFrame, folds: list[int], rows: dict[tuple[bool, int], int]) -> dict[str, float]:
    pos = sum(table[f"p{f}"].to_numpy() for f in folds)
    weight = _weight(pos, sum(table[f"n{f}"].to_numpy() for f in folds), sum(rows.get((True, f), 0) for f in folds), sum(rows.get((False, f), 0) for f in folds))
    good = (weight >= LEAST_WEIGHT) & (pos >= max(2, LEAST_DOCS * len(folds) // 2))
    held = dict(zip(table["gram"][good], pos[good]))
    # a beginning that nearly always goes on in the same way says no more than the longer one
    told = {g[:-1] for g, n in held.items() if not g.endswith("$") and n >= SAME * held.get(g[:-1], math.inf)}
    return {g: round(float(w), 4) for g, w in zip(table["gram"][good], weight[good]) if g not in told}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Weights of a logistic regression by Newton steps, the constant last."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / sd, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    own = w[:-1] / sd
    return [*own.tolist(), float(w[-1] - own @ mean)]


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learned from rows of ``docs`` (doc_id, text) with a label (doc_id, toxic) that are not held out."""
    known = labels.filter("toxic is not null").select("doc_id", (F.col("toxic") > 0).alias("toxic")).filter(~held_out())
    known = settle(first_by_hash(known, "doc_id", TRAIN_ROWS))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("row_"))  # of a doc_id that is there many times
    rows = one.select("doc_id", "row_.*").repartition(TRAIN_PARTS)
    rows = settle(rows.withColumn("fold", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2)).cast("int")))
    sizes = {(r["toxic"], r["fold"]): r["count"] for r in rows.groupBy("toxic", "fold").count().collect()}  # four numbers
    if len({toxic for toxic, _ in sizes}) < 2:
        return Model({}, UNTRAINED)
    counts = rows.mapInPandas(_counted, "gram string, p0 long, p1 long, n0 long, n1 long").groupBy("gram").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    rank = F.log(F.col("p0") + F.col("p1") + 0.5) - F.log(F.col("n0") + F.col("n1") + 0.5)
    table = counts.filter(F.col("p0") + F.col("p1") >= LEAST_DOCS).orderBy(rank.desc(), "gram").limit(LEXICON).toPandas()
    halves = [_entries(table, [1 - f], sizes) for f in (0, 1)]

    @F.pandas_udf("array<double>")
    def unseen(texts: pd.Series, folds: pd.Series) -> pd.Series:
        machine, lexicons = grammar(), [Lexicon(h) for h in halves]
        return pd.Series([document_features(*clause_scores(t, lexicons[f], machine)) for t, f in zip(texts, folds)])

    known = rows.select(unseen("text", "fold").alias("x"), "toxic").toPandas()  # TRAIN_ROWS at most
    weights = _logistic(np.array(known["x"].tolist()), known["toxic"].to_numpy(dtype=float))
    return Model(_entries(table, [0, 1], sizes), weights)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with clauses (start, end, score and what the grammar said of it), features and score."""
    own = [c.split()[0] for c in ("clauses", "features", "score")]

    @F.pandas_udf(OWN)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine, lexicon = grammar(), Lexicon(model.lexicon)
        for texts in batches:
            rows = []
            for text in texts:
                found, n_words = clause_scores(text, lexicon, machine)
                features = document_features(found, n_words)
                logit = float(np.dot(features, model.weights[:-1]) + model.weights[-1])
                clauses = [{"start": a, "end": b, "score": s, "parts": [c for c, _ in parts]} for a, b, s, parts in found]
                rows.append((clauses, features, 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))))
            yield pd.DataFrame(rows, columns=own)

    bound_arrow_batches(docs.sparkSession)
    return docs.drop(*own, "toxic_").withColumn("toxic_", judge.asNondeterministic()("text")).withColumns(
        {c: F.col(f"toxic_.{c}") for c in own}).drop("toxic_")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_clauses (in which the grammar found something) of each document."""
    rows = scored(docs.select("doc_id", "text"), train(docs, labels))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                       F.size("clauses").cast("long").alias("n_clauses"))
