"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs them, a span classifier decides.

Candidates are the base patterns' spans and looser ones, which every labeler proposes: names after a title, after a context word or in
the gazetteer, identity numbers, account numbers, and numbers or addresses that just miss a base rule (phones without a plus,
card numbers of 13 digits or with a wrong one, spelt-out or one-label mail addresses, IPv6 and four numbers with dots). Labelers (patterns,
gazetteers, context words, words that name something else, shapes) vote yes, no or nothing on each. How often each combination of votes occurs is
counted over all documents, kind by kind; from these counts expectation-maximisation estimates how reliable each labeler is for that kind
and how likely each combination is personal data. Labelers that never differ within a kind tell it nothing, so the estimates are drawn
to what the labelers are worth by themselves (``WORTH``) and the share of personal data to ``SHARE``. A logistic span classifier is then
trained on at most ``TRAIN_ROWS`` distinct candidates, the first by hash, weighted by that likelihood. Looser candidates that
it gives ``LEAST_PROBABILITY`` become spans of their own kind if no base span overlaps them. Base spans always stay.

The gazetteer of given names is a table of at most ``GAZETTEER`` rows, sent to the tasks; without one a short list is used.

Null text: empty, no spans. Repeated rows: the same spans each. An empty table gives an empty result. Extra columns pass
through ``scan``; ``spans_`` is replaced.
"""

from __future__ import annotations

import ipaddress
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.llm.sample import first_by_hash
from contigloom.llm.spans import Span, overlaps
from contigloom.session import bound_arrow_batches, settle

BASE_KINDS = ("email", "ip", "card", "phone")
NEAR_KINDS = tuple(f"near_{k}" for k in BASE_KINDS)  # just miss the base rule
KINDS = (*BASE_KINDS, "name", "identity", "account", *NEAR_KINDS)
SPANS = "array<struct<kind:string,start:int,end:int>>"
TRAIN_ROWS = 4000
LEAST_PROBABILITY = 0.9
AROUND = 30  # characters of context on each side
GAZETTEER = 200_000  # names
SHARE = 0.2  # of candidates, before any is seen
DRAWN = 30.0  # candidates that what the labelers are worth by themselves counts as

# The base patterns. Where a run can only match from its first character, a look behind says so, which
# keeps long runs linear; digits are taken whole for the same reason.
_LOCAL = r"A-Za-z0-9._%+-"
_EMAIL = rf"[{_LOCAL}]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
_EMAIL_HERE, _EMAIL_NEXT = re.compile(_EMAIL), re.compile(rf"(?<![{_LOCAL}])" + _EMAIL)
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"[ \[({](?:at|AT)[ \])}]")

_NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\.? [A-ZÀ-Þ][\w'-]+(?: [A-ZÀ-Þ][\w'-]+)?")
_IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NEAR = {
    "near_email": re.compile(rf"(?<![{_LOCAL}])[{_LOCAL}]++(?:@[A-Za-z0-9-]+|(?: ?[\[({{] ?(?:at|AT) ?[\])}}] ?| (?:at|AT) )"
                             r"[A-Za-z0-9-]+(?:(?: ?[\[({] ?(?:dot|DOT) ?[\])}] ?| (?:dot|DOT) |\.)[A-Za-z0-9-]+)+)"),
    "near_ip": re.compile(r"(?<![0-9A-Fa-f:.])(?=[0-9A-Fa-f]*:)[0-9A-Fa-f:]{2,39}(?![0-9A-Fa-f:])|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])"),
    "near_card": re.compile(r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])"),
    "near_phone": re.compile(r"(?<![0-9+])(?<![0-9][ .-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ .-]?[0-9]{2,4}(?:[ .-][0-9]{2,5}){1,4}(?![0-9])(?![.-][0-9])"),
}
_WORD = re.compile(r"(?<!\w)[A-ZÀ-Þ][\w'-]*+")
_SURNAME = re.compile(r" [A-ZÀ-Þ][\w'-]+")
_NAMED = re.compile(r"\b(?i:name|dear|sincerely|patient)(?:(?i: is)|[:,])? ([A-ZÀ-Þ][\w'-]+(?: [A-ZÀ-Þ][\w'-]+)?)")
_ACCOUNT = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")

# Gazetteers and context words.
DOMAINS = frozenset("com org net edu gov info io de fr es uk eu".split())
GIVEN_NAMES = frozenset("""anna ben carlos claire david elena emma fatima hans ines jane john jose julia karl laura li luis maria
mark mary michael mohammed nina omar paul peter pierre sara sofia thomas wei""".split())
COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
CONTEXT = {
    "email": "mail email contact write correo courriel", "ip": "ip ipv4 ipv6 host server address addr",
    "card": "card visa mastercard credit payment karte kreditkarte tarjeta carte",
    "phone": "phone telephone call calls tel mobile cell fax anruf telefon llama llamar telefono",
    "name": "name named dear sincerely patient born regards", "identity": "ssn social security identity passport",
    "account": "iban account bank konto cuenta compte",
}
CONTEXT = {kind: frozenset(words.split()) for kind, words in CONTEXT.items()}
#: Words next to a number or a name that is something else.
OTHER = frozenset("""order orders part parts serial model version release build item items sku ref reference invoice ticket case isbn issn doi
article chapter section page pages figure table row column line id code lot batch room bestellung teil artikel commande pedido street road
avenue station airport university""".split())
LABELERS = ("pattern", "gazetteer", "context", "shape", "distinct", "other")
#: Log odds of a vote by itself.
WORTH = (1.0, 1.0, 2.0, 0.5, 0.5, 3.0)
_NEXT = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, at = [], 0
    while True:
        # right after a match the next may begin inside a run
        m = (_EMAIL_HERE.match(text, at) if at else None) or _EMAIL_NEXT.search(text, at)
        if m is None:
            return found
        found.append(("email", m.start(), m.end()))
        at = m.end()


def base_spans(text: str) -> list[Span]:
    """Leftmost matches that don't overlap, per kind; those that fail their rule are dropped without another try."""
    found = _emails(text) if "@" in text else []
    if _DIGIT.search(text) is None:
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def loose_spans(text: str, base: list[Span], names: frozenset[str] = GIVEN_NAMES) -> list[Span]:
    """Candidates beside the base spans, none overlapping one."""
    found: list[Span] = []
    if _DIGIT.search(text):
        found += [("identity", *m.span()) for m in _IDENTITY.finditer(text)]
        found += [("account", *m.span()) for m in _ACCOUNT.finditer(text)]
        found += [(k, *m.span()) for k in ("near_ip", "near_card", "near_phone") for m in _NEAR[k].finditer(text) if k != "near_ip" or _near_ip(m[0])]
    elif "::" in text:
        found += [("near_ip", *m.span()) for m in _NEAR["near_ip"].finditer(text) if _near_ip(m[0])]
    if "@" in text or _AT.search(text):
        found += [("near_email", *m.span()) for m in _NEAR["near_email"].finditer(text)]
    found += [("name", *m.span()) for m in _NAME.finditer(text)]
    found += [("name", *m.span(1)) for m in _NAMED.finditer(text)]
    for m in _WORD.finditer(text):
        if m[0].lower() in names:
            more = _SURNAME.match(text, m.end())
            found.append(("name", m.start(), more.end() if more else m.end()))
    free: list[Span] = []
    taken = bytearray(len(text))  # as a text may hold very many
    for _, a, b in base:
        taken[a:b] = b"\1" * (b - a)
    for span in found:
        if 1 not in taken[span[1]:span[2]]:
            taken[span[1]:span[2]] = b"\1" * (span[2] - span[1])
            free.append(span)
    return free


def _near_ip(value: str) -> bool:
    """IPv6 (two colons together, or eight parts), or four numbers with dots."""
    return "." in value or value.count("::") == 1 and value != "::" or value.count(":") == 7


def _ipv6(value: str) -> bool:
    try:
        return ipaddress.ip_address(value).version == 6
    except ValueError:
        return False


def _iban(value: str) -> bool:
    value = value.replace(" ", "")
    if not value.isascii() or not value.isalnum():
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def votes(text: str, span: Span, names: frozenset[str] = GIVEN_NAMES) -> tuple[int, ...]:
    """1 yes, -1 no, 0 nothing, by each of ``LABELERS``."""
    kind, a, b = span
    value = text[a:b]
    # whole words: one that is cut at the window's far end doesn't count
    before, after = text[max(0, a - AROUND - 1):a].lower(), text[b:b + AROUND + 1].lower()
    before = before if a <= AROUND else before[re.match(r"\w*", before).end():]
    after = after if b + AROUND + 1 >= len(text) else after[:re.search(r"\w*\Z", after).start()]
    near = {*_NEXT.findall(before), *_NEXT.findall(after)}
    digits = [c for c in value if c in "0123456789"]
    strict = {"account": _iban, "identity": lambda v: v[:3] not in ("000", "666") and v[0] != "9" and v[4:6] != "00" and v[7:] != "0000",
              "near_ip": _ipv6, "near_card": lambda v: luhn(re.sub("[ -]", "", v)), "near_phone": lambda v: 7 <= len(digits) <= 15,
              "near_email": lambda v: "@" in v or re.search("[\\[({]", v) is not None or re.search("(?i) dot ", v) is not None}
    pattern = 1 if kind in BASE_KINDS else (1 if strict[kind](value) else -1) if kind in strict else 0
    if kind in ("email", "near_email"):
        known = 1 if re.split(r"[^A-Za-z0-9-]+", value)[-1].lower() in DOMAINS else -1
    elif kind == "name":
        known = 1 if any(w.lower().strip(".") in names for w in value.split()) else 0
    elif kind == "account":
        known = 1 if value[:2] in COUNTRIES else -1
    elif kind in ("card", "near_card"):
        known = 1 if value[0] in "3456" else -1
    else:
        known = 0
    context = 1 if near & CONTEXT[kind.removeprefix("near_")] or kind == "name" and _NAME.match(text, a) else 0
    edge = text[a - 1:a] + text[b:b + 1]
    shape = -1 if re.search(r"[\w@/=]", edge) else 1
    distinct = (-1 if len(set(digits)) <= 2 else 1) if len(digits) >= 4 else 0
    other = -1 if near & OTHER and kind not in ("email", "near_email") and not context else 0
    return pattern, known, context, shape, distinct, other


def features(text: str, span: Span, names: frozenset[str] = GIVEN_NAMES) -> list[float]:
    """What the classifier sees: the votes, the kind, and plain counts of the span."""
    kind, a, b = span
    value = text[a:b]
    n = max(1, len(value))
    return [1.0, *map(float, votes(text, span, names)), *[float(kind == k) for k in KINDS], min(len(value), 60) / 30,
            sum(c.isdigit() for c in value) / n, sum(c.isupper() for c in value) / n, sum(c in " -.()" for c in value) / n]


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100, worth: tuple[float, ...] | None = None) -> tuple[dict[tuple[int, ...], float], np.ndarray]:
    """Expectation-maximisation with two classes over counted vote patterns.

    Gives the probability of personal data for each pattern, and per class and labeler the chances of no, nothing, yes. With ``worth``
    the chances are drawn to those at which a vote is worth so much, and the share of personal data to ``SHARE``.
    """
    table = np.array([p for p, _ in patterns])
    weight = np.array([n for _, n in patterns], dtype=float)
    drawn = np.full((2, table.shape[1], 3), 0.5)
    start = table.sum(axis=1).astype(float)
    if worth is not None:
        for j, w in enumerate(worth):
            for c, sign in enumerate((-1, 1)):
                own = np.exp(sign * w / 2 * np.array([-1, 0, 1]))
                drawn[c, j] = DRAWN * own / own.sum()
        start = table @ np.array(worth) + np.log(SHARE / (1 - SHARE))
    right = 1 / (1 + np.exp(-start))
    for _ in range(rounds):
        share = (weight * right).sum() / weight.sum()
        share = (share + SHARE) / 2 if worth is not None else share
        share = min(max(share, 1e-4), 1 - 1e-4)
        chance = np.empty((2, table.shape[1], 3))
        for c, mass in enumerate((weight * (1 - right), weight * right)):
            for v in (-1, 0, 1):
                chance[c, :, v + 1] = drawn[c, :, v + 1] + (mass[:, None] * (table == v)).sum(axis=0)
            chance[c] /= chance[c].sum(axis=1, keepdims=True)
        log = [sum(np.log(chance[c, j, table[:, j] + 1]) for j in range(table.shape[1])) for c in (0, 1)]
        right = 1 / (1 + np.exp(-np.clip(np.log(share / (1 - share)) + log[1] - log[0], -40, 40)))
    return {p: float(r) for (p, _), r in zip(patterns, right)}, chance


def gazetteer(names: DataFrame | None) -> frozenset[str]:
    """The names of a table's first column in lower case; a short list without a table."""
    if names is None:
        return GIVEN_NAMES
    rows = names.select(F.lower(F.col(f"`{names.columns[0]}`")).alias("n_")).filter("n_ <> ''").distinct().limit(GAZETTEER + 1).collect()
    if len(rows) > GAZETTEER:
        raise ValueError(f"more than {GAZETTEER} names")
    return frozenset(r["n_"] for r in rows)


FOUND = "base array<struct<kind:string,start:int,end:int>>, loose array<struct<kind:string,start:int,end:int>>, seen array<struct<kind:string,votes:array<int>,features:array<double>>>"


def with_candidates(docs: DataFrame, names: frozenset[str] = GIVEN_NAMES) -> DataFrame:
    """``docs`` with ``found_``: base spans, loose spans, and kind, votes and features of both in this order."""
    sent = docs.sparkSession.sparkContext.broadcast(names)

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            base = base_spans(text)
            loose = loose_spans(text, base, sent.value)
            seen = []
            for s in base + loose:
                own = features(text, s, sent.value)
                seen.append((s[0], [int(v) for v in own[1:1 + len(LABELERS)]], own))
            rows.append((base, loose, seen))
        return pd.DataFrame(rows, columns=["base", "loose", "seen"])

    bound_arrow_batches(docs.sparkSession)
    return docs.drop("found_", "spans_").withColumn("found_", find.asNondeterministic()(F.col("text")))


def train(found: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray | None:
    """Weights of the span classifier from rows with ``found_``; None without candidates.

    The vote patterns are counted over all candidates, kind by kind; a kind has at most 3 ** 6 of them.
    """
    seen = found.select(F.explode("found_.seen").alias("c_")).select("c_.kind", "c_.votes", "c_.features")
    counted = settle(seen.groupBy("kind", "votes", "features").count())
    patterns = counted.groupBy("kind", "votes").agg(F.sum("count").alias("n")).collect()
    if not patterns:
        return None
    chance = {}
    for kind in {r["kind"] for r in patterns}:
        chance[kind], _ = estimate(sorted((tuple(r["votes"]), r["n"]) for r in patterns if r["kind"] == kind), worth=WORTH)
    sample = first_by_hash(counted.drop("count"), "features", rows).collect()
    x = np.array([r["features"] for r in sample])
    y = np.array([chance[r["kind"]][tuple(r["votes"])] for r in sample])
    w = np.zeros(x.shape[1])
    penalty = 1e-2 * np.eye(x.shape[1])
    for _ in range(30):  # Newton steps of a logistic regression on likelihoods
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty, x.T @ (y - p) - 1e-2 * w)
    return w


def decided(found: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """``found`` with ``spans_`` in place of ``found_``: base spans, then what the classifier adds, in no order."""

    @F.pandas_udf(SPANS)
    def decide(cells: pd.DataFrame) -> pd.Series:
        held = [(list(b), list(l), list(s)) for b, l, s in zip(cells["base"], cells["loose"], cells["seen"])]
        if weights is None:
            return pd.Series([b for b, _, _ in held], dtype=object)
        x = [c["features"] for b, _, seen in held for c in seen[len(b):]]  # all loose spans of the batch at once
        good = iter((np.array(x) @ weights >= np.log(LEAST_PROBABILITY / (1 - LEAST_PROBABILITY))).tolist() if x else [])
        return pd.Series([b + [s for s in l if next(good)] for b, l, _ in held], dtype=object)

    return found.withColumn("spans_", decide("found_")).drop("found_")


def scan(docs: DataFrame, weights: np.ndarray | None, names: frozenset[str] = GIVEN_NAMES) -> DataFrame:
    """``docs`` with ``spans_``."""
    return decided(with_candidates(docs, names), weights)


def personal_data(docs: DataFrame, names: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """``scan`` with a classifier trained on these documents.

    With ``keep``, the columns wanted beside ``spans_`` and without the text, texts are read once: what was found in them is kept in the
    shared folder until the classifier is there. Otherwise they are read again, so that no text is stored.
    """
    known = gazetteer(names)
    found = with_candidates(docs, known)
    if keep is not None:
        found = settle(found.select(*keep, "found_"))
    return decided(found, train(found))
