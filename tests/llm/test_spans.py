"""Secrets and personal data: base spans against plain patterns, what the models add, odd cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from contigloom.llm import private, secrets
from contigloom.llm.spans import listed, plain
from tests.llm.cases import DOCS, ODD, docs, prose

TEXTS = [
    *ODD, "password=abcdefgh token: short1 x", "API_KEY = 'Zz9/_+=.-aa' secret:token:abcdefghij", "PaſſWORD=abcdefgh1 ſecret=abcdefgh1 to\u212aen=abcdefgh",
    "AKIAABCDEFGHIJKL AKIASHORT AKIAAKIAAKIAAKIA1", "f" * 31 + " " + "0a" * 16 + "g" + "b" * 40, 'token = "' + "ab12" * 10 + '" é',
    "a.b@c.d%x@e.f @g.h x@y z@z.z.z.", "a@b.c@d.e q@w.e", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.04 1.2.3", "12345.1.2.3.4 ٣.1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 378282246310005 11111111111111111111", "+1 (988) 555-2485 +123456789 +1234567890123456 +49 30 12 34 56 78.",
    "0 0 0 0 0 0 0 0 0 0 0 0 0 0", "9" * 3000, "a" * 3000 + "@",
]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_secrets(t):
    a = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
    return ([("assign", *m.span()) for m in re.finditer(a, t) if len(m[1]) >= 8]
            + [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
            + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def brute_private(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


@pytest.mark.parametrize("module, brute", [(secrets, brute_secrets), (private, brute_private)])
def test_base_spans_match_plain_patterns(module, brute):
    rng = random.Random(1)
    noise = ["".join(rng.choice("ab1.@%+-: =0(x") for _ in range(60)) for _ in range(3000)]
    for text in [t or "" for t in TEXTS] + noise:
        assert sorted(module.base_spans(text)) == sorted(brute(text)), text


def made_secrets(n, seed):
    rng = random.Random(seed)
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    rows = []
    for i in range(n):
        words = prose(30, seed * 1000 + i)
        rows += [f"{words} token = \"{hexes(40)}\" {words}", f"{words} password={hexes(18)} {words}",
                 f"{words} {''.join(rng.choice('abcdefghij') for _ in range(18))}1 {words}", f"{words} {rng.randrange(10 ** 15, 10 ** 16)} {words}"]
    return rows


def test_the_network_learns_and_reaches_its_recall(spark):
    model = secrets.train(secrets.findings(docs(spark, made_secrets(150, 1))))
    held = made_secrets(60, 2)
    scored = [(secrets.overlaps(("", a, b), secrets.base_spans(t)), model.probabilities(secrets.encode([secrets.seen(t, a)]))[0] >= model.threshold)
              for t in held for a, b in secrets.candidates(t)]
    positive = [hit for truth, hit in scored if truth]
    assert np.mean(positive) >= 0.9
    assert np.mean([hit for truth, hit in scored if not truth]) <= 0.05
    # a key of a shape that no base pattern knows, in words that announce one
    text = "pass_word=" + "9f" * 9 + "Z"
    got = {r["doc_id"]: [plain(s) for s in r["spans_"]] for r in secrets.scan(docs(spark, [text, prose(50, 3)]), model).collect()}
    assert got[1] == [] and all(k in secrets.KINDS for k, _, _ in got[0])


def test_the_threshold_is_the_recall_quantile_even_below_one_half():
    # mostly plain findings that look the same: no score of a secret reaches one half
    x = secrets.encode([secrets.seen("key " + "ab12" * 5, 4)] * 400)
    y = np.array([1.0, 0.0, 0.0, 0.0] * 100)
    model = secrets.CharNet().fit(x, y)
    assert model.threshold < 0.5 and np.mean(model.probabilities(x[y == 1]) >= model.threshold) >= secrets.RECALL


def test_a_long_candidate_is_seen_to_its_end_and_beyond(spark):
    text = "/srv/" + "x1/" * 40 + "KEY7 'behind its end'"
    (a, b), = secrets.candidates(text)
    windows = [secrets.seen(text, s)[secrets.BEFORE:] for s in secrets.window_starts(a, b)]
    assert "KEY7 'behind its end" [:20] in windows[-1] and "".join(w[:secrets.STEP] for w in windows[:-1]) in text

    class Late:
        threshold = 0.5

        def probabilities(self, x):
            return (x == secrets._CLASS_OF[ord("'")]).any(axis=1).astype(float)

    got = {r["doc_id"]: [plain(s) for s in r["spans_"]] for r in secrets.scan(docs(spark, [text, text.replace("'", ".")]), Late()).collect()}
    assert got == {0: [("model", a, b)], 1: []}
    seen = [r["seen"] for r in secrets.findings(docs(spark, [text, text.replace("KEY7", "KEY8")])).collect()]
    assert any("KEY7" in w for w in seen) and any("KEY8" in w for w in seen)


def test_secret_scan_odd_cases_and_redaction(spark):
    rows = docs(spark, TEXTS).withColumns({"spans_": F.lit("mine"), "seen": F.lit(1), "label": F.lit(2)})
    assert secrets.train(secrets.findings(rows)) is None  # too few findings
    scanned = secrets.scan(rows, None)
    got = {r["doc_id"]: sorted(plain(s) for s in r["spans_"]) for r in scanned.collect()}
    assert got == {i: sorted(brute_secrets(t or "")) for i, t in enumerate(TEXTS)}
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(scanned).collect()}
    assert clean[0] is None and clean[6] == TEXTS[6]
    assert clean[7] == "<secret> token: short1 x"
    assert clean[12] == "<secret>\" é"  # overlapping spans are one
    assert secrets.scan(spark.createDataFrame([], DOCS), None).count() == 0


def test_found_and_replaced_at_once_is_scan_and_redaction(spark):
    class Some:
        threshold = 0.5

        def probabilities(self, x):
            return (x == secrets._CLASS_OF[ord("0")]).any(axis=1).astype(float)

    rows = docs(spark, [*TEXTS, "see /srv/" + "x0/" * 40 + "KEY7 password=abcdefgh1", "see /srv/" + "x7/" * 40])
    for model in (None, Some()):
        scanned = secrets.scan(rows, model).withColumn("any_", F.size("spans_") > 0)
        want = {r["doc_id"]: r["text"] if r["any_"] else None for r in secrets.redacted(scanned).collect()}
        assert {r["doc_id"]: r["redacted_"] for r in secrets.with_redaction(rows, model).collect()} == want
    assert want[len(TEXTS)] == "see <secret> <secret>" and want[len(TEXTS) + 1] is None


def test_votes_are_weighed_by_agreement():
    # two labelers agree, the third says the opposite half the time: it counts for little
    counts = [((1, 1, 1), 400), ((1, 1, -1), 400), ((-1, -1, 1), 400), ((-1, -1, -1), 400), ((1, -1, 1), 5)]
    chance, table = private.estimate(counts)
    assert chance[1, 1, -1] > 0.99 and chance[-1, -1, 1] < 0.01
    assert table[1, 0, 2] > 0.95 and abs(table[1, 2, 2] - 0.5) < 0.1


def test_personal_data_odd_cases_and_what_the_classifier_adds(spark):
    rows = docs(spark, TEXTS).withColumns({"spans_": F.lit("mine"), "votes": F.lit(1), "features": F.lit(2)})
    got = {r["doc_id"]: [plain(s) for s in r["spans_"]] for r in private.personal_data(rows).collect()}
    for i, t in enumerate(TEXTS):
        assert sorted(s for s in got[i] if s[0] in private.BASE_KINDS) == sorted(brute_private(t or ""))
        assert not any(private.overlaps(s, brute_private(t or "")) for s in got[i] if s[0] not in private.BASE_KINDS)
    people = [f"Contact Mr. Thomas Miller{'s' * (i % 3)} by mail: a{i}@b.org or +1 (300) 555-{1000 + i}, ssn 123-45-{6000 + i}" for i in range(40)]
    scanned = private.personal_data(docs(spark, [*people, prose(80, 1)])).collect()
    spans = {r["doc_id"]: [plain(s) for s in r["spans_"]] for r in scanned}
    assert all({"email", "phone", "identity"} <= {k for k, _, _ in spans[i]} for i in range(40)) and spans[40] == []
    assert private.personal_data(spark.createDataFrame([], DOCS)).count() == 0


def test_every_labeler_proposes_near_misses():
    text = ("call (017) 555-7713 or 555-123-4567, card 4222222222222 or 4111 1111 1111 1112, mail jo [at] host [dot] org, ann at mail dot com, "
            "root@localhost, host 2001:db8::1 or 999.1.2.3, dear Ximena Ortiz, then Anna Smith came")
    got = [(k, text[a:b]) for k, a, b in private.loose_spans(text, private.base_spans(text))]
    assert sorted(got) == sorted([
        ("near_phone", "(017) 555-7713"), ("near_phone", "555-123-4567"), ("near_card", "4222222222222"), ("near_card", "4111 1111 1111 1112"),
        ("near_email", "jo [at] host [dot] org"), ("near_email", "ann at mail dot com"), ("near_email", "root@localhost"),
        ("near_ip", "2001:db8::1"), ("near_ip", "999.1.2.3"), ("name", "Ximena Ortiz"), ("name", "Anna Smith")])
    assert private.loose_spans("at 10:30 the 7 dogs met at home", []) == []


def test_near_misses_are_decided_on_by_the_classifier(spark):
    texts = [f"{prose(9, i)} please call our phone (017) 555-{7000 + i * 7 % 999} today or write a mail to a{i}@b.org" for i in range(60)]
    got = {r["doc_id"]: {s[0] for s in map(plain, r["spans_"])} for r in private.personal_data(docs(spark, texts)).collect()}
    assert sum("near_phone" in kinds for kinds in got.values()) >= 50


def test_context_words_count_as_wholes():
    def context(text, kind="near_ip"):
        a = text.index("2001")
        return private.votes(text, (kind, a, a + len("2001:db8::1")))[2]

    assert [context(f"{w} 2001:db8::1 x") for w in ("the description", "a ghost", "the host", "host:", "my server")] == [0, 0, 1, 1, 1]
    assert context("hotel 2001:db8::1", "near_phone") == 0 and context("tel. 2001:db8::1", "near_phone") == 1


def test_part_numbers_and_versions_are_no_personal_data(spark):
    texts = [f"{prose(5, i)} order {i} of part 207-307-{5000 + 7 * i} was shipped" for i in range(60)]
    texts += [f"{prose(5, i)} release 10.20.{i}.999 of the model 301-22-{1000 + i}" for i in range(60)]
    phones = [f"{prose(5, i)} my phone is 207-307-{5000 + 7 * i} for now" for i in range(60)]
    for given in (texts, texts + phones):
        got = [[plain(s) for s in r["spans_"]] for r in private.personal_data(docs(spark, given)).orderBy("doc_id").collect()]
        assert not any(s[0] not in private.BASE_KINDS for own in got[:120] for s in own)
        assert all(any(s[0] == "near_phone" for s in own) for own in got[120:])


def test_a_table_of_names_is_the_gazetteer(spark, monkeypatch):
    names = spark.createDataFrame([("Zebulon",), ("XIMENA",), (None,), ("",)], "given string")
    texts = [f"{prose(6, i)} then Zebulon Okafor came, dear Ximena Ortiz" for i in range(40)]
    rows = docs(spark, texts)
    found = lambda **k: {(s[0], texts[r["doc_id"]][s[1]:s[2]]) for r in private.personal_data(rows, **k).collect() for s in map(plain, r["spans_"])}
    assert ("name", "Ximena Ortiz") in found(names=names) and not any("Zebulon" in v for _, v in found())
    assert {v for k, v in private.loose_spans(texts[0], [], private.gazetteer(names)) and [(k, texts[0][a:b]) for k, a, b in private.loose_spans(texts[0], [], private.gazetteer(names))]} == {"Zebulon Okafor", "Ximena Ortiz"}
    once = private.personal_data(rows, names, keep=["doc_id"])
    assert once.columns == ["doc_id", "spans_"] and sorted(map(str, once.collect())) == sorted(map(str, private.personal_data(rows, names).select("doc_id", "spans_").collect()))
    monkeypatch.setattr(private, "GAZETTEER", 1)
    with pytest.raises(ValueError, match="names"):
        private.gazetteer(names)


def test_listing_order():
    assert listed([("b", 3, 4), ("a", 3, 9), ("b", 0, 1)], ("a", "b")) == "b:0:1,a:3:9,b:3:4"


def made_findings(spark, plain_rows, secret_rows):
    """Windows that are unlike each other; a secret's are behind a word for one."""
    rng = random.Random(5)
    rows = [(secrets.seen(f"{'api_key = ' if label else 'see page '}{i:06d}{rng.getrandbits(80):020x}", 10), label)
            for label, n in ((0, plain_rows), (1, secret_rows)) for i in range(n)]
    return spark.createDataFrame(rows, "seen string, label int")


def test_the_network_is_trained_on_every_finding(spark, monkeypatch):
    fitted, scored = [], []
    monkeypatch.setattr(secrets.CharNet, "fit", lambda net, x, y: fitted.append((len(x), int(y.sum()))))
    some = made_findings(spark, 1_700, 900)
    secrets.train(some.union(some))
    assert fitted == [(2_600, 900)]
    monkeypatch.setattr(secrets, "EPOCHS", 1)
    calibrate = secrets.CharNet.calibrate
    monkeypatch.setattr(secrets.CharNet, "calibrate", lambda net, score, truth: (scored.append(len(score)), calibrate(net, score, truth))[1])
    assert secrets.train(made_findings(spark, 1_700, 1_600)) is not None  # two blocks
    assert len(fitted) == 1 and scored[0] in (660, 661)  # a fifth of all is held out


def test_blocks_train_one_network_however_the_findings_lie(spark, monkeypatch):
    monkeypatch.setattr(secrets, "EPOCHS", 6)
    rows = made_findings(spark, 900, 700)
    one, other = (secrets.train(r, block_rows=300) for r in (rows.coalesce(1), rows.repartition(7)))
    x, y = secrets.encode([r["seen"] for r in rows.collect()]), np.array([r["label"] for r in rows.collect()])
    assert one.threshold == other.threshold and np.array_equal(one.filters, other.filters)
    said = one.probabilities(x) >= one.threshold
    assert said[y == 1].mean() > 0.9 and said[y == 0].mean() < 0.05
