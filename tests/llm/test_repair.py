import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from contigloom.llm import repair
from contigloom.llm.queries import table
from tests.conftest import SF

CHATS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute_damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        own = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{own[0]}:{own[1]}".encode()) % 20
        role, text = own[2], own[3]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        marks = WORD.findall(text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def greedy(rows, kinds):
    """(cost, audit, roles and texts): costs to the end for every row and state, then always the least letter that stays cheapest."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    n = len(rows)

    def edits(i, state):
        yield "I", 5, i, after[state], (after[state], "")
        if i < n:
            _, role, text = rows[i]
            yield "D", 2, i + 1, state, None
            if kinds[i] not in ("blank", "duplicate"):
                more, first = 5 * (kinds[i] == "truncated"), role[:1]
                if first == after[state] or first == "s" and state == "":
                    yield "K", more, i + 1, first, (role, text)
                for to in "ua":
                    if to == after[state]:
                        yield "R", 1 + more, i + 1, to, (to, text)

    best = {}
    for i in range(n, -1, -1):
        for s in ("", "s", "u", "a"):
            best[i, s] = 0 if i == n and s in ("", "a") else 10 ** 9
        for _ in range(4):  # insertions lead to states of the same row
            for s in ("", "s", "u", "a"):
                best[i, s] = min([best[i, s], *[c + best[j, t] for _, c, j, t, _ in edits(i, s)]])
    i, s, audit, said = 0, "", "", []
    while not (i == n and s in ("", "a") and best[i, s] == 0):
        letter, c, i, s, line = min((e for e in edits(i, s) if e[1] + best[e[2], e[3]] == best[i, s]), key=lambda e: e[0])
        audit += letter
        said += [] if line is None else [line]
    names = {"u": "user", "a": "assistant"}
    return best[0, ""], audit, "\n".join(f"{names.get(r, r)}:{t}" for r, t in said)


def brute(rows, ids):
    """All rows of the result, from damaged rows."""
    out = {}
    for conv in set(ids):
        own = [r[1:] for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        kinds = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, said = greedy(own, kinds)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
                     hashlib.sha256(said.encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def collected(frame):
    rows = frame.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}


def test_audits_match_an_enumeration_of_all_edits():
    rng = random.Random(11)
    for _ in range(60):
        rows = [(rng.choice("ssuuaax"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(0, 5))]
        options = []
        for initial, fault in rows:
            own = [("D", 2, "")]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                own += [("K", more, initial), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
            options.append(own)
        gaps = [("", 0, ""), ("I", 5, "u"), ("I", 5, "a"), ("II", 10, "ua"), ("II", 10, "au")]
        best = None
        for chosen in itertools.product(*itertools.chain(*[(gaps, o) for o in options]), gaps):
            if re.fullmatch("(s?(ua)+)?", "".join(c[2] for c in chosen)):
                own = (sum(c[1] for c in chosen), "".join(c[0] for c in chosen))
                best = own if best is None else min(best, own)
        assert repair.ended(repair.cheapest(rows)) == best


def test_segments_combine_to_the_whole():
    rng = random.Random(12)
    for _ in range(100):
        rows = [(rng.choice("ssuuaax"), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(1, 14))]
        held, at = [(0, ""), None, None, None], 0
        while at < len(rows):
            end = at + rng.randrange(1, 5)
            held = repair._then(held, [repair.cheapest(rows[at:end], s) for s in range(4)])
            at = end
        assert repair.ended(held) == repair.ended(repair.cheapest(rows))


def test_audits_compare_like_strings_also_when_all_hashes_are_equal(monkeypatch):
    rng = random.Random(13)
    texts = ["".join(rng.choices("DK", k=rng.randrange(0, 40))) for _ in range(80)]
    texts += [t[:len(t) // 2] + "IR" for t in texts]
    for modulus in (repair.MODULUS, 1):  # with 1 every hash is 0, so all equal hashes have to be verified
        monkeypatch.setattr(repair, "MODULUS", modulus)
        audits, nodes = repair.Audits(), []
        for t in texts:
            node = 0
            for letter in t:
                node = audits.push(node, letter)
            assert audits.text(node) == t
            nodes.append(node)
        for _ in range(600):
            i, j = rng.randrange(len(texts)), rng.randrange(len(texts))
            a, b = texts[i], texts[j]
            assert audits.less(nodes[i], nodes[j]) == (a < b)
            assert audits.common(nodes[i], nodes[j]) == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_the_conversations_match_brute_force(spark):
    rows = table(spark, SF, "conversations")
    given = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    broken = repair.damaged(rows)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, broken.collect()), key=key) == sorted(brute_damaged(given), key=key)
    assert collected(repair.repaired(broken, rows.select("conv_id"))) == brute(brute_damaged(given), [r[0] for r in given])


def odd_rows(seed, n=260):
    rng = random.Random(seed)
    texts = ["Good.", "Good.", "Well then", "", " \t", None, "No!", "Why?\n", "é.", "a b", "x" * 20_000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "unicorn"]
    return [(rng.choice([1, 1, 1, 2, 3, None, 4 + i % 40]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("segment_rows", [50_000, 7])
def test_odd_rows_and_conversations_over_many_segments(spark, segment_rows):
    given = odd_rows(1)
    rows = spark.createDataFrame(given, CHATS)
    wide = rows.withColumns({"key": F.lit(1), "kind": F.lit("x"), "digest": F.lit(2), "n": F.lit(3.0), "copy_": F.lit(0)})
    want = brute(brute_damaged(given), [r[0] for r in given])
    assert max(len(v[6]) for v in want.values()) > 60
    assert collected(repair.repaired(repair.damaged(wide), wide.select("conv_id", "n"), segment_rows)) == want


def test_conversations_without_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], CHATS)
    assert repair.repaired(repair.damaged(none), none).count() == 0
    got = collected(repair.repaired(none, spark.createDataFrame([(5,), (None,), (5,)], "conv_id long")))
    assert got == {i: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in (5, None)}


def test_long_conversations_take_time_in_proportion(spark):
    rows = [("ua"[i % 3 % 2], "truncated" if i % 7 == 0 else "") for i in range(6000)]
    cost, audit = repair.ended(repair.cheapest(rows))
    assert len(audit) >= 6000 and cost > 0
