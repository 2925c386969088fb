"""Repair of conversation structure: the cheapest edits that make the roles ``(s?(ua)+)?``, found by a dynamic program.

Each row is kept, given another role or deleted, and empty user or assistant turns may be inserted anywhere. The program holds one cheapest
audit (the edits' initials in order) per state of that pattern. Audits are persistent: linked nodes that share their beginnings, each with its
ancestors at powers of two and a rolling hash. Of two audits of equal cost the smaller in ASCII order counts; it is found by a search
for their longest common prefix over the ancestors' hashes, and equal hashes of different nodes are verified letter by letter.

Rows are sorted by range over conversation and turn, so a conversation of any length is cut into segments, a task each. A segment's program
runs from every state if it may have begun or ends inside a conversation, and the segments of a conversation are combined by what
they cost from state to state. That loses nothing: two audits of one segment with equal cost and states are never one the beginning of
the other, as the longer one would have more insertions. Equal rows of a conversation travel as one with a count. The audit and the hash
of a conversation are single values by definition: the audit is held in one task, and the texts pass through it in order, row by row.

Nulls in role or text: one space. Rows with equal turn: by role, then by the text's hash, so equal rows stand together. Null turns come first
and don't count for gaps. A null conv_id is a conversation. An empty table gives an empty result; conversations without rows have zeros, an
empty audit and the hash of the empty text. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigloom.session import bound_arrow_batches, settle

BLANKS = " \t\n\x0b\x0c\r"
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; what is kept costs nothing, truncated rows that stay cost more
START, SYSTEM, USER, ASSISTANT = range(4)  # the last role that the repaired conversation has so far
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what may be inserted or renamed to
ROLES = {USER: "user", ASSISTANT: "assistant"}
SEGMENT_ROWS = 50_000
MODULUS, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E6F


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: the rows with faults chosen by their hash."""
    fault = (F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20).alias("fault_")
    rows = rows.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), fault).filter("fault_ <> 0")
    role = F.when(F.col("fault_") == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(F.col("fault_") == 1, F.lit("")).when(F.col("fault_") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("fault_") == 3, F.lit(2)).otherwise(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy_")).drop("copy_")


class Audits:
    """Strings of edits that share their beginnings. Node 0 is the empty one; equal strings are one node."""

    def __init__(self):
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.above: list[list[int]] = [[]]  # ancestors 1, 2, 4, ... letters shorter
        self.known: dict[tuple[int, str], int] = {}

    def push(self, node: int, letter: str) -> int:
        at = self.known.get((node, letter))
        if at is None:
            at = self.known[node, letter] = len(self.letter)
            above = [node]
            while len(self.above[above[-1]]) >= len(above):
                above.append(self.above[above[-1]][len(above) - 1])
            self.letter.append(letter)
            self.depth.append(self.depth[node] + 1)
            self.hash.append((self.hash[node] * BASE + ord(letter)) % MODULUS)
            self.above.append(above)
        return at

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.above[node][0]
        return "".join(reversed(out))

    def _up(self, node: int, depth: int) -> int:
        """The beginning of so many letters."""
        while self.depth[node] > depth:
            node = self.above[node][(self.depth[node] - depth).bit_length() - 1]
        return node

    def _same(self, a: int, b: int) -> bool:
        return a == b or self.hash[a] == self.hash[b] and self.depth[a] == self.depth[b] and self.text(a) == self.text(b)

    def common(self, a: int, b: int) -> int:
        """Letters of the longest common beginning."""
        depth = min(self.depth[a], self.depth[b])
        a, b = self._up(a, depth), self._up(b, depth)
        if self._same(a, b):
            return depth
        for k in range(len(self.above[a]) - 1, -1, -1):
            if k < len(self.above[a]) and not self._same(self.above[a][k], self.above[b][k]):
                a, b = self.above[a][k], self.above[b][k]
        return self.depth[a] - 1

    def less(self, a: int, b: int) -> bool:
        n = self.common(a, b)
        if n in (self.depth[a], self.depth[b]):
            return self.depth[a] < self.depth[b]
        return self.letter[self._up(a, n + 1)] < self.letter[self._up(b, n + 1)]


class _Held:
    """The cheapest audit of each state."""

    def __init__(self, audits: Audits):
        self.audits = audits
        self.cost: list[int | None] = [None] * 4
        self.node = [0] * 4

    def offer(self, state: int, cost: int, node: int, letter: str) -> None:
        old = self.cost[state]
        if old is None or cost < old:
            self.cost[state], self.node[state] = cost, self.audits.push(node, letter)
        elif cost == old:
            new = self.audits.push(node, letter)
            if self.audits.less(new, self.node[state]):
                self.node[state] = new

    def insert(self) -> None:
        """Offer insertions: users first, then assistants after them. More of them never pay."""
        for state in (START, SYSTEM, ASSISTANT, USER):
            if self.cost[state] is not None:
                self.offer(AFTER[state], self.cost[state] + INSERT, self.node[state], "I")


def cheapest(rows: list[tuple[str, str]], start: int = START) -> list[tuple[int, str] | None]:
    """For each state at the end the cheapest edits (cost, audit) from ``start``; rows are (role's initial, fault or empty)."""
    held = _Held(Audits())
    held.cost[start] = 0
    for initial, fault in rows:
        held.insert()
        after = _Held(held.audits)
        for state in range(4):
            cost, node = held.cost[state], held.node[state]
            if cost is None:
                continue
            after.offer(state, cost + DELETE, node, "D")
            if fault in ("blank", "duplicate"):
                continue
            cost += TRUNCATED if fault else 0
            to = AFTER[state]
            if initial == ROLES[to][0]:
                after.offer(to, cost, node, "K")
            else:
                after.offer(to, cost + RENAME, node, "R")
            if initial == "s" and state == START:
                after.offer(SYSTEM, cost, node, "K")
        held = after
    return [None if c is None else (c, held.audits.text(n)) for c, n in zip(held.cost, held.node)]


def _then(held: list[tuple[int, str] | None], steps: list[list[tuple[int, str] | None]]) -> list[tuple[int, str] | None]:
    """What is held per state, followed by a segment's cheapest from state to state."""
    return [min([(held[i][0] + steps[i][j][0], held[i][1] + steps[i][j][1]) for i in range(4) if held[i] and steps[i][j]], default=None) for j in range(4)]


def ended(held: list[tuple[int, str] | None]) -> tuple[int, str]:
    """The cheapest whole audit: last insertions, and an end after an assistant or with nothing at all."""
    out = [held[START], held[ASSISTANT]]
    for state, n in ((USER, 1), (START, 2), (SYSTEM, 2)):
        if held[state]:
            out.append((held[state][0] + n * INSERT, held[state][1] + "I" * n))
    return min(x for x in out if x)


ALLOWED = ("su", "ua", "au")
_PART = "key string, seg int, edge boolean, costs array<long>, audits array<string>, illegal long, first string, last string"


def _segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation and segment: its cheapest audits, from the start alone unless the segment may cut the conversation."""
    held: list[tuple[str, str, int]] = []
    key = seg = None
    done: list[tuple] = []
    whole = False  # whether the conversation began in this segment

    def closed(edge: bool) -> tuple:
        rows = []
        illegal = 0
        for k, (initial, fault, n) in enumerate(held):
            rows.append((initial, fault))
            rows += [(initial, "blank" if fault == "blank" else "duplicate")] * (n - 1)
            illegal += n - 1 + (k > 0 and held[k - 1][0] + initial not in ALLOWED)
        found = [cheapest(rows, s) if edge or s == START else [None] * 4 for s in range(4)]
        flat = [x for own in found for x in own]
        return (key, seg, edge, [-1 if x is None else x[0] for x in flat], ["" if x is None else x[1] for x in flat], illegal, held[0][0], held[-1][0])

    for frame in frames:
        for k, s, initial, fault, n in frame[["key", "seg", "initial", "fault", "n"]].itertuples(index=False):
            if k != key:
                if held:
                    done.append(closed(not whole))
                    whole = True
                key, seg, held = k, s, []
            held.append((initial, fault, int(n)))
        if done:
            yield pd.DataFrame(done, columns=[c.split()[0] for c in _PART.split(", ")])
            done = []
    if held:
        yield pd.DataFrame([closed(True)], columns=[c.split()[0] for c in _PART.split(", ")])


_DECIDED = "key string, cost long, audit string, illegal long"


def _matrix(costs, audits) -> list[list[tuple[int, str] | None]]:
    flat = [None if c < 0 else (int(c), a) for c, a in zip(costs, audits)]
    return [flat[4 * i:4 * i + 4] for i in range(4)]


def _whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        best = [ended(_matrix(c, a)[START]) for c, a in zip(frame["costs"], frame["audits"])]
        yield pd.DataFrame({"key": frame["key"], "cost": [c for c, _ in best], "audit": [a for _, a in best], "illegal": frame["illegal"]})


def _combined(parts: pd.DataFrame) -> pd.DataFrame:
    """The segments of one conversation, in order: as many rows as segments hold it."""
    parts = parts.sort_values("seg")
    held: list[tuple[int, str] | None] = [(0, ""), None, None, None]
    for costs, audits in zip(parts["costs"], parts["audits"]):
        held = _then(held, _matrix(costs, audits))
    between = sum(a + b not in ALLOWED for a, b in zip(parts["last"].iloc[:-1], parts["first"].iloc[1:]))
    cost, audit = ended(held)
    return pd.DataFrame([(parts["key"].iloc[0], cost, audit, int(parts["illegal"].sum()) + between)], columns=["key", "cost", "audit", "illegal"])


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """key and hash of each conversation: its audit comes first, then its rows in order. Nothing but the audit is held."""
    key, edits, at, state, digest, lines = None, "", 0, START, None, 0

    def say(role: str, text: str) -> None:
        nonlocal lines
        digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        lines += 1

    def inserted() -> None:
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            state = AFTER[state]
            say(ROLES[state], "")
            at += 1

    for frame in frames:
        out = []
        for k, kind, role, text in frame[["key", "kind", "role", "text"]].itertuples(index=False):
            if kind == 0:
                if key is not None:
                    inserted()
                    out.append((key, digest.hexdigest()))
                key, edits, at, state, digest, lines = k, text, 0, START, hashlib.sha256(), 0
                continue
            inserted()
            edit = edits[at]
            at += 1
            if edit == "K":
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                say(role, text)
            elif edit == "R":
                state = AFTER[state]
                say(ROLES[state], text)
        yield pd.DataFrame(out, columns=["key", "repaired_sha256"])
    if key is not None:
        inserted()
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "repaired_sha256"])


def repaired(rows: DataFrame, conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """conv_id of all ``conversations``, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of ``rows``."""
    bound_arrow_batches(rows.sparkSession)
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key")
    rows = rows.select(key, "turn", _text("role").alias("role"), _text("text").alias("text"))
    rows = rows.withColumns({"no_turn": F.col("turn").isNotNull(), "digest": F.sha2("text", 256)})  # false sorts first
    order = ["key", "no_turn", "turn", "role", "digest"]
    said = F.rtrim("text", F.lit(BLANKS))
    cells = settle(rows.withColumns({"blank": said == "", "cut": ~F.right(said, F.lit(1)).isin(*".!?")})
                   .groupBy(*order).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")))
    same = ["key", "role", "digest"]
    firsts = cells.groupBy(*same).agg(F.min(F.struct("no_turn", "turn")).alias("first_"))
    cells = cells.join(firsts, same).withColumn("again", F.col("first_") != F.struct("no_turn", "turn"))
    fault = F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    cells = cells.select(*order, "n", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"))
    parts = cells.count() // segment_rows + 1
    cells = settle(cells.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("seg", F.spark_partition_id()))

    def count(name: str) -> Column:  # of equal rows the first may have another fault than the rest
        first = F.when(F.col("fault") == name, 1).otherwise(0)
        rest = F.when(F.when(F.col("fault") == "blank", "blank").otherwise("duplicate") == name, F.col("n") - 1).otherwise(0)
        return F.sum(first + rest).alias(name)

    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps")
    counts = cells.groupBy("key").agg(gaps, *[count(c) for c in ("blank", "duplicate", "truncated")])
    found = settle(cells.select("key", "seg", "initial", "fault", "n").mapInPandas(_segments, _PART))
    decided = settle(found.filter("not edge").mapInPandas(_whole, _DECIDED).unionByName(
        found.filter("edge").groupBy("key").applyInPandas(_combined, _DECIDED)))
    texts = rows.withColumn("kind", F.lit(1)).select(*order, "kind", "text").unionByName(
        decided.select("key", F.col("audit").alias("text"), F.lit(0).alias("kind")), allowMissingColumns=True)
    by = ["key", "kind", *order[1:]]
    hashes = texts.repartition(*["key"]).sortWithinPartitions(*by).select("key", "kind", "role", "text").mapInPandas(_hashed, "key string, repaired_sha256 string")
    every = conversations.select("conv_id", key).distinct()
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(counts, "key", "left").join(decided, "key", "left").join(hashes, "key", "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
