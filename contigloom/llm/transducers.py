"""Weighted finite-state transducers over small alphabets, with composition and best paths.

Each arc reads one symbol and writes one; weights add up along a path (the greatest sum is the best path).
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable
from typing import NamedTuple


class Arc(NamedTuple):
    read: str
    write: str
    weight: float
    to: Hashable


class Transducer:
    """``arcs`` of each state; paths begin at ``start`` and end in ``finals``."""

    def __init__(self, start: Hashable, arcs: dict[Hashable, list[Arc]], finals: Iterable[Hashable]):
        self.start, self.arcs, self.finals = start, arcs, set(finals)

    def compose(self, other: Transducer) -> Transducer:
        """What ``other`` makes of this one's output. Only state pairs that can be reached are built."""
        start = (self.start, other.start)
        arcs: dict[Hashable, list[Arc]] = {}
        open_ = [start]
        while open_:
            pair = open_.pop()
            if pair in arcs:
                continue
            mine, theirs = pair
            arcs[pair] = [Arc(a.read, b.write, a.weight + b.weight, (a.to, b.to))
                          for a in self.arcs.get(mine, []) for b in other.arcs.get(theirs, []) if a.write == b.read]
            open_ += [a.to for a in arcs[pair]]
        return Transducer(start, arcs, [p for p in arcs if p[0] in self.finals and p[1] in other.finals])

    def compiled(self) -> Machine:
        number = {state: i for i, state in enumerate(self.arcs)}
        table: list[dict[str, list[tuple[str, float, int]]]] = [{} for _ in number]
        for state, arcs in self.arcs.items():
            for a in arcs:
                table[number[state]].setdefault(a.read, []).append((a.write, a.weight, number[a.to]))
        return Machine(number[self.start], table, {number[s] for s in self.finals if s in number})


class Machine(NamedTuple):
    """A transducer with numbered states, for running."""

    start: int
    table: list[dict[str, list[tuple[str, float, int]]]]
    finals: set[int]

    def best(self, symbols: list[str], factors: list[float]) -> tuple[float, list[tuple[str, float]]]:
        """The greatest sum of arc weights, each times its symbol's factor, and (written symbol, factor) where the weight isn't zero."""
        held: dict[int, tuple[float, tuple | None]] = {self.start: (0.0, None)}
        for symbol, factor in zip(symbols, factors):
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, path) in held.items():
                for written, weight, to in self.table[state].get(symbol, ()):
                    total = score + weight * factor
                    if to not in after or total > after[to][0]:
                        after[to] = (total, (path, written, factor) if weight else path)
            held = after
        score, path = max((held[s] for s in held if s in self.finals), key=lambda x: x[0], default=(0.0, None))
        said = []
        while path:
            path, written, factor = path
            said.append((written, factor))
        return score, said[::-1]
