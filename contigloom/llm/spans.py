"""Spans in texts: (kind, start, end) with code points, end exclusive. Shared by the secret and personal-data scans."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def listed(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then by the kind's place in ``kinds``, joined by commas."""
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2])))


def digest(spans: list[Span], kinds: tuple[str, ...]) -> str:
    return hashlib.sha256(listed(spans, kinds).encode()).hexdigest()


def overlaps(span: Span, others: list[Span]) -> bool:
    return any(span[1] < b and a < span[2] for _, a, b in others)


def plain(span) -> Span:
    """A span as a Python function gets it from a column: a row, a dict or a tuple."""
    return tuple(span.values()) if isinstance(span, dict) else tuple(span)
