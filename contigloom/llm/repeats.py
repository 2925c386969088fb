"""Substring dedup with difference-cover anchors.

A window of ``WINDOW`` words is removed from a document if the same words, in a row, start in a document with a smaller
doc_id. Any two equal windows share an aligned anchor: the places of a difference cover modulo ``PERIOD`` are such that
for any two starts there is one shift below the period that brings both to places of the cover. An anchor is the
``WINDOW`` - ``PERIOD`` + 1 words at such a place, so the shifted anchor still lies in the window. Only anchors are hashed and
compared over all documents (three of seven places); where an anchor is shared by two documents, the windows around it are
extended to full length, hashed and compared in turn. Windows without a shared anchor can't repeat elsewhere.

Documents are dealt to batches of about ``BATCH_BYTES`` of text, once. Hashes travel as packed arrays from batches to buckets by hash
and back; equal values of a batch are one entry, so a passage in very many documents meets as one entry per batch. For
anchors, 32 bits within a bucket are compared: a chance hit costs a needless extension, no wrong result. Windows carry a hash by which
they meet (64 bits), a cryptographic digest of their words (32 bits), and the smallest doc_id of the batch that has them; windows are
equal where both are, so by 96 bits. Nothing is listed per pair.

Words are runs of other characters than space and controls 9 to 13, unchanged. Null text: no words. Null doc_id: greater than
any other. Repeated rows (equal doc_id): neither removes from the other. An empty table gives an empty result. Extra columns
are left out.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.llm.wordhash import Words, windows, words_of

WINDOW = 13
PERIOD, COVER = 7, (1, 2, 4)  # a perfect difference set: each shift modulo 7 is a difference of two of its numbers
ANCHOR = WINDOW - PERIOD + 1
BATCH_BYTES = 4_000_000
BUCKET_BYTES = 16_000_000  # of text whose hashes meet in a bucket

_PACKED = "bucket long, batch long, packed binary, digests binary, least binary"
_COLUMNS = [c.split()[0] for c in _PACKED.split(", ")]


class _Batch:
    """The words of a batch's documents, and which hold a shared anchor."""

    def __init__(self, docs: pd.DataFrame):
        self.docs = docs
        self.ids = docs["doc_id"].to_numpy(dtype=np.int64)
        self.words: Words = words_of(docs["text"].tolist())
        self.bounds = self.words.bounds(len(docs))
        self.id_of_word = self.ids[self.words.text]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        place = np.arange(len(self.words.hash)) - self.bounds[self.words.text]
        return windows(self.words, ANCHOR, np.isin(place % PERIOD, COVER))

    def digests(self, at: np.ndarray) -> np.ndarray:
        """A digest of the words of the window at each place."""
        told: list[bytes] = []
        if len(at):
            data, start, end = self.words.data, self.words.start, self.words.end
            plain = b" ".join([data[s:e] for s, e in zip(start.tolist(), end.tolist())])
            ends = np.cumsum(end - start + 1) - 1
            begins = ends - (end - start)
            told = [hashlib.blake2b(plain[a:b], digest_size=4).digest() for a, b in zip(begins[at].tolist(), ends[at + WINDOW - 1].tolist())]
        return np.frombuffer(b"".join(told), dtype=np.uint32)

    def around(self, shared: np.ndarray) -> np.ndarray:
        """For each word, whether a window that starts there holds one of the anchors that start at ``shared``."""
        step = np.zeros(len(self.words.hash) + 1, dtype=np.int64)
        first = np.maximum(shared - PERIOD + 1, self.bounds[self.words.text[shared]])
        np.add.at(step, first, 1)
        np.add.at(step, shared + 1, -1)
        return np.cumsum(step[:-1]) > 0


class _Windows(NamedTuple):
    """Distinct windows in order of their hash: hash, digest, smallest id; and the place of each given row among them."""

    value: np.ndarray
    digest: np.ndarray
    least: np.ndarray
    place: np.ndarray


def _distinct(value: np.ndarray, digest: np.ndarray, ids: np.ndarray) -> _Windows:
    order = np.lexsort((digest, value))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (value[order][1:] != value[order][:-1]) | (digest[order][1:] != digest[order][:-1])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    least = np.full(int(new.sum()), np.iinfo(np.int64).max)
    np.minimum.at(least, place, ids)
    return _Windows(value[order][new], digest[order][new], least, place)


def _dealt(batch: int, value: np.ndarray, n_buckets: int, windows_: _Windows | None) -> pd.DataFrame:
    """Rows of packed values by bucket: ``value`` is distinct. Of anchors, the low bits alone."""
    bucket = ((value >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    rows = []
    for name, a, b in zip(names, starts, [*starts[1:], len(order)]):
        own = order[a:b]
        if windows_ is None:
            rows.append((name, batch, np.unique(value[own].astype(np.uint32)).tobytes(), None, None))
        else:
            rows.append((name, batch, value[own].tobytes(), windows_.digest[own].tobytes(), windows_.least[own].tobytes()))
    return pd.DataFrame(rows, columns=_COLUMNS)


def _joined(parts, kind) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=kind)


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted ``wanted``."""
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def _returned(rows: pd.DataFrame, n_buckets: int, value: np.ndarray) -> np.ndarray:
    """Which anchors the buckets have sent back."""
    bucket = (value >> np.uint64(33)) % np.uint64(n_buckets)
    sent = [np.frombuffer(p, np.uint32).astype(np.uint64) + (np.uint64(b) << np.uint64(32)) for b, p in zip(rows["bucket"], rows["packed"])]
    return _among((bucket << np.uint64(32)) + (value & np.uint64(0xFFFFFFFF)), np.sort(np.concatenate([np.zeros(0, np.uint64), *sent])))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by a space) of each document."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_batches, n_buckets = total // BATCH_BYTES + 1, total // BUCKET_BYTES + 1
    last = np.iinfo(np.int64).max
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)).alias("batch"), F.coalesce("doc_id", F.lit(last)).alias("doc_id"), "text",
                        F.col("doc_id").isNull().alias("no_id"))

    def send_anchors(docs: pd.DataFrame) -> pd.DataFrame:
        value, _ = _Batch(docs).anchors()
        return _dealt(docs["batch"].iloc[0], np.unique(value), n_buckets, None)

    def shared_anchors(rows: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(p, np.uint32) for p in rows["packed"]]
        value = np.sort(np.concatenate(own))
        twice = np.unique(value[1:][value[1:] == value[:-1]])
        back = rows.assign(packed=[o[_among(o, twice)].tobytes() for o in own])
        return back[[len(p) > 0 for p in back["packed"]]]

    def send_windows(key: tuple, docs: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=_COLUMNS)
        batch = _Batch(docs)
        value, at = batch.anchors()
        # what repeats within the batch alone is seen when words are removed
        found, start = windows(batch.words, WINDOW, batch.around(at[_returned(back, n_buckets, value)]))
        own = _distinct(found, batch.digests(start), batch.id_of_word[start])
        return _dealt(key[0], own.value, n_buckets, own)

    def earlier_windows(rows: pd.DataFrame) -> pd.DataFrame:
        digest = _joined(rows["digests"], np.uint32)
        value, ids = _joined(rows["packed"], np.uint64), _joined(rows["least"], np.int64)
        own = _distinct(value, digest, ids)
        late = own.least[own.place] < ids  # a batch with a smaller doc_id has it too
        cut = np.cumsum([0, *[len(p) // 8 for p in rows["packed"]]])
        back = rows.assign(packed=[value[a:b][late[a:b]].tobytes() for a, b in zip(cut, cut[1:])],
                           digests=[digest[a:b][late[a:b]].tobytes() for a, b in zip(cut, cut[1:])], least=None)
        return back[[len(p) > 0 for p in back["packed"]]]

    def remove(key: tuple, docs: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=["doc_id", "n_words", "n_removed", "kept"])
        batch = _Batch(docs)
        value, at = windows(batch.words, WINDOW)
        late = _joined(back["packed"], np.uint64)
        _, place, times = np.unique(value, return_inverse=True, return_counts=True)
        likely = np.flatnonzero((times > 1)[place] | _among(value, np.sort(late)))
        # equal hashes choose what to look at, digests of the words decide
        n, late_digest = len(likely), _joined(back["digests"], np.uint32)
        own = _distinct(np.concatenate([value[likely], late]), np.concatenate([batch.digests(at[likely]), late_digest]),
                        np.concatenate([batch.id_of_word[at[likely]], np.full(len(late), np.iinfo(np.int64).min)]))
        gone = at[likely[own.least[own.place[:n]] < batch.id_of_word[at[likely]]]]
        step = np.zeros(len(batch.words.hash) + 1, dtype=np.int64)
        np.add.at(step, gone, 1)
        np.add.at(step, gone + WINDOW, -1)
        stay = np.cumsum(step[:-1]) == 0
        data, start, end = batch.words.data, batch.words.start, batch.words.end
        kept, removed = [], []
        for a, b in zip(batch.bounds, batch.bounds[1:]):
            own = np.flatnonzero(stay[a:b]) + a
            kept.append(b" ".join([data[s:e] for s, e in zip(start[own].tolist(), end[own].tolist())]).decode("utf-8", "surrogatepass"))
            removed.append(b - a - len(own))
        ids = pd.Series(batch.ids, dtype="Int64").mask(docs["no_id"].to_numpy())
        return pd.DataFrame({"doc_id": ids, "n_words": np.diff(batch.bounds), "n_removed": removed, "kept": pd.Series(kept, dtype=object)})

    # the documents' exchange by batch is the same three times, and runs once
    by_batch = dealt.groupBy("batch")
    anchors = by_batch.applyInPandas(send_anchors, _PACKED)
    anchors = anchors.groupBy("bucket").applyInPandas(shared_anchors, _PACKED)
    found = by_batch.cogroup(anchors.groupBy("batch")).applyInPandas(send_windows, _PACKED)
    found = found.groupBy("bucket").applyInPandas(earlier_windows, _PACKED)
    return by_batch.cogroup(found.groupBy("batch")).applyInPandas(remove, "doc_id long, n_words long, n_removed long, kept string")
