"""Per-base work that built-in expressions do too slowly, as numpy over Arrow batches.

Sliding windows and k-mers built from higher-order functions ran 40 times slower than these and
more. Each kernel looks at one batch at a time; Spark does all partitioning and grouping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# How many bases a kernel holds as integers at a time.
SLICE_BASES = 1_000_000

NOT_A_BASE = 4
CODE_OF_LETTER = np.full(256, NOT_A_BASE, dtype=np.int64)
for _code, _letter in enumerate("ACGT"):
    CODE_OF_LETTER[ord(_letter)] = _code
    CODE_OF_LETTER[ord(_letter.lower())] = _code


def letters_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array in one row, and where each string starts (one more at the end)."""
    if isinstance(strings, pa.ChunkedArray):
        strings = strings.combine_chunks()
    strings = strings.cast(pa.large_binary())
    if strings.null_count:
        strings = strings.fill_null(b"")
    _, offsets, data = strings.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[strings.offset:strings.offset + len(strings) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), starts - starts[0]
    letters = np.frombuffer(data, dtype=np.uint8)[starts[0]:starts[-1]]
    return letters, starts - starts[0]


def row_slices(strings: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of whole rows with about SLICE_BASES letters each."""
    _, starts = letters_of(strings)
    row, rows = 0, len(strings)
    while row < rows:
        stop = int(np.searchsorted(starts, starts[row] + SLICE_BASES, side="right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield row, stop
        row = stop


def window_trim(qual: pa.Array, window: int, mean_q: float, front: bool, tail: bool) -> pa.StructArray:
    """First kept position (from 1) and kept length of each read.

    ``front`` drops bases until the window starting there has mean quality ``mean_q`` or more;
    ``tail`` does the same from the other end, on what ``front`` left. A read without such a
    window, or shorter than the window, is left with nothing.
    """
    letters, starts = letters_of(qual)
    begin, end = starts[:-1].copy(), starts[1:].copy()
    if window < 1:
        raise ValueError("window must be at least 1")
    if (front or tail) and len(letters):
        total = np.concatenate([[0], np.cumsum(letters.astype(np.int64) - 33)])
        at = np.arange(len(letters) + 1, dtype=np.int64)
        owner_end = np.repeat(ends := starts[1:], np.diff(starts))
        fits = np.zeros(len(letters) + 1, dtype=bool)
        fits[:-1] = at[:-1] + window <= owner_end
        good = np.zeros(len(letters) + 1, dtype=bool)
        good[:-1][fits[:-1]] = (
            total[at[:-1][fits[:-1]] + window] - total[at[:-1][fits[:-1]]] >= mean_q * window)
        if front:
            after = np.where(good, at, len(letters))
            next_good = np.minimum.accumulate(after[::-1])[::-1]
            begin = np.minimum(next_good[begin], ends)
        if tail:
            before = np.where(good, at, -1)
            last_good = np.maximum.accumulate(before)[np.maximum(end - 1, 0)]
            own = (last_good >= begin) & (last_good < end)
            end = np.where(own, last_good + window, begin)
    elif front or tail:
        end = begin
    return pa.StructArray.from_arrays(
        [pa.array(begin - starts[:-1] + 1, pa.int32()), pa.array(end - begin, pa.int32())],
        names=["start", "kept"])


def quality_sum(qual: pa.Array) -> pa.Array:
    """Sum of Phred+33 qualities of each read."""
    letters, starts = letters_of(qual)
    total = np.concatenate([[0], np.cumsum(letters.astype(np.int64) - 33)])
    return pa.array(total[starts[1:]] - total[starts[:-1]], pa.int64())


def _kmer_codes(letters: np.ndarray, k: int, canonical: bool) -> tuple[np.ndarray, np.ndarray]:
    """2-bit code of every k-letter window, and whether all its letters are bases.

    Codes of 1, 2, 4, ... letters are joined to k letters, so the work grows with log k.
    """
    codes = CODE_OF_LETTER[letters]
    bad = np.concatenate([[0], np.cumsum(codes == NOT_A_BASE)])
    n = len(codes) - k + 1
    clean = bad[k:] == bad[:n]
    part, part_rc, size = codes & 3, 3 - (codes & 3), 1
    forward, reverse, have = part, part_rc, 0
    while have < k:
        if k & size:
            starts = len(part) - have
            if have:
                forward = (forward[:starts] << (2 * size)) | part[have:]
                if canonical:
                    reverse = (part_rc[have:] << (2 * have)) | reverse[:starts]
            else:
                forward, reverse = part, part_rc
            have += size
        starts = len(part) - size
        if have < k:
            part = (part[:starts] << (2 * size)) | part[size:]
            if canonical:
                part_rc = (part_rc[size:] << (2 * size)) | part_rc[:starts]
            size *= 2
    return (np.minimum(forward, reverse) if canonical else forward), clean


def _count_pairs(row: np.ndarray, codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, code) pairs, in order, and how often each occurs. ``row`` is not decreasing."""
    near = row - row[0]
    if 2 * k + int(near[-1]).bit_length() <= 62:
        pair = np.sort((near << (2 * k)) | codes)
        first = np.flatnonzero(np.concatenate([[True], np.diff(pair) != 0]))
        pair, end = pair[first], len(pair)
        row, codes = (pair >> (2 * k)) + row[0], pair & ((1 << (2 * k)) - 1)
    else:
        order = np.lexsort((codes, row))
        row, codes = row[order], codes[order]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(codes) != 0)]))
        row, codes, end = row[first], codes[first], len(order)
    return row, codes, np.diff(np.concatenate([first, [end]]))


def _slices(starts: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of at most SLICE_BASES windows that together hold every window once."""
    size = int(starts[-1])
    for begin in range(0, max(size - k + 1, 0), SLICE_BASES):
        yield begin, min(begin + SLICE_BASES + k - 1, size)


def kmer_rows(batches: Iterator[pa.RecordBatch], keys: list[str], k: int, canonical: bool,
              schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per key and distinct k-mer of a slice, with its number of occurrences.

    Long sequences are cut into slices that overlap by k - 1, so nothing grows with their length.
    """
    for batch in batches:
        letters, starts = letters_of(batch.column("seq"))
        for begin, end in _slices(starts, k):
            codes, clean = _kmer_codes(letters[begin:end], k, canonical)
            at = np.arange(begin, begin + len(codes), dtype=np.int64)
            row = np.searchsorted(starts, at, side="right") - 1
            keep = clean & (at + k <= starts[row + 1])
            row, codes = row[keep], codes[keep]
            if not len(codes):
                continue
            row, codes, n = _count_pairs(row, codes, k)
            taken = pa.array(row, pa.int64())
            columns = [batch.column(key).take(taken) for key in keys]
            columns += [pa.array(codes, pa.int64()), pa.array(n, pa.int64())]
            out = pa.RecordBatch.from_arrays(columns, schema=schema)
            for i in range(0, out.num_rows, 100_000):
                yield out.slice(i, 100_000)
