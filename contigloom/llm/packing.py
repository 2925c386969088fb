"""Best-two-fit packing of token sequences.

Only lengths decide a packing, and there are at most ``size`` of them: Spark counts the pieces of each length, the driver
packs the counts (bins of one pattern at a time: greedy fill, then the smallest piece of the bin gives way to the two
unpacked ones that fill its expanded gap best), and Spark deals the pieces out to the places of the patterns by their
number among the pieces of their length. What the driver holds is bounded by ``size``, not by the input.

Null text: an empty document, one piece with the closing id alone. Ties and repeated rows: any order among equal lengths.
An empty table gives an empty result. Extra columns pass through ``tokenise``, ``pack`` keeps all columns of its pieces.
"""

from __future__ import annotations

import os
import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.llm.wordhash import in_chunks
from contigloom.session import bound_arrow_batches, settle

SIZE = 2048
CACHED_WORDS = 250_000  # per worker, some 120 MB; the ids of a word don't depend on what is around it
PART_ROWS = 1_000_000  # pieces of one length are numbered in parts of about so many at most

#: What splits a word before the merges: a fixed value of the public vocabulary.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = re.compile(r"[^ \t-\r]+")
#: What str.split() takes for a blank and the vocabulary does not, or not as a byte: texts with it are left to the tokenizer.
_ODD = b"\x1c\x1d\x1e\x1f\x85\xa0"


def _printable_bytes() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else 256 and up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + moved.index(b)) for b in range(256)}


class _Encoder:
    """Token ids of texts, word by word: the tokenizer's rules don't reach over blanks.

    In texts of Latin characters, lower case is taken at once and a new word is cut by the vocabulary's own pattern;
    other texts have each new word encoded by the tokenizer as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.cut = self.tokenizer.model, regex.compile(_PIECES).findall
        self.bytes = _printable_bytes()
        self.known: dict[tuple | str, int] = {}  # pieces and lower-case words; raw words as (word,)
        self.flat, self.first = array("I", [0]), array("q", [0, 1])  # word 0 is the closing id
        self.uses = np.zeros(1, dtype=np.int64)

    def _forget(self) -> None:
        """Drop the words that were met once or twice."""
        kept = {key: i for key, i in self.known.items() if i < len(self.uses) and self.uses[i] > 2}
        kept = kept if len(kept) < CACHED_WORDS // 2 else {}
        flat, first = self.flat, self.first
        self.known, self.flat, self.first = {}, array("I", [0]), array("q", [0, 1])
        for key, i in kept.items():
            self._add(key, flat[first[i]:first[i + 1]])
        self.uses = np.zeros(len(self.first) - 1, dtype=np.int64)

    def _add(self, key: tuple | str, ids) -> int:
        self.flat.extend(ids)
        self.first.append(len(self.flat))
        at = self.known[key] = len(self.first) - 2
        return at

    def _new(self, key: tuple | str) -> int:
        at = self.known.get(key)
        if at is not None:  # twice in the text that brought it
            return at
        if isinstance(key, tuple):
            return self._add(key, self.tokenizer.encode(key[0], add_special_tokens=False).ids)
        pieces = None if key.isalpha() else self.cut(key)
        if pieces is None or pieces == [key]:
            spelled = key if key.isascii() and key.isprintable() else "".join([self.bytes[b] for b in key.encode()])
            return self._add(key, [t.id for t in self.model.tokenize(spelled)])
        ids = array("I")
        for i in map(self._new, pieces):
            ids.extend(self.flat[self.first[i]:self.first[i + 1]])
        return self._add(key, ids)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the closing id 0, and where each text's ids end."""
        if len(self.known) > CACHED_WORDS:
            self._forget()
        known, new, at, ends = self.known, self._new, [], []
        for text in texts:
            try:
                plain = "<|" not in text and len(raw := text.encode("latin-1")) == len(raw.translate(None, _ODD))
            except UnicodeEncodeError:
                plain = False
            keys = text.lower().split() if plain else [(w,) for w in _WORD.findall(text)]
            found = list(map(known.get, keys))
            if None in found:
                found = [new(k) if i is None else i for k, i in zip(keys, found)]
            at += found
            at.append(0)
            ends.append(len(at))
        at = np.array(at, dtype=np.int64)
        uses = np.bincount(at, minlength=len(self.first) - 1)
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        flat, first = np.array(self.flat, dtype="<u4"), np.array(self.first)
        length = first[at + 1] - first[at]
        after = np.cumsum(length)
        return flat[np.repeat(first[at] - after + length, length) + np.arange(after[-1])], after[np.array(ends) - 1]


def _encoder(path: str) -> _Encoder:
    """The Python worker's encoder, kept for the tasks that it runs later: what it has learnt of words stays true."""
    kept = sys.modules.setdefault("contigloom_worker_encoders", types.ModuleType("contigloom_worker_encoders")).__dict__
    if path not in kept:
        kept[path] = _Encoder(path)
    return kept[path]


def tokenise(docs: DataFrame, tokenizer_path: str, size: int = SIZE) -> DataFrame:
    """One row per piece: the document's other columns, piece, start, length, ids (binary, little-endian unsigned 32-bit).

    A document of more than ``size`` ids (its closing id 0 counts) is cut into pieces of ``size``.
    """

    @F.pandas_udf("array<binary>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(tokenizer_path)
        for texts in batches:
            out = []
            for _, part in in_chunks(texts.tolist()):
                ids, ends = encoder.texts([t or "" for t in part])
                for a, b in zip([0, *ends[:-1]], ends):
                    out.append([ids[i:min(i + size, b)].tobytes() for i in range(a, b, size)])
            yield pd.Series(out)

    bound_arrow_batches(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("text", "piece", "start", "length", "ids")]
    # else the optimizer puts a second call of it into a filter before the explode
    rows = docs.select(*columns, cut.asNondeterministic()(F.col("text")).alias("pieces"))
    rows = rows.select(*columns, F.posexplode("pieces").alias("piece", "ids"))
    return rows.withColumns({"start": F.col("piece").cast("long") * size,
                             "length": (F.octet_length("ids") / 4).cast("long")})


def _fit(left: np.ndarray, gap: int) -> int:
    """The greatest length that is left and fits, or 0."""
    fits = np.flatnonzero(left[:gap + 1])
    return int(fits[-1]) if len(fits) else 0


def _best_two(left: np.ndarray, gap: int, more_than: int) -> tuple[int, int] | None:
    """Two lengths that are left and fill the gap best, if they fill more than ``more_than`` of it."""
    there = np.flatnonzero(left[:gap + 1])
    if not len(there) or there[0] * 2 > gap:
        return None
    low, high, best = 0, len(there) - 1, None
    while low <= high:
        a, b = int(there[low]), int(there[high])
        if a + b > gap or low == high and left[a] < 2:
            high -= 1
            continue
        if a + b > more_than:
            more_than, best = a + b, (b, a)
        if a + b == gap:
            break
        low += 1
    return best


def pack_counts(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one bin) and how many bins have each, for so many pieces of each length.

    Replacing helps where small pieces are plenty. So the least of two packings is taken: the smallest piece gives way
    to any two that fill more, or only to two that fill the bin to the last place.
    """
    return min((_pack(counts, size, least) for least in (0, size)), key=lambda patterns: sum(n for _, n in patterns))


def _pack(counts: dict[int, int], size: int, least_fill: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = []
    while left.any():
        spare, gap, held = left.copy(), size, []
        while gap and (length := _fit(spare, gap)):
            held.append(length)
            spare[length] -= 1
            gap -= length
        while gap and len(held) > 1:  # the largest stays
            least = held[-1]
            two = _best_two(spare, gap + least, max(least, least_fill - size + gap + least - 1))
            if two is None:
                break
            held[-1:] = two
            held.sort(reverse=True)
            spare[least] += 1
            spare[two[0]] -= 1
            spare[two[1]] -= 1
            gap -= sum(two) - least
        uses = np.bincount(held, minlength=size + 1)
        n = int(min(left[x] // uses[x] for x in set(held)))
        left -= uses * n
        patterns.append((tuple(held), n))
    return patterns


def _places(patterns: list[tuple[tuple[int, ...], int]], size: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: number of the first piece that goes to each place, the first bin of the place, the offset in its bins."""
    found: dict[int, list] = {}
    taken, bins = np.zeros(size + 1, dtype=np.int64), 0
    for held, n in patterns:
        offset = 0
        for length in held:
            found.setdefault(length, []).append((taken[length], bins, offset))
            taken[length] += n
            offset += length
        bins += n
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for length, rows in found.items()}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` (1 to ``size``) is the only column that counts.

    The pieces are kept in the shared folder on the way: drop large columns first.
    """
    columns = pieces.columns
    rows = settle(pieces)
    n_salts = rows.count() // PART_ROWS + 1
    rows = rows.withColumn("salt_", F.pmod(F.xxhash64(*columns), F.lit(n_salts)))
    found = rows.groupBy("length", "salt_").agg(F.count("*").alias("n_"))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.sum("n_").alias("n")).collect()}
    places = _places(pack_counts(counts, size), size)

    # a number for each piece among those of its length: within its part, after the parts before
    before = Window.partitionBy("length").orderBy("salt_").rowsBetween(Window.unboundedPreceding, -1)
    starts = found.select("length", "salt_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"))
    within = F.row_number().over(Window.partitionBy("length", "salt_").orderBy(*columns))
    numbered = rows.withColumn("within_", within).join(starts, ["length", "salt_"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        length, number = length.to_numpy(), number.to_numpy()
        bins, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for x in np.unique(length):
            mine = length == x
            first, start, off = places[int(x)]
            at = np.searchsorted(first, number[mine], side="right") - 1
            bins[mine] = start[at] + number[mine] - first[at]
            offset[mine] = off[at]
        return pd.DataFrame({"sequence_id": bins, "offset": offset})

    placed = numbered.withColumn("place_", place(F.col("length"), F.col("before_") + F.col("within_") - 1))
    kept = [c for c in columns if c not in ("sequence_id", "offset")]
    return placed.select(*kept, "place_.sequence_id", "place_.offset")
