import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from contigloom.llm import packing
from contigloom.llm.queries import tokenizer_path
from tests.llm.cases import DOCS, ODD, docs, prose

STRANGE = [*ODD, "It's THE don't x²", "a\x1cb <|endoftext|> <|ENDOFTEXT|>q", "ΟΔΟΣ Σας İ ﬁ", "é\xa0è\x85n", "½½ ª~~``", "日本 語 w", prose(3000, 1)]


def whole_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def test_ids_are_those_of_the_whole_text_and_every_piece_has_its_place(spark):
    rows = docs(spark, STRANGE + [prose(50, i) for i in range(40)] + [prose(50, 3)]).withColumns({"piece": F.lit("x"), "n_": F.lit(1), "salt_": F.lit(0)})
    pieces = packing.pack(packing.tokenise(rows, tokenizer_path()))
    assert {"lang", "n_", "salt_", "ids", "sequence_id", "offset"} <= set(pieces.columns)
    got, sequences = defaultdict(dict), defaultdict(list)
    for r in pieces.collect():
        got[r["doc_id"]][r["piece"]] = r
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(STRANGE):
        ids = whole_ids(text)
        own = [got[i][k] for k in range(len(got[i]))]
        assert b"".join(bytes(r["ids"]) for r in own) == ids.tobytes()
        assert all(r["start"] == k * 2048 and r["length"] == min(2048, len(ids) - k * 2048) for k, r in enumerate(own))
        assert zlib.crc32(bytes(own[0]["ids"])) == zlib.crc32(ids[:2048].tobytes())
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_close_to_the_bound_and_uses_each_piece_once(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 2049) if seed else 1500: rng.randrange(1, 40) for _ in range(rng.randrange(1, 900))}
    patterns = packing.pack_counts(counts)
    used = defaultdict(int)
    for held, n in patterns:
        assert sum(held) <= 2048 and n > 0
        for x in held:
            used[x] += n
    assert dict(used) == counts
    gaps = []  # best fit, longest first
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        at = bisect.bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else 2048
        bisect.insort(gaps, gap - length)
    assert sum(n for _, n in patterns) <= len(gaps) * 1.001 + 1


def test_two_small_pieces_replace_the_smallest():
    # greedy puts 600 after 1400 and leaves 48; 400 and 248 fill the gap
    assert packing.pack_counts({1400: 1, 600: 1, 400: 1, 248: 1})[0] == ((1400, 400, 248), 1)


def test_plain_filling_never_takes_the_place_of_replacing():
    counts = {24: 25, 18: 22, 13: 21}
    number = [sum(n for _, n in packing._pack(counts, 50, least)) for least in (0, 50, 51)]
    assert number == [29, 29, 27]  # filling without replacing would need fewer here
    assert sum(n for _, n in packing.pack_counts(counts, 50)) == 29


def test_pieces_of_one_length_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 10)
    pieces = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 3 * 500 + 40).alias("length"))
    rows = packing.pack(pieces.repartition(5)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 500


def test_empty_table(spark):
    assert packing.pack(packing.tokenise(spark.createDataFrame([], DOCS), tokenizer_path())).count() == 0
