"""Benchmark decontamination by templates: numbers, names and units become typed placeholders, windows of the result are joined.

Tokens are runs of letters, and numbers; in scripts without spaces each letter is one. A number is a number slot; a unit right after a number is a unit slot; a capitalised
word is a name slot, at the start of a sentence too, unless it is one of the words that questions and sentences begin with (``OPENERS``). Windows of ``WINDOW`` tokens of the canonical text are hash-joined with those of the
benchmark's items; a match is aligned by its shift between document and item. An alignment counts if its slots are
consistent: one value of the item always stands for one value of the document. Windows are joined on their words as they are too;
such a window counts whatever stands around it. An item is leaked into a document if at least ``NEED`` of its windows,
or all it has, are found word for word or in consistent alignments. So both verbatim passages and questions with
other numbers, names or units are found.

Items of fewer tokens than a window are one window of their own length, so a single word is found wherever it stands. Templates with
fewer than ``LITERAL`` tokens that aren't slots are left out on both sides: such windows, of numbers or names, are found word
for word only, and are not among the windows that a changed copy must have. Null text: no tokens, no match. Documents
with one doc_id are judged together (nulls too); repeated rows change nothing. Ties: a document may match several items, a row
each. An empty table on either side gives an empty result. Extra columns are left out by ``leaked`` and kept by ``without_leaks``.

Only DataFrame expressions run on the documents. First pieces of windows meet those of the benchmark, broadcast if measured small, else
shuffled: all of the benchmark's, and as many of a document's as give each of its windows one (of five tokens, every fourth). Windows, with
words, shifts and slots, are made only of documents that share one, which loses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigloom.session import broadcast_if_small, settle

WINDOW = 8
NEED = 6  # windows: thirteen tokens in a row
LITERAL = 4
UNITS = ("mm cm m km in ft yd mi inch inches feet foot yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
         "mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons "
         "s sec second seconds min minute minutes h hour hours day days week weeks month months year years kmh mph percent dollar dollars "
         "euro euros cent cents degree degrees").split()
# Words that begin sentences and are no names.
OPENERS = ("The A An This That These Those It He She They We You I In On At If When What Which Who Whose Where Why How Is Are Was Were Do Does Did Can "
           "Could Will Would Should After Before And But Or Each Every There Find Let Given For From Then Now Some All Not So To Of As By With "
           "Der Die Das Ein Eine Ist Sind Wie Was Wer Wann Wo Warum Wenn Und Es Er Sie Wir Im In Am Auf Mit Von Nach Le La Les Un Une Il Elle Est Que Qui "
           "Quel Quelle Comment Combien Si Et Dans Sur El Los Las Una Es Son Como Cuando Donde Por Con En").split()
# Thai, Lao, Myanmar, Khmer, kana, Han; ranges, as a look-up of each letter's script is slow, within one that most letters fail at once
UNSPACED = (r"[\u0E00-\x{3FFFF}&&[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3041-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF"
            r"\x{20000}-\x{3FFFF}]]")
NAME, UNIT = "\x02", "\x03"  # marks before a slot's value; both sort before digits, and digits before letters
PIECE = 5  # tokens that are looked for first; a window of eight has four pieces in a row, so every fourth piece of a document will do


def canonical_tokens(text: Column) -> Column:
    """Tokens in lower case; names and units carry their mark. A token that sorts before ``:`` is a slot."""
    text = F.coalesce(text, F.lit(""))
    marked = F.contains(text, F.lit(NAME)) | F.contains(text, F.lit(UNIT))  # translate is slow, and hardly any text has a mark
    plain = F.when(marked, F.translate(text, NAME + UNIT, "  ")).otherwise(text)
    ascii_ = F.octet_length(text) == F.length(text)
    cut = F.when(ascii_, plain).otherwise(F.regexp_replace(plain, rf"{UNSPACED}\p{{M}}*", " $0 "))
    named = F.regexp_replace(cut, rf"(?=\p{{Lu}}\p{{Ll}})(?<![\p{{L}}\p{{M}}])(?!(?:{'|'.join(OPENERS)})(?![\p{{L}}\p{{M}}]))", NAME)
    united = F.regexp_replace(named, rf"[0-9] ?(?=(?i:{'|'.join(UNITS)})(?!\p{{L}}))", "$0" + UNIT)
    return F.regexp_extract_all(F.lower(united), F.lit(rf"[{NAME}{UNIT}]?[\p{{L}}\p{{M}}]+|[0-9]+(?:[.,][0-9]+)*"), F.lit(0))


def _windows(sizes: list[int]) -> Column:
    """All windows of these sizes: size, pos, raw (over the words as they are), hash, words (null if no token of the text is a slot)."""
    each = [f"case when size({of}) >= {n} then transform(sequence(0, size({of}) - {n}), i -> struct({n} as size, i as pos, {raw} as raw, "
            f"xxhash64({sign}{n}, {', '.join(f'{of}[i + {j}]' for j in range(n))}) as hash, "
            f"case when has_slots then slice(tokens, i + 1, {n}) end as words)) "
            f"else array() end" for n in sizes for of, raw, sign in (("hashes", "false", ""), ("raws", "true", "-"))]
    return F.expr(each[0] if len(each) == 1 else f"concat({', '.join(each)})")


def windows_of(rows: DataFrame, key: str, sizes: list[int]) -> DataFrame:
    """key, size, pos, raw, hash, words: each window of each text as it is, and as template if it has enough literal tokens."""
    kind = f"case when t < ':' then case when t < '{UNIT}' then '<name>' when t < '0' then '<unit>' else '<number>' end else t end"
    rows = rows.select(key, canonical_tokens(F.col("text")).alias("tokens"))
    rows = rows.select(key, "tokens", F.expr(f"transform(tokens, t -> xxhash64({kind}))").alias("hashes"),
                       F.expr(f"transform(tokens, t -> xxhash64(if(t < '0', substring(t, 2), t)))").alias("raws"),
                       F.expr("exists(tokens, t -> t < ':')").alias("has_slots"))
    # the outer form, as the optimizer would build the windows twice for the inner one
    rows = rows.select(key, F.explode_outer(_windows(sizes)).alias("w_")).select(key, "w_.*")
    literal = F.expr(f"raw or size >= {LITERAL} and (words is null or size(filter(words, t -> t >= ':')) >= {LITERAL})")
    return rows.filter(F.col("hash").isNotNull() & literal)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, size, wpos, raw, hash, item_words, n_item (windows of the item), n_same (those that have a template). Kept in the shared folder."""
    items = benchmark.select("item_id", "text").withColumn("n_", F.size(canonical_tokens(F.col("text"))))
    sizes = list(range(1, WINDOW + 1))
    rows = windows_of(items.select(F.struct("item_id", "n_").alias("item_"), "text"), "item_", sizes)
    rows = rows.filter(F.col("size") == F.least(F.col("item_.n_"), F.lit(WINDOW))).select(
        "item_.item_id", "size", F.col("pos").alias("wpos"), "raw", "hash", F.col("words").alias("item_words")).dropDuplicates(["item_id", "raw", "wpos", "hash"])
    total = rows.groupBy("item_id").agg(F.countDistinct("wpos").alias("n_item"), F.countDistinct(F.when(~F.col("raw"), F.col("wpos"))).alias("n_same"))
    return settle(rows.join(total, rows["item_id"].eqNullSafe(total["item_id"])).drop(total["item_id"]))


def _strides(sizes: list[int]) -> dict[int, int]:
    """Length of a piece: every how many places one is needed, so that each window of these sizes holds one."""
    return {min(n, PIECE): min(m - min(m, PIECE) + 1 for m in sizes if min(m, PIECE) == min(n, PIECE)) for n in sizes}


def _pieces(rows: DataFrame, key: str, strides: dict[int, int]) -> DataFrame:
    """key, hash: of every so many pieces of each text, as template and as it is.

    A place is the piece's start * 8 + its length. Places are exploded and hashed as rows, in generated code; lambdas over arrays are interpreted.
    """
    places = [f"case when size(tokens) >= {n} then sequence({n}L, (size(tokens) - {n}) * 8L + {n}, {8 * step}L) else array() end"
              for n, step in strides.items()]
    # the outer form, as the optimizer would make the tokens twice for the inner one
    rows = rows.select(key, canonical_tokens(F.col("text")).alias("tokens")).select(
        key, "tokens", F.explode_outer(F.expr(places[0] if len(places) == 1 else f"concat({', '.join(places)})")).alias("place"))
    rows = rows.filter("place is not null").withColumn("start", F.expr("cast(shiftright(place, 3) as int)"))

    def of(token: str) -> str:
        each = [(n, f"xxhash64({', '.join(token.format(f'tokens[start + {j}]') for j in range(n))})") for n in strides]
        return each[0][1] if len(each) == 1 else f"case place & 7 {' '.join(f'when {n} then {h}' for n, h in each)} end"

    slot = "case when {0} >= ':' then {0} when {0} >= '0' then '0' else left({0}, 1) end"
    word = "case when {0} < '0' then substring({0}, 2) else {0} end"
    return rows.select(key, F.explode_outer(F.expr(f"array({of(slot)}, {of(word)})")).alias("hash"))


def candidates(docs: DataFrame, benchmark: DataFrame, sizes: list[int]) -> DataFrame:
    """leak_doc_id_ of the documents that share a piece of a window with the benchmark, and more. Kept in the shared folder.

    Two equal windows, as they are or as templates, are equal piece by piece; all pieces of the benchmark meet some of the documents',
    at least one of each window.
    """
    strides = _strides(sizes)
    known = settle(_pieces(benchmark, "item_id", dict.fromkeys(strides, 1)).select("hash").distinct())
    hashes = _pieces(docs.select(F.struct("doc_id").alias("leak_"), "text"), "leak_", strides)
    return settle(hashes.join(broadcast_if_small(known), "hash", "left_semi").select(F.col("leak_.doc_id").alias("leak_doc_id_")).distinct())


def leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows (of the item, found), n_item (all it has), exact (no slot has another value)."""
    items = item_windows(benchmark)
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect()) or [WINDOW]  # eight at most
    docs = docs.select("doc_id", "text")
    likely = broadcast_if_small(candidates(docs, benchmark, sizes))
    found = windows_of(docs.join(likely, F.col("doc_id").eqNullSafe(F.col("leak_doc_id_")), "left_semi"), "doc_id", sizes)
    found = found.join(broadcast_if_small(items.drop("size")), ["raw", "hash"])
    # a window found as it is has nothing to be consistent with
    slots = F.expr("case when not raw then filter(arrays_zip(item_words, words), p -> p.words < ':') end")
    found = found.select("doc_id", "item_id", "n_item", "n_same", "raw", "wpos", (F.col("pos") - F.col("wpos")).alias("shift"), slots.alias("slots"))
    # an alignment has a value for each of its item's tokens at most
    aligned = found.groupBy("doc_id", "item_id", "n_item", "n_same", "raw", "shift").agg(
        F.collect_set("wpos").alias("at"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    one = F.expr("size(array_distinct(transform(slots, p -> p.item_words))) = size(slots)")
    exact = F.expr("forall(slots, p -> p.item_words = p.words)")
    aligned = aligned.filter(one).withColumn("exact", exact)
    places = aligned.select("doc_id", "item_id", "n_item", "n_same", "raw", "exact", F.explode("at").alias("wpos"))
    sums = places.groupBy("doc_id", "item_id", "n_item", "n_same").agg(
        F.countDistinct("wpos").alias("n_windows"), F.countDistinct(F.when(~F.col("raw"), F.col("wpos"))).alias("same"), F.every("exact").alias("exact"))
    enough = F.expr(f"n_windows >= least({NEED}, n_item) or same >= least({NEED}, n_same) and n_same > 0")
    return sums.filter(enough).select("doc_id", "item_id", "n_windows", "n_item", "exact")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents into which no item is leaked."""
    gone = settle(leaked(docs, benchmark).select(F.col("doc_id").alias("leak_doc_id_")).distinct())
    return docs.join(broadcast_if_small(gone), docs["doc_id"].eqNullSafe(F.col("leak_doc_id_")), "left_anti")
