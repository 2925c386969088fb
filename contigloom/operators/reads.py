"""Read tables (``sample, mate, read_no, seq, qual``): trimming, pair filtering, quality reports."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contigloom.functions import bases, kernels
from contigloom.session import fits_broadcast, settle


def _by_slices(kernel, qual: pa.Array) -> pa.Array:
    parts = [kernel(qual.slice(a, b - a)) for a, b in kernels.row_slices(qual)]
    return pa.concat_arrays(parts) if parts else kernel(qual)


def trim_bounds(qual, window: int, mean_q: float, front: bool, tail: bool) -> Column:
    @F.arrow_udf("start int, kept int")
    def bounds(q: pa.Array) -> pa.Array:
        return _by_slices(lambda part: kernels.window_trim(part, window, mean_q, front, tail), q)

    return bounds(qual)


def trim_reads(reads: DataFrame, window: int = 4, mean_q: float = 20, front: bool = False,
               tail: bool = False) -> DataFrame:
    """Cut low-quality ends.

    From the front, bases go until ``window`` bases in a row have mean quality ``mean_q`` or more; from
    the tail likewise, on what is left. A read without such a window becomes empty. Only the
    qualities go through Arrow; no shuffle.
    """
    if not front and not tail:
        return reads
    cut = reads.withColumn("_cut", trim_bounds("qual", window, mean_q, front, tail))
    start, kept = F.col("_cut.start"), F.col("_cut.kept")
    return cut.withColumns({
        "seq": F.substring("seq", start, kept),
        "qual": F.substring("qual", start, kept),
    }).drop("_cut")


def read_passes(q: int = 15, u: float = 40, e: float = 0, l: int = 15, qual: str = "qual") -> Column:
    """Long enough, at most ``u`` percent of bases below quality ``q``, mean quality at least ``e``."""
    length = F.length(qual)
    low = length - bases.count_quality_at_least(qual, q)
    good = (length >= l) & (low * 100 <= length * u)
    if e > 0:
        @F.arrow_udf("bigint")
        def quality_sum(values: pa.Array) -> pa.Array:
            return _by_slices(kernels.quality_sum, values)

        good = good & (quality_sum(qual) >= length * e)
    return F.coalesce(good, F.lit(False))


#: Numbers of pairs that one row of :func:`failed_pairs` stands for, as 64 bits in each of so many longs.
WORDS = 512


def pair_verdicts(reads: DataFrame, passes: Column, pair: str = "read_no") -> DataFrame:
    """``sample, pair`` of the pairs that go: a mate fails or is missing. Raises when the mates' read ids differ, where there are ids.

    One shuffle of a few numbers a read, no letters: ids are compared by their hashes.
    """
    columns = {"_mate": F.col("mate"), "_pass": passes}
    torn = F.lit(False)
    if "read_id" in reads.columns and pair != "read_id":
        columns["_id"] = F.xxhash64("read_id")
        torn = F.coalesce(F.min("_id") != F.max("_id"), F.lit(False))
    light = reads.select("sample", pair, *[c.alias(name) for name, c in columns.items()])
    found = light.groupBy("sample", pair).agg(
        (F.min("_pass") & (F.min("_mate") != F.max("_mate"))).alias("_good"), torn.alias("_torn"))
    message = F.concat(F.lit("mates with different ids in sample "), F.coalesce("sample", F.lit("")), F.lit(", read "), F.col(pair).cast("string"))
    bad = F.when(F.col("_torn"), F.raise_error(message).cast("boolean")).otherwise(~F.coalesce("_good", F.lit(False)))
    return found.filter(bad).select("sample", pair)


def failed_bits(failed: DataFrame, pair: str = "read_no") -> DataFrame:
    """``sample, _chunk, _words``: failed pairs as bits, a row for ``64 * WORDS`` numbers."""
    numbers = failed.select("sample", F.col(pair).cast("long").alias("_n"))
    words = numbers.groupBy("sample", F.shiftright("_n", 6).alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(_n, 64) as int)))").alias("_bits"))
    slot = F.pmod(F.col("_word"), F.lit(WORDS)).cast("int")
    chunks = words.groupBy("sample", F.floor(F.col("_word") / WORDS).alias("_chunk")).agg(F.map_from_entries(F.collect_list(F.struct(slot, "_bits"))).alias("_map"))  # WORDS entries at most
    return chunks.select("sample", "_chunk", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda k: F.coalesce(F.try_element_at("_map", k), F.lit(0).cast("long"))).alias("_words"))


def filter_reads(reads: DataFrame, q: int = 15, u: float = 40, e: float = 0, l: int = 15,
                 pair: str = "read_no") -> DataFrame:
    """Reads of the pairs whose mates are both there and pass; ``pair`` names a pair within a sample.

    A mate alone goes; :func:`lone_mates` lists them. Raises when the two of a pair have different read ids, where there are ids.
    Letters and qualities stay where they are: which pairs fail is found from a few numbers a read, and sent to the reads as rows if these
    are few, or as bits if ``pair`` is a number and they are many (two thousand million pairs fit). Beyond that, reads are shuffled on
    the pair, a failing one without its letters.
    """
    keys = ["sample", pair]
    failed = settle(pair_verdicts(reads, read_passes(q, u, e, l), pair))
    small, count = fits_broadcast(failed)
    if not count:
        return reads
    if small:
        return _without(reads, F.broadcast(failed), keys)
    if isinstance(reads.schema[pair].dataType, T.IntegralType):
        bits = settle(failed_bits(failed, pair))
        if fits_broadcast(bits)[0]:
            number = F.col(pair).cast("long")
            word = F.shiftright(number, 6)
            known = reads.withColumn("_chunk", F.floor(word / WORDS)).join(F.broadcast(bits.withColumnsRenamed({"sample": "_sample", "_chunk": "_own"})), F.col("sample").eqNullSafe(F.col("_sample")) & (F.col("_chunk") == F.col("_own")), "left")
            own = F.get("_words", F.pmod(word, F.lit(WORDS)).cast("int"))
            hit = F.coalesce(F.getbit(own, F.pmod(number, F.lit(64)).cast("int")), F.lit(0)) == 1
            return known.filter(~hit).select(reads.columns)
    light = reads.withColumn("_pass", read_passes(q, u, e, l))
    light = light.withColumns({c: F.when(F.col("_pass"), F.col(c)) for c in ("seq", "qual")})
    mates = Window.partitionBy(*keys)
    both = F.min("mate").over(mates) != F.max("mate").over(mates)
    return light.withColumn("_pair", F.min("_pass").over(mates) & both).filter("_pair").select(reads.columns)


def _without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among ``gone``; nulls are keys like others."""
    named = gone.select(*[F.col(k).alias(f"_gone{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_gone{i}")) for i, k in enumerate(keys)]
    return rows.join(named, same, "left_anti")


def lone_mates(reads: DataFrame, pair: str = "read_no") -> DataFrame:
    """``sample, pair, mate`` of reads whose mate is missing: the sample's files are not equally long."""
    return (reads.groupBy("sample", pair).agg(F.min("mate").alias("mate"), F.max("mate").alias("_last"))
            .filter(F.col("mate") == F.col("_last")).drop("_last"))


def pair_reads(reads: DataFrame, pair: str = "read_no") -> DataFrame:
    """``sample, pair, r1, r2``: both mates in one row (structs of ``read_id, seq, qual``), NULL for one that is missing.

    The one shuffle of a run over reads: store the result, and trimming, filtering and statistics are passes without any.
    """
    def mate(n: int) -> Column:
        return F.max(F.when(F.col("mate") == n, F.struct("read_id", "seq", "qual"))).alias(f"r{n}")

    rows = reads if "read_id" in reads.columns else reads.withColumn("read_id", F.lit(None).cast("string"))
    return rows.groupBy("sample", pair).agg(mate(1), mate(2))


def unpair_reads(pairs: DataFrame, pair: str = "read_no") -> DataFrame:
    """The mates of :func:`pair_reads` as reads again, where they are."""
    mates = F.array(*[F.struct(F.lit(n).alias("mate"), F.col(f"r{n}").alias("r")) for n in (1, 2)])
    rows = pairs.select("sample", pair, F.explode(mates).alias("m")).filter("m.r is not null")
    return rows.select("sample", "m.mate", pair, "m.r.read_id", "m.r.seq", "m.r.qual")


def clean_pairs(pairs: DataFrame, trim: dict | None = None, keep: dict | None = None) -> DataFrame:
    """Pairs of which both mates are there and pass after trimming; the options of ``trim_reads`` and ``filter_reads``. No shuffle."""
    message = F.concat(F.lit("mates with different ids in sample "), "sample")
    torn = F.coalesce(F.col("r1.read_id") != F.col("r2.read_id"), F.lit(False))
    there = F.when(torn, F.raise_error(message).cast("boolean")).otherwise(F.col("r1").isNotNull() & F.col("r2").isNotNull())
    rows = pairs.filter(there)
    for n in (1, 2):
        parts = rows.withColumns({"_id": F.col(f"r{n}.read_id"), "seq": F.col(f"r{n}.seq"), "qual": F.col(f"r{n}.qual")})
        cut = trim_reads(parts, **(trim or {}))
        rows = cut.withColumns({f"r{n}": F.struct(F.col("_id").alias("read_id"), "seq", "qual"),
                                f"_ok{n}": read_passes(**(keep or {}))}).drop("_id", "seq", "qual")
    return rows.filter("_ok1 and _ok2").select(pairs.columns)


def read_qc_stats(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Reads, bases, Q20/Q30 bases and rates, G/C and mean length per sample and mate."""
    keys = keys or ["sample", "mate"]
    measured = reads.select(
        *keys, F.length("seq").cast("long").alias("bases"),
        bases.count_quality_at_least("qual", 20).cast("long").alias("q20"),
        bases.count_quality_at_least("qual", 30).cast("long").alias("q30"),
        bases.count_letters("seq", "GC").cast("long").alias("gc"))
    sums = measured.groupBy(*keys).agg(
        F.count("*").alias("reads"), F.sum("bases").alias("bases"),
        F.sum("q20").alias("q20_bases"), F.sum("q30").alias("q30_bases"), F.sum("gc").alias("gc_bases"))
    return sums.withColumns({
        "q20_rate": bases.rate("q20_bases", "bases"),
        "q30_rate": bases.rate("q30_bases", "bases"),
        "gc_rate": bases.rate("gc_bases", "bases"),
        "mean_length": bases.rate("bases", "reads", 2),
    })


def qc_before_and_after(reads: DataFrame, trimmed: DataFrame) -> DataFrame:
    """Quality report of the raw and of the trimmed and filtered reads, one row per stage."""
    both = (reads.withColumn("stage", F.lit("before"))
            .unionByName(trimmed.withColumn("stage", F.lit("after"))))
    return read_qc_stats(both, ["sample", "mate", "stage"])


def per_cycle_quality(reads: DataFrame) -> DataFrame:
    """Mean quality and base counts per sample, mate and position in the read.

    Bases are taken from bytes, whose positions need no search, and summed per position inside each
    task; the shuffle carries positions, not bases.
    """
    message = F.lit("sequence and quality of a read differ in length")
    checked = reads.filter(F.length("seq") > 0).filter(
        F.when(F.length("seq") != F.length("qual"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    letters = checked.select("sample", "mate", F.upper("seq").cast("binary").alias("s"), F.col("qual").cast("binary").alias("q"))
    cells = (letters.select("sample", "mate", "s", "q", F.explode(F.expr("sequence(1, length(s))")).alias("pos"))
             .selectExpr("sample", "mate", "pos", "substring(s, pos, 1) as base",
                         "ascii(cast(substring(q, pos, 1) as string)) - 33 as score"))
    bases_of = {"n_a": "41", "n_c": "43", "n_g": "47", "n_t": "54"}
    sums = ["count(*) as n", "sum(score) as sum_q"]
    sums += [f"count_if(base = X'{code}') as {name}" for name, code in bases_of.items()]
    return (cells.groupBy("sample", "mate", "pos").agg(*[F.expr(e) for e in sums])
            .withColumns({"n_other": F.expr("n - n_a - n_c - n_g - n_t"), "mean_q": bases.rate("sum_q", "n")}))
