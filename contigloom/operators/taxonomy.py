"""Taxa of contigs from shared k-mers, and the removal list that follows from them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contigloom.functions import kernels
from contigloom.session import broadcast_if_small, settle

# A k-mer row is two numbers, so more of them may be broadcast than of wider rows.
BROADCAST_KMERS = 5_000_000

ARROW_TYPES = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}


def kmers(sequences: DataFrame, keys: list[str], k: int, canonical: bool = True) -> DataFrame:
    """``keys, kmer, n``: k-mers of ``seq`` as 2-bit numbers (k up to 31).

    K-mers with a letter other than A, C, G, T are left out. ``canonical`` takes the smaller of a
    k-mer and its reverse complement. Repeats inside a sequence are counted before they leave the
    task; the same key and k-mer can still come in several rows.
    """
    if not 1 <= k <= 31:
        raise ValueError("k must be between 1 and 31")
    narrow = sequences.select(*keys, "seq")
    fields = [narrow.schema[key] for key in keys]
    arrow = pa.schema([(f.name, ARROW_TYPES[f.dataType]) for f in fields]
                      + [("kmer", pa.int64()), ("n", pa.int64())])
    result = T.StructType(fields + [T.StructField("kmer", T.LongType()), T.StructField("n", T.LongType())])

    def rows(batches):
        return kernels.kmer_rows(batches, keys, k, canonical, arrow)

    return narrow.mapInArrow(rows, result)


def kmer_code(kmer) -> F.Column:
    """The number :func:`kmers` gives a k-mer string, without taking the reverse complement."""
    return F.conv(F.translate(F.upper(kmer), "ACGT", "0123"), 4, 10).cast("long")


def screen_kmers(contigs: DataFrame, kmer_taxa: DataFrame, k: int, canonical: bool = True,
                 keys: list[str] | None = None) -> DataFrame:
    """``keys, taxid, n``: how many k-mers of a contig the table (``kmer, taxid``) gives each taxon.

    A small table is broadcast and no k-mer is shuffled. Otherwise both sides are shuffled by k-mer;
    the table holds a k-mer once, so AQE can split the partition of a frequent one.
    """
    keys = keys or ["sample", "rec_no"]
    table = broadcast_if_small(kmer_taxa.select("kmer", "taxid"), BROADCAST_KMERS)
    return (kmers(contigs, keys, k, canonical).join(table, "kmer")
            .groupBy(*keys, "taxid").agg(F.sum("n").alias("n")))


def lineages(taxonomy: DataFrame) -> DataFrame:
    """``taxid, name, lineage, entry, exit``: taxa from the root down to the taxon itself, and the tree's numbers.

    ``entry`` numbers the taxa so that a clade is a range, from its taxon's ``entry`` to its ``exit``. One row per taxon, so its size does not depend on the cohort. Each round joins every unfinished path with the path of
    the taxon it has reached, which doubles its length: about log2(depth) rounds for any number of taxa. A taxon that is
    its own parent is a root, as one without a parent is; one whose parents are not in the table is left out. Raises on a
    cycle.
    """
    up = F.when(F.col("parent_taxid") != F.col("taxid"), F.col("parent_taxid").cast("int"))
    paths = settle(taxonomy.select(F.col("taxid").cast("int").alias("taxid"), "name", up.alias("above"),
                                   F.array(F.col("taxid").cast("int")).alias("lineage")))
    open_before = None
    while open_now := paths.filter("above is not null").count():
        if open_now == open_before:  # the shortest unfinished paths end in each round, unless they go round
            some = [r["taxid"] for r in paths.filter("above is not null").select("taxid").orderBy("taxid").limit(5).collect()]
            raise ValueError(f"{open_now} taxa on or below a cycle, such as {some}")
        open_before = open_now
        higher = paths.select(F.col("taxid").alias("above"), F.col("above").alias("next"), F.col("lineage").alias("upper"))
        longer = paths.filter("above is not null").join(higher, "above").select(
            "taxid", "name", F.col("next").alias("above"), F.concat("upper", "lineage").alias("lineage"))
        paths = settle(paths.filter("above is null").unionByName(longer))
    return _numbered(paths.drop("above"))


# Taxa that a task puts in order.
TAXA_PER_TASK = 200_000


def _numbered(paths: DataFrame) -> DataFrame:
    """Lineages in order are the tree in order: a taxon comes right before its clade."""
    parts = paths.count() // TAXA_PER_TASK + 1
    if parts == 1:
        numbered = paths.withColumn("entry", F.row_number().over(Window.orderBy("lineage")).cast("long") - 1)
    else:
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ordered = settle(paths.repartitionByRange(parts, "lineage").sortWithinPartitions("lineage").withColumns({"_part": F.spark_partition_id(), "_row": row}))
        before, firsts = 0, []
        for r in ordered.groupBy("_part").count().orderBy("_part").collect():  # one number per task
            firsts += [F.lit(r["_part"]), F.lit(before)]
            before += r["count"]
        numbered = ordered.withColumn("entry", F.col("_row") + F.create_map(*firsts)[F.col("_part")])
    sizes = paths.select(F.explode("lineage").alias("taxid")).groupBy("taxid").agg(F.count("*").alias("size"))  # once for a taxonomy
    return settle(numbered.join(sizes, "taxid").select("taxid", "name", "lineage", "entry", (F.col("entry") + F.col("size") - 1).alias("exit")))


def classify_contigs(kmer_hits: DataFrame, taxa: DataFrame, contigs: DataFrame | None = None,
                     keys: list[str] | None = None) -> DataFrame:
    """``keys, taxid, score``: taxon of each contig.

    A taxon scores its own k-mers and those of its ancestors; the best one wins, and equal ones give
    their lowest common ancestor. With ``contigs``, those without a hit follow as taxid 0. ``taxa``
    comes from :func:`lineages`. Each hit meets its own ancestors only, never the other hits.
    """
    keys = keys or ["sample", "rec_no"]
    own = kmer_hits.select(*keys, F.col("taxid").cast("int").alias("taxid"), "n")
    tree = broadcast_if_small(taxa.select("taxid", "entry", "exit"))
    # A hit counts from its taxon's place on and no more after its clade: the running sum at a taxon's place is what it and
    # its ancestors have. Two rows a hit, whatever its depth; all up to the best taxa is partitioned by contig once.
    place, after = F.col("entry") * 2 + 1, F.col("exit") * 2 + 2
    events = own.join(tree, "taxid").select(*keys, F.explode(F.array(
        F.struct(place.alias("at"), F.col("n").alias("change"), F.col("taxid")),
        F.struct(after.alias("at"), (-F.col("n")).alias("change"), F.lit(None).cast("int").alias("taxid")))).alias("e")).select(*keys, "e.*")
    contig = Window.partitionBy(*keys)
    scored = events.withColumn("score", F.sum("change").over(contig.orderBy("at"))).filter("taxid is not null")
    best = scored.withColumn("_rank", F.rank().over(contig.orderBy(F.desc("score")))).filter("_rank = 1")
    # the lowest taxon above all of the best is above the first of them, and its clade reaches the last
    tied = best.groupBy(*keys).agg(F.min_by("taxid", "at").alias("taxid"), F.min("at").alias("_first"), F.max("at").alias("_last"), F.max("score").alias("score"))
    lines = broadcast_if_small(taxa.select("taxid", "lineage"))
    above = F.when(F.col("_first") == F.col("_last"), F.array("taxid")).otherwise(F.col("lineage"))  # a single best taxon is its own answer
    asked = tied.join(lines, "taxid").select(*keys, "_last", "score", F.posexplode(above).alias("_depth", "taxid")).join(tree.select("taxid", "exit"), "taxid")
    classified = asked.filter(F.col("exit") * 2 + 1 >= F.col("_last")).groupBy(*keys).agg(F.max_by("taxid", "_depth").alias("taxid"), F.max("score").alias("score"))
    if contigs is None:
        return classified
    every = contigs.select(*keys)
    return (every.join(classified, keys, "left")
            .withColumns({"taxid": F.coalesce("taxid", F.lit(0)), "score": F.coalesce("score", F.lit(0))}))


def taxonomy_report(classified: DataFrame, taxa: DataFrame) -> DataFrame:
    """Per sample and taxon: contigs of the taxon, contigs of its clade, percent of the sample.

    Counted per taxon before the tree is looked at. In the tree's order, the taxa above a sample's next taxon that are not above the one
    before are new, so each is named once; what its clade has is what a running count grows by over its range. Unclassified
    contigs are the row of taxid 0.
    """
    direct = settle(classified.groupBy("sample", "taxid").agg(F.count("*").alias("n")))
    taxa = broadcast_if_small(taxa)
    placed = direct.join(taxa.select("taxid", "entry", "lineage"), "taxid", "left")
    along = Window.partitionBy("sample").orderBy("entry")
    before = F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = placed.filter("entry is not null").withColumns({"before": before, "previous": F.lag("lineage").over(along)})
    shared = F.when(F.col("previous").isNull(), 0).otherwise(F.size(F.array_intersect("lineage", "previous")))
    fresh = known.select("sample", "before", F.col("taxid").alias("own"), "n", F.explode(F.slice("lineage", shared + 1, F.size("lineage"))).alias("taxid"))
    named = fresh.join(taxa.select("taxid", "exit"), "taxid").select(
        "sample", (F.col("exit") * 2 + 1).alias("at"), F.lit(0).cast("long").alias("n"), "taxid", "before", F.when(F.col("own") == F.col("taxid"), F.col("n")).otherwise(0).alias("direct"))
    nothing = F.lit(None)
    told = placed.filter("entry is not null").select("sample", (F.col("entry") * 2).alias("at"), "n", nothing.cast("int").alias("taxid"),
                                                    nothing.cast("long").alias("before"), nothing.cast("long").alias("direct"))
    rows = told.unionByName(named)
    counted = rows.withColumn("upto", F.sum("n").over(Window.partitionBy("sample").orderBy("at"))).filter("taxid is not null")
    clades = counted.select("sample", "taxid", "direct", (F.col("upto") - F.col("before")).alias("clade"))
    clades = clades.unionByName(placed.filter("entry is null").select("sample", "taxid", F.col("n").alias("direct"), F.col("n").alias("clade")))
    # At most one row per taxon in a sample.
    total = F.sum("direct").over(Window.partitionBy("sample"))
    named = clades.withColumn("total", total).join(taxa.select("taxid", "name"), "taxid", "left")
    return named.select("sample", "taxid", F.coalesce("name", F.lit("unclassified")).alias("name"), "direct",
                        "clade", F.round(F.col("clade") * 100 / F.col("total"), 2).alias("pct"))


def contaminants_to_removals(classified: DataFrame, taxa: DataFrame, expected: int) -> DataFrame:
    """``path, contig_id`` of contigs on another branch than ``expected``.

    Contigs of the expected clade, of its ancestors, and unclassified ones stay. ``classified`` has
    ``path, contig_id, taxid``. The result is what ``remove_contigs`` takes.
    """
    ancestors = taxa.filter(F.col("taxid") == expected).select(F.explode("lineage").alias("taxid"))
    other = (taxa.filter(~F.array_contains("lineage", expected)).select("taxid")
             .join(F.broadcast(ancestors), "taxid", "left_anti"))  # one path, so a few dozen rows
    return classified.join(broadcast_if_small(other), "taxid", "left_semi").select("path", "contig_id")
