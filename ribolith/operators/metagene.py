"""Classes of positions: regions of coding transcripts, biotypes of non-coding ones, by one segment a position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.operators.intervals import BIN, with_cdna

#: Regions of coding transcripts, first to last.
REGIONS = ("5UTR", "3UTR", "exon", "intron")
#: Non-coding biotypes, first to last.
BIOTYPES = (
    "Mt_rRNA", "sRNA", "scRNA", "scaRNA", "snRNA", "snoRNA", "Mt_tRNA", "rRNA", "rRNA_pseudogene", "miRNA", "lncRNA", "non_stop_decay", "nonsense_mediated_decay",
    "processed_pseudogene", "misc_RNA", "ribozyme", "processed_transcript", "retained_intron", "vault_RNA", "transcribed_processed_pseudogene",
    "transcribed_unitary_pseudogene", "transcribed_unprocessed_pseudogene", "translated_processed_pseudogene", "translated_unprocessed_pseudogene",
    "unitary_pseudogene", "unprocessed_pseudogene", "polymorphic_pseudogene", "IG_C_gene", "IG_C_pseudogene", "IG_D_gene", "IG_J_gene", "IG_J_pseudogene",
    "IG_V_gene", "IG_V_pseudogene", "IG_pseudogene", "LRG_gene", "TEC", "TR_C_gene", "TR_D_gene", "TR_J_gene", "TR_J_pseudogene", "TR_V_gene", "TR_V_pseudogene", "pseudogene",
)
#: What a non-coding position has whose biotypes are none of these.
UNLISTED = "noncoding"


def exon_regions(exons: DataFrame, cds: DataFrame) -> DataFrame:
    """Pieces of the exons of coding transcripts: before, inside and behind the CDS, as 5UTR, exon and 3UTR.

    `cds` has transcript_id, cds_from and cds_to in transcript coordinates; transcripts that it lacks have no pieces.
    """
    placed = with_cdna(exons).join(cds, "transcript_id")
    ends = {"5UTR": (F.col("cdna_start"), F.least("cdna_end", F.col("cds_from") - 1)), "exon": (F.greatest("cdna_start", "cds_from"), F.least("cdna_end", "cds_to")), "3UTR": (F.greatest("cdna_start", F.col("cds_to") + 1), F.col("cdna_end"))}
    pieces = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), a.cast("long").alias("a"), z.cast("long").alias("z")) for k, (a, z) in ends.items())))
    rows = placed.withColumn("p", pieces).where("p.a <= p.z")
    head, tail = F.col("p.a") - F.col("cdna_start"), F.col("cdna_end") - F.col("p.z")
    plus = F.col("strand") == 1
    start, end = F.col("exon_start") + F.when(plus, head).otherwise(tail), F.col("exon_end") - F.when(plus, tail).otherwise(head)
    return rows.select("chr", "strand", start.alias("feature_start"), end.alias("feature_end"), "p.kind")


def typed_intervals(exons: DataFrame, cds: DataFrame, biotypes: DataFrame) -> DataFrame:
    """Intervals with kind and priority: regions of coding transcripts, introns as their whole span, and spans of the others by biotype.

    `biotypes` has transcript_id and biotype; coding transcripts are those of `cds`.
    """
    order = {k: i for i, k in enumerate([*REGIONS, *BIOTYPES, UNLISTED])}
    spans = exons.groupBy("transcript_id", "chr", "strand").agg(F.min("exon_start").alias("feature_start"), F.max("exon_end").alias("feature_end"))
    introns = spans.join(cds, "transcript_id", "left_semi").withColumn("kind", F.lit("intron"))
    others = spans.join(cds, "transcript_id", "left_anti").join(biotypes.select("transcript_id", F.when(F.col("biotype").isin(*BIOTYPES), F.col("biotype")).otherwise(UNLISTED).alias("kind")), "transcript_id")
    columns = ["chr", "strand", "feature_start", "feature_end", "kind"]
    rows = exon_regions(exons, cds).select(*columns).unionByName(introns.select(*columns)).unionByName(others.select(*columns))
    priority = F.coalesce(*(F.when(F.col("kind") == k, i) for k, i in order.items()))
    return rows.withColumn("priority", priority)


def segments(typed: DataFrame, width: int = BIN) -> DataFrame:
    """Disjoint segments (chr, strand, bin, a, z, kind, priority) of the intervals of `typed`: each position has that of least priority, ties the least kind.

    Intervals are cut at the bounds of bins, and of equal starts and kinds in a bin the longest is enough, so a bin of `width` bases holds at
    most `width` starts for each kind, however many intervals meet there. In a bin the edges of all pieces are the sweep's stops; each
    stretch between two stops takes the best piece over it, and stretches of one kind that follow each other are joined.
    """
    key = ["chr", "strand", "bin"]
    low, high = F.floor(F.col("feature_start") / width), F.floor(F.col("feature_end") / width)
    cut = typed.where("feature_start <= feature_end").withColumn("bin", F.explode(F.sequence(low.cast("long"), high.cast("long"))))
    cut = cut.withColumn("a", F.greatest("feature_start", F.col("bin") * width)).withColumn("z", F.least("feature_end", (F.col("bin") + 1) * width - 1))
    pieces = cut.groupBy(*key, "a", "priority", "kind").agg(F.max("z").alias("z"))
    stops = pieces.select(*key, F.explode(F.array("a", F.col("z") + 1)).alias("s")).distinct()
    stretch = stops.withColumn("e", F.lead("s").over(Window.partitionBy(*key).orderBy("s")) - 1).where("e is not null")
    best = stretch.join(pieces, key).where("a <= s and e <= z").groupBy(*key, "s", "e").agg(F.min(F.struct("priority", "kind")).alias("k"))
    order = Window.partitionBy(*key).orderBy("s")
    fresh = (F.lag("k").over(order) != F.col("k")) | (F.lag("e").over(order) != F.col("s") - 1)
    run = F.sum(F.coalesce(fresh.cast("int"), F.lit(1))).over(order)
    joined = best.withColumn("run", run).groupBy(*key, "run").agg(F.min("s").alias("a"), F.max("e").alias("z"), F.first("k").alias("k"))
    return joined.select(*key, "a", "z", "k.kind", "k.priority")


def classify(points: DataFrame, typed: DataFrame, width: int = BIN) -> DataFrame:
    """`points` (chr, strand, start, …) with the kind of their place, intergenic where none is; a point meets one segment at most."""
    found = segments(typed, width).select(F.col("chr").alias("__c"), F.col("strand").alias("__s"), F.col("bin").alias("__b"), "a", "z", "kind")
    own = points.withColumn("__bin", F.floor(F.col("start") / width).cast("long"))
    on = (own["chr"] == found["__c"]) & (own["strand"] == found["__s"]) & (own["__bin"] == found["__b"]) & own["start"].between(found["a"], found["z"])
    return own.join(found, on, "left").withColumn("kind", F.coalesce("kind", F.lit("intergenic"))).drop("__bin", "__c", "__s", "__b", "a", "z")


def class_table(classified: DataFrame) -> DataFrame:
    """A row for each chr: reads in all, by region, in non-coding transcripts and between genes (A10)."""
    sums = classified.groupBy("chr", "kind").agg(F.sum("cnt").alias("reads"))
    of = lambda c, name: F.coalesce(F.sum(F.when(c, F.col("reads"))), F.lit(0)).alias(name)
    rows = [of(F.col("kind") == k, n) for k, n in (("exon", "exon"), ("5UTR", "utr5"), ("3UTR", "utr3"), ("intron", "intron"))]
    return sums.groupBy("chr").agg(F.sum("reads").alias("reads"), *rows, of(~F.col("kind").isin(*REGIONS, "intergenic"), "noncoding"), of(F.col("kind") == "intergenic", "intergenic"))


def biotype_table(classified: DataFrame) -> DataFrame:
    """chr, biotype, reads of the non-coding positions."""
    return classified.where(~F.col("kind").isin(*REGIONS, "intergenic")).groupBy("chr", F.col("kind").alias("biotype")).agg(F.sum("cnt").alias("reads"))
