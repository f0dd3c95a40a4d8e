"""Gene models: joins of their tables, transcript filters, exon structures of open reading frames, variants in exons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ribolith.operators.graphs import components
from ribolith.operators.intervals import EXON_BIN, points_in, with_cdna
from ribolith.operators.ranges import staged

#: Times that a structure's number passes over starts and stops before links are joined.
ROUNDS = 3


def coding_transcripts(genes: DataFrame, transcripts: DataFrame, translations: DataFrame) -> DataFrame:
    """Transcripts with their gene and translation."""
    return transcripts.join(genes, "gene_id").join(translations, "transcript_id")


def noncoding_transcripts(transcripts: DataFrame, translations: DataFrame) -> DataFrame:
    """Transcripts without a translation."""
    return transcripts.join(translations, "transcript_id", "left_anti")


def with_ccds(transcripts: DataFrame, xrefs: DataFrame) -> DataFrame:
    """Transcripts with the smallest of their consensus ids, or No."""
    known = xrefs.groupBy("transcript_id").agg(F.min("ccds").alias("ccds"))
    return transcripts.join(known, "transcript_id", "left").withColumn("ccds", F.coalesce("ccds", F.lit("No")))


def transcript_filter(calls: DataFrame, kind: str = "none") -> DataFrame:
    """Calls with even exon coverage, of all, canonical or consensus transcripts."""
    kept = calls.where(F.col("exon_coverage") == "Yes")
    return {"none": kept, "canonical": kept.where("canonical = 'Yes'"), "ccds": kept.where("ccds <> 'No'")}[kind]


def canonical_map(orfs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Records with the external id of their transcript where one is known."""
    return orfs.join(mapping, "transcript_id", "left")


def orf_structure(orfs: DataFrame, exons: DataFrame) -> DataFrame:
    """The genomic exons and stop of frames that start at `cdna_from` and are `length` bases long.

    Exons are cut to the frame by their transcript coordinates; starts and ends are listed in rank order.
    """
    placed = with_cdna(exons).join(orfs, "transcript_id")
    low, high = F.greatest("cdna_start", "cdna_from"), F.least("cdna_end", F.col("cdna_from") + F.col("length") - 1)
    plus = F.col("strand") == 1
    head, tail = low - F.col("cdna_start"), F.col("cdna_end") - high
    cut = placed.where(low <= high).select(
        "orf_id", "rank", "strand", (F.col("exon_start") + F.when(plus, head).otherwise(tail)).alias("a"), (F.col("exon_end") - F.when(plus, tail).otherwise(head)).alias("z")
    )
    parts = F.sort_array(F.collect_list(F.struct("rank", "a", "z", "strand")))  # as many as the transcript has exons
    rows = cut.groupBy("orf_id").agg(parts.alias("p"))
    last = F.element_at("p", -1)
    return rows.select(
        "orf_id", F.when(last["strand"] == 1, last["z"]).otherwise(last["a"]).alias("stop"),
        F.array_join(F.transform("p", lambda x: x["a"].cast("string")), "_").alias("starts"), F.array_join(F.transform("p", lambda x: x["z"].cast("string")), "_").alias("ends"),
    )


def variants_in_exons(variants: DataFrame, exons: DataFrame) -> DataFrame:
    """Variants in the exons of transcripts, with their place in the transcript and their bases by its strand."""
    hit = points_in(variants, with_cdna(exons), "pos", "exon_start", "exon_end", keys=("chr",), width=EXON_BIN)
    plus = F.col("strand") == 1
    place = F.col("cdna_start") + F.when(plus, F.col("pos") - F.col("exon_start")).otherwise(F.col("exon_end") - F.col("pos"))
    turned = lambda c: F.when(plus, F.col(c)).otherwise(F.reverse(F.translate(c, "ACGT", "TGCA")))
    return hit.select("transcript_id", "chr", "pos", place.alias("tr_pos"), turned("ref").alias("ref"), turned("alt").alias("alt"), "af")


def transcript_regions(rows: DataFrame, least: int = 1) -> DataFrame:
    """CDS and UTR rows (transcript_id, strand, feature, start, end) summed by transcript and region, UTRs split by the CDS start.

    Transcripts whose CDS is under `least` bases go.
    """
    cds = rows.where("feature = 'CDS'").groupBy("transcript_id").agg(F.min("start").alias("cds_start"), F.sum(F.expr("end - start + 1")).alias("cds_length"))
    before = F.col("start") < F.col("cds_start")
    five = F.when(F.col("strand") == 1, before).otherwise(~before)
    region = F.when(F.col("feature") == "CDS", "CDS").otherwise(F.when(five, "5UTR").otherwise("3UTR"))
    out = rows.join(cds.where(F.col("cds_length") >= least), "transcript_id")
    return out.groupBy("transcript_id", region.alias("region")).agg(F.min("start").alias("first"), F.max("end").alias("last"), F.sum(F.expr("end - start + 1")).alias("bases"))


def feature_window(features: DataFrame, before: int = 1000, after: int = 200) -> DataFrame:
    """Promoter windows around the 5' end of features, by strand."""
    plus = F.col("strand") == 1
    return features.withColumn("window_start", F.when(plus, F.col("feature_start") - before).otherwise(F.col("feature_end") - after)).withColumn(
        "window_end", F.when(plus, F.col("feature_start") + after).otherwise(F.col("feature_end") + before)
    )


def annotation_rank(column: str = "annotation") -> Column:
    """Fixed order of annotations: aTIS, CDS, 5UTR, 3UTR, ntr."""
    names = ("aTIS", "CDS", "5UTR", "3UTR", "ntr")
    return F.coalesce(*(F.when(F.col(column) == n, i) for i, n in enumerate(names)), F.lit(len(names)))


def best_representative(orfs: DataFrame, group: list[str]) -> DataFrame:
    """Of each group the longest record; of equal ones that with both kinds of variants, then with indels, with SNPs, the least id."""
    return _first(orfs, group, F.desc("len"), F.desc(F.expr("indel and snp")), F.desc("indel"), F.desc("snp"), F.asc("orf_id"))


def base_orf(orfs: DataFrame, group: list[str]) -> DataFrame:
    """Of each structure the annotated record, else the longest, then without variants, the least id."""
    return _first(orfs, group, F.desc(F.expr("annotation = 'aTIS'")), F.desc("len"), F.asc(F.expr("indel or snp")), F.asc("orf_id"))


def base_proteoform(members: DataFrame, group: list[str]) -> DataFrame:
    """Of each group the first member in the order of annotations."""
    return _first(members, group, annotation_rank().asc(), F.asc("orf_id"))


def _first(df: DataFrame, group: list[str], *order: Column) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where("__r = 1").drop("__r")


def structure_groups(orfs: DataFrame) -> DataFrame:
    """`orfs` with `structure`: records of one transcript that share start or stop, also over others, form one.

    The structure's number is the least orf_id in it. Rows are dealt by transcript once; the least number passes between those that share a
    start and those that share a stop, some times within that deal. What it has not reached by then (long chains) is left as links
    between numbers, of which the connected components are taken, whatever the length of a chain. A null start or stop is shared with none.
    """
    found = orfs.repartition("transcript_id").withColumn("structure", F.col("orf_id"))
    for side in ("start", "stop") * ROUNDS:
        shared = Window.partitionBy("transcript_id", side)
        known = F.col("transcript_id").isNotNull() & F.col(side).isNotNull()
        found = found.withColumn("structure", F.when(known, F.min("structure").over(shared)).otherwise(F.col("structure")))
    # after the last side all that share a stop agree
    shared = Window.partitionBy("transcript_id", "start")
    known = F.col("transcript_id").isNotNull() & F.col("start").isNotNull()
    found = staged(found.withColumn("__least", F.when(known, F.min("structure").over(shared)).otherwise(F.col("structure"))))
    links = found.where("__least <> structure").select(F.col("structure").alias("a"), F.col("__least").alias("b"))
    found = found.drop("__least")
    if links.isEmpty():
        return found
    roots = components(links)
    return found.join(roots, found["structure"] == roots["node"], "left").withColumn("structure", F.coalesce("root", "structure")).drop("node", "root")


def structure_order(structures: DataFrame) -> DataFrame:
    """Structures of each transcript by number: that with an annotated start is 1, then by their least orf_id."""
    own = structures.groupBy("transcript_id", "structure").agg(F.max((F.col("annotation") == "aTIS").cast("int")).alias("annotated"), F.count("*").alias("members"))
    number = F.row_number().over(Window.partitionBy("transcript_id").orderBy(F.desc("annotated"), "structure"))
    return own.select("transcript_id", "structure", "members", number.alias("number"))
