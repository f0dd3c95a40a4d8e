"""Protein lists of identification tables: split, joined with what is known of each protein, and put together again in their own order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sources that stand before all others, in this order.
FIRST_SOURCES = ("SwissProt", "TrEMBL")
#: Marks of contaminants and reversed sequences in accessions.
CONTAMINANT, REVERSED = "CON__", "REV__"


def members(df: DataFrame, key: str, proteins: str = "proteins", counts: str | None = None) -> DataFrame:
    """(key, place, accession[, n]) of the `;`-separated list of each row, with the number at the same place of another list.

    Empty items are left out; an item without a number has n null. A row with a null or empty list has no members. Lists come from one cell each.
    """
    listed = lambda c: F.split(F.coalesce(F.col(c), F.lit("")), ";")
    rows = df.select(key, F.posexplode(listed(proteins)).alias("place", "accession"), *([listed(counts).alias("__n")] if counts else []))
    if counts:
        rows = rows.withColumn("n", F.get("__n", F.col("place")).try_cast("long")).drop("__n")
    return rows.withColumn("accession", F.trim("accession")).where("accession <> ''")


def source_order(source: Column) -> Column:
    """A sort key for sources: those of `FIRST_SOURCES`, then the others by name."""
    return F.struct(F.coalesce(*(F.when(source == s, i) for i, s in enumerate(FIRST_SOURCES)), F.lit(len(FIRST_SOURCES))).alias("o"), source.alias("s"))


def _sources(column: Column) -> Column:
    """Aggregate: the distinct sources of `+`-lists, in order, joined by +."""
    parts = F.array_distinct(F.flatten(F.collect_set(F.split(column, r"\+"))))
    return F.array_join(F.transform(F.array_sort(F.transform(F.filter(parts, lambda s: s != ""), source_order)), lambda s: s["s"]), "+")


def list_sources(df: DataFrame, key: str, accessions: DataFrame, without: tuple[str, ...] = (CONTAMINANT,)) -> DataFrame:
    """(sources, n): rows by the union of the sources of all their proteins; rows that name one of the marks go.

    `accessions` has accession and source (a `+`-list). Proteins that it lacks add no source; rows of which none is known have the source ''.
    """
    marked = "|".join(without)
    rows = members(df.where(~F.coalesce(F.col("proteins"), F.lit("")).rlike(marked)) if without else df, key)
    met = rows.join(accessions.select("accession", "source"), "accession", "left")
    return met.groupBy(key).agg(_sources(F.coalesce("source", F.lit(""))).alias("sources")).groupBy("sources").agg(F.count("*").alias("n"))


def max_proteins(groups: DataFrame, accessions: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Each group's proteins with most peptides and all that is known of them (V1).

    `groups` has group_id, proteins and counts (`;`-lists side by side); `accessions` accession, source, annotation, snp_id, bincode, gene_id and transcript_id;
    `descriptions` transcript_id and description. Lists of a group keep the order of its proteins and are joined by |; sources are a union. Only proteins with
    a transcript have a description, whose apostrophes go; unknown ones have empty attributes. Groups without any number have no row.
    """
    rows = members(groups, "group_id", counts="counts").where("n is not null")
    best = rows.withColumn("top", F.max("n").over(Window.partitionBy("group_id"))).where("n = top").drop("top")
    known = best.join(accessions, "accession", "left").join(descriptions, "transcript_id", "left")
    item = F.struct("place", "accession", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("annotation", "snp_id", "bincode", "gene_id")), F.when(F.coalesce("transcript_id", F.lit("")) != "", F.replace(F.coalesce("description", F.lit("")), F.lit("'"), F.lit(""))).alias("description"))
    each = known.groupBy("group_id").agg(F.sort_array(F.collect_list(item)).alias("l"), _sources(F.coalesce("source", F.lit(""))).alias("sources"))
    text = lambda name: F.array_join(F.transform("l", lambda x: x[name]), "|")
    names = {"max_proteins": "accession", "annotations": "annotation", "snp_ids": "snp_id", "bincodes": "bincode", "gene_ids": "gene_id", "descriptions": "description"}
    return each.select("group_id", "sources", *(text(c).alias(n) for n, c in names.items()))
