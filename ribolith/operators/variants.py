"""Variant tables: filters, classes against known variants, and allele frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ribolith.operators.intervals import covers, totals_in

KEY = ["chr", "pos", "ref", "alt"]


def split_multiallelic(df: DataFrame) -> DataFrame:
    """One row for each alternative of a comma-separated list."""
    return df.withColumn("alt", F.explode(F.split("alt", ",")))


def filter_calls(df: DataFrame, depth: tuple[int, int], homozygous: float = 0.95, heterozygous: tuple[float, float] = (0.3, 0.7)) -> DataFrame:
    """Single-base calls within the depths whose frequency looks like one or two alleles."""
    snv = (F.length("ref") == 1) & (F.length("alt") == 1)
    af = (F.col("af") > homozygous) | ((F.col("af") > heterozygous[0]) & (F.col("af") < heterozygous[1]))
    return df.where(snv & F.col("dp").between(*depth) & af)


def classify(called: DataFrame, known: DataFrame, mismatches: DataFrame) -> DataFrame:
    """Calls as new (y) or known (n), and mismatches that are known but not called (m)."""
    called, known, mismatches = (df.select(*KEY).distinct() for df in (called, known, mismatches))
    new = called.join(known, KEY, "left_anti").withColumn("new", F.lit("y"))
    old = called.join(known, KEY, "left_semi").withColumn("new", F.lit("n"))
    only = mismatches.join(known, KEY, "left_semi").join(called, KEY, "left_anti").withColumn("new", F.lit("m"))
    return new.unionByName(old).unionByName(only)


def per_transcript(variants: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Distinct variants inside each transcript, zero included."""
    n = totals_in(variants.select(*KEY).distinct(), transcripts, "pos", "feature_start", "feature_end", {"n": F.lit(1)}, ["feature_id"], keys=("chr",))
    return transcripts.select("feature_id").join(n, "feature_id", "left").select("feature_id", F.coalesce("n", F.lit(0)).alias("n"))


def guard(variants: DataFrame, transcripts: DataFrame, most: int = 5) -> DataFrame:
    """Distinct variants that stand in no transcript with more than `most` of them (A36). Both steps are running sums; no pairs are made."""
    distinct = variants.select(*KEY).distinct()
    spans = transcripts.select("chr", "feature_id", "feature_start", "feature_end")
    n = totals_in(distinct, spans, "pos", "feature_start", "feature_end", {"n": F.lit(1)}, ["feature_id"], keys=("chr",))
    crowded = spans.join(n.where(F.col("n") > most), "feature_id", "left_semi")
    return covers(distinct, crowded, "pos", "feature_start", "feature_end", {"held": F.lit(1)}, keys=("chr",)).where("held = 0").select(*KEY)
