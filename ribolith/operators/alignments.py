"""From read alignments to ribosome position counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The standard P-site offsets by fragment length; shorter and longer fragments take the nearest one.
STANDARD_OFFSETS = {26: 12, 27: 12, 28: 12, 29: 12, 30: 12, 31: 13, 32: 13, 33: 13, 34: 14}


def strand_of(flag: str = "flag") -> Column:
    """-1 for reads on the reverse strand, else 1 (P5)."""
    return F.when(F.col(flag).bitwiseAND(16) != 0, -1).otherwise(1)


def filter_reads(df: DataFrame, unique: bool = False, first_rank: bool = False, max_hits: int | None = None, unique_mapq: int = 255) -> DataFrame:
    """Unique reads by mapping quality or one hit (P1), first-ranked hits (P2), reads under a number of hits."""
    if unique:
        df = df.where((F.col("mapq") == unique_mapq) | (F.col("nh") == 1))
    if first_rank:
        df = df.where((F.col("hi") == 1) | (F.col("nh") == 1))
    return df if max_hits is None else df.where(F.col("nh") < max_hits)


def cigar_ops(cigar: str = "cigar") -> Column:
    """array<struct<n, op>> of a CIGAR string (F1)."""
    parts = F.regexp_extract_all(F.col(cigar), F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    return F.transform(parts, lambda p: F.struct(F.substring(p, 1, F.length(p) - 1).cast("int").alias("n"), F.right(p, F.lit(1)).alias("op")))


def _sum(ops: Column, kinds: str) -> Column:
    """Bases of the operations whose letters are in `kinds`."""
    return F.aggregate(F.filter(ops, lambda x: x["op"].isin(*kinds)), F.lit(0), lambda acc, x: acc + x["n"])


def aligned_length(ops: Column, strand: Column) -> Column:
    """Bases of M, I and S without a leading clip of one base and a trailing clip, in reading direction (F2)."""
    read = F.when(strand == 1, ops).otherwise(F.reverse(ops))
    first, last = F.element_at(read, 1), F.element_at(read, -1)
    lead = F.when((first["op"] == "S") & (first["n"] == 1), 1).otherwise(0)
    trail = F.when((F.size(read) > 1) & (last["op"] == "S"), last["n"]).otherwise(0)
    return _sum(ops, "MIS") - lead - trail


def psite_position(pos: Column, ops: Column, strand: Column, offset: Column) -> Column:
    """Genomic P-site: `offset` read bases from the 5' end, introns skipped.

    The walk goes over matched blocks in reading direction; clips take no reference bases.
    """
    span = _sum(ops, "MDN=X")
    read = F.when(strand == 1, ops).otherwise(F.reverse(ops))
    start = F.struct(F.lit(0).alias("ref"), offset.cast("int").alias("left"), F.lit(False).alias("done"))

    def step(acc, x):
        body = x["op"].isin("M", "=", "X")
        inside = body & (x["n"] > acc["left"]) & ~acc["done"]
        return F.when(acc["done"], acc).when(
            inside, F.struct((acc["ref"] + acc["left"]).alias("ref"), F.lit(0).alias("left"), F.lit(True).alias("done"))
        ).otherwise(F.struct(
            (acc["ref"] + F.when(body | x["op"].isin("D", "N"), x["n"]).otherwise(0)).alias("ref"),
            (acc["left"] - F.when(body | (x["op"] == "I"), x["n"]).otherwise(0)).alias("left"), F.lit(False).alias("done"),
        ))

    walked = F.aggregate(read, start, step, lambda acc: acc["ref"])
    return F.when(strand == 1, pos + walked).otherwise(pos + span - 1 - walked)


def offset_of(length: Column, offsets: dict[int, int] | None = None, five_prime: int | None = None, three_prime: int | None = None) -> Column:
    """P-site offset of a fragment length: by table (clamped to its ends), or constant from either end."""
    if five_prime is not None:
        return F.lit(five_prime)
    if three_prime is not None:
        return length - three_prime - 1
    known = offsets or STANDARD_OFFSETS
    table = F.create_map(*(F.lit(x) for pair in sorted(known.items()) for x in pair))
    return F.element_at(table, F.least(F.greatest(length, F.lit(min(known))), F.lit(max(known))).cast("int"))


def with_psites(df: DataFrame, **how) -> DataFrame:
    """Alignments with strand, len and psite."""
    rows = df.withColumn("strand", strand_of()).withColumn("__ops", cigar_ops())
    rows = rows.withColumn("len", aligned_length(F.col("__ops"), F.col("strand")))
    place = psite_position(F.col("pos"), F.col("__ops"), F.col("strand"), offset_of(F.col("len"), **how))
    return rows.withColumn("psite", place.cast("long")).drop("__ops")


def psite_counts(psites: DataFrame, shortest: int = 26, longest: int = 34) -> DataFrame:
    """Reads by chr, strand and P-site, of fragments within the lengths."""
    kept = psites.where(F.col("len").between(shortest, longest))
    return kept.groupBy("chr", "strand", F.col("psite").alias("start")).agg(F.count("*").alias("cnt"))


def psite_counts_by_length(psites: DataFrame) -> DataFrame:
    """The same for each fragment length, all lengths (A2)."""
    return psites.groupBy("chr", "strand", F.col("psite").alias("start"), F.col("len").alias("rpf")).agg(F.count("*").alias("cnt"))


def fractional_counts(df: DataFrame, trim: int = 12) -> DataFrame:
    """Each covered base of a read without `trim` bases at both ends counts 1 / bases left (A3)."""
    ops = cigar_ops()
    rows = df.withColumn("strand", strand_of()).withColumn("__ops", ops)
    body = F.filter(F.col("__ops"), lambda x: x["op"].isin("M", "D", "N", "=", "X"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("bases"))
    grow = lambda acc, x: F.struct(
        (acc["at"] + x["n"]).alias("at"),
        F.when(x["op"].isin("M", "=", "X"), F.concat(acc["bases"], F.sequence(acc["at"], acc["at"] + x["n"] - 1))).otherwise(acc["bases"]).alias("bases"),
    )
    covered = F.aggregate(body, start, grow, lambda acc: acc["bases"])
    rows = rows.withColumn("__b", covered).withColumn("__n", F.size("__b") - 2 * trim).where("__n > 0")
    rows = rows.withColumn("__at", F.explode(F.slice("__b", trim + 1, F.col("__n"))))
    return rows.groupBy("chr", "strand", (F.col("pos") + F.col("__at")).alias("start")).agg(F.sum(1.0 / F.col("__n")).alias("value"))


def length_distribution(psites: DataFrame) -> DataFrame:
    """Reads by chr and aligned length (A4)."""
    return psites.groupBy("chr", "len").agg(F.count("*").alias("reads"))


def mapping_statistics(df: DataFrame) -> DataFrame:
    """Per chr: all, unique and multiple reads and their shares."""
    out = df.groupBy("chr").agg(
        F.count("*").alias("total"), F.count_if(F.col("nh") == 1).alias("mapped_u"), F.count_if(F.col("nh") > 1).alias("mapped_m")
    )
    share = lambda c: F.round(F.col(c) / F.col("total"), 5)
    return out.withColumn("freq_u", share("mapped_u")).withColumn("freq_m", share("mapped_m"))


def mark_duplicates(df: DataFrame, best: list) -> DataFrame:
    """One read for each chr, position, strand and CIGAR: the first by `best`."""
    same = Window.partitionBy("chr", "pos", "strand", "cigar").orderBy(*best)
    return df.withColumn("strand", strand_of()).withColumn("__r", F.row_number().over(same)).where("__r = 1").drop("__r")
