"""Counts of positions over genes, exons and reading frames, and quality metrics of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.operators.intervals import EXON_BIN, cdna_position, covers, points_in, totals_in, with_cdna
from ribolith.operators.ranges import running

#: Fragment lengths whose sums are taken side by side in one pass.
LENGTHS = 32
#: Positions of a block in which neighbours are compared.
NEAR = 4096


def merged(psite: DataFrame) -> DataFrame:
    """Counts by position over all fragment lengths. Summing first keeps very deep positions small in later joins."""
    return psite.groupBy("chr", "strand", "start").agg(F.sum("cnt").alias("cnt"))


def feature_counts(points: DataFrame, features: DataFrame) -> DataFrame:
    """Sum and number of positions in each feature; features without any go."""
    values = {"counts_sum": F.col("cnt"), "counts_n": F.lit(1)}
    return totals_in(points, features, "start", "feature_start", "feature_end", values, ["feature_id"]).where("counts_n > 0")


def gene_distribution(points: DataFrame, features: DataFrame) -> DataFrame:
    """Reads by gene, positions outside all genes as -1."""
    free = covers(points, features, "start", "feature_start", "feature_end", {"held": F.lit(1)}).where("held = 0")
    none = free.agg(F.count("*").alias("n"), F.sum("cnt").alias("reads")).where("n > 0").select(F.lit(-1).alias("feature_id"), "reads")
    return feature_counts(points, features).select("feature_id", F.col("counts_sum").alias("reads")).unionByName(none)


def metagenic(points: DataFrame, typed: DataFrame) -> DataFrame:
    """Reads by chr and the class of least priority that holds a position, else intergenic.

    `typed` has chr, strand, feature_start, feature_end, kind and priority.
    """
    classes = sorted((r["priority"], r["kind"]) for r in typed.select("kind", "priority").distinct().collect())  # a row for each class
    held = covers(points, typed, "start", "feature_start", "feature_end", {f"k{i}": ((F.col("kind") == k) & (F.col("priority") == p)).cast("long") for i, (p, k) in enumerate(classes)})
    kind = F.coalesce(*(F.when(F.col(f"k{i}") > 0, F.lit(k)) for i, (_, k) in enumerate(classes)), F.lit("intergenic"))
    return held.groupBy("chr", kind.alias("kind")).agg(F.sum("cnt").alias("reads"))


def exon_hits(points: DataFrame, exons: DataFrame) -> DataFrame:
    """Positions with the exons that hold them and their transcript coordinate and frame."""
    hit = points_in(points, with_cdna(exons), "start", "exon_start", "exon_end", width=EXON_BIN)
    return hit.withColumn("cdna", cdna_position()).withColumn("phase", F.pmod(F.col("cdna") - 1, F.lit(3)).cast("int"))


def transcript_coverage(points: DataFrame, exons: DataFrame, mapped: DataFrame) -> DataFrame:
    """Reads, covered positions, share covered and reads per kilobase and million of each transcript.

    `mapped` has one row with the column mapped: the number of all reads.
    """
    size = exons.groupBy("transcript_id").agg(F.sum(F.col("exon_end") - F.col("exon_start") + 1).alias("length"))
    sums = exon_hits(points, exons).groupBy("transcript_id").agg(F.sum("cnt").alias("reads"), F.count("*").alias("covered"))
    rows = sums.join(size, "transcript_id").crossJoin(F.broadcast(mapped))
    return rows.select(
        "transcript_id", "reads", "covered", F.round(F.col("covered") / F.col("length"), 6).alias("coverage"),
        F.round(F.col("reads") * 1e9 / (F.col("length") * F.col("mapped")), 6).alias("fpkm"),
    )


def translated(points: DataFrame, exons: DataFrame, noise: float = 0.2, most: float = 0.15) -> DataFrame:
    """Whether a transcript's exons are covered evenly: few have under `noise` of the mean count per base."""
    size = F.col("exon_end") - F.col("exon_start") + 1
    sums = exon_hits(points, exons).groupBy("transcript_id", "rank").agg(F.sum("cnt").alias("reads"))
    each = exons.select("transcript_id", "rank", size.alias("length")).join(sums, ["transcript_id", "rank"], "left")
    each = each.withColumn("norm", F.coalesce("reads", F.lit(0)) / F.col("length"))
    each = each.withColumn("mean", F.avg("norm").over(Window.partitionBy("transcript_id")))
    out = each.groupBy("transcript_id").agg(
        F.sum(F.coalesce("reads", F.lit(0))).alias("reads"), F.count_if(F.col("norm") < F.col("mean") * noise).alias("noisy"), F.count("*").alias("exons")
    )
    return out.where("reads > 0").withColumn("exon_coverage", F.when(F.col("noisy") / F.col("exons") < most, "Yes").otherwise("No"))


def orf_counts(points: DataFrame, exons: DataFrame, trim: int = 15, short: int = 300) -> DataFrame:
    """Reads before, in and after the trimmed frame; frames of up to `short` bases are trimmed in proportion."""
    size = Window.partitionBy("transcript_id")
    own = exons.withColumn("n", F.sum(F.col("exon_end") - F.col("exon_start") + 1).over(size))
    cut = F.when(F.col("n") > short, F.lit(trim)).otherwise(F.floor(F.col("n") * trim / short))
    hit = exon_hits(points, own).withColumn("cut", cut)
    first, last = F.col("cdna") <= F.col("cut"), F.col("cdna") > F.col("n") - F.col("cut")
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("cnt"))), F.lit(0))
    return hit.groupBy("transcript_id").agg(total(first).alias("pre_count"), total(~first & ~last).alias("count"), total(last & ~first).alias("post_count"))


def phase_by_length(psite: DataFrame, exons: DataFrame) -> DataFrame:
    """Reads in each frame by fragment length."""
    held = phase_covers(psite, exons)
    total = lambda p: F.sum(F.col("cnt") * F.col(f"phase{p}")).alias(f"phase{p}")
    return held.where("phase0 + phase1 + phase2 > 0").groupBy("rpf").agg(*map(total, range(3)))


def phase_covers(points: DataFrame, exons: DataFrame) -> DataFrame:
    """`points` with phase0, phase1 and phase2: the number of exons that hold the position in that frame of their transcript.

    Along an exon the frame follows the position's remainder by three, so exons of one strand are of three kinds, by `shift`.
    """
    own = with_cdna(exons)
    plus = F.col("strand") == 1
    shift = F.pmod(F.col("cdna_start") - 1 + F.when(plus, -F.col("exon_start")).otherwise(F.col("exon_end")), F.lit(3))
    held = covers(points, own, "start", "exon_start", "exon_end", {f"__s{k}": (shift == k).cast("long") for k in range(3)})
    step = F.pmod(F.when(plus, F.col("start")).otherwise(-F.col("start")), F.lit(3))  # frame = shift + step
    phase = lambda p: F.coalesce(*(F.when(step == k, F.col(f"__s{(p - k) % 3}")) for k in range(3)), F.lit(0)).alias(f"phase{p}")
    return held.select(*points.columns, *map(phase, range(3)))


def frame_metrics(points: DataFrame, exons: DataFrame, threshold: float = 1.0) -> DataFrame:
    """In-frame share of reads, its dispersion around the mean, and share of positions over the mean.

    Positions without reads count as zeros: their squares are added from the transcript's length.
    """
    size = exons.groupBy("transcript_id").agg(F.sum(F.col("exon_end") - F.col("exon_start") + 1).alias("length"))
    # positions by count first: a row for each count that a transcript has, at most as many as its bases
    same = exon_hits(points, exons).groupBy("transcript_id", "cnt").agg(F.count("*").alias("n"), F.count_if(F.col("phase") == 0).alias("n0"))
    sums = same.groupBy("transcript_id").agg(
        F.sum(F.col("cnt") * F.col("n")).alias("reads"), F.sum(F.col("cnt") * F.col("n0")).alias("reads0"), F.sum("n0").alias("n0"),
        F.sum(F.col("cnt") * F.col("cnt") * F.col("n0")).alias("squares"), F.collect_list(F.struct("cnt", "n")).alias("counts"),
    )
    known = sums.join(size, "transcript_id").withColumn("mean", F.col("reads") / F.col("length")).withColumn("slots", F.floor((F.col("length") + 2) / 3))
    stat = F.col("squares") - 2 * F.col("mean") * F.col("reads0") + F.col("slots") * F.col("mean") * F.col("mean")
    above = F.aggregate("counts", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["cnt"] > threshold * F.col("mean"), x["n"]).otherwise(0))
    return known.select(
        "transcript_id", F.round(F.col("reads0") / F.col("reads"), 6).alias("ifc"), F.round(stat, 6).alias("ifc_stat"),
        F.round(above / F.col("length"), 6).alias("spread"),
    )


def phase_histogram(points: DataFrame, exons: DataFrame, bins: int = 20) -> DataFrame:
    """Positions by bin of relative place in the transcript and frame."""
    size = exons.groupBy("transcript_id").agg(F.sum(F.col("exon_end") - F.col("exon_start") + 1).alias("length"))
    hit = exon_hits(points, exons).join(size, "transcript_id")
    bin_ = F.floor(F.col("cdna") * bins / (F.col("length") + 1)).cast("int")
    return hit.groupBy(bin_.alias("bin"), "phase").agg(F.count("*").alias("positions"))


def rank_curve(counts: DataFrame, key: str = "feature_id", value: str = "counts_sum") -> DataFrame:
    """Rank by count and cumulative share of all reads.

    Ranks need the order of all genes; counts are grouped to distinct values first, whose running sums come from ranges.
    """
    by = counts.groupBy(value).agg(F.count("*").alias("n"))
    before = running(by, value, {"first": F.col("n"), "mass": F.col("n") * F.col(value)}, ascending=False)
    before = before.crossJoin(F.broadcast(by.agg(F.sum(F.col("n") * F.col(value)).alias("all"))))
    place = Window.partitionBy(value).orderBy(key)
    ranked = counts.join(before, value).withColumn("k", F.row_number().over(place))
    rank = F.coalesce("first", F.lit(0)) + F.col("k")
    share = (F.coalesce("mass", F.lit(0)) + F.col("k") * F.col(value)) / F.col("all")
    return ranked.select(key, F.col(value), rank.cast("long").alias("rank"), F.round(share, 6).alias("cumulative"))


def length_fractions(psite: DataFrame, features: DataFrame) -> DataFrame:
    """Reads of each fragment length in each feature and their share of the feature's reads."""
    sums = length_sums(psite, features, "feature_id", "feature_start", "feature_end")
    return sums.withColumn("fraction", F.col("reads") / F.sum("reads").over(Window.partitionBy("feature_id")))


def length_sums(psite: DataFrame, intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, rpf, reads): reads of each fragment length inside the `intervals` of each key; counts are positive, lengths without reads have no row.

    The sums of `LENGTHS` fragment lengths at a time stand side by side, so that a position is one row for them.
    """
    lengths = sorted((r[0] for r in psite.select("rpf").distinct().collect()), key=lambda x: (x is None, x))  # a row for each fragment length
    kind, out = psite.schema["rpf"].dataType, None
    for at in range(0, max(1, len(lengths)), LENGTHS):
        some = [F.lit(x).cast(kind) for x in lengths[at : at + LENGTHS]]
        names = [f"__r{i}" for i in range(len(some))]
        wide = psite.groupBy("chr", "strand", "start").agg(F.sum("cnt").alias("__any"), *(F.sum(F.when(F.col("rpf").eqNullSafe(x), F.col("cnt"))).alias(n) for x, n in zip(some, names)))
        sums = totals_in(wide, intervals, "start", start, end, {n: F.coalesce(F.col(n), F.lit(0)) for n in ["__any", *names]}, [key])
        each = F.array(*(F.struct(x.alias("rpf"), F.col(n).alias("reads")) for x, n in zip(some, names))) if some else F.array(F.struct(F.lit(None).cast(kind).alias("rpf"), F.col("__any").alias("reads")))
        part = sums.where("__any > 0").select(key, F.explode(each).alias("e")).select(key, "e.rpf", "e.reads").where("reads > 0")
        out = part if out is None else out.unionByName(part)
    return out


def floss(psite: DataFrame, features: DataFrame, reference: DataFrame) -> DataFrame:
    """Reads and half the summed distance of a feature's length fractions to the reference's (A23, lengths it has)."""
    known = length_fractions(psite, features).join(F.broadcast(reference), "rpf", "left")
    gap = F.abs(F.col("fraction") - F.coalesce("ref", F.lit(0.0)))
    return known.groupBy("feature_id").agg(F.sum("reads").alias("nreads"), F.round(F.sum(gap) / 2, 6).alias("floss"))


def reference_fractions(psite: DataFrame, features: DataFrame) -> DataFrame:
    """rpf, ref: shares of the fragment lengths over all features (A22); one row for each length."""
    held = covers(psite, features, "start", "feature_start", "feature_end", {"held": F.lit(1)}).where("held > 0")
    sums = held.groupBy("rpf").agg(F.sum(F.col("cnt") * F.col("held")).alias("reads"))
    return sums.select("rpf", (F.col("reads") / F.sum("reads").over(Window.partitionBy())).alias("ref"))


def orfscore(points: DataFrame, exons: DataFrame, dominance: float = 0.7) -> DataFrame:
    """log2(1 + chi-square of the frame sums), negative unless frame 0 leads; dominant positions masked (M6)."""
    same = exon_hits(points, exons).groupBy("transcript_id", "cnt").agg(*(F.count_if(F.col("phase") == p).alias(f"n{p}") for p in range(3)))  # positions by count
    sums = same.groupBy("transcript_id").agg(F.sum(F.col("cnt") * (F.col("n0") + F.col("n1") + F.col("n2"))).alias("all"), F.collect_list(F.struct("cnt", "n0", "n1", "n2")).alias("counts"))
    sums = sums.withColumn("counts", F.filter("counts", lambda x: x["cnt"] < dominance * F.col("all"))).where(F.size("counts") > 0)
    reads = lambda p: F.aggregate("counts", F.lit(0).cast("long"), lambda acc, x: acc + x["cnt"] * x[f"n{p}"]).alias(f"f{p}")
    f = [reads(p) for p in range(3)]
    sums = sums.select("transcript_id", *f).withColumn("m", (F.col("f0") + F.col("f1") + F.col("f2")) / 3)
    chi = sum(((F.col(f"f{p}") - F.col("m")) * (F.col(f"f{p}") - F.col("m")) / F.col("m") for p in range(3)), F.lit(0.0))
    sign = F.when((F.col("f0") > F.col("f1")) & (F.col("f0") > F.col("f2")), 1).otherwise(-1)
    return sums.select("transcript_id", (F.round(sign * F.log2(1 + chi), 6) + 0.0).alias("orfscore"))


def local_maxima(points: DataFrame, exons: DataFrame, codons: int = 1) -> DataFrame:
    """Positions of a transcript with no larger count within `codons` codons."""
    reach = 3 * codons
    own = with_cdna(exons)
    # inside an exon the neighbours are those of the genome: one test for each position, whatever the exons over it
    around = Window.partitionBy("chr", "strand", "block").orderBy("start").rangeBetween(-reach, reach)
    first, last = F.floor((F.col("start") - reach) / NEAR).cast("long"), F.floor((F.col("start") + reach) / NEAR).cast("long")
    wide = points.withColumn("block", F.explode(F.sequence(first, last)))
    tops = wide.withColumn("top", F.max("cnt").over(around)).where(F.col("block") == F.floor(F.col("start") / NEAR).cast("long")).where("cnt >= top").select(*points.columns)
    inner = own.withColumn("a", F.col("exon_start") + reach).withColumn("z", F.col("exon_end") - reach).where("a <= z")
    inside = points_in(tops, inner, "start", "a", "z", width=EXON_BIN).withColumn("cdna", cdna_position()).select("transcript_id", "cdna", "cnt")
    # next to an exon's ends they may lie in another exon: the ends alone, each with as many bases again beside it
    long_ = F.col("exon_end") - F.col("exon_start") + 1 > 4 * reach
    end = lambda a, z: F.struct(a.cast("long").alias("a"), z.cast("long").alias("z"))
    whole = F.array(end(F.col("exon_start"), F.col("exon_end")))
    both = F.array(end(F.col("exon_start"), F.col("exon_start") + 2 * reach - 1), end(F.col("exon_end") - 2 * reach + 1, F.col("exon_end")))
    ends = own.withColumn("p", F.explode(F.when(long_, both).otherwise(whole))).withColumn("a", F.col("p.a")).withColumn("z", F.col("p.z")).drop("p")
    near = Window.partitionBy("transcript_id").orderBy("cdna").rangeBetween(-reach, reach)
    edge = ~F.col("start").between(F.col("exon_start") + reach, F.col("exon_end") - reach)
    hit = points_in(points, ends, "start", "a", "z", width=EXON_BIN).withColumn("cdna", cdna_position()).select("transcript_id", "cdna", "cnt", edge.alias("edge"))
    beside = hit.withColumn("top", F.max("cnt").over(near)).where("edge and cnt >= top").select("transcript_id", "cdna", "cnt")
    return inside.unionByName(beside)
