"""Interval joins by bins, and transcript coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a bin in bases: an interval lands in as many bins as it touches, a point in one.
BIN = 1000
#: The same where points meet exons: about an exon's length, so that most points of a bin lie in the exons that touch it.
EXON_BIN = 128


def _bin(column, width: int) -> Column:
    return F.floor(F.col(column) / width).cast("long") if isinstance(column, str) else F.floor(column / width).cast("long")


def points_in(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, keys=("chr", "strand"), how: str = "inner", width: int = BIN) -> DataFrame:
    """`points` joined with the closed `intervals` of the same `keys` that hold them.

    An equi-join on key and bin with the exact test on top, so Spark shuffles by (keys, bin) and no pair of rows of
    different bins meets. Null bounds or points match nothing.
    """
    binned = intervals.withColumn("__bin", F.explode(F.sequence(_bin(start, width), _bin(F.greatest(F.col(end), F.col(start)), width))))
    left = points.withColumn("__bin", _bin(point, width))
    right = binned.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__bin").alias("__b"), *(c for c in intervals.columns if c not in keys))
    on = left["__bin"] == right["__b"]
    for k in keys:
        on = on & (left[k] == right[f"__{k}"])
    on = on & left[point].between(right[start], right[end])
    return left.join(right, on, how).drop("__bin", "__b", *(f"__{k}" for k in keys))


def overlaps(a: DataFrame, b: DataFrame, a_id: str, b_id: str, start: str, end: str, keys=("chr", "strand"), width: int = BIN, unique: bool = False) -> DataFrame:
    """Distinct pairs (a_id, b_id) of overlapping closed intervals of the same keys.

    A pair is told in the bin of the larger start alone. With `unique`, where each id has one interval, that makes pairs distinct without a shuffle of them.
    """

    def binned(df, tag, own):
        kept = [F.col(k).alias(k) for k in keys]
        rows = df.select(*kept, F.col(own).alias(own), F.col(start).alias(f"{tag}_start"), F.col(end).alias(f"{tag}_end"))
        return rows.withColumn("__bin", F.explode(F.sequence(_bin(f"{tag}_start", width), _bin(f"{tag}_end", width))))

    met = binned(a, "a", a_id).join(binned(b, "b", b_id), [*keys, "__bin"])
    met = met.where("a_start <= b_end and a_end >= b_start").where(F.col("__bin") == _bin(F.greatest("a_start", "b_start"), width)).select(a_id, b_id)
    return met if unique else met.distinct()


def _running(marks: DataFrame, keys, values, order: str, width: int) -> DataFrame:
    """`marks` (keys, __at, `order`, …) with each of `values` as its sum over the marks of the same keys up to the row, by (__at, `order`).

    Sums run inside a bin, and the bins' totals, a row for each, run over the bins of the keys, so no task sees more than a bin's marks.
    """
    cut = marks.withColumn("__bin", _bin("__at", width))
    own = [*keys, "__bin"]
    totals = cut.groupBy(*own).agg(*(F.sum(v).alias(f"__t_{v}") for v in values))
    before = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*(F.col(c).alias(f"__k_{c}") for c in own), *(F.sum(f"__t_{v}").over(before).alias(f"__b_{v}") for v in values))
    inside = Window.partitionBy(*own).orderBy("__at", order).rowsBetween(Window.unboundedPreceding, 0)
    rows = cut.select(*(c for c in cut.columns if c not in values), *(F.sum(v).over(inside).alias(v) for v in values))
    on = F.lit(True)
    for c in own:
        on = on & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    sums = (F.coalesce(F.col(v), F.lit(0)) + F.coalesce(F.col(f"__b_{v}"), F.lit(0)) for v in values)
    return rows.join(totals, on).select(*(c for c in marks.columns if c not in values), *(x.alias(v) for x, v in zip(sums, values)))


def totals_in(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, values: dict[str, Column], by, keys=("chr", "strand"), width: int = BIN) -> DataFrame:
    """(by, values): for each group `by` of closed `intervals` the sums of `values` over the `points` of the same `keys` inside them.

    A point counts once for each interval that holds it. The sum inside an interval is the running sum at its end less that before its
    start, so the work follows points plus intervals, not their pairs; it is exact for whole numbers and decimals. Null values count as zero, null bounds
    or points match nothing. Groups without a point have zeros.
    """
    names = list(values)
    marks = points.where(F.col(point).isNotNull()).select(*keys, F.col(point).cast("long").alias("__at"), F.lit(0).alias("__edge"), *(v.alias(n) for n, v in values.items()))
    kept = intervals.where(F.col(start) <= F.col(end)).dropna(subset=list(keys))
    side = lambda at, sign: F.struct(at.cast("long").alias("at"), F.lit(sign).alias("sign"))
    edges = kept.select(*keys, *(F.col(b).alias(f"__g_{b}") for b in by), F.explode(F.array(side(F.col(start) - 1, -1), side(F.col(end), 1))).alias("e"))
    edges = edges.select(*keys, F.col("e.at").alias("__at"), F.lit(1).alias("__edge"), *(f"__g_{b}" for b in by), F.col("e.sign").alias("__sign"))
    rows = _running(marks.unionByName(edges, allowMissingColumns=True), keys, names, "__edge", width).where("__edge = 1")
    return rows.groupBy(*(F.col(f"__g_{b}").alias(b) for b in by)).agg(*(F.sum(F.when(F.col("__sign") > 0, F.col(n)).otherwise(-F.col(n))).alias(n) for n in names))


def covers(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, weights: dict[str, Column], keys=("chr", "strand"), width: int = BIN) -> DataFrame:
    """`points` with, for each of `weights`, its sum over the closed `intervals` of the same `keys` that hold the point.

    An interval adds its weight from its start on and takes it off behind its end; the work follows points plus intervals, not their pairs.
    Null bounds or points match nothing.
    """
    names = list(weights)
    kept = intervals.where(F.col(start) <= F.col(end)).dropna(subset=list(keys))
    side = lambda at, sign: F.struct(at.cast("long").alias("at"), F.lit(sign).alias("sign"))
    edges = kept.select(*keys, *(w.alias(n) for n, w in weights.items()), F.explode(F.array(side(F.col(start), 1), side(F.col(end) + 1, -1))).alias("e"))
    edges = edges.select(*keys, F.col("e.at").alias("__at"), F.lit(0).alias("__edge"), *((F.col("e.sign") * F.col(n)).alias(n) for n in names))
    sums = edges.groupBy(*keys, "__at", "__edge").agg(*(F.sum(n).alias(n) for n in names))  # edges of one place are one
    own = points.withColumn("__at", F.col(point).cast("long")).withColumn("__edge", F.lit(1))
    rows = _running(own.unionByName(sums, allowMissingColumns=True), keys, names, "__edge", width).where("__edge = 1")
    return rows.select(*points.columns, *(F.when(F.col("__at").isNotNull(), F.col(n)).otherwise(0).alias(n) for n in names))


def with_cdna(exons: DataFrame, transcript: str = "transcript_id") -> DataFrame:
    """`exons` with cdna_start and cdna_end, counted from 1 in rank order."""
    before = Window.partitionBy(transcript).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    length = F.col("exon_end") - F.col("exon_start") + 1
    first = F.coalesce(F.sum(length).over(before), F.lit(0)) + 1
    return exons.withColumn("cdna_start", first.cast("long")).withColumn("cdna_end", (first + length - 1).cast("long"))


def cdna_position(position: str = "start") -> Column:
    """The transcript coordinate of a genomic position inside an exon with cdna_start."""
    offset = F.when(F.col("strand") == 1, F.col(position) - F.col("exon_start")).otherwise(F.col("exon_end") - F.col(position))
    return F.col("cdna_start") + offset


def genome_position(position: str = "cdna") -> Column:
    """The genomic coordinate of a transcript position inside an exon (F13, the other way)."""
    offset = F.col(position) - F.col("cdna_start")
    return F.when(F.col("strand") == 1, F.col("exon_start") + offset).otherwise(F.col("exon_end") - offset)


def clip_cds(exons: DataFrame, head: int = 15, tail: int = 15) -> DataFrame:
    """Exons without the first `head` and last `tail` coding bases; exons of which nothing is left go."""
    total = Window.partitionBy("transcript_id")
    placed = with_cdna(exons).withColumn("__n", F.max("cdna_end").over(total))
    low, high = F.greatest("cdna_start", F.lit(head + 1)), F.least("cdna_end", F.col("__n") - tail)
    cut = placed.withColumn("__a", low - F.col("cdna_start")).withColumn("__z", F.col("cdna_end") - high).where(low <= high)
    plus = F.col("strand") == 1
    return (
        cut.withColumn("clip_start", F.col("exon_start") + F.when(plus, F.col("__a")).otherwise(F.col("__z")))
        .withColumn("clip_end", F.col("exon_end") - F.when(plus, F.col("__z")).otherwise(F.col("__a")))
        .drop("__n", "__a", "__z")
    )


def upstream(intervals: DataFrame, start: str, end: str, n: int = 50) -> DataFrame:
    """Intervals extended by `n` bases upstream by strand, never below 1."""
    plus = F.col("strand") == 1
    return intervals.withColumn("utr_start", F.when(plus, F.greatest(F.col(start) - n, F.lit(1))).otherwise(F.col(start))).withColumn(
        "utr_end", F.when(plus, F.col(end)).otherwise(F.col(end) + n)
    )
