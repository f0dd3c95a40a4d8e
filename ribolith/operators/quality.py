"""Codon usage, coverage checks, offsets, length-distribution cutoffs, coherence and variants from reads."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ribolith.operators.alignments import cigar_ops, strand_of
from ribolith.operators.ranges import staged
from ribolith.operators.smoothing import local_regression


def codon_phase_counts(hits: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Reads by codon and frame, and each codon's share of all in percent.

    `hits` has transcript_id, cdna, phase and cnt; `transcripts` transcript_id and seq. A position counts for the codon that holds it.
    """
    codon = F.substring("seq", F.col("cdna") - F.col("phase"), F.lit(3))
    by = hits.join(transcripts, "transcript_id").groupBy(codon.alias("codon"), "phase").agg(F.sum("cnt").alias("reads"))
    by = by.where(F.length("codon") == 3)
    return by.withColumn("percent", F.round(100 * F.col("reads") / F.sum("reads").over(Window.partitionBy()), 6))  # 192 rows at most


def coverage_checks(hits: DataFrame, sizes: DataFrame, least: int = 50, most: float = 0.5) -> DataFrame:
    """For each transcript: any reads, no position with over `most` of them, length at least `least`, and all of these (M3)."""
    sums = hits.groupBy("transcript_id").agg(F.sum("cnt").alias("reads"), F.max("cnt").alias("top"))
    rows = sizes.join(sums, "transcript_id", "left").select(
        "transcript_id", (F.coalesce("reads", F.lit(0)) > 0).alias("covered"),
        F.coalesce(F.col("top") / F.col("reads") <= most, F.lit(False)).alias("even"), (F.col("length") >= least).alias("long"),
    )
    return rows.withColumn("passes", F.expr("covered and even and long"))


def offset_fill(offsets: DataFrame, unresolved: int = 50) -> DataFrame:
    """`offsets` (length, offset) with unresolved ones taken from the length before, at the start the smallest of all.

    A row for each fragment length, so one window partition is small.
    """
    known = F.when(F.col("offset") != unresolved, F.col("offset"))
    least = F.min(known).over(Window.partitionBy())
    return offsets.withColumn("offset", F.coalesce(F.last(known, ignorenulls=True).over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)), least))


def psite_offsets(reads: DataFrame, starts: DataFrame) -> DataFrame:
    """The most frequent distance of a start codon from the read's 5' end by read length, within 40 to 60 % of it; else half of it.

    `reads` has chr, strand, first (5' end) and len; `starts` chr, strand and start. Equal counts go to the smaller distance.
    """
    step = F.when(F.col("strand") == 1, 1).otherwise(-1)
    low, high = F.ceil(F.col("len") * 0.4), F.floor(F.col("len") * 0.6)
    sums = reads.groupBy("chr", "strand", "first", "len").agg(F.count("*").alias("reads"))
    near = sums.withColumn("offset", F.explode(F.sequence(low, high))).withColumn("start", F.col("first") + step * F.col("offset"))
    found = near.join(starts.select("chr", "strand", "start").distinct(), ["chr", "strand", "start"]).groupBy("len", "offset").agg(F.sum("reads").alias("n"))
    best = found.groupBy("len").agg(F.min_by("offset", F.struct(-F.col("n"), F.col("offset"))).alias("best"))
    return sums.select("len").distinct().join(best, "len", "left").select("len", F.coalesce("best", F.floor(F.col("len") / 2)).alias("offset"))


def rna_position(pos: Column, strand: Column, span: Column, length: Column, offset: Column, flip: bool = False) -> Column:
    """Genomic position of an RNA read without introns: `offset` from its 5' end, one further on the minus strand.

    With `flip` reads are of the opposite strand, as some library kits give them.
    """
    own = -strand if flip else strand
    return F.when(own == 1, pos + offset).otherwise(pos + span - offset + 0 * length)


def mean_pruned_length(reads: DataFrame, trim: int = 12) -> DataFrame:
    """One row: mean bases left of reads without `trim` bases at both ends, over reads that keep any (A5)."""
    left = F.col("len") - 2 * trim
    return reads.where(left > 0).agg(F.round(F.sum(left) / F.count("*"), 6).alias("mean_length"))


def site_coverage(reads: DataFrame, offsets: dict[int, int] | None = None) -> DataFrame:
    """P-site and A-site reads by position, by offsets of read lengths, half the length where none is known.

    `reads` has chr, strand, first (5' end) and len; the A-site lies three bases after the P-site.
    """
    known = F.create_map(*(F.lit(x) for pair in sorted((offsets or {-1: 0}).items()) for x in pair))
    step = F.when(F.col("strand") == 1, 1).otherwise(-1)
    offset = F.coalesce(F.try_element_at(known, F.col("len").cast("int")), F.floor(F.col("len") / 2))
    sums = reads.groupBy("chr", "strand", "first", "len").agg(F.count("*").alias("reads"))
    sites = sums.withColumn("site", F.explode(F.array(F.lit("P"), F.lit("A"))))
    place = F.col("first") + step * (offset + F.when(F.col("site") == "A", 3).otherwise(0))
    rows = sites.groupBy("chr", "strand", place.cast("long").alias("start")).agg(*(F.sum(F.when(F.col("site") == s, F.col("reads")).otherwise(0)).alias(n) for s, n in (("P", "p_reads"), ("A", "a_reads"))))
    return rows


def floss_classes(scores: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Good under the cutoff of the read number, else Extreme; Not in cutoff range; No reads (M2)."""
    rows = scores.join(cutoffs, "nreads", "left")
    kind = F.when(F.coalesce("nreads", F.lit(0)) == 0, "No reads").when(F.col("cutoff").isNull(), "Not in cutoff range")
    return rows.withColumn("class", kind.when(F.col("floss") < F.col("cutoff"), "Good").otherwise("Extreme"))


def floss_cutoff(windows: DataFrame, span: float = 0.75) -> DataFrame:
    """(nreads, cutoff): local regression of the windows' extremes on log10 of their mean reads, at every whole number of their range (M1).

    The numbers come from a range that Spark makes, and each reads its cell of the curve, so that nothing follows the range's
    length. Windows without reads take no part; without windows there are no cutoffs.
    """
    rows = staged(windows.where("mean_reads > 0").select(F.log10("mean_reads").alias("x"), F.col("extreme").alias("y"), "mean_reads"))  # read by each pass of the fit
    lo, hi = rows.agg(F.min("mean_reads"), F.max("mean_reads")).first()
    numbers = windows.sparkSession.range(math.ceil(lo) if lo else 0, math.floor(hi) + 1 if hi else 0)
    curve = local_regression(rows, span)
    return numbers.select(F.col("id").alias("nreads"), curve(F.log10(F.col("id").cast("double"))).alias("cutoff"))


def coherence(profiles: DataFrame, width: int = 30, step: int = 3) -> DataFrame:
    """Mean, median and largest coherence with the 4:1:1 codon pattern at a third of a cycle over sliding windows, and over the whole (M4, M5).

    `profiles` has transcript_id and profile, array<double> of counts by base. Spectra are smoothed by a (3, 3) Daniell window. Profiles
    under `width` bases have nulls. Phase is the frame with most reads.
    """
    schema = T.StructType([f for f in profiles.schema.fields if f.name == "transcript_id"] + [T.StructField(n, T.DoubleType()) for n in ("mean", "median", "most", "whole")] + [T.StructField("phase", T.IntegerType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        kernel = np.convolve([0.25, 0.5, 0.25], [0.25, 0.5, 0.25])

        def score(x):
            n = x.shape[1]
            ref = np.resize([4 / 6, 1 / 6, 1 / 6], n)
            a, b = np.fft.fft(x - x.mean(axis=1, keepdims=True), axis=1), np.fft.fft(ref - ref.mean())
            smooth = lambda z: sum(k * np.roll(z, s, axis=-1) for k, s in zip(kernel, range(-2, 3)))
            at = round(n / 3)
            cross, own, other = (smooth(z)[..., at] for z in (a * b.conj(), np.abs(a) ** 2, np.abs(b) ** 2))
            return np.where(own > 1e-12, np.abs(cross) ** 2 / np.maximum(own * other, 1e-300), 0.0)

        for batch in batches:
            out = []
            for p in map(_numbers, batch.column("profile")):
                x = np.array([] if p is None else p, "float64")
                if len(x) < width:
                    out.append((None, None, None, None, int(np.argmax([x[i::3].sum() for i in range(3)])) if len(x) else None))
                    continue
                windows = np.lib.stride_tricks.sliding_window_view(x, width)[::step]
                each = score(windows)
                whole = score(x[None, : len(x) // 3 * 3])[0]
                out.append((float(each.mean()), float(np.median(each)), float(each.max()), float(whole), int(np.argmax([x[i::3].sum() for i in range(3)]))))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column("transcript_id"), *(pa.array(c, pa.float64()) for c in cols[:4]), pa.array(cols[4], pa.int32())], names=schema.names)

    return profiles.select("transcript_id", "profile").mapInArrow(run, schema)


def _numbers(value):
    """The doubles of an array of a batch, None for null."""
    return value.values.to_numpy(zero_copy_only=False) if value.is_valid else None


def profiles(hits: DataFrame, sizes: DataFrame) -> DataFrame:
    """(transcript_id, profile): reads of every base of a transcript, zeros where none; as long as the transcript."""
    pairs = hits.groupBy("transcript_id").agg(F.collect_list(F.struct(F.col("cdna").cast("long").alias("i"), F.col("cnt").cast("double").alias("n"))).alias("p"))
    rows = sizes.join(pairs, "transcript_id").select("transcript_id", F.col("length").cast("long").alias("length"), F.col("p.i").alias("i"), F.col("p.n").alias("n"))
    schema = T.StructType([rows.schema["transcript_id"], T.StructField("profile", T.ArrayType(T.DoubleType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for length, i, n in zip(batch.column("length").to_pylist(), batch.column("i"), batch.column("n")):
                at, value = i.values.to_numpy(zero_copy_only=False), n.values.to_numpy(zero_copy_only=False)
                inside = (at >= 1) & (at <= length)
                out.append(np.bincount(at[inside] - 1, value[inside], length))
            ends = np.cumsum([0, *map(len, out)], dtype="int32")
            values = pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("transcript_id"), pa.ListArray.from_arrays(pa.array(ends), values)], names=schema.names)

    return rows.mapInArrow(run, schema)


def md_mismatches(df: DataFrame) -> DataFrame:
    """(chr, pos, ref, alt) of each mismatch that the MD tags of reads without insertions and deletions name; N is left out.

    `df` has chr, pos, cigar, md and seq. Read bases are counted over matched blocks; introns of the CIGAR move the place.
    """
    ops = cigar_ops()
    rows = df.where(~F.col("cigar").rlike("[ID]") & F.col("md").isNotNull()).withColumn("__ops", ops)
    clip = F.element_at("__ops", 1)
    rows = rows.withColumn("__clip", F.when(clip["op"] == "S", clip["n"]).otherwise(0))
    tokens = F.regexp_extract_all("md", F.lit(r"(\d+|[ACGTN])"), F.lit(1))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<at:int,ref:string>>)").alias("found"))

    def walk(acc, t):
        number = t.rlike(r"^\d+$")
        found = F.concat(acc["found"], F.array(F.struct(acc["at"].cast("int").alias("at"), t.alias("ref"))))
        return F.struct((acc["at"] + F.when(number, t.cast("int")).otherwise(1)).alias("at"), F.when(number, acc["found"]).otherwise(found).alias("found"))

    rows = rows.withColumn("__m", F.explode(F.aggregate(tokens, start, walk, lambda acc: acc["found"])))
    # introns before the base: those whose matched bases before them are at most its number
    blocks = F.aggregate(
        "__ops", F.struct(F.lit(0).alias("read"), F.lit(0).alias("skip")),
        lambda acc, x: F.struct(
            (acc["read"] + F.when(x["op"].isin("M", "=", "X"), x["n"]).otherwise(0)).alias("read"),
            (acc["skip"] + F.when((x["op"] == "N") & (acc["read"] <= F.col("__m.at")), x["n"]).otherwise(0)).alias("skip"),
        ), lambda acc: acc["skip"],
    )
    alt = F.substring("seq", F.col("__clip") + F.col("__m.at") + 1, F.lit(1))
    out = rows.select("chr", (F.col("pos") + F.col("__m.at") + blocks).cast("long").alias("pos"), F.col("__m.ref").alias("ref"), alt.alias("alt"))
    return out.where("ref <> 'N' and alt <> 'N' and alt <> ref")


def allele_frequency(reads: DataFrame, mismatches: DataFrame) -> DataFrame:
    """Depth and share of each mismatch from the reads that cover its place (F30). Equal alignments are counted first.

    `reads` has chr, pos and cigar; only matched blocks cover.
    """
    same = reads.groupBy("chr", "pos", "cigar").agg(F.count("*").alias("n")).withColumn("__ops", cigar_ops())
    start = F.struct(F.col("pos").cast("long").alias("at"), F.expr("cast(array() as array<struct<a:bigint,z:bigint>>)").alias("b"))

    def walk(acc, x):
        body = x["op"].isin("M", "=", "X")
        block = F.concat(acc["b"], F.array(F.struct(acc["at"].alias("a"), (acc["at"] + x["n"] - 1).alias("z"))))
        return F.struct((acc["at"] + F.when(body | x["op"].isin("N", "D"), x["n"]).otherwise(0)).alias("at"), F.when(body, block).otherwise(acc["b"]).alias("b"))

    blocks = same.withColumn("x", F.explode(F.aggregate("__ops", start, walk, lambda acc: acc["b"]))).select("chr", "n", F.col("x.a").alias("block_start"), F.col("x.z").alias("block_end"))
    from ribolith.operators.intervals import points_in

    seen = mismatches.groupBy("chr", "pos", "ref", "alt").agg(F.count("*").alias("alts"))
    places = seen.select("chr", "pos").distinct()
    depth = points_in(places, blocks, "pos", "block_start", "block_end", keys=("chr",)).groupBy("chr", "pos").agg(F.sum("n").alias("dp"))
    return seen.join(depth, ["chr", "pos"]).withColumn("af", F.round(F.col("alts") / F.col("dp"), 6))


def read_ends(alignments: DataFrame) -> DataFrame:
    """Alignments (chr, flag, pos, cigar) as reads with strand, first (5' end) and len (matched and inserted bases)."""
    rows = alignments.withColumn("strand", strand_of()).withColumn("__ops", cigar_ops())
    total = lambda kinds: F.aggregate(F.filter("__ops", lambda x: x["op"].isin(*kinds)), F.lit(0), lambda acc, x: acc + x["n"])
    first = F.when(F.col("strand") == 1, F.col("pos")).otherwise(F.col("pos") + total("MDN=X") - 1)
    return rows.withColumn("first", first.cast("long")).withColumn("len", total("MI=X")).drop("__ops")


def reference_distribution(psite_hits: DataFrame) -> DataFrame:
    """Mean over transcripts of their shares of each read length, lengths without reads as zero."""
    sums = psite_hits.groupBy("transcript_id", "rpf").agg(F.sum("cnt").alias("n"))
    share = sums.withColumn("f", F.col("n") / F.sum("n").over(Window.partitionBy("transcript_id")))
    count = sums.select("transcript_id").distinct().agg(F.count("*").alias("t"))
    return share.groupBy("rpf").agg(F.sum("f").alias("f")).crossJoin(F.broadcast(count)).select("rpf", F.round(F.col("f") / F.col("t"), 6).alias("ref"))


def library_normalize(tracks: DataFrame) -> DataFrame:
    """Counts of samples divided by their library size over the smallest one."""
    sizes = tracks.groupBy("sample").agg(F.sum("cnt").alias("size"))
    factor = sizes.crossJoin(sizes.agg(F.min("size").alias("least"))).select("sample", (F.col("size") / F.col("least")).alias("factor"))
    return tracks.join(F.broadcast(factor), "sample").withColumn("normalized", F.round(F.col("cnt") / F.col("factor"), 6)).drop("factor")


def sample_counts(hits: DataFrame, samples: list[str]) -> DataFrame:
    """Reads of each transcript side by side for the samples."""
    return hits.groupBy("transcript_id").agg(*(F.sum(F.when(F.col("sample") == s, F.col("cnt")).otherwise(0)).alias(s) for s in samples))
