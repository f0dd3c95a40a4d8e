"""Calls of external ORF finders: their locations, their p-values, and the features of the frames they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ribolith.functions.sequence import NEAR_COGNATE, translated
from ribolith.operators.intervals import points_in

_LOCATION = r"^(.+)([+-]):(\d+-\d+(?:\|\d+-\d+)*)$"


def parse_location(location: Column) -> Column:
    """A location `chr±:a-b|c-d`, zero-based and half-open, as struct(chr, strand, parts: array of struct(start, end)), one-based and closed; null for other text.

    Parts keep the order of the text, which is that of the chromosome.
    """
    one = lambda i: F.regexp_extract(location, _LOCATION, i)
    ends = lambda p: F.split(p, "-")
    parts = F.transform(F.split(one(3), r"\|"), lambda p: F.struct((F.element_at(ends(p), 1).cast("long") + 1).alias("start"), F.element_at(ends(p), 2).cast("long").alias("end")))
    return F.when(location.rlike(_LOCATION), F.struct(one(1).alias("chr"), F.when(one(2) == "+", 1).otherwise(-1).alias("strand"), parts.alias("parts")))


def join_calls(found: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, rejected) of all frames `found` (orf_id, location, prior_location, start_codon, caller_annotation) and those `kept` (prior_location, pvalue).

    Calls: a row for each frame that is kept, with transcript (its id without the last two parts), chr, strand, parts and pvalue. Of p-values that
    repeat a prior location the least counts. Rejected: `kept` rows of which no frame is known (`unknown`) or that have no p-value (`pvalue`), and frames with
    another form of location or with a part that has no base (`location`).
    """
    good = kept.where("pvalue is not null").groupBy("prior_location").agg(F.min("pvalue").alias("pvalue"))
    rows = found.join(good, "prior_location").withColumn("l", parse_location(F.col("location")))
    whole = F.col("l").isNotNull() & F.forall("l.parts", lambda p: p["start"] <= p["end"])
    whole = F.coalesce(whole, F.lit(False))
    calls = rows.where(whole).select(
        "orf_id", F.regexp_extract("orf_id", r"^(.*)_[^_]*_[^_]*$", 1).alias("transcript"), "l.chr", "l.strand", "l.parts", "start_codon", "caller_annotation", "pvalue",
    )
    lost = rows.where(~whole).select("prior_location", "location", F.lit("location").alias("reason"))
    none = F.lit(None).cast("string").alias("location")
    unknown = good.join(found, "prior_location", "left_anti").select("prior_location", none, F.lit("unknown").alias("reason"))
    blank = kept.where("pvalue is null").select("prior_location", none, F.lit("pvalue").alias("reason"))
    return calls, lost.unionByName(unknown).unionByName(blank)


def frame_ends(strand: str = "strand", parts: str = "parts") -> dict[str, Column]:
    """start and stop of a frame by its strand, and its parts' starts and ends as text."""
    first, last = F.element_at(parts, 1), F.element_at(parts, -1)
    plus = F.col(strand) == 1
    text = lambda name: F.array_join(F.transform(parts, lambda p: p[name].cast("string")), "_")
    return {"start": F.when(plus, first["start"]).otherwise(last["end"]), "stop": F.when(plus, last["end"]).otherwise(first["start"]), "starts": text("start"), "ends": text("end")}


def annotation(start: str = "start", atis: str = "atis", stop: str = "cds_stop", strand: str = "strand") -> Column:
    """aTIS, 5UTR, CDS, 3UTR by the annotated start and stop, or ntr without them (M7)."""
    by = F.when(F.col(strand) == 1, 1).otherwise(-1)
    from_start, from_stop = (F.col(start) - F.col(atis)) * by, (F.col(stop) - F.col(start)) * by
    return F.when(F.col(atis).isNull(), "ntr").when(from_start == 0, "aTIS").when(from_start < 0, "5UTR").when(from_stop >= 0, "CDS").otherwise("3UTR")


def distances(calls: DataFrame, exons: DataFrame, sites: DataFrame) -> DataFrame:
    """`calls` with atis, cds_stop, dist_to_transcript_start (from 1) and dist_to_atis in transcript coordinates (M7).

    `exons` has transcript, exon_start, exon_end, cdna_start; `sites` transcript, atis, cds_stop. A place that stands in no exon of the
    transcript gives null. Transcripts without sites have null in all but the first distance.
    """
    out = calls.join(sites, "transcript", "left")
    spans = exons.select("transcript", "exon_start", "exon_end", "cdna_start")
    for place, name in (("start", "cdna_of_start"), ("atis", "cdna_of_atis")):
        wanted = out.select("orf_id", "transcript", "strand", F.col(place).alias("__p")).where("__p is not null")
        met = wanted.join(spans, "transcript").where("__p between exon_start and exon_end")
        at = F.col("cdna_start") + F.when(F.col("strand") == 1, F.col("__p") - F.col("exon_start")).otherwise(F.col("exon_end") - F.col("__p"))
        out = out.join(met.groupBy("orf_id").agg(F.min(at).alias(name)), "orf_id", "left")
    return out.withColumn("dist_to_transcript_start", F.col("cdna_of_start")).withColumn("dist_to_atis", F.col("cdna_of_start") - F.col("cdna_of_atis")).drop("cdna_of_start", "cdna_of_atis")


def coverage(calls: DataFrame, points: DataFrame, depth: int) -> DataFrame:
    """orf_id, count, coverage (share of bases with reads) and fpkm of frames (orf_id, chr, strand, parts) (M7).

    `points` (chr, strand, start, cnt) has a row for each position, `depth` is the number of all reads. Frames without reads have zeros.
    """
    parts = calls.select("orf_id", "chr", "strand", F.explode("parts").alias("p")).select("orf_id", "chr", "strand", F.col("p.start").alias("a"), F.col("p.end").alias("z"))
    bases = calls.select("orf_id", F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["end"] - p["start"] + 1).alias("bases"))
    hit = points_in(points, parts, "start", "a", "z").groupBy("orf_id").agg(F.sum("cnt").alias("count"), F.count("*").alias("covered"))
    out = bases.join(hit, "orf_id", "left").select("orf_id", "bases", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("covered", F.lit(0)).alias("covered"))
    fpkm = F.col("count") / (F.lit(depth) / 1e6) / (F.col("bases") / 1000) if depth else F.lit(0.0)
    return out.select("orf_id", "count", F.round(F.col("covered") / F.col("bases"), 6).alias("coverage"), F.round(fpkm, 6).alias("fpkm"))


def checked(calls: DataFrame, sequences: DataFrame) -> DataFrame:
    """`calls` with seq, aa and status of their sequence (orf_id, seq): Unmatching_start_codon, no_stop, early_stop or ok (M7).

    The protein starts with M where the start codon is ATG or one base off. Frames without a sequence have the status no_sequence.
    """
    return with_status(calls.join(sequences.select("orf_id", "seq"), "orf_id", "left"))


def with_status(rows: DataFrame) -> DataFrame:
    """Rows (start_codon, seq, …) with aa and status as in `checked`, for calls that bring their sequence."""
    rows = rows.withColumn("aa", translated(F.col("seq")))
    stop = F.instr("aa", "*")
    status = (
        F.when(F.col("seq").isNull(), "no_sequence").when(F.substring("seq", 1, 3) != F.coalesce("start_codon", F.lit("")), "Unmatching_start_codon")
        .when(stop == 0, "no_stop").when(stop < F.length("aa"), "early_stop").otherwise("ok")
    )
    near = F.substring("seq", 1, 3).rlike(NEAR_COGNATE)
    return rows.withColumn("status", status).withColumn("aa", F.when(near, F.concat(F.lit("M"), F.substring("aa", F.lit(2), F.length("aa")))).otherwise(F.col("aa")))


def score_annotation(calls: DataFrame, exons: DataFrame, sites: DataFrame, points: DataFrame, depth: int) -> DataFrame:
    """The features of accepted calls: ends, distances, annotation, reads (M7).

    Calls have distinct orf_ids. Callers that give a posterior are cut by it before: `calls.where("posterior > …")`, which leaves out nulls.
    """
    ends = frame_ends()
    rows = calls.select("*", *(c.alias(n) for n, c in ends.items()))
    rows = distances(rows, exons, sites).withColumn("annotation", annotation())
    return rows.join(coverage(calls, points, depth), "orf_id")


def by_posterior(scored: DataFrame, threshold: float) -> DataFrame:
    """Rows (orf_id, chr, sign, coordinates `a-b,c-d` one-based, posterior) over the threshold, with strand and parts (M7).

    Rows without a posterior, and with a sign other than + and -, go.
    """
    ends = lambda p: F.split(p, "-")
    parts = F.transform(F.split("coordinates", ","), lambda p: F.struct(F.element_at(ends(p), 1).cast("long").alias("start"), F.element_at(ends(p), 2).cast("long").alias("end")))
    kept = scored.where((F.col("posterior") > threshold) & F.col("sign").isin("+", "-") & F.col("coordinates").rlike(r"^\d+-\d+(,\d+-\d+)*$"))
    return kept.withColumn("strand", F.when(F.col("sign") == "+", 1).otherwise(-1)).withColumn("parts", F.array_sort(parts))
