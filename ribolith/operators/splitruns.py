"""Runs over parts of a genome whose results are put together later: mergeable states and what follows from them.

A state is a table (kind, key, a, b) of sums over any rows: exact histograms of scores (`score`: rows by score, translated in `a`,
others in `b`), sums of fragment-length shares (`length`: `a` sums of shares by length) and the number of profiles (`profiles`, `a`). States of
parts add up to that of the whole, so each part is written once and merged with others in any grouping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.operators.ranges import running

#: Fragment lengths of the reference distribution.
LENGTHS = (24, 36)


def run_state(transcripts: DataFrame, lengths: DataFrame, expressed: float = 3.0) -> DataFrame:
    """The state of one part: `transcripts` (transcript_id, fpkm, score) and `lengths` (transcript_id, rpf, fraction) (M8).

    Translated rows have an fpkm of at least `expressed`. Rows without a score or an fpkm are not in its histogram, fractions that are null, and lengths outside the
    reference's range, not in the sums.
    """
    known = transcripts.where("score is not null and fpkm is not null and not isnan(score)")
    high = F.col("fpkm") >= expressed
    scores = known.groupBy(F.col("score").cast("double").alias("key")).agg(F.count_if(high).cast("double").alias("a"), F.count_if(~high).cast("double").alias("b"))
    inside = lengths.where(F.col("fraction").isNotNull())
    sums = inside.where(F.col("rpf").between(*LENGTHS)).groupBy(F.col("rpf").cast("double").alias("key")).agg(F.sum("fraction").alias("a"))
    profiles = inside.select("transcript_id").distinct().agg(F.count("*").cast("double").alias("a"))
    kind = lambda df, name: df.select(F.lit(name).alias("kind"), *((F.col(c) if c in df.columns else F.lit(0.0)).alias(c) for c in ("key", "a", "b")))
    return kind(scores, "score").unionByName(kind(sums, "length")).unionByName(kind(profiles, "profiles"))


def write_state(state: DataFrame, folder: str, run: str) -> None:
    """Writes the state of `run` beside those of other runs; a run that is repeated replaces its own state alone."""
    out = state.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("run").parquet(folder)


def merge_states(states: DataFrame) -> DataFrame:
    """The state of all parts together."""
    return states.groupBy("kind", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def reference_lengths(state: DataFrame) -> DataFrame:
    """rpf, ref: mean share of each fragment length over the profiles; one row for each length of the reference's range, zero where none has it."""
    span = state.sparkSession.range(LENGTHS[0], LENGTHS[1] + 1).select(F.col("id").cast("int").alias("rpf"))
    sums = state.where("kind = 'length'").select(F.col("key").cast("int").alias("rpf"), "a")
    n = state.where("kind = 'profiles'").agg(F.coalesce(F.sum("a"), F.lit(0.0)).alias("n"))
    rows = span.join(sums, "rpf", "left").crossJoin(F.broadcast(n))
    return rows.select("rpf", F.when(F.col("n") > 0, F.coalesce("a", F.lit(0.0)) / F.col("n")).otherwise(0.0).alias("ref"))


def score_posteriors(state: DataFrame) -> DataFrame:
    """score, posterior: share of translated rows among those with at least the score, by distinct score; 0 for a score of 0, 1 above the highest translated one."""
    rows = state.where("kind = 'score'").select(F.col("key").alias("score"), "a", (F.col("a") + F.col("b")).alias("n"))
    above = running(rows, "score", {"ta": F.col("a"), "tn": F.col("n")}, ascending=False)
    top = rows.where("a > 0").agg(F.max("score").alias("top"))
    share = (F.col("ta") + F.col("a")) / (F.col("tn") + F.col("n"))
    above = above.crossJoin(F.broadcast(top))
    return above.select("score", F.when(F.col("score") == 0, 0.0).when(F.coalesce(F.col("score") > F.col("top"), F.lit(True)), 1.0).otherwise(share).alias("posterior"))


def summary(state: DataFrame, fdr: float = 0.05) -> DataFrame:
    """One row: translated and other rows, the threshold (quantile 1 - fdr of the others' scores, between its two neighbours) and the ROC area.

    Both come from the histogram by running counts, so that no task sees all scores; the neighbours are found by their place.
    """
    rows = state.where("kind = 'score'").select(F.col("key").alias("score"), "a", "b")
    ranked = running(rows, "score", {"na": F.col("a"), "nb": F.col("b")})
    totals = rows.agg(F.coalesce(F.sum("a"), F.lit(0.0)).alias("translated"), F.coalesce(F.sum("b"), F.lit(0.0)).alias("other"))
    ranked = ranked.crossJoin(F.broadcast(totals))
    place = (F.col("other") - 1) * (1 - fdr)
    at = lambda p: F.max(F.when((F.col("nb") <= p) & (p < F.col("nb") + F.col("b")), F.col("score")))
    out = ranked.agg(
        F.max("translated").cast("long").alias("translated"), F.max("other").cast("long").alias("other"), at(F.floor(place)).alias("lo"), at(F.ceil(place)).alias("hi"),
        F.max(place - F.floor(place)).alias("part"), F.sum(F.col("a") * (F.col("nb") + F.col("b") / 2)).alias("wins"),
    )
    return out.select(
        F.coalesce("translated", F.lit(0)).alias("translated"), F.coalesce("other", F.lit(0)).alias("other"), F.round(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part"), 6).alias("threshold"),
        F.when(F.col("translated") * F.col("other") > 0, F.round(F.col("wins") / (F.col("translated") * F.col("other")), 6)).alias("auc"),
    )


def full_floss(lengths: DataFrame, reference: DataFrame) -> DataFrame:
    """transcript_id, floss: half the summed distance of the shares of fragment lengths to the reference's, over all lengths of the reference (A23, full range).

    A length that a transcript lacks counts with the reference's share; lengths outside the reference do not count. The distance is the reference's whole sum and,
    for each length that there is, what it differs from that, so no transcript is expanded to all lengths.
    """
    own = lengths.where(F.col("fraction").isNotNull()).groupBy("transcript_id", "rpf").agg(F.sum("fraction").alias("fraction"))
    whole = reference.agg(F.sum(F.abs("ref")).alias("whole"))
    met = own.join(F.broadcast(reference), "rpf", "left")  # a row for each length of the range
    gap = F.when(F.col("ref").isNotNull(), F.abs(F.col("fraction") - F.col("ref")) - F.abs("ref")).otherwise(0.0)
    sums = met.groupBy("transcript_id").agg(F.sum(gap).alias("gap"), F.sum("fraction").alias("all")).crossJoin(F.broadcast(whole))
    return sums.where("all > 0").select("transcript_id", F.round((F.col("whole") + F.col("gap")) / 2, 6).alias("floss"))


def scored(transcripts: DataFrame, lengths: DataFrame, state: DataFrame) -> DataFrame:
    """transcript_id, posterior, floss of each transcript under the state of all runs; null where it has no score or no profile."""
    rows = transcripts.select("transcript_id", "score").join(score_posteriors(state), "score", "left")
    return rows.join(full_floss(lengths, reference_lengths(state)), "transcript_id", "left").select("transcript_id", F.round("posterior", 6).alias("posterior"), "floss")
