"""Mass-spectrometry identifications: filters, groups, scores and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.functions.sequence import combine_bits
from ribolith.operators.ranges import running


def significant(df: DataFrame, q: float = 0.05, pep: float = 0.05) -> DataFrame:
    """Rows under both thresholds (P10)."""
    return df.where((F.col("q") < q) & (F.col("pep") < pep))


def source_counts(psms: DataFrame, sources: DataFrame) -> DataFrame:
    """Groups by the ordered union of their proteins' sources."""
    label = F.array_join(F.array_sort(F.collect_set("source")), "+")
    each = psms.join(sources, "protein_id").groupBy("group_id").agg(label.alias("sources"))
    return each.groupBy("sources").agg(F.count("*").alias("n"))


def bincode_counts(psms: DataFrame, sources: DataFrame, width: int = 3) -> DataFrame:
    """Groups by the union of their proteins' bincodes."""
    each = psms.join(sources, "protein_id").groupBy("group_id").agg(combine_bits(F.col("bincode"), width).alias("bincode"))
    return each.groupBy("bincode").agg(F.count("*").alias("n"))


def leading_proteins(psms: DataFrame) -> DataFrame:
    """Each group's proteins tied for most distinct peptides."""
    n = psms.groupBy("group_id", "protein_id").agg(F.countDistinct("peptide").alias("peptides"))
    top = F.max("peptides").over(Window.partitionBy("group_id"))
    return n.withColumn("top", top).where("peptides = top").drop("top")


def without_subsets(df: DataFrame, group: str = "protein_id", item: str = "peptide") -> DataFrame:
    """Groups whose item set is not inside another's; of equal sets the smallest group stays.

    Equal sets, told by their size and two sums of hashes of 64 bits, are one group from the start. Sets of one item go where a larger
    one holds it. Of the others each meets the groups that hold its rarest item, as a set that holds another holds that item too.
    """
    pairs = df.select(group, item).distinct()
    total = lambda *seed: F.sum(F.xxhash64(*seed, item).cast("decimal(38,0)"))
    sets = pairs.groupBy(group).agg(F.count("*").alias("n"), total().alias("h1"), total(F.lit(7)).alias("h2"))
    size = sets.groupBy("n", "h1", "h2").agg(F.min(group).alias(group)).select(group, "n")
    pairs = pairs.join(size, group)
    several = pairs.where("n > 1").select(group, item, "n")
    inside = pairs.where("n = 1").join(several.select(item).distinct(), item, "left_semi").select(group)
    common = several.groupBy(item).agg(F.count("*").alias("m"))
    rarest = several.join(common, item).groupBy(group).agg(F.min_by(F.struct(item, "n"), F.struct("m", item)).alias("r")).select(F.col(group).alias("a"), F.col("r.n").alias("na"), f"r.{item}")
    meant = rarest.join(several.select(F.col(group).alias("b"), item, F.col("n").alias("nb")), item).where("a <> b and na < nb").select("a", "b", "na")
    a, b = several.select(F.col(group).alias("a"), item), several.select(F.col(group).alias("b"), item)
    shared = meant.join(a, "a").join(b, ["b", item]).groupBy("a", "b", "na").agg(F.count("*").alias("both"))
    lost = shared.where("both = na").select(F.col("a").alias(group)).unionByName(inside).distinct()
    return size.join(lost, group, "left_anti")


def posterior(df: DataFrame, score: str = "score", coding: str = "coding") -> DataFrame:
    """Share of coding rows among those with at least a score, by distinct score."""
    by = df.groupBy(score).agg(F.count_if(coding).alias("c"), F.count("*").alias("n"))
    above = running(by, score, {"cs": F.col("c"), "ns": F.col("n")}, ascending=False)
    return above.select(score, ((F.col("cs") + F.col("c")) / (F.col("ns") + F.col("n"))).alias("posterior"))


def auc(df: DataFrame, score: str = "score", positive: str = "positive") -> DataFrame:
    """Area under the ROC curve from rank sums; ties share their mean rank."""
    by = df.groupBy(score).agg(F.count_if(positive).alias("p"), F.count("*").alias("n"))
    ranked = running(by, score, {"before": F.col("n")}).withColumn("rank", F.col("before") + (F.col("n") + 1) / 2)
    sums = ranked.agg(F.sum("p").alias("np"), F.sum(F.col("n") - F.col("p")).alias("nn"), F.sum(F.col("p") * F.col("rank")).alias("s"))
    return sums.select(F.round((F.col("s") - F.col("np") * (F.col("np") + 1) / 2) / (F.col("np") * F.col("nn")), 6).alias("auc"))


def threshold(df: DataFrame, fdr: float = 0.05, score: str = "score") -> DataFrame:
    """The exact (1 - fdr) quantile of the scores."""
    return df.agg(F.round(F.percentile(score, 1 - fdr), 6).alias("threshold"))


def extrapolate_q(df: DataFrame, low: float = 1e-4, high: float = 1e-2) -> DataFrame:
    """q below `low` replaced by a line through log10 q over score between the bounds."""
    fit = df.where((F.col("q") > low) & (F.col("q") < high)).agg(F.regr_slope(F.log10("q"), "score").alias("m"), F.regr_intercept(F.log10("q"), "score").alias("c"))
    line = F.pow(F.lit(10.0), F.col("m") * F.col("score") + F.col("c"))
    return df.crossJoin(F.broadcast(fit)).withColumn("q_fit", F.when(F.col("q") < low, line).otherwise(F.col("q"))).drop("m", "c")


def gain_loss(a: DataFrame, b: DataFrame, thresholds: list[float], key: str = "id") -> DataFrame:
    """Identified by both, by the first or by the second alone, at each threshold."""
    both = a.select(key, F.col("q").alias("qa")).join(b.select(key, F.col("q").alias("qb")), key, "full")
    rows = both.withColumn("t", F.explode(F.array(*map(F.lit, thresholds))))
    in_a, in_b = F.coalesce(F.col("qa") < F.col("t"), F.lit(False)), F.coalesce(F.col("qb") < F.col("t"), F.lit(False))
    return rows.groupBy("t").agg(F.count_if(in_a & in_b).alias("kept"), F.count_if(in_a & ~in_b).alias("lost"), F.count_if(~in_a & in_b).alias("gained"))


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Groups of `a` with the smallest group of `b` that shares a peptide and a protein with it."""
    left = a.select("group_id", "peptide", "protein_id").distinct()
    right = b.select(F.col("group_id").alias("other"), "peptide", "protein_id").distinct()
    return left.join(right, ["peptide", "protein_id"]).groupBy("group_id").agg(F.min("other").alias("other"))


def histogram(df: DataFrame, feature: str, size: float) -> DataFrame:
    """Rows by bin of a feature and label."""
    return df.groupBy(F.floor(F.col(feature) / size).cast("long").alias("bin"), "label").agg(F.count("*").alias("n"))


def medians(df: DataFrame, by: str, value: str) -> DataFrame:
    """Exact median of a value by group."""
    return df.groupBy(by).agg(F.round(F.percentile(value, 0.5), 6).alias("median"))
