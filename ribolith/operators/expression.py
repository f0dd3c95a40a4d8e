"""Statistics of mapping, expressed transcripts, callers' transcript tables, and reference distributions of coding transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ribolith.operators.intervals import covers, overlaps, totals_in

#: Bits of a read's flag: unmapped, and lines that are not its first.
UNMAPPED, FURTHER = 4, 256 | 2048


def read_statistics(alignments: DataFrame, split: Column | bool = True) -> DataFrame:
    """Per sample and type of reference: all, unique, multiple, mapped and unmapped reads, and their shares of all.

    `alignments` has sample, type, flag and nh; a read counts by its first line. A read is unmapped by its flag, else unique or multiple by
    nh; a mapped read without nh is unique. Where `split` does not hold, unique and multiple reads are not told apart.
    """
    first = alignments.where(F.col("flag").bitwiseAND(FURTHER) == 0)
    away = F.col("flag").bitwiseAND(UNMAPPED) != 0
    many = F.coalesce(F.col("nh") > 1, F.lit(False))
    out = first.groupBy("sample", "type").agg(F.count("*").alias("total"), F.count_if(~away & ~many).alias("u"), F.count_if(~away & many).alias("m"), F.count_if(away).alias("unmapped"))
    told = split if isinstance(split, Column) else F.lit(split)
    share = lambda c: F.round(c / F.col("total"), 5)
    u, m, t = F.when(told, F.col("u")), F.when(told, F.col("m")), F.col("u") + F.col("m")
    return out.select("sample", "type", "total", u.alias("mapped_u"), m.alias("mapped_m"), t.alias("mapped_t"), "unmapped", share(u).alias("freq_u"), share(m).alias("freq_m"), share(t).alias("freq_t"))


def expressed(counts: DataFrame, *columns: str) -> DataFrame:
    """Transcripts of which the sum of the named counts, nulls as none, is over zero, with it as `total`."""
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    return counts.withColumn("total", total).where("total > 0")


def expressed_by_both(quantified: DataFrame, ambiguous: DataFrame, key: str = "transcript") -> DataFrame:
    """Transcripts with unique or ambiguous reads, the two tables joined by name."""
    return expressed(quantified.join(ambiguous, key), "UniqueCount", "AmbigCount")


def covered_sites(sites: DataFrame, least: int = 10) -> DataFrame:
    """Methylation sites (chr, site, methylated, coverage) read at least `least` times, as positions with counts."""
    return sites.where(F.col("coverage") >= least).select("chr", F.col("site").alias("start"), F.col("methylated").alias("cnt"))


def methylation(sites: DataFrame, features: DataFrame) -> DataFrame:
    """Sum and number of covered sites (chr, start, cnt) in each feature, whatever its strand; features without any go.

    Sums are of decimals with twelve places, so that they do not depend on the order of sites.
    """
    value = F.col("cnt").cast("decimal(18,12)")
    values = {"methylated": F.coalesce(value, F.lit(0).cast("decimal(18,12)")), "known": F.col("cnt").isNotNull().cast("long"), "sites": F.lit(1)}
    sums = totals_in(sites, features, "start", "feature_start", "feature_end", values, ["feature_id"], keys=("chr",)).where("sites > 0")
    return sums.select("feature_id", F.when(F.col("known") > 0, F.round(F.col("methylated").cast("double"), 4)).alias("methylated"), "sites")


def ingest_isoforms(isoforms: DataFrame, transcripts: DataFrame, genes: DataFrame) -> DataFrame:
    """Expressed isoforms of a caller as transcript calls (M9).

    `isoforms` has gene, transcript, sign, ccds_status, ccds, type, length, fpkm and reads; `transcripts` transcript, transcript_id, chr, start, end;
    `genes` gene and canonical (a transcript_id). Unknown transcripts and other signs than + and - go. A consensus id counts where the status
    is Yes. The normalised count is reads by base, null without a length.
    """
    rows = isoforms.where(F.col("sign").isin("+", "-")).join(transcripts, "transcript").join(genes, "gene", "left")
    return rows.select(
        "transcript_id", "transcript", "chr", F.when(F.col("sign") == "+", 1).otherwise(-1).alias("strand"), "start", "end", "reads",
        F.round(F.col("reads") / F.nullif(F.col("length"), F.lit(0)), 6).alias("normalized"), F.col("type").alias("biotype"), F.lit("NA").alias("exon_coverage"),
        F.when(F.coalesce(F.col("canonical") == F.col("transcript_id"), F.lit(False)), "Yes").otherwise("No").alias("canonical"),
        F.when((F.col("ccds_status") == "Yes") & F.col("ccds").isNotNull(), F.col("ccds")).otherwise("No").alias("ccds"), "gene", "fpkm",
    )


def reference_of_coding(psite: DataFrame, genes: DataFrame, noncoding: DataFrame, exons: DataFrame, lengths: tuple[int, int] = (26, 34)) -> DataFrame:
    """rpf, ref: shares of fragment lengths over the coding exons of canonical transcripts of genes that no non-coding transcript overlaps.

    `genes` has gene_id, chr, gene_start and gene_end of the coding ones; `noncoding` nc_id, chr, gene_start and gene_end, whatever the strand; `exons`
    gene_id, chr, strand, exon_start and exon_end of the coding part of each canonical transcript.
    """
    hit = overlaps(genes, noncoding, "gene_id", "nc_id", "gene_start", "gene_end", keys=("chr",)).select("gene_id").distinct()
    clean = exons.join(hit, "gene_id", "left_anti").join(genes.select("gene_id").distinct(), "gene_id", "left_semi")
    reads = covers(psite.where(F.col("rpf").between(*lengths)), clean, "start", "exon_start", "exon_end", {"held": F.lit(1)}).where("held > 0")
    sums = reads.groupBy("rpf").agg(F.sum(F.col("cnt") * F.col("held")).alias("reads"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("reads").alias("all")))).select("rpf", F.round(F.col("reads") / F.col("all"), 6).alias("ref"))


def psm_parts(engine: str, psm_id: Column) -> Column:
    """struct(raw_file, scan, sequence, charge, event) of an engine's PSM id, null where it has too few parts.

    `dot`: raw.scan.… ; `dash`: raw-raw-scan-sequence-charge-event.
    """
    get = lambda parts, i: F.get(parts, F.lit(i))
    none = F.lit(None).cast("string")
    if engine == "dot":
        p = F.split(psm_id, r"\.")
        fields, least = (get(p, 0), get(p, 1), none, none, none), 2
    elif engine == "dash":
        p = F.split(psm_id, "-")
        fields, least = (F.concat_ws("-", get(p, 0), get(p, 1)), get(p, 2), get(p, 3), get(p, 4), get(p, 5)), 6
    else:
        raise ValueError(f"no such form of PSM ids: {engine}")
    return F.when(F.size(p) >= least, F.struct(*(f.alias(n) for f, n in zip(fields, ("raw_file", "scan", "sequence", "charge", "event")))))


def plain_peptide(peptide: Column) -> Column:
    """A peptide without marks of modifications: underscores, dots, (ox) and (ac); oxidised m as M."""
    return F.replace(F.regexp_replace(peptide, r"\(ox\)|\(ac\)|[_.]", ""), F.lit("m"), F.lit("M"))


def common_id(raw_file: Column, scan: Column, peptide: Column, charge: Column) -> Column:
    """raw-scan-peptide-charge, under which the engines' PSMs meet."""
    return F.concat(raw_file, F.lit("-"), scan, F.lit("-"), plain_peptide(peptide), F.lit("-"), charge)
