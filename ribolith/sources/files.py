"""Readers and writers of the file formats around position counts, gene models, sequences and identifications."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ribolith.operators.orfcalls import join_calls
from ribolith.operators.ranges import running


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below `spark.checkpoint.dir`, which driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """SAM text without header lines: the eleven fixed fields and the tags NH, HI and MD."""
    parts = F.split("value", "\t")
    tags = F.slice(parts, 12, F.greatest(F.size(parts) - 11, F.lit(1)))
    tag = lambda name, kind: F.try_element_at(F.filter(tags, lambda t: t.startswith(f"{name}:{kind}:")), F.lit(1))
    field = lambda i: F.element_at(parts, i)
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(parts) >= 11))
    return rows.select(
        field(1).alias("qname"), field(2).cast("int").alias("flag"), field(3).alias("chr"), field(4).cast("long").alias("pos"),
        field(5).cast("int").alias("mapq"), field(6).alias("cigar"), field(10).alias("seq"),
        F.substring(tag("NH", "i"), 6, 20).cast("int").alias("nh"), F.substring(tag("HI", "i"), 6, 20).cast("int").alias("hi"),
        F.regexp_replace(tag("MD", "Z"), "^MD:Z:", "").alias("md"),
    )


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """accession, description, seq of FASTA records over any number of lines; a record is a row, so files stay splittable."""
    rows = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", "^>", "").alias("r")).where("length(trim(r)) > 0")
    head = F.regexp_extract("r", r"^([^\r\n]*)", 1)
    return rows.select(
        F.regexp_extract(head, r"^(\S+)", 1).alias("accession"), F.trim(F.regexp_extract(head, r"^\S+\s*(.*)$", 1)).alias("description"),
        F.regexp_replace(F.regexp_replace("r", r"^[^\n]*(\n|$)", ""), r"\s", "").alias("seq"),
    )


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows of a GTF file with gene_id, transcript_id and gene_name from the attributes (S3)."""
    names = "chr string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"
    rows = spark.read.csv(path, sep="\t", comment="#", schema=names, quote="")
    own = lambda k: F.nullif(F.regexp_extract("attributes", rf'(?:^|;\s*){k} "?([^";]+)"?', 1), F.lit("")).alias(k)
    return rows.select("chr", "feature", "start", "end", F.when(F.col("strand") == "-", -1).otherwise(1).alias("strand"), *map(own, ("gene_id", "transcript_id", "gene_name")))


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """chr, pos, ref, alt of a VCF file."""
    rows = spark.read.csv(path, sep="\t", comment="#", quote="", schema="chr string, pos long, id string, ref string, alt string")
    return rows.select("chr", "pos", "ref", "alt")


def read_identifications(spark: SparkSession, path: str, drop_contaminants: bool = True) -> DataFrame:
    """A tab-separated table addressed by its header, without reversed hits and contaminants."""
    rows = spark.read.csv(path, sep="\t", header=True)
    for name in ("Reverse", *(["Potential contaminant"] if drop_contaminants else [])):
        if name in rows.columns:
            rows = rows.where(F.coalesce(F.col(f"`{name}`"), F.lit("")) != "+")
    return rows


def read_expression(spark: SparkSession, path: str) -> DataFrame:
    """Isoform expression: rows whose tracking id is not the gene id, the smallest value of each id."""
    rows = spark.read.csv(path, sep="\t", header=True).where("tracking_id <> gene_id")
    return rows.groupBy("tracking_id").agg(F.min(F.col("FPKM").cast("double")).alias("fpkm"))


def read_orf_calls(spark: SparkSession, table: str, locations: str) -> tuple[DataFrame, DataFrame]:
    """(calls, rejected) of an external ORF finder (S7): a tab-separated table of all frames, and the kept ones by prior location.

    The table has a header; its second to sixth fields are id, location, prior location, start codon and type. A line of the other file is the prior
    location, a tab, and fields between spaces of which the fourth is `p=…`.
    """
    fields = F.split("value", "\t")
    at = lambda i: F.try_element_at(fields, F.lit(i))
    lines = spark.read.csv(table, sep="\t", header=True, quote="", comment=None)
    names = ("orf_id", "location", "prior_location", "start_codon", "caller_annotation")
    found = lines.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(lines.columns[1:6], names)))
    p = F.regexp_extract(F.coalesce(F.try_element_at(F.split(at(2), " "), F.lit(4)), F.lit("")), r"^p=(\S+)$", 1)
    kept = spark.read.text(locations).where("length(value) > 0").select(at(1).alias("prior_location"), p.try_cast("double").alias("pvalue"))
    return join_calls(found, kept)


def write_counts(counts: DataFrame, path: str) -> None:
    """Position counts rounded to three decimals without zeros, a folder for each chr."""
    counts.where("count <> 0").withColumn("count", F.round("count", 3)).write.partitionBy("chr").parquet(path)


def bedgraph(counts: DataFrame) -> DataFrame:
    """bedGraph lines of (chr, strand, start, count): zero-based, chr in front, MT as M, antisense negative."""
    name = F.concat(F.lit("chr"), F.when(F.col("chr") == "MT", "M").otherwise(F.col("chr").cast("string")))
    value = F.when(F.col("strand") == 1, F.col("count")).otherwise(-F.col("count"))
    return counts.select(F.concat_ws("\t", name, F.col("start") - 1, F.col("start"), value).alias("line"))


def fasta(df: DataFrame, header: Column, seq: str = "seq") -> DataFrame:
    """FASTA records as rows of text."""
    return df.select(F.concat(F.lit(">"), header, F.lit("\n"), F.col(seq)).alias("value"))


def write_fasta(df: DataFrame, header: Column, path: str, seq: str = "seq") -> None:
    fasta(df, header, seq).write.text(path)


def split_parts(df: DataFrame, parts: int, key: str) -> DataFrame:
    """`df` with its part (1 to `parts`): contiguous runs by `key`, sizes at most one apart.

    Ranks are running counts over ranges of the key, so that no task gathers all rows; the key is unique.
    """
    total = df.count()
    if not total:
        return df.withColumn("part", F.lit(1))
    ranked = running(df, key, {"__n": F.lit(1)})
    big, small = total % parts, total // parts
    part = F.when(F.col("__n") < big * (small + 1), F.floor(F.col("__n") / (small + 1))).otherwise(
        big + F.floor((F.col("__n") - big * (small + 1)) / max(1, small))
    )
    return ranked.withColumn("part", (part + 1).cast("int")).drop("__n")


def parse_headers(df: DataFrame, column: str = "description") -> DataFrame:
    """Fields of combined headers transcript_chr_start_annotation[_snp][_bincode] as columns (S13); other texts have no start and empty fields."""
    one = lambda i: F.regexp_extract(column, r"^([^_\s]+)_([^_\s]+)_(\d+)_([^_\s]+?)(?:_(snp\d+))?(?:_(\d+db\d+))?$", i)
    return df.select("*", one(1).alias("transcript"), one(2).alias("chr"), one(3).try_cast("long").alias("start"), one(4).alias("annotation"), F.nullif(one(5), F.lit("")).alias("snp_id"), F.nullif(one(6), F.lit("")).alias("bincode"))
