"""Domain-shaped inputs derived from the driver's tables, and the same projections as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LINE = {
    "chr": "cast(l_suppkey % 20 as bigint)",
    "strand": "case when l_returnflag = 'A' then -1 else 1 end",
    "start": "cast((l_partkey * 37 + l_linenumber * 11) % 100000 as bigint)",
    "rpf": "cast(26 + cast(l_quantity as bigint) % 9 as bigint)",
}


def psite(spark, sf_dir) -> DataFrame:
    """Position counts split by fragment length: chr, strand, start, rpf, cnt."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(*(f"{e} {n}" for n, e in _LINE.items()))
    return rows.groupBy("chr", "strand", "start", "rpf").agg(F.count("*").alias("cnt"))


def features(spark, sf_dir) -> DataFrame:
    """Gene intervals: feature_id, chr, strand, feature_start, feature_end (closed)."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey feature_id", "cast(p_partkey % 20 as bigint) chr", "case when p_size % 2 = 0 then 1 else -1 end strand",
        "cast((p_partkey * 53) % 100000 as bigint) feature_start", "cast((p_partkey * 53) % 100000 + 20 * p_size as bigint) feature_end",
    )


def exons(spark, sf_dir) -> DataFrame:
    """Three exons for each transcript, ranks against the coordinate on the minus strand."""
    rows = table(spark, sf_dir, "part").withColumn("k", F.explode(F.array(*map(F.lit, (1, 2, 3)))))
    return rows.selectExpr(
        "p_partkey transcript_id", "cast(p_partkey % 20 as bigint) chr", "case when p_size % 2 = 0 then 1 else -1 end strand",
        "case when p_size % 2 = 0 then k else 4 - k end rank",
        "cast((p_partkey * 53) % 100000 + (k - 1) * 8 * p_size as bigint) exon_start",
        "cast((p_partkey * 53) % 100000 + (k - 1) * 8 * p_size + 4 * p_size - 1 as bigint) exon_end",
    )


_CIGAR = """case l_linenumber % 3 when 0 then concat(cast(26 + cast(l_quantity as int) % 9 as string), 'M')
 when 1 then concat(cast(6 + cast(l_quantity as int) % 9 as string), 'M100N20M')
 else concat('1S', cast(26 + cast(l_quantity as int) % 9 as string), 'M') end"""


def alignments(spark, sf_dir) -> DataFrame:
    """Alignments with plain, spliced and soft-clipped CIGARs."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_LINE['chr']} chr", "case when l_returnflag = 'A' then 16 else 0 end flag",
        f"{_LINE['start']} pos", "case when l_linenumber = 1 then 255 else 3 end mapq", "l_linenumber nh", f"{_CIGAR} cigar",
    )


def dna(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "regexp_replace(translate(text,'abcdefghijklmnopqrstuvwxyz','ACGTACGTACGTACGTACGTACGTAC'),'[^ACGT]','') seq"
    )


def protein(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "regexp_replace(translate(text,'abcdefghijklmnopqrstuvwxyz','AACDEFGHIKKLMNPPQRSTLVWYYG'),'[^ACDEFGHIKLMNPQRSTVWY]','') aa",
    )


def variants(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{_LINE['chr']} chr", f"{_LINE['start']} pos", "substring('ACGT', cast(l_orderkey % 4 as int) + 1, 1) ref",
        "substring('CGTA', cast((l_orderkey + l_linenumber % 3) % 4 as int) + 1, 1) alt", "cast(l_quantity as int) dp",
        "round(l_discount * 10, 2) af",
    )


def psms(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey group_id", "l_partkey protein_id", "concat('PEP', cast(l_suppkey as string), '_', cast(l_linenumber as string)) peptide",
        "round(l_discount, 4) q", "round(l_tax, 4) pep", "l_extendedprice score", "l_linestatus label",
    )


def protein_sources(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey protein_id", "case when p_size % 3 = 0 then 'SwissProt' when p_size % 3 = 1 then 'TrEMBL' else 'Custom' end source",
        "concat(cast(p_size % 2 as string), cast((p_size div 2) % 2 as string), '1') bincode",
    )


#: The same for DuckDB, by name.
CTE = {
    "psite": "psite as (select " + ", ".join(f"{e} {n}" for n, e in _LINE.items()) + ", count(*) cnt from lineitem group by 1, 2, 3, 4)",
    "features": """features as (select p_partkey feature_id, cast(p_partkey % 20 as bigint) chr, case when p_size % 2 = 0 then 1 else -1 end strand,
 cast((p_partkey * 53) % 100000 as bigint) feature_start, cast((p_partkey * 53) % 100000 + 20 * p_size as bigint) feature_end from part)""",
    "exons": """exons as (select p_partkey transcript_id, cast(p_partkey % 20 as bigint) chr, case when p_size % 2 = 0 then 1 else -1 end strand,
 case when p_size % 2 = 0 then k else 4 - k end rank, cast((p_partkey * 53) % 100000 + (k - 1) * 8 * p_size as bigint) exon_start,
 cast((p_partkey * 53) % 100000 + (k - 1) * 8 * p_size + 4 * p_size - 1 as bigint) exon_end from part cross join (values (1), (2), (3)) as r(k))""",
    "alignments": f"""alignments as (select l_orderkey, l_linenumber, {_LINE['chr']} chr, case when l_returnflag = 'A' then 16 else 0 end flag,
 {_LINE['start']} pos, case when l_linenumber = 1 then 255 else 3 end mapq, l_linenumber nh, {_CIGAR} cigar from lineitem)""",
    "dna": """dna as (select doc_id, regexp_replace(translate(text,'abcdefghijklmnopqrstuvwxyz','ACGTACGTACGTACGTACGTACGTAC'),'[^ACGT]','','g') seq from documents)""",
    "protein": """protein as (select doc_id, regexp_replace(translate(text,'abcdefghijklmnopqrstuvwxyz','AACDEFGHIKKLMNPPQRSTLVWYYG'),'[^ACDEFGHIKLMNPQRSTVWY]','','g') aa from documents)""",
    "variants": f"""variants as (select {_LINE['chr']} chr, {_LINE['start']} pos, substring('ACGT', cast(l_orderkey % 4 as int) + 1, 1) ref,
 substring('CGTA', cast((l_orderkey + l_linenumber % 3) % 4 as int) + 1, 1) alt, cast(l_quantity as int) dp, round(l_discount * 10, 2) af from lineitem)""",
    "psms": """psms as (select l_orderkey group_id, l_partkey protein_id, concat('PEP', cast(l_suppkey as string), '_', cast(l_linenumber as string)) peptide,
 round(l_discount, 4) q, round(l_tax, 4) pep, l_extendedprice score, l_linestatus label from lineitem)""",
    "protein_sources": """protein_sources as (select p_partkey protein_id, case when p_size % 3 = 0 then 'SwissProt' when p_size % 3 = 1 then 'TrEMBL' else 'Custom' end source,
 concat(cast(p_size % 2 as string), cast((p_size // 2) % 2 as string), '1') bincode from part)""",
}


def ctes(*names: str) -> str:
    return "with " + ",\n".join(CTE[n] for n in names)
