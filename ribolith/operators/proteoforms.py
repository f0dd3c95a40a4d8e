"""Proteoforms: identifications of custom proteins, comparison of engines, names and classes from aligned pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def custom_peptides(df: DataFrame, pattern: str = "ENST%") -> DataFrame:
    """Rows (…, proteins: array) all of whose proteins have custom ids."""
    return df.where(F.expr(f"size(proteins) > 0 and forall(proteins, x -> x like '{pattern}')"))


def valid_orfs(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (…, codon, called_codon, aa with * for stops) with their start codon, one stop at the end; and the rejected ones."""
    good = F.expr("coalesce(codon = called_codon and instr(aa, '*') = length(aa) and length(aa) > 0, false)")
    return df.where(good), df.where(~good)


def group_peptides(groups: DataFrame, peptides: DataFrame) -> DataFrame:
    """Groups (group_id, peptide_ids: array) joined with the peptides that they list."""
    return groups.select("group_id", F.explode("peptide_ids").alias("peptide_id")).distinct().join(peptides, "peptide_id")


def scan_proteins(psms: DataFrame, results: DataFrame, sequences: DataFrame) -> DataFrame:
    """Rescored PSMs (raw_file, scan, peptide) with the proteins of the search results whose sequence holds the peptide.

    Without any the label is NoProteinInfoFound.
    """
    met = psms.join(results, ["raw_file", "scan", "peptide"], "left").join(sequences, "protein_id", "left")
    held = F.when(F.col("seq").contains(F.col("peptide")), F.col("protein_id").cast("string"))
    names = F.array_join(F.array_sort(F.collect_set(held)), ";")
    return met.groupBy("raw_file", "scan", "peptide").agg(F.coalesce(F.nullif(names, F.lit("")), F.lit("NoProteinInfoFound")).alias("proteins"))


def corrected_peptide_counts(psms: DataFrame, redundant: DataFrame) -> DataFrame:
    """Distinct peptides of each group's proteins, with those of their redundant partners that lie at position 2 (V2).

    `redundant` has protein_id and partner; peptides of the partner that the protein lacks in the group are added.
    """
    own = psms.select("group_id", "protein_id", "peptide").distinct()
    second = psms.where("position = 2").select("group_id", F.col("protein_id").alias("partner"), "peptide").distinct()
    more = own.select("group_id", "protein_id").distinct().join(redundant, "protein_id").join(second, ["group_id", "partner"]).select("group_id", "protein_id", "peptide")
    return own.unionByName(more).groupBy("group_id", "protein_id").agg(F.countDistinct("peptide").alias("peptides"))


def proving_peptides(group_peptides_: DataFrame, proteoforms: DataFrame, known: DataFrame, base: DataFrame) -> DataFrame:
    """Each group's peptides of its proteoform that no known protein has; without any those that the base canonical lacks (V3).

    `proteoforms` and `known` list (protein_id, peptide); `base` (protein_id, peptide) of the base canonical of each proteoform.
    """
    own = group_peptides_.join(proteoforms, ["protein_id", "peptide"])
    unknown = own.join(known.select("peptide").distinct(), "peptide", "left_anti").select("group_id", "protein_id", "peptide", F.lit(1).alias("tier"))
    rest = own.join(base, ["protein_id", "peptide"], "left_anti").select("group_id", "protein_id", "peptide", F.lit(2).alias("tier"))
    both = unknown.unionByName(rest)
    least = both.groupBy("group_id", "protein_id").agg(F.min("tier").alias("tier"))
    return both.join(least, ["group_id", "protein_id", "tier"]).groupBy("group_id", "protein_id", "tier").agg(F.countDistinct("peptide").alias("peptides"))


def identifications(groups: DataFrame, peptides: DataFrame) -> DataFrame:
    """Groups with their significant peptides and errors as |-lists, by peptide (V4)."""
    rows = group_peptides(groups, peptides).groupBy("group_id").agg(F.sort_array(F.collect_set(F.struct("peptide", "pep"))).alias("l"))
    joined = lambda f: F.array_join(F.transform("l", lambda x: x[f].cast("string")), "|")
    return rows.select("group_id", joined("peptide").alias("peptides"), joined("pep").alias("peps"))


def compare_engines(a: DataFrame, b: DataFrame, longest: int = 30, pep: float = 0.01) -> DataFrame:
    """Groups of `a` (group_id, protein_id, peptide, pep): overlap with `b`, or alone, and why an alone one may be missed (V5).

    Groups overlap that share a peptide and a protein. Alone: a peptide over `longest` residues, or one under the error `pep`, rescues.
    """
    met = a.select("group_id", "peptide", "protein_id").join(b.select("peptide", "protein_id").distinct(), ["peptide", "protein_id"], "left_semi").select("group_id").distinct()
    sums = a.groupBy("group_id").agg(F.max(F.length("peptide")).alias("longest"), F.min("pep").alias("pep"))
    rows = sums.join(met.withColumn("met", F.lit(True)), "group_id", "left")
    return rows.select("group_id", F.when(F.col("met"), "overlap").when(F.col("longest") > longest, "long").when(F.col("pep") < pep, "strong").otherwise("alone").alias("class"))


def base_canonical(proteoforms: DataFrame, canonical: DataFrame) -> DataFrame:
    """Proteoforms with the canonical protein of their gene; those of non-coding transcripts have none (V6)."""
    named = canonical.groupBy("gene_id").agg(F.min("protein_id").alias("base"))
    return proteoforms.join(named, "gene_id", "left").withColumn("base", F.when(F.col("annotation") == "ntr", "non-coding").otherwise(F.coalesce(F.col("base").cast("string"), F.lit("unknown"))))


def psm_key(raw: Column, scan: Column, charge: Column, sequence: Column) -> Column:
    """raw file, scan, charge and the bare sequence, modifications in brackets and flanks gone."""
    bare = F.regexp_replace(F.regexp_replace(sequence, r"\[[^\]]*\]|\([^)]*\)", ""), r"^[A-Z-]\.|\.[A-Z-]$|[^A-Z.]", "")
    return F.concat_ws("_", raw, scan.cast("string"), charge.cast("string"), F.regexp_replace(bare, r"\.", ""))


def pin_columns(df: DataFrame, columns: list[str], proteins: str = "proteins") -> DataFrame:
    """The named columns, protein lists joined by tabs."""
    return df.select(*columns, F.array_join(proteins, "\t").alias(proteins))


def without_contaminated(df: DataFrame, mark: str = "CON") -> DataFrame:
    """Rows (group_id, protein) of groups without a contaminant."""
    bad = df.where(F.col("protein").startswith(mark)).select("group_id").distinct()
    return df.join(bad, "group_id", "left_anti")


def with_decoys(proteins: DataFrame, contaminants: DataFrame, decoy: Column) -> DataFrame:
    """Proteins and contaminants (id, seq), each also as a decoy with REV__ in front."""
    both = proteins.select("id", "seq").unionByName(contaminants.select(F.concat(F.lit("CON__"), "id").alias("id"), "seq"))
    return both.unionByName(both.select(F.concat(F.lit("REV__"), "id").alias("id"), decoy.alias("seq")))


def classification_counts(df: DataFrame) -> DataFrame:
    """Rows by class."""
    return df.groupBy("class").agg(F.count("*").alias("n"))


def columns_of(a: Column, b: Column) -> Column:
    """array<struct<x, y>> of an aligned pair: its residues, - for gaps."""
    return F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.struct(x.alias("x"), y.alias("y")))


def variant_descriptions(df: DataFrame, key: str = "id", a: str = "a", b: str = "b", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, simple, complex), and the columns `keep`: of an aligned pair the single substitutions as place|residue and the other differing runs as start|end|residues.

    Places count in `b`, the base; an insertion is given with the place before it. Places are running counts over the pair's columns. No column
    is a row of its own.
    """
    text = _described(F.col(a), F.col(b))
    return df.select(key, *keep, text.alias("d")).select(key, "d.simple", "d.complex", *keep)


@F.pandas_udf(T.StructType([T.StructField("simple", T.StringType()), T.StructField("complex", T.StringType())]))
def _described(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """The two lists of each pair; work follows its columns, and nothing leaves its row."""

    def lists(x, y):
        simple, others = [], []
        if x is not None and y is not None and x != y:
            n = max(len(x), len(y))
            p, q = (np.frombuffer(t.ljust(n, "\0").encode("utf-32-le"), np.uint32) for t in (x, y))
            compared = min(len(x), len(y))  # columns that one lacks are no columns of the pair
            cut = np.flatnonzero(np.diff(np.concatenate(([0], (p[:compared] != q[:compared]).astype(np.int8), [0]))))
            at = np.cumsum(q != ord("-"))
            for i, k in zip(cut[::2].tolist(), cut[1::2].tolist()):
                if k == i + 1 and x[i] != "-" and y[i] != "-":
                    simple.append(f"{at[i]}|{x[i]}")
                else:
                    others.append(f"{at[i]}|{at[k - 1]}|{x[i:k].replace('-', '')}")
        return ";".join(simple), ";".join(others)

    return pd.DataFrame([lists(x, y) for x, y in zip(a, b)], columns=["simple", "complex"])


def pair_shape(a: Column, b: Column) -> Column:
    """One letter for each column of an aligned pair: = equal, x substituted, i only in the first, d only in the second."""
    letter = lambda x, y: F.when(x == y, "=").when(y == "-", "i").when(x == "-", "d").otherwise("x")
    return F.array_join(F.zip_with(F.split(a, ""), F.split(b, ""), letter), "")


def classify_pair(a: Column, b: Column, annotation: Column) -> Column:
    """Class of a proteoform `a` aligned with its base `b`, from the shape of the pair.

    Annotated non-coding, upstream and downstream frames first; then extension and truncation at either end, exclusions and inclusions
    inside, substitutions only, several of them, and out of frame below 0.35 equal columns of those without gaps.
    """
    shape = pair_shape(a, b)
    core = F.replace(F.replace(shape, F.lit("i"), F.lit("")), F.lit("d"), F.lit(""))
    identity = F.length(F.replace(core, F.lit("x"), F.lit(""))) / F.length(core)
    few = lambda p: shape.rlike(p)
    return (
        F.when(annotation == "ntr", "Translation of non-coding region").when(annotation == "5UTR", "uORF").when(annotation == "3UTR", "dORF")
        .when((F.length(core) == 0) | (identity < 0.35), "Out-of-frame ORF").when(few("^=+$"), "Canonical")
        .when(few("^i+=+$"), "N-terminal extension").when(few("^d+=+$"), "N-terminal truncation")
        .when(few("^=+i+$"), "C-terminal extension").when(few("^=+d+$"), "C-terminal truncation")
        .when(few("^=+i+=+$"), "Exon inclusion").when(few("^=+d+=+$"), "Exon exclusion")
        .when(few("^[=x]+$"), "Only amino acid substitutions").when(few("^[id]+x*[=x]+$"), "N-terminal splice variant").when(few("^[=x]+x*[id]+$"), "C-terminal splice variant")
        .otherwise("Multiple variations")
    )


def proteoform_name(a: Column, b: Column) -> Column:
    """Extension, truncation, single substitution and other parts of the shape of an aligned pair, joined."""
    shape = pair_shape(a, b)
    part = lambda p, name: F.when(shape.rlike(p), F.lit(name))
    named = F.concat_ws(
        ", ", part("^i", "N-terminal extension"), part("^d", "N-terminal truncation"), part("(^|=)x(=|$)", "SAV"),
        part("[=x][id]+[=x]|xx", "other variation"), part("[=x]i+$", "C-terminal extension"), part("[=x]d+$", "C-terminal truncation"),
    )
    return F.when(named == "", "canonical form").otherwise(named)


def protein_names(df: DataFrame) -> DataFrame:
    """(structure, gene, name) by the annotations of a structure's members.

    With an annotated start the gene product; all of non-coding transcripts, all inside the coding frame; else undeterminable.
    """
    rows = df.groupBy("structure").agg(F.min("gene").alias("gene"), F.bool_or(F.col("annotation") == "aTIS").alias("a"), F.bool_and(F.col("annotation") == "ntr").alias("n"), F.bool_and(F.col("annotation") == "CDS").alias("c"))
    text = F.when(F.col("a"), "Gene product of").when(F.col("n"), "Product from non-coding part of").when(F.col("c"), "Alternative reading frame product of").otherwise("Undeterminable product of")
    return rows.select("structure", "gene", F.concat_ws(" ", text, F.col("gene").cast("string")).alias("name"))


def variant_numbers(df: DataFrame) -> DataFrame:
    """Records numbered inside their structure by number of variants, then id; and with a suffix where an ORF id repeats."""
    inside = Window.partitionBy("structure").orderBy("variants", "orf_id", "snp_id")
    same = Window.partitionBy("orf_id")
    again = F.when(F.count("*").over(same) > 1, F.concat_ws("_", F.col("orf_id").cast("string"), F.row_number().over(same.orderBy("snp_id")).cast("string")))
    return df.withColumn("number", F.row_number().over(inside)).withColumn("order", F.dense_rank().over(Window.partitionBy("structure").orderBy("variants"))).withColumn("name", F.coalesce(again, F.col("orf_id").cast("string")))


def bincode_labels(spark, names: list[str]) -> DataFrame:
    """(bincode, label) of every combination of the sets."""
    n = len(names)
    bits = F.lpad(F.bin("id"), n, "0")
    label = F.concat_ws("+", *(F.when(F.substring(bits, i + 1, 1) == "1", name) for i, name in enumerate(names)))
    return spark.range(1, 1 << n).select(bits.alias("bincode"), label.alias("label"))


def missing_lengths(transcripts: DataFrame, sequences: DataFrame) -> DataFrame:
    """Transcripts with their sequence, its length and whether it is the expected one."""
    rows = transcripts.join(sequences, "transcript_id", "left")
    return rows.withColumn("seq_length", F.length("seq")).withColumn("fits", F.coalesce(F.length("seq") == F.col("length"), F.lit(False)))
