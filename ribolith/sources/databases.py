"""Annotated sequence databases as text, and the registry of analyses."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Folders of a registry: one for each call, in the order of the calls.
_CALL = "call"


def escaped(text: Column) -> Column:
    """Text of an annotation: backslashes, brackets and bars get a backslash, line breaks become spaces."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\()|])", r"\\$1"), r"[\r\n]+", " ")


def peff_entries(entries: DataFrame, forms: DataFrame, taxon: int, species: str) -> DataFrame:
    """(transcript_id, structure, header, seq) of annotated entries.

    `entries` has transcript_id, structure, gene, protein, seq, first and last; `forms` transcript_id, structure, accession, name and the variants of each
    form against the entry's sequence as in `variant_descriptions`: simple and complex, `;`-lists. Variants are numbered in an entry: simple ones first, each kind by its text.
    Forms follow by number of variants, least variant and accession, the canonical form before all. Entries without forms have none.
    """
    key = ["transcript_id", "structure"]
    lists = lambda c, kind: F.transform(F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ";"), lambda v: v != ""), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("v")))
    each = forms.select(*key, "accession", "name", F.array_distinct(F.concat(lists("simple", 0), lists("complex", 1))).alias("l"))
    variants = each.select(*key, F.explode("l").alias("x")).select(*key, "x.kind", "x.v").distinct()
    numbered = variants.withColumn("number", F.row_number().over(Window.partitionBy(*key).orderBy("kind", "v")))
    texts = numbered.withColumn("t", F.concat(F.lit("("), F.col("number").cast("string"), F.lit(":"), F.col("v"), F.lit(")")))
    ordered = lambda kind: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("number", "t")))), lambda x: x["t"]), "")
    texts = texts.groupBy(*key).agg(ordered(0).alias("simple"), ordered(1).alias("complex"))

    used = each.select(*key, "accession", "name", F.explode_outer("l").alias("x")).select(*key, "accession", "name", "x.kind", "x.v").join(numbered, [*key, "kind", "v"], "left")
    used = used.groupBy(*key, "accession", "name").agg(F.sort_array(F.collect_list("number")).alias("numbers"))
    bounds = entries.select(*key, "first", "last")
    one = F.concat(F.lit("("), escaped(F.col("accession")), F.lit("|"), F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string"), F.lit("|"), F.array_join(F.transform("numbers", lambda n: n.cast("string")), ","), F.lit("|"), escaped(F.col("name")), F.lit(")"))
    place = F.struct((F.col("name") != "canonical form").alias("c"), F.size("numbers").alias("n"), F.coalesce(F.get("numbers", F.lit(0)), F.lit(0)).alias("m"), F.col("accession").alias("a"), one.alias("t"))
    parts = used.join(bounds, key).groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(place)), lambda x: x["t"]), "").alias("forms"))

    rows = entries.join(texts, key, "left").join(parts, key, "left")
    field = lambda name, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"\\{name}="), F.col(c), F.lit(" "))).otherwise("")
    header = F.concat(
        F.lit(">gen:"), F.col("transcript_id").cast("string"), F.lit("-"), F.col("structure").cast("string"), F.lit(" \\PName="), escaped(F.col("protein")), F.lit(" \\GName="), escaped(F.col("gene")),
        F.lit(f" \\NcbiTaxId={taxon} \\TaxName={species} \\Length="), F.length("seq").cast("string"), F.lit(" "), field("VariantSimple", "simple"), field("VariantComplex", "complex"), F.lit(" \\Proteoform="), F.coalesce("forms", F.lit("")),
    )
    return rows.select(*key, header.alias("header"), "seq")


def variant_lines(records: DataFrame) -> DataFrame:
    """(transcript, line) of records (transcript, snp, indel) with any variant: the three fields between tabs."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return records.where((text("snp") != "") | (text("indel") != "")).select("transcript", F.concat_ws("\t", F.col("transcript").cast("string"), text("snp"), text("indel")).alias("line"))


def write_ordered(rows: DataFrame, order: list[str], line: Column, path: str, parts: int | None = None) -> None:
    """Writes a line (or several) for each row in the order of `order`: files by name follow each other, each sorted."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(line.alias("value")).write.text(path)


def write_peff(entries: DataFrame, path: str, parts: int | None = None) -> None:
    write_ordered(entries, ["transcript_id", "structure"], F.concat("header", F.lit("\n"), "seq"), path, parts)


def register(rows: DataFrame, path: str, key: str = "id") -> None:
    """Adds analyses to the registry at `path` (S14): a folder for each call, so that files follow the rows and not the ids.

    An id that is there is replaced when the registry is read, so that a repeated or retried job leaves one row. Of rows that repeat an id in
    one call the least stays; null ids go. Other calls' rows are not read.
    """
    others = [c for c in rows.columns if c != key]
    one = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("r")).select(*(F.col(f"r.{c}").alias(c) for c in others), key)
    one.write.parquet(f"{path}/{_CALL}={time.time_ns():020d}-{uuid.uuid4().hex}")


def read_registry(spark: SparkSession, path: str, key: str = "id", kind: T.DataType | None = None) -> DataFrame:
    """All analyses, of each id that of its last call; their ids as text or as `kind`."""
    rows = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)
    rows = rows.withColumn(key, F.col(key).cast(kind or T.StringType()))
    others = [c for c in rows.columns if c not in (key, _CALL)]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.col(_CALL).cast("string")).alias("r"))
    return last.select(*(F.col(f"r.{c}").alias(c) for c in others), key)


def export_registry(rows: DataFrame, path: str, key: str = "id") -> None:
    """The registry as tab-separated text with a header, by id."""
    rows.repartitionByRange(key).sortWithinPartitions(key).write.option("sep", "\t").option("header", "true").csv(path)


def fungal_header(header: Column) -> Column:
    """A header `transcript | gene | description` as `sp|transcript|gene description`; null for other forms (F32)."""
    form = r"^>?(CNAG\S*)\W\|\W(CNAG\S*)\W\|\W(.+)$"
    one = lambda i: F.regexp_extract(header, form, i)
    return F.when(header.rlike(form), F.concat(F.lit("sp|"), one(1), F.lit("|"), one(2), F.lit(" "), one(3)))


def variant_header(header: Column) -> Column:
    """A header `number |field|field…` as `generic|hspv<number>|fields between spaces`, without empty fields and coordinates `..`; null for other forms (F32)."""
    form = r"^>?(\S+) \|(.+)$"
    fields = F.transform(F.split(F.regexp_extract(header, form, 2), r"\|"), lambda x, i: F.when((i == 3) & (F.trim(x) == ".."), "").otherwise(F.trim(x)))
    return F.when(header.rlike(form), F.concat(F.lit("generic|hspv"), F.regexp_extract(header, form, 1), F.lit("|"), F.array_join(F.filter(fields, lambda x: x != ""), " ")))


#: Tables of a gene model dump with the columns that the joins read, and their place in a line.
MODEL = {
    "gene": {"gene_id": 0, "biotype": 1, "seq_region_id": 3, "seq_region_start": 4, "seq_region_end": 5, "seq_region_strand": 6, "canonical_transcript_id": 11, "stable_id": 12},
    "transcript": {"transcript_id": 0, "gene_id": 1, "seq_region_id": 3, "seq_region_start": 4, "seq_region_end": 5, "seq_region_strand": 6, "biotype": 9, "canonical_translation_id": 12, "stable_id": 13},
    "exon": {"exon_id": 0, "seq_region_id": 1, "seq_region_start": 2, "seq_region_end": 3, "seq_region_strand": 4, "phase": 5, "end_phase": 6, "stable_id": 9},
    "exon_transcript": {"exon_id": 0, "transcript_id": 1, "rank": 2},
    "translation": {"translation_id": 0, "transcript_id": 1, "seq_start": 2, "start_exon_id": 3, "seq_end": 4, "end_exon_id": 5, "stable_id": 6},
    "seq_region": {"seq_region_id": 0, "name": 1, "coord_system_id": 2, "length": 3},
    "coord_system": {"coord_system_id": 0, "species_id": 1, "name": 2, "version": 3, "rank": 4},
    "xref": {"xref_id": 0, "external_db_id": 1, "dbprimary_acc": 2, "display_label": 3, "description": 5},
    "object_xref": {"object_xref_id": 0, "ensembl_id": 1, "ensembl_object_type": 2, "xref_id": 3},
}
_TEXT = ("biotype", "stable_id", "name", "version", "dbprimary_acc", "display_label", "description", "ensembl_object_type")


def read_gene_model(spark: SparkSession, folder: str, tables: dict[str, dict[str, int]] | None = None) -> dict[str, DataFrame]:
    """The tables of a gene model dump by name (S4): `<table>.txt` or `.txt.gz` in `folder`, fields between tabs, \\N for null, no header.

    `tables` gives the columns and their places where a release has them elsewhere. Ids and places are long, others text.
    """
    out = {}
    for name, columns in (tables or MODEL).items():
        fields = F.split("value", "\t")
        at = lambda i: F.nullif(F.get(fields, F.lit(i)), F.lit("\\N"))  # noqa: E731, B023
        rows = spark.read.text(f"{folder}/{name}.txt*").where("length(value) > 0")
        out[name] = rows.select(*((at(i) if c in _TEXT else at(i).try_cast("long")).alias(c) for c, i in columns.items()))
    return out


def model_exons(model: dict[str, DataFrame], coord_system: str = "chromosome") -> DataFrame:
    """transcript_id, chr, strand, rank, exon_start, exon_end of all transcripts on the named coordinate system."""
    places = model["seq_region"].join(model["coord_system"].where(F.col("name") == coord_system).select("coord_system_id"), "coord_system_id", "left_semi")
    exons = model["exon"].select("exon_id", "seq_region_id", F.col("seq_region_start").alias("exon_start"), F.col("seq_region_end").alias("exon_end"), F.col("seq_region_strand").cast("int").alias("strand"))
    rows = model["exon_transcript"].join(exons, "exon_id").join(places.select("seq_region_id", F.col("name").alias("chr")), "seq_region_id")
    return rows.select("transcript_id", "chr", "strand", F.col("rank").cast("int").alias("rank"), "exon_start", "exon_end")
