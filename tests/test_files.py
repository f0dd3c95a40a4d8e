"""Readers and writers on files, read statistics, and forms of PSM ids."""

import gzip

from pyspark.sql import functions as F

from ribolith.operators import expression as E
from ribolith.sources import databases as B
from ribolith.sources import files as W


def test_identification_tables(spark, tmp_path):
    (tmp_path / "groups.txt").write_text("Protein IDs\tReverse\tPotential contaminant\tScore\nA;B\t\t\t1.5\nC\t+\t\t2\nCON__D\t\t+\t3\nE\t\t\t\n")
    rows = W.read_identifications(spark, str(tmp_path / "groups.txt"))
    assert [(r["Protein IDs"], r["Score"]) for r in rows.collect()] == [("A;B", "1.5"), ("E", None)]
    assert W.read_identifications(spark, str(tmp_path / "groups.txt"), drop_contaminants=False).count() == 3
    (tmp_path / "plain.txt").write_text("a\tb\n1\t2\n")
    assert W.read_identifications(spark, str(tmp_path / "plain.txt")).count() == 1


def test_expression_table(spark, tmp_path):
    (tmp_path / "isoforms.tsv").write_text("tracking_id\tgene_id\tFPKM\nT1\tG1\t2.5\nT1\tG1\t1.5\nG1\tG1\t9\nT2\tG1\t0\n")
    assert sorted(map(tuple, W.read_expression(spark, str(tmp_path / "isoforms.tsv")).collect())) == [("T1", 1.5), ("T2", 0.0)]


def test_counts_and_fasta_are_written(spark, tmp_path):
    rows = spark.createDataFrame([("1", 1, 5, 0.12345), ("1", 1, 6, 0.0), ("MT", -1, 7, 2.0)], "chr string, strand int, start long, count double")
    W.write_counts(rows, str(tmp_path / "counts"))
    assert sorted((str(r["chr"]), r["start"], r["count"]) for r in spark.read.parquet(str(tmp_path / "counts")).collect()) == [("1", 5, 0.123), ("MT", 7, 2.0)]
    assert sorted(p.name for p in (tmp_path / "counts").glob("chr=*")) == ["chr=1", "chr=MT"]
    seqs = spark.createDataFrame([("a", "MK"), ("b", "MKK")], "id string, seq string")
    W.write_fasta(seqs, F.concat(F.lit("sp|"), "id"), str(tmp_path / "fa"))
    back = W.read_fasta(spark, str(tmp_path / "fa"))
    assert sorted((r["accession"], r["seq"]) for r in back.collect()) == [("sp|a", "MK"), ("sp|b", "MKK")]
    heads = W.parse_headers(spark.createDataFrame([("T1_X_12_aTIS_snp3_101db2",), ("T1_X_12_5UTR",), ("odd",), (None,)], "description string"))
    assert [tuple(r)[1:] for r in heads.collect()][:2] == [("T1", "X", 12, "aTIS", "snp3", "101db2"), ("T1", "X", 12, "5UTR", None, None)]


def test_gene_model_dump(spark, tmp_path):
    text = {
        "gene": "1\tprotein_coding\t8\t3\t100\t300\t1\tx\tx\tx\tx\t11\tENSG1\n", "transcript": "11\t1\t8\t3\t100\t300\t1\tx\tx\tprotein_coding\tx\tx\t7\tENST11\n",
        "exon": "21\t3\t100\t150\t1\t-1\t0\t1\t1\tENSE21\n22\t3\t200\t300\t1\t0\t-1\t1\t1\tENSE22\n23\t4\t5\t9\t-1\t0\t0\t1\t1\t\\N\n", "exon_transcript": "21\t11\t1\n22\t11\t2\n23\t12\t1\n",
        "translation": "7\t11\t3\t21\t60\t22\tENSP7\n", "seq_region": "3\tX\t1\t1000\n4\tscaffold\t2\t50\n", "coord_system": "1\t1\tchromosome\tv1\t1\n2\t1\tscaffold\t\\N\t2\n", "xref": "5\t1\tA1\tA1\tx\tsome text\n", "object_xref": "6\t1\tGene\t5\n",
    }
    for name, rows in text.items():
        if name == "exon":
            with gzip.open(tmp_path / f"{name}.txt.gz", "wt") as f:
                f.write(rows)
        else:
            (tmp_path / f"{name}.txt").write_text(rows)
    model = B.read_gene_model(spark, str(tmp_path))
    assert set(model) == set(B.MODEL)
    assert tuple(model["gene"].first()) == (1, "protein_coding", 3, 100, 300, 1, 11, "ENSG1") and tuple(model["translation"].first()) == (7, 11, 3, 21, 60, 22, "ENSP7")
    assert [r["stable_id"] for r in model["exon"].orderBy("exon_id").collect()] == ["ENSE21", "ENSE22", None]
    assert sorted(map(tuple, B.model_exons(model).collect())) == [(11, "X", 1, 1, 100, 150), (11, "X", 1, 2, 200, 300)]


def test_read_statistics(spark):
    rows = [("s", "genomic", 0, 1), ("s", "genomic", 256, 1), ("s", "genomic", 2064, 1), ("s", "genomic", 16, 3), ("s", "genomic", 4, None), ("s", "genomic", 0, None), ("s", "rRNA", 4, None)]
    df = spark.createDataFrame(rows, "sample string, type string, flag int, nh int")
    got = {r["type"]: tuple(r)[2:] for r in E.read_statistics(df, F.col("type") == "genomic").collect()}
    assert got == {"genomic": (4, 2, 1, 3, 1, 0.5, 0.25, 0.75), "rRNA": (1, None, None, 0, 1, None, None, 0.0)}
    assert E.read_statistics(df.where("false")).count() == 0


def test_expressed(spark):
    rows = spark.createDataFrame([("a", 1, None), ("b", 0, 0), ("c", None, None), ("d", None, 2)], "t string, x int, y int")
    assert sorted((r["t"], r["total"]) for r in E.expressed(rows, "x", "y").collect()) == [("a", 1.0), ("d", 2.0)]
    sites = spark.createDataFrame([("1", 5, 0.5, 9), ("1", 6, 0.25, 10), ("1", 7, 0.1, None)], "chr string, site long, methylated double, coverage int")
    assert [tuple(r) for r in E.covered_sites(sites).collect()] == [("1", 6, 0.25)]


def test_psm_ids_of_engines_meet(spark):
    rows = spark.createDataFrame([("run-1-77-_mAC(ac)K_-2-9", "run-1.77.3", "MAC(ox)K"), ("broken", "", "x"), (None, None, None)], "dash string, dot string, peptide string")
    d, o = E.psm_parts("dash", F.col("dash")), E.psm_parts("dot", F.col("dot"))
    got = [tuple(r) for r in rows.select(E.common_id(d["raw_file"], d["scan"], d["sequence"], d["charge"]), E.common_id(o["raw_file"], o["scan"], F.col("peptide"), F.lit("2")), d["event"]).collect()]
    assert got == [("run-1-77-MACK-2", "run-1-77-MACK-2", "9"), (None, None, None), (None, None, None)]


def test_headers_of_other_databases(spark):
    rows = spark.createDataFrame([(">CNAG_1 | CNAG_2 | kinase", ">7 |a| b ||..|c||"), ("x", "y"), (None, None)], "f string, v string")
    assert [tuple(r) for r in rows.select(B.fungal_header(F.col("f")), B.variant_header(F.col("v"))).collect()] == [("sp|CNAG_1|CNAG_2 kinase", "generic|hspv7|a b c"), (None, None), (None, None)]
