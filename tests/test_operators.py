"""Small hand-made cases that the tables do not hold."""

from pyspark.sql import functions as F

from ribolith.functions import sequence as S
from ribolith.operators import alignments as A
from ribolith.operators import curves as K
from ribolith.operators import database as D
from ribolith.operators import intervals as J
from ribolith.operators import startsites as P
from ribolith.operators import variants as V
from ribolith.operators.proteoforms import variant_descriptions
from ribolith.sources import files as W


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_bin_width_does_not_matter(spark):
    points = spark.createDataFrame([("1", 1, p) for p in range(0, 300, 7)], "chr string, strand int, p long")
    spans = spark.createDataFrame([(i, "1", 1, i * 13, i * 13 + i) for i in range(20)], "id long, chr string, strand int, a long, b long")
    rows = [sorted(map(tuple, J.points_in(points, spans, "p", "a", "b", width=w).select("p", "id").collect())) for w in (1, 10, 1000)]
    assert rows[0] == rows[1] == rows[2] and rows[0]


def test_psite_inside_intron_and_minus_strand(spark):
    rows = spark.createDataFrame([(0, 100, "10M50N20M"), (16, 100, "10M50N20M"), (16, 100, "1S28M"), (0, 100, "28M3S")], "flag int, pos long, cigar string")
    got = [(r["len"], r["psite"]) for r in A.with_psites(rows, five_prime=12).collect()]
    assert got == [(30, 162), (30, 167), (28, 115), (28, 112)]


def test_translation_and_selenocysteine(spark):
    assert one(spark, S.translate_codons(F.lit("ATGGCNTAAATG"))) == "MA"
    assert one(spark, S.selenocysteine(F.lit("ATGTGAGCATAA"), F.lit(2))) == ["M", "MUA"]
    assert one(spark, S.near_cognate(F.lit("CTG"))) and not one(spark, S.near_cognate(F.lit("CCC")))


def test_find_orfs_reports_nested_starts(spark):
    got = one(spark, S.find_orfs(F.lit("ATGGCACTGGCATAA"), 1))
    assert [(o["start"], o["end"], o["codon"]) for o in got] == [(1, 15, "ATG"), (7, 15, "CTG")]


def test_decoy_keeps_cleavage_sites(spark):
    assert one(spark, S.decoy(F.lit("AKBRRCD"))) == "DRRCKBA"


def test_alignment_stats(spark):
    got = one(spark, S.alignment_stats(F.lit("MKV-A"), F.lit("MRVLA")))
    assert (got["identity"], got["substitutions_only"], got["longest"]) == (0.75, False, 1)


def test_contained_proteins_go(spark):
    rows = spark.createDataFrame([(1, "MABCDEFGHIJ"), (2, "MCDEFGHIJ"), (3, "XCDEFGHIJ"), (4, "MZZ")], "id long, seq string")
    assert sorted(r["id"] for r in D.remove_contained(rows, k=4).collect()) == [1, 4]


def test_multiallelic(spark):
    rows = spark.createDataFrame([("1", 5, "A", "C,G")], "chr string, pos long, ref string, alt string")
    assert [r["alt"] for r in V.split_multiallelic(rows).collect()] == ["C", "G"]


def test_fasta_records(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a one\nACGT\nAC\n>b\nGG\n")
    rows = {r["accession"]: (r["description"], r["seq"]) for r in W.read_fasta(spark, str(tmp_path / "x.fa")).collect()}
    assert rows == {"a": ("one", "ACGTAC"), "b": ("", "GG")}


def test_sam_gtf_vcf(spark, tmp_path):
    (tmp_path / "x.sam").write_text("@HD\tx\nr1\t0\t1\t5\t255\t3M\t*\t0\t0\tACG\t!!!\tNH:i:2\tHI:i:1\tMD:Z:3\n")
    r = W.read_alignments(spark, str(tmp_path / "x.sam")).first()
    assert (r["pos"], r["nh"], r["hi"], r["md"]) == (5, 2, 1, "3")
    (tmp_path / "x.gtf").write_text('#c\n1\ts\texon\t1\t9\t.\t-\t.\tgene_id "g1"; transcript_id "t1";\n')
    g = W.read_gtf(spark, str(tmp_path / "x.gtf")).first()
    assert (g["strand"], g["gene_id"], g["transcript_id"], g["gene_name"]) == (-1, "g1", "t1", None)
    (tmp_path / "x.vcf").write_text("##h\n#CHROM\n1\t7\t.\tA\tG\t9\n")
    assert tuple(W.read_vcf(spark, str(tmp_path / "x.vcf")).first()) == ("1", 7, "A", "G")


def test_rolling_extreme_block_size_does_not_matter(spark):
    rows = spark.createDataFrame([(i, i % 17, (i * 37 % 101) / 8) for i in range(120)], "feature_id long, nreads long, floss double")
    got = [sorted(map(tuple, K.rolling_extreme(rows, width=10, block=b).collect())) for b in (7, 10, 50, 1000)]
    assert got[0] == got[1] == got[2] == got[3] and [r[0] for r in got[0]] == list(range(10, 121))


def test_poly_regression_is_least_squares(spark):
    import numpy as np

    x = np.arange(1, 30) / 10
    y = 0.5 + 0.25 * x - 0.125 * x**2 + np.sin(x * 9) / 20
    rows = spark.createDataFrame([(float(a), float(10**b)) for a, b in zip(x, y)] + [(-1.0, 5.0), (1.0, 0.0)], "x double, y double")
    got = K.poly_regression(rows, "x", "y").first()
    assert np.allclose([got["c2"], got["c1"], got["c0"]], np.polyfit(x, y, 2), atol=1e-4)
    flat = K.poly_regression(rows.where("x in (0.1, 0.2)"), "x", "y").first()
    assert flat["c2"] is None


def test_start_sites(spark):
    seq = "CCATGCCCCCCCTGCCCC"  # ATG at 3, CTG at 12
    hits = spark.createDataFrame([(1, 2, 4, 0), (1, 3, 6, 1), (1, 12, 9, 0), (1, 8, 50, 0), (2, 5, 1, 0), (3, 4, 0, 9)], "transcript_id long, cdna long, ltm long, chx long")
    sequences = spark.createDataFrame([(i, seq) for i in (1, 2, 3)], "transcript_id long, seq string")
    cds = spark.createDataFrame([(1, 3, 15), (2, 3, 15), (3, 3, 15)], "transcript_id long, cds_start int, cds_end int")
    got = {(r["transcript_id"], r["cdna"]): (r["annotation"], r["codon"], r["peak_shift"], r["cnt"], r["atis_call"]) for r in P.call_starts(hits, sequences, cds, {k: (5, -999.0) for k in P.THRESHOLDS}).collect()}
    assert got == {(1, 3): ("aTIS", "ATG", "+1 0", 10, "True"), (1, 12): ("CDS", "CTG", "0", 9, "NA"), (2, 3): ("aTIS", "ATG", None, None, "no_data")}


def test_groups_without_subsets(spark):
    import random

    from ribolith.operators import identifications as I

    rng = random.Random(4)
    sets = {i: frozenset(rng.sample("abcdefgh", rng.randint(1, 5))) for i in range(60)} | {100 + i: frozenset("z") for i in range(50)} | {200: frozenset("yz"), 300: frozenset("x"), 301: frozenset("x")}
    df = spark.createDataFrame([(i, x) for i, s in sets.items() for x in s] * 2, "protein_id long, peptide string")
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    want = {(i, len(s)) for s, i in first.items() if not any(s < t for t in first)}
    assert {(r["protein_id"], r["n"]) for r in I.without_subsets(df).collect()} == want
    assert I.without_subsets(df.where("false")).count() == 0


def test_variant_descriptions_stay_in_their_row(spark):
    rows = [(1, "MKIACDEF", "MKLACDEF"), (2, "--MKAAQ", "MLMK--Q"), (3, "MK", "MK"), (4, None, "MK"), (5, "MKéW", "MK-L"), (6, "MKA", "MC")]
    made = variant_descriptions(spark.createDataFrame(rows, "id long, a string, b string"), keep=("b",))
    got = {r["id"]: (r["simple"], r["complex"]) for r in made.collect()}
    assert got == {1: ("3|I", ""), 2: ("", "1|2|;4|4|AA"), 3: ("", ""), 4: ("", ""), 5: ("", "2|3|éW"), 6: ("2|K", "")}
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()


def test_translated_columns_equal_translated_codons(spark):
    rows = [("ATGAAATAA",), ("ATGNNNCTNTAACT",), ("",), (None,), ("aTGéTG",), ("AC",)]
    got = spark.createDataFrame(rows, "seq string").select(S.translated("seq").alias("a"), S.translate_codons(F.col("seq"), to_stop=False).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] == ["MK*", "MXL*", "", None, "XX", ""]
