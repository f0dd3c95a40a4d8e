"""Callers' files, split runs, segments, protein lists, annotated databases and the registry on hand-made cases."""

import random

from pyspark.sql import functions as F

from ribolith.operators import metagene as M
from ribolith.operators import orfcalls as O
from ribolith.operators import proteinlists as L
from ribolith.operators import splitruns as R
from ribolith.sources import databases as B
from ribolith.sources import files as W


def test_caller_files(spark, tmp_path):
    (tmp_path / "all.tsv").write_text(
        "Gene\tId\tLocation\tCandidate Location\tCodon\tType\tx\n"
        "g1\tENST1_CDS_0\t1+:9-20|29-41\t1+:6-20|29-41\tATG\tCDS\t1\n"
        "g2\tENST_2_uORF_1\tX-:9-20|29-41\tX-:9-20|29-50\tCTG\tuORF\t1\n"
        "g3\tENST3_CDS_0\t1:9-20\tp3\tATG\tCDS\t1\n"
        "g4\tENST4_CDS_0\t1+:9-20\tp4\tATG\tCDS\t1\n"
        "g5\tENST5_CDS_0\t1+:20-20\tp5\tATG\tCDS\t1\n"
    )
    (tmp_path / "kept.loc").write_text("1+:6-20|29-41\ta b c p=0.01 e\nX-:9-20|29-50\ta b c p=2e-3\np3\ta b c p=0.5\np4\ta b\nnone\ta b c p=0.2\np5\ta b c p=0.3\n\n")
    calls, lost = W.read_orf_calls(spark, str(tmp_path / "all.tsv"), str(tmp_path / "kept.loc"))
    got = {r["orf_id"]: (r["transcript"], r["chr"], r["strand"], [tuple(p) for p in r["parts"]], r["start_codon"], r["pvalue"]) for r in calls.collect()}
    assert got == {"ENST1_CDS_0": ("ENST1", "1", 1, [(10, 20), (30, 41)], "ATG", 0.01), "ENST_2_uORF_1": ("ENST_2", "X", -1, [(10, 20), (30, 41)], "CTG", 0.002)}
    assert {tuple(r) for r in lost.collect()} == {("p3", "1:9-20", "location"), ("p5", "1+:20-20", "location"), ("p4", None, "pvalue"), ("none", None, "unknown")}


def test_features_of_calls(spark):
    calls = spark.createDataFrame(
        [("a", "T", "1", 1, [(10, 20), (30, 41)]), ("b", "T", "1", 1, [(3, 8)]), ("c", "U", "1", -1, [(10, 20), (30, 41)]), ("d", "V", "2", 1, [(1, 9)])],
        "orf_id string, transcript string, chr string, strand int, parts array<struct<start:long,end:long>>",
    )
    exons = spark.createDataFrame([("T", 1, 20, 1), ("T", 30, 60, 21), ("U", 30, 60, 1), ("U", 1, 20, 32)], "transcript string, exon_start long, exon_end long, cdna_start long")
    sites = spark.createDataFrame([("T", 10, 55), ("U", 50, 12)], "transcript string, atis long, cds_stop long")
    points = spark.createDataFrame([("1", 1, 10, 4), ("1", 1, 25, 9), ("1", 1, 41, 1), ("1", -1, 41, 5), ("1", 1, 3, 2)], "chr string, strand int, start long, cnt long")
    got = {r["orf_id"]: (r["start"], r["stop"], r["starts"], r["ends"], r["dist_to_transcript_start"], r["dist_to_atis"], r["annotation"], r["count"], r["coverage"], r["fpkm"]) for r in O.score_annotation(calls, exons, sites, points, 1_000_000).collect()}
    assert got == {
        "a": (10, 41, "10_30", "20_41", 10, 0, "aTIS", 5, round(2 / 23, 6), round(5 / 0.023, 6)), "b": (3, 8, "3", "8", 3, -7, "5UTR", 2, round(1 / 6, 6), round(2 / 0.006, 6)),
        "c": (41, 10, "10_30", "20_41", 20, 9, "CDS", 5, round(1 / 23, 6), round(5 / 0.023, 6)), "d": (1, 9, "1", "9", None, None, "ntr", 0, 0.0, 0.0),
    }
    rows = spark.createDataFrame([(1, "+", "30-41,10-20", 0.9), (2, "-", "5-9", None), (3, "?", "5-9", 0.9), (4, "-", "5-9", 0.2), (5, "-", "x", 0.9)], "orf_id int, sign string, coordinates string, posterior double")
    assert [(r["orf_id"], r["strand"], [tuple(p) for p in r["parts"]]) for r in O.by_posterior(rows, 0.5).collect()] == [(1, 1, [(10, 20), (30, 41)])]


def test_segments_are_the_least_priority_at_any_width(spark):
    rng = random.Random(6)
    kinds = ["a", "b", "c", "d"]
    typed = [("1", rng.choice((1, -1)), s, s + rng.choice((0, 3, 40, 150)), (k := rng.randrange(4)), kinds[k]) for s in (rng.randrange(300) for _ in range(70))]
    typed += [("1", 1, 50, 20, 0, "a"), ("1", 1, None, 20, 0, "a")]
    frame = spark.createDataFrame(typed, "chr string, strand int, feature_start long, feature_end long, priority int, kind string")
    points = spark.createDataFrame([("1", s, p, 1) for s in (1, -1) for p in range(-5, 460)] + [("2", 1, 5, 1), (None, 1, 5, 1)], "chr string, strand int, start long, cnt long")
    want = {(s, p): min(((pr, k) for _, st, a, z, pr, k in typed if a is not None and st == s and a <= p <= z), default=(0, "intergenic"))[1] for s in (1, -1) for p in range(-5, 460)}
    for width in (1, 7, 100, 1000):
        rows = M.classify(points, frame, width).collect()
        assert len(rows) == points.count()
        assert {(r["strand"], r["start"]): r["kind"] for r in rows if r["chr"] == "1"} == want and all(r["kind"] == "intergenic" for r in rows if r["chr"] != "1")
        parts = sorted((r["strand"], r["a"], r["z"]) for r in M.segments(frame, width).collect())
        assert all(x[0] != y[0] or x[2] < y[1] for x, y in zip(parts, parts[1:]))


def test_states_add_up_in_any_grouping(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.choice((0.5, 3.0, 9.0, None)), rng.choice((0.0, round(rng.random(), 1), None, float("nan"))), i % 5) for i in range(200)]
    shares = [(i, n, rng.random(), i % 5) for i in range(0, 200, 2) for n in rng.sample(range(22, 40), 6)] + [(1, 30, None, 1)]
    transcripts = spark.createDataFrame(rows, "transcript_id long, fpkm double, score double, run int")
    lengths = spark.createDataFrame(shares, "transcript_id long, rpf int, fraction double, run int")
    whole = R.run_state(transcripts, lengths)
    for k in range(5):
        R.write_state(R.run_state(transcripts.where(F.col("run") == k), lengths.where(F.col("run") == k)), str(tmp_path / "runs"), f"r{k}")
    R.write_state(R.run_state(transcripts.where("run = 2"), lengths.where("run = 2")), str(tmp_path / "runs"), "r2")  # a run again
    states = spark.read.parquet(str(tmp_path / "runs"))
    halves = R.merge_states(R.merge_states(states.where("run < 'r3'")).unionByName(R.merge_states(states.where("run >= 'r3'"))))
    table = lambda df: {(r["kind"], r["key"]): (round(r["a"], 9), r["b"]) for r in df.collect()}
    assert table(halves) == table(whole) and len(table(whole)) > 20
    known = [(f, s) for _, f, s, _ in rows if f is not None and s is not None and s == s]
    yes, no = [s for f, s in known if f >= 3], [s for f, s in known if f < 3]
    got = R.summary(halves).first()
    wins = sum((a > b) + (a == b) / 2 for a in yes for b in no) / len(yes) / len(no)
    place = 0.95 * (len(no) - 1)
    lo, hi = sorted(no)[int(place)], sorted(no)[min(int(place) + 1, len(no) - 1)]
    assert (got["translated"], got["other"], got["auc"], got["threshold"]) == (len(yes), len(no), round(wins, 6), round(lo + (hi - lo) * (place % 1), 6))
    for r in R.score_posteriors(halves).collect():
        s = r["score"]
        at, all_ = sum(x >= s for x in yes), sum(x >= s for x in yes + no)
        assert abs(r["posterior"] - (0 if s == 0 else 1 if s > max(yes) else at / all_)) < 1e-12
    ref = {r["rpf"]: r["ref"] for r in R.reference_lengths(halves).collect()}
    n = len({t for t, _, f, _ in shares if f is not None})
    assert sorted(ref) == list(range(24, 37)) and all(abs(v - sum(f for _, m, f, _ in shares if m == k and f is not None) / n) < 1e-9 for k, v in ref.items())
    floss = {r["transcript_id"]: r["floss"] for r in R.full_floss(lengths, R.reference_lengths(halves)).collect()}
    for t in (0, 2, 198):
        own = {m: f for u, m, f, _ in shares if u == t}
        assert abs(floss[t] - sum(abs(own.get(k, 0) - v) for k, v in ref.items()) / 2) < 1e-6
    empty = R.run_state(transcripts.where("false"), lengths.where("false"))
    assert R.summary(empty).first()["auc"] is None and R.score_posteriors(empty).count() == 0 and R.full_floss(lengths.where("false"), R.reference_lengths(empty)).count() == 0


def test_protein_lists(spark):
    groups = spark.createDataFrame([(1, "B;A;C;A", "3;3;2;1"), (2, "X; A ;;", "1;1"), (3, None, None), (4, "A;B", "x;"), (5, "CON__A;A", "2;2")], "group_id long, proteins string, counts string")
    known = spark.createDataFrame(
        [("A", "TrEMBL+SwissProt", "aTIS", "", "11", "g1", "t1"), ("B", "Ribo+Abc", "CDS", "s1", "10", None, ""), ("C", "Ribo", "ntr", "", "01", "g3", "t3")],
        "accession string, source string, annotation string, snp_id string, bincode string, gene_id string, transcript_id string",
    )
    text = spark.createDataFrame([("t1", "5' end"), ("t9", "x")], "transcript_id string, description string")
    got = {r["group_id"]: tuple(r)[1:] for r in L.max_proteins(groups, known, text).collect()}
    assert got == {
        1: ("SwissProt+TrEMBL+Abc+Ribo", "B|A", "CDS|aTIS", "s1|", "10|11", "|g1", "5 end"), 2: ("SwissProt+TrEMBL", "X|A", "|aTIS", "|", "|11", "|g1", "5 end"), 5: ("SwissProt+TrEMBL", "CON__A|A", "|aTIS", "|", "|11", "|g1", "5 end"),
    }
    assert {tuple(r) for r in L.list_sources(groups, "group_id", known).collect()} == {("SwissProt+TrEMBL+Abc+Ribo", 2), ("SwissProt+TrEMBL", 1)}


def test_annotated_database(spark, tmp_path):
    entries = spark.createDataFrame([("T2", 1, "G(2)", "Product", "MAAAK", 0, 5), ("T1", 1, "G1", None, "MK", 3, 9)], "transcript_id string, structure int, gene string, protein string, seq string, first int, last int")
    forms = spark.createDataFrame(
        [("T2", 1, "x|1", "SAV", "3|C;2|D", ""), ("T2", 1, "x2", "canonical form", "", None), ("T2", 1, "x3", "cut", "2|D", "1|2|"), ("T2", 1, "x4", "cut", "", "1|2|")],
        "transcript_id string, structure int, accession string, name string, simple string, complex string",
    )
    B.write_peff(B.peff_entries(entries, forms, 9606, "Homo Sapiens"), str(tmp_path / "db"), parts=2)
    files = sorted((tmp_path / "db").glob("part-*"))
    assert "".join(f.read_text() for f in files) == (
        ">gen:T1-1 \\PName= \\GName=G1 \\NcbiTaxId=9606 \\TaxName=Homo Sapiens \\Length=2  \\Proteoform=\nMK\n"
        ">gen:T2-1 \\PName=Product \\GName=G\\(2\\) \\NcbiTaxId=9606 \\TaxName=Homo Sapiens \\Length=5 \\VariantSimple=(1:2|D)(2:3|C) \\VariantComplex=(3:1|2|)  "
        "\\Proteoform=(x2|0-5||canonical form)(x4|0-5|3|cut)(x3|0-5|1,3|cut)(x\\|1|0-5|1,2|SAV)\nMAAAK\n"
    )
    lines = B.variant_lines(spark.createDataFrame([("T1", "5_A_C_0.5", None), ("T2", "", ""), ("T3", None, "7_AC_A_1.0")], "transcript string, snp string, indel string"))
    assert sorted(r["line"] for r in lines.collect()) == ["T1\t5_A_C_0.5\t", "T3\t\t7_AC_A_1.0"]


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    frame = lambda rows: spark.createDataFrame(rows, "id long, local_max int, filter string")
    B.register(frame([(1, 1, "none"), (2, 1, "canonical"), (None, 0, "lost")]), path)
    B.register(frame([(2, 3, "ccds"), (2, 3, "ccds"), (10, 5, None)]), path)
    B.register(frame([(2, 3, "ccds"), (10, 5, None)]), path)  # a job that is run again
    rows = B.read_registry(spark, path, kind=spark.range(1).schema["id"].dataType)
    assert sorted((r["id"], r["local_max"], r["filter"]) for r in rows.collect()) == [(1, 1, "none"), (2, 3, "ccds"), (10, 5, None)]
    B.export_registry(rows.select("id", "local_max", "filter"), str(tmp_path / "out"))
    text = [f.read_text().split("\n") for f in sorted((tmp_path / "out").glob("part-*"))]
    assert {t[0] for t in text if t[0]} == {"id\tlocal_max\tfilter"} and [x for t in text for x in t[1:] if x] == ["1\t1\tnone", "2\t3\tccds", "10\t5\t"]


def test_registry_files_follow_calls(spark, tmp_path):
    """A call writes a folder whatever the number of its ids."""
    path = tmp_path / "many"
    rows = spark.range(500).select("id", F.lit(1).alias("local_max"))
    for _ in range(2):
        B.register(rows.withColumn("local_max", F.col("id") + F.lit(_)), str(path))
    assert len([p for p in path.iterdir() if p.is_dir()]) == 2
    assert [tuple(r) for r in B.read_registry(spark, str(path)).agg(F.count("*"), F.sum(F.col("local_max") - F.col("id").cast("long"))).collect()] == [(500, 500)]


def test_frames_are_made_once(spark):
    """Calls that bring their sequence meet no join."""
    from ribolith.operators import orfcalls as O

    rows = spark.createDataFrame([(1, "ATG", "ATGAAATAA"), (2, "CTG", "ATGAAATAA"), (3, "ATG", None)], "k long, start_codon string, seq string")
    made = O.with_status(rows)
    assert {r["k"]: (r["status"], r["aa"]) for r in made.collect()} == {1: ("ok", "MK*"), 2: ("Unmatching_start_codon", "MK*"), 3: ("no_sequence", None)}
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
