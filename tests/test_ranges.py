"""Ranks over ranges, parts of equal size, structures and coherence against plain computations."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ribolith.operators import genemodel, quality, ranges
from ribolith.operators.ranges import running
from ribolith.sources.files import read_alignments, split_parts


def test_running_sums(spark):
    rng = random.Random(1)
    rows = list({round(rng.gauss(0, 50), 3): rng.randint(0, 9) for _ in range(3000)}.items()) + [(None, 5)]
    df = spark.createDataFrame(rows, "x double, v long").repartition(5)
    for up in (True, False):
        got = {r["x"]: r["s"] for r in running(df, "x", {"s": F.col("v")}, ascending=up).collect() if r["x"] is not None}
        total = 5 if up else 0
        for x, v in sorted((r for r in rows if r[0] is not None), reverse=not up):
            assert got[x] == total
            total += v
    names = spark.createDataFrame([(f"P{i:04d}", 1) for i in range(500)], "x string, v long")
    assert [r["s"] for r in running(names, "x", {"s": F.col("v")}).orderBy("x").collect()] == list(range(500))


def test_texts_with_a_long_common_start_make_many_ranges(spark):
    rows = spark.range(20_000).select(F.format_string("ENST%020d", (F.col("id") * 7_919) % 20_000).alias("x"), F.lit(1).alias("v"))
    cuts = ranges._cuts(rows, "x")
    assert len(cuts) == ranges.RANGES - 1
    at = [sum(c < f"ENST{i:020d}" for c in cuts) for i in range(0, 20_000, 7)]
    assert max(map(at.count, set(at))) < 5 * len(at) / ranges.RANGES
    got = [(r["x"], r["s"]) for r in running(rows, "x", {"s": F.col("v")}).where("s % 997 = 0").collect()]
    assert got and all(x == f"ENST{s:020d}" for x, s in got)
    odd = spark.createDataFrame([("",), ("é",), (None,), ("a",), ("ab",), ("Z",)], "x string")
    assert [r["x"] for r in running(odd, "x", {"s": F.lit(1)}).orderBy("s").collect()] == [None, "", "Z", "a", "ab", "é"]


def test_parts_of_many_wide_rows(spark):
    df = spark.range(600_000).select(((F.col("id") * 7_919) % 600_000).alias("key"), F.repeat(F.lit("x"), 192).alias("wide")).repartition(16)
    got = split_parts(df, 5, "key").groupBy("part").agg(F.count("*"), F.min("key"), F.max("key")).orderBy("part").collect()
    assert [tuple(r) for r in got] == [(p + 1, 120_000, p * 120_000, (p + 1) * 120_000 - 1) for p in range(5)]
    few = split_parts(spark.range(7).withColumnRenamed("id", "key"), 3, "key").groupBy("part").count().orderBy("part").collect()
    assert [tuple(r) for r in few] == [(1, 3), (2, 2), (3, 2)]


def test_structures_equal_a_search(spark):
    rng = random.Random(2)
    rows = [(i, i % 7, rng.randrange(30), rng.randrange(30)) for i in range(300)]
    got = {r["orf_id"]: r["structure"] for r in genemodel.structure_groups(spark.createDataFrame(rows, "orf_id long, transcript_id long, start long, stop long")).collect()}
    for i, t, a, z in rows:
        seen, todo = {i}, [(a, z)]
        while todo:
            a, z = todo.pop()
            for j, u, b, y in rows:
                if u == t and j not in seen and (a == b or z == y):
                    seen.add(j)
                    todo.append((b, y))
        assert got[i] == min(seen)


def test_coherence_of_periodic_and_flat_profiles(spark):
    rng = np.random.default_rng(3)
    rows = [(1, [8.0, 2.0, 2.0] * 30), (2, [0.0, 5.0, 1.0] * 30), (3, rng.poisson(4, 90).astype(float).tolist()), (4, [1.0] * 10), (5, [0.0] * 60)]
    got = {r["transcript_id"]: r for r in quality.coherence(spark.createDataFrame(rows, "transcript_id long, profile array<double>")).collect()}
    assert math.isclose(got[1]["mean"], 1.0, abs_tol=1e-6) and math.isclose(got[1]["whole"], 1.0, abs_tol=1e-6) and got[1]["phase"] == 0
    assert got[2]["phase"] == 1 and got[3]["mean"] < 0.9 and got[4]["mean"] is None and got[5]["whole"] == 0.0


def test_floss_cutoff_follows_a_parabola(spark):
    rows = [(float(n), 0.1 + 0.05 * math.log10(n) ** 2) for n in range(10, 400)]
    got = quality.floss_cutoff(spark.createDataFrame(rows, "mean_reads double, extreme double")).collect()
    assert len(got) == 390 and all(abs(r["cutoff"] - 0.1 - 0.05 * math.log10(r["nreads"]) ** 2) < 2e-3 for r in got)


def test_long_md_tags_are_read_whole(spark, tmp_path):
    md = "10A" * 5000 + "3"
    (tmp_path / "x.sam").write_text("@HD\n" + "\t".join(["r", "0", "1", "5", "255", "10M", "*", "0", "0", "ACGT", "IIII", "NH:i:1", "HI:i:1", f"MD:Z:{md}"]) + "\n")
    assert read_alignments(spark, str(tmp_path / "x.sam")).first()["md"] == md
