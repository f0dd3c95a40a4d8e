"""Running sums over intervals against plain loops, and on crowded places where pairs of points and intervals are many."""

import random

from pyspark.sql import functions as F

from ribolith.operators import counts as C
from ribolith.operators import expression as E
from ribolith.operators import intervals as J
from ribolith.operators import quality as Q
from ribolith.operators import variants as V


def _made(spark):
    r = random.Random(7)
    points = [(r.choice(["1", "2", None]), r.choice([1, -1]), r.choice([None, *range(60)]), r.randint(1, 9)) for _ in range(300)]
    spans = [(i % 35, r.choice(["1", "2", None]), r.choice([1, -1]), a, None if a % 17 == 0 else a + r.randint(-3, 25)) for i in range(120) for a in [r.randint(-5, 60)]]
    inside = lambda p, s: None not in (p[0], p[2], s[4]) and p[:2] == s[1:3] and s[3] <= p[2] <= s[4]
    return points, spans, inside, spark.createDataFrame(points, "chr string, strand int, start long, cnt long"), spark.createDataFrame(spans, "id long, chr string, strand int, a long, b long")


def test_sums_inside_intervals_equal_a_plain_loop(spark):
    points, spans, inside, p, s = _made(spark)
    want = {}
    for x in spans:
        for y in points:
            if inside(y, x):
                n, c = want.get(x[0], (0, 0))
                want[x[0]] = (n + 1, c + y[3])
    for width in (1, 7, 1000):
        rows = J.totals_in(p, s, "start", "a", "b", {"n": F.lit(1), "c": F.col("cnt")}, ["id"], width=width).collect()
        assert {r["id"]: (r["n"], r["c"]) for r in rows if r["n"]} == want


def test_intervals_over_points_equal_a_plain_loop(spark):
    points, spans, inside, p, s = _made(spark)
    want = sorted(str((*y, sum(inside(y, x) for x in spans), sum(x[0] for x in spans if inside(y, x)))) for y in points)
    for width in (1, 7, 1000):
        rows = J.covers(p, s, "start", "a", "b", {"n": F.lit(1), "ids": F.col("id")}, width=width).collect()
        assert sorted(str(tuple(r)) for r in rows) == want


def test_crowded_places_make_no_pairs(spark):
    """40,000 intervals that all hold 40,000 positions: 1.6 billion pairs, none of which is made."""
    n = 40_000
    points = spark.range(n).selectExpr("1L chr", "1 strand", "1000 + id % 500 start", "id % 3 rpf", "2L cnt")
    spans = spark.range(n).selectExpr("id feature_id", "1L chr", "1 strand", "id % 900 feature_start", "1600 + id feature_end")
    counted = C.feature_counts(points, spans).agg(F.min("counts_n"), F.max("counts_n"), F.max("counts_sum"), F.count("*")).first()
    assert tuple(counted) == (n, n, 2 * n, n)
    shares = C.length_fractions(points, spans).agg(F.count("*"), F.sum("reads"), F.round(F.max("fraction"), 4)).first()
    assert tuple(shares) == (3 * n, 2 * n * n, 0.3334)
    assert [r["reads"] for r in C.metagenic(points, spans.selectExpr("*", "'x' kind", "0 priority")).collect()] == [2 * n]
    found = spark.range(n).selectExpr("1L chr", "1000 + id % 500 pos", "cast(id as string) ref", "'A' alt")
    assert V.per_transcript(found, spans).agg(F.min("n"), F.max("n")).first() == (n, n)
    assert V.guard(found, spans, n - 1).count() == 0 and V.guard(found, spans, n).count() == n


def test_frames_of_a_crowded_place(spark):
    n = 3_000
    exons = spark.range(n).selectExpr("id transcript_id", "1L chr", "if(id % 2 = 0, 1, -1) strand", "1 rank", "10 + id % 3 exon_start", "39 + id % 3 exon_end")
    psite = spark.createDataFrame([(1, s, p, 28, 1) for s in (1, -1) for p in (15, 16, 17, 18)], "chr long, strand int, start long, rpf long, cnt long")
    want = [0, 0, 0]
    for s in (1, -1):
        for p in (15, 16, 17, 18):
            for i in range(n):
                if (1 if i % 2 == 0 else -1) == s:
                    want[((p - 10 - i % 3) if s == 1 else (39 + i % 3 - p)) % 3] += 1
    assert [tuple(r) for r in C.phase_by_length(psite, exons).collect()] == [(28, *want)]


def test_methylation_without_values(spark):
    sites = spark.createDataFrame([(1, 5, None), (1, 6, 0.1), (1, 6, 0.2), (1, 50, None)], "chr long, start long, cnt double")
    spans = spark.createDataFrame([(1, 1, 0, 10), (2, 1, 40, 60), (3, 1, 70, 80)], "feature_id long, chr long, feature_start long, feature_end long")
    assert sorted(map(tuple, E.methylation(sites, spans).collect())) == [(1, 0.3, 3), (2, None, 1)]


def test_local_maxima_of_short_exons_equal_a_plain_loop(spark):
    r = random.Random(3)
    exons, points = [], [("1", s, p, r.randint(1, 4)) for s in (1, -1) for p in range(0, 9000) if r.random() < 0.7]
    for t in range(60):
        at = r.choice([r.randint(0, 300), r.randint(4000, 4090)])
        strand = r.choice([1, -1])
        parts = []
        for _ in range(r.randint(1, 4)):
            z = at + r.choice([0, 1, 3, 5, 6, 11, 12, 13, 40])
            parts.append((at, z))
            at = z + r.randint(1, 9)
        exons += [(t, "1", strand, k if strand == 1 else len(parts) + 1 - k, *p) for k, p in enumerate(parts, 1)]
    want, count = [], {(s, p): n for _, s, p, n in points}
    for t in range(60):
        own = sorted((x for x in exons if x[0] == t), key=lambda x: x[3])
        bases = [p for x in own for p in (range(x[4], x[5] + 1) if x[2] == 1 else range(x[5], x[4] - 1, -1))]
        line = {i: count[own[0][2], p] for i, p in enumerate(bases, 1) if (own[0][2], p) in count}
        want += [(t, i, n) for i, n in line.items() if n >= max(line.get(i + d, 0) for d in range(-3, 4))]
    p = spark.createDataFrame(points, "chr string, strand int, start long, cnt long")
    e = spark.createDataFrame(exons, "transcript_id long, chr string, strand int, rank int, exon_start long, exon_end long")
    assert sorted(map(tuple, C.local_maxima(p, e).collect())) == sorted(want)


def test_profile_is_as_long_as_the_transcript(spark):
    hits = spark.createDataFrame([(1, 2, 5), (1, 60_000, 7)], "transcript_id long, cdna long, cnt long")
    sizes = spark.createDataFrame([(1, 60_001), (2, 3)], "transcript_id long, length long")
    rows = Q.profiles(hits, sizes).collect()
    assert [r["transcript_id"] for r in rows] == [1] and len(rows[0]["profile"]) == 60_001
    assert {i: v for i, v in enumerate(rows[0]["profile"], 1) if v} == {2: 5.0, 60_000: 7.0}


def test_overlapping_pairs_come_once(spark):
    spans = spark.createDataFrame([(1, "1", 1, 0, 9000), (2, "1", 1, 500, 8000), (3, "1", 1, 8001, 8002)], "id long, chr string, strand int, a long, b long")
    other = spans.withColumnRenamed("id", "other")
    for unique in (True, False):
        assert sorted(map(tuple, J.overlaps(spans, other, "id", "other", "a", "b", unique=unique).where("id < other").collect())) == [(1, 2), (1, 3)]
    assert "HashAggregate" not in J.overlaps(spans, other, "id", "other", "a", "b", unique=True)._jdf.queryExecution().executedPlan().toString()
