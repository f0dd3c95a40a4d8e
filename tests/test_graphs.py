"""Components and structures of long chains, hubs and random links."""

import random

from pyspark.sql import functions as F

from ribolith.operators.genemodel import structure_groups, structure_order
from ribolith.operators.graphs import components


def test_components_equal_a_search(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {n: n for e in edges for n in e}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        group[b] = a
    assert got == {n: root(n) for n in group if n != 5000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def chain(spark, n):
    """Records of one transcript, each of which shares its start or its stop with the next; ids in no order along the chain."""
    i = F.col("id")
    return spark.range(n).select(((i * 7_919 + 13) % n).alias("orf_id"), F.lit(1).alias("transcript_id"), F.floor((i + 1) / 2).alias("start"), F.floor(i / 2).alias("stop"))


def test_long_chains_are_one_structure(spark):
    for n in (400, 100_000):
        assert [tuple(r) for r in structure_groups(chain(spark, n)).groupBy("structure").count().collect()] == [(0, n)]


def test_structures_with_nulls(spark):
    rows = [(1, 1, 5, 9, "CDS"), (2, 1, None, 9, "aTIS"), (3, 1, None, 7, "CDS"), (4, 2, 5, 9, "CDS"), (5, None, 5, 9, "CDS"), (6, 1, 8, 7, "CDS")]
    orfs = spark.createDataFrame(rows, "orf_id long, transcript_id long, start long, stop long, annotation string")
    made = structure_groups(orfs)
    assert {r["orf_id"]: r["structure"] for r in made.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 3}
    assert {(r["transcript_id"], r["structure"], r["members"], r["number"]) for r in structure_order(made).collect()} == {(1, 1, 2, 1), (1, 3, 2, 2), (2, 4, 1, 1), (None, 5, 1, 1)}


def test_short_chains_take_no_rounds(spark, monkeypatch):
    """Chains of some links are told within one deal of the rows; only longer ones need components."""
    from ribolith.operators import genemodel

    monkeypatch.setattr(genemodel, "components", None)
    rows = [(9, 1, 1, 1), (4, 1, 1, 2), (7, 1, 2, 2), (2, 1, 2, 3), (3, 1, 4, 4), (1, 2, 1, 1)]
    made = structure_groups(spark.createDataFrame(rows, "orf_id long, transcript_id long, start long, stop long"))
    assert {r["orf_id"]: r["structure"] for r in made.collect()} == {9: 2, 4: 2, 7: 2, 2: 2, 3: 3, 1: 1}
