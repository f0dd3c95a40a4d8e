"""The vector searches against brute force, and the pipeline from end to end."""

import math

import numpy as np

from ribolith.llm import maxscore, nndescent

SCHEMA = "vec_id long, embedding array<float>, label int, score int"


def odd(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], 1, 1), (1, [1.0, 0.0], 1, 1), (2, [0.0, 1.0], 1, 1), (3, None, 1, 1), (4, [nan, 1.0], 1, 1), (5, [None, 1.0], 1, 1), (6, [0.0, 0.0], 1, 1), (None, [1.0, 1.0], 1, 1), (100, [1.0, 0.1], None, None), (100, [1.0, 0.1], None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], "float64")


def test_maxscore_is_exact(spark):
    ids, x = vectors(spark)
    v = np.floor(64 * x)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in maxscore.report(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).collect()}
    want = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = v @ v[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:20]
        want.update({(ids[i], k): (ids[j], int(s[j])) for k, j in enumerate(order, 1)})
    assert got == want


def test_maxscore_prunes_nothing_needed():
    rng = np.random.default_rng(1)
    v = rng.integers(-9, 9, (3000, 6)).astype("float64")
    ids = np.arange(3000)
    rows, found, score = maxscore.search_shard(ids, v, ids[:5], v[:5], 7)
    for n in range(5):
        s = v @ v[n]
        best = [j for j in np.lexsort((ids, -s)) if j != n][:7]
        assert list(found[rows == n]) == best and list(score[rows == n]) == [s[j] for j in best]


def test_odd_vectors(spark):
    rows = [(r["vec_id"], [math.floor(64 * x) for x in r["embedding"]]) for r in odd(spark).collect() if r["vec_id"] is not None and r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    want = []
    for q in sorted({i for i, _ in rows if i % 20 == 0}):  # every row counts, also those that repeat an id
        pairs = [(-sum(a * b for a, b in zip(v, w)), j) for i, v in rows if i == q for j, w in rows if j != q]
        want += [(q, k + 1, j, -s) for k, (s, j) in enumerate(sorted(pairs)[:20])]
    got = [tuple(r) for r in maxscore.report(odd(spark)).orderBy("query_id", "rank").collect()]
    assert got == want and len({r[0] for r in want}) == 2
    near = [tuple(r) for r in nndescent.nearest(odd(spark)).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in near] == [(0, 1, 1), (0, 2, 100), (0, 3, 2), (100, 1, 0), (100, 2, 1), (100, 3, 2)]
    assert math.isclose(near[1][3], 1 / math.sqrt(1.01), rel_tol=1e-6)
    none = spark.createDataFrame([], SCHEMA)
    assert maxscore.report(none).count() == nndescent.nearest(none).count() == 0


def test_nn_descent_recall(spark):
    ids, x = vectors(spark)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {(r["query_id"], r["vec_id"]) for r in nndescent.nearest(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).collect()}
    want = set()
    for i in np.flatnonzero(ids % 50 == 0):
        s = x @ x[i]
        want |= {(ids[i], ids[j]) for j in [j for j in np.lexsort((ids, -s)) if j != i][:5]}
    assert len(got & want) >= 0.95 * len(want)


def test_nn_descent_in_a_tight_cluster(spark):
    """A third of the vectors stand within a hundredth of one another."""
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (1200, 32))
    x[::3] = rng.normal(0, 1, 32) + rng.normal(0, 0.01, (400, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in nndescent.nearest(df, every=10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = {True: [], False: []}
    for q in range(0, 1200, 10):
        s = u @ u[q]
        s[q] = -2
        hits[q % 3 == 0].append(len(got[q] & set(np.argsort(-s)[:5].tolist())) / 5)
    assert np.mean(hits[True]) >= 0.95 and np.mean(hits[False]) >= 0.95


def test_beams_keep_their_size(spark, monkeypatch):
    """With 600 nodes a beam of 10 stays one of 10, and what queries score stays far from all pairs."""
    monkeypatch.setattr(nndescent, "BEAM", 10)
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(0, 1, (600, 16)))], "vec_id long, embedding array<double>")
    stage = nndescent.Stage(spark, "beams")
    nodes = stage.write(nndescent.make_nodes(df, 6)[0])
    queries = nodes.where("node % 20 = 0").select(nodes["node"].alias("q"))
    sizes = nndescent.search(queries, nodes, nndescent.build_graph(nodes, stage), stage).groupBy("q").count().collect()
    assert len(sizes) == 30 and {r["count"] for r in sizes} == {10}


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert 0 < len({r["doc_id"] for r in rows}) <= docs.count()
    assert set(docs.columns) < set(rows[0].asDict())
