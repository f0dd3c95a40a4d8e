"""Approximate nearest neighbours: NN-descent builds a graph by iterative joins, queries search it greedily.

Equal vectors are one node with its smallest ids, so a very common vector is one node. The graph starts from small groups of
nodes that share the signs of random projections. Then, in each round, the neighbours of every node in either direction are
brought together with their vectors (a join), compared pairwise, and each pair that beats the worst neighbour of one of
its ends is proposed to that end; a window keeps the best. Rounds end when few neighbours change.

A query starts at its own node. In each round the best nodes of its beam that are not expanded yet are joined with their
neighbours in either direction, and the beam keeps the best, until all of it is expanded. The whole beam is then scored by cosines of
the original vectors in double precision.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.llm.common import Stage
from ribolith.llm.vectors import matrix, one_each, usable

#: Neighbours of a node; groups of the start and their size; the share of changes that ends the rounds.
NEIGHBOURS, STARTS, GROUP, ENOUGH = 36, 4, 60, 0.01
#: Beam of a query, whatever the number of nodes, so that what the queries meet grows about as they do; the part of it that a round expands.
BEAM, EXPAND = 100, 4
#: Lists that are compared at once in a task.
SLICE = 64


def _top(rows: DataFrame, key: str, by: list, n: int) -> DataFrame:
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(*by))).where(F.col("__r") <= n).drop("__r")


def make_nodes(df: DataFrame, members: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, embedding, vec: unit vector in single precision) and members (node, vec_id, n-th smallest at most)."""
    rows = one_each(usable(df)).where(F.exists("embedding", lambda x: x != 0))
    # Ids of a very common vector are cut down in salted parts before they meet.
    part = Window.partitionBy("embedding", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    some = rows.withColumn("r", F.row_number().over(part)).where(F.col("r") <= members).drop("r")
    whole = Window.partitionBy("embedding")
    ranked = some.withColumn("node", F.min("vec_id").over(whole)).withColumn("r", F.row_number().over(whole.orderBy("vec_id")))
    ranked = ranked.where(F.col("r") <= members)

    def unit(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            m = matrix(b.column("embedding"))
            m = m / np.maximum(np.abs(m).max(axis=1, keepdims=True), 1e-300)
            m = (m / np.linalg.norm(m, axis=1, keepdims=True)).astype("float32")
            signs = []
            for s in range(STARTS):
                planes = np.random.default_rng([17, s]).normal(size=(m.shape[1], 20))
                signs.append(((m @ planes > 0) << np.arange(20)).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("embedding"), pa.array([x.tobytes() for x in m], pa.binary()), pa.array(np.stack(signs, 1).tolist(), pa.list_(pa.int64()))],
                names=["node", "embedding", "vec", "signs"],
            )

    firsts = ranked.where("vec_id = node").select("node", "embedding")
    kind = dict(df.dtypes)["embedding"]
    return firsts.mapInArrow(unit, f"node long, embedding {kind}, vec binary, signs array<long>"), ranked.select("node", "vec_id")


def compare(lists: DataFrame) -> DataFrame:
    """Proposals (a, b, sim) from lists of (id, vec, worst, fresh): all pairs with a fresh end that beat `worst` of a."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                column = whole.slice(at, SLICE).column("items")
                flat = column.flatten()
                ids, fresh = flat.field("id").to_numpy(), flat.field("fresh").to_numpy(zero_copy_only=False)
                worst = flat.field("worst").to_numpy()
                vec = np.frombuffer(b"".join(flat.field("vec").to_pylist()), "float32").reshape(len(ids), -1)
                a, b, sims, start = [], [], [], 0
                for n in column.value_lengths().to_pylist():
                    s = slice(start, start + n)
                    start += n
                    if n < 2:
                        continue
                    sim = vec[s] @ vec[s].T
                    good = (sim > worst[s][:, None]) & (fresh[s][:, None] | fresh[s][None]) & (ids[s][:, None] != ids[s][None])
                    i, j = np.nonzero(good)
                    a.append(ids[s][i])
                    b.append(ids[s][j])
                    sims.append(sim[i, j])
                if a:
                    a, b, sims = np.concatenate(a), np.concatenate(b), np.concatenate(sims)
                    order = np.lexsort((b, a))
                    a, b, sims = a[order], b[order], sims[order]
                    once = np.ones(len(a), bool)
                    once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                    yield pa.RecordBatch.from_arrays([pa.array(a[once]), pa.array(b[once]), pa.array(sims[once].astype("float32"))], names=["a", "b", "sim"])

    return lists.mapInArrow(run, "a long, b long, sim float")


def build_graph(nodes: DataFrame, stage: Stage, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Edges (a, b, sim) to about the nearest `neighbours` nodes of each node."""
    best = [F.desc("sim"), "b"]
    bits = max(0, min(20, math.floor(math.log2(max(1, nodes.count()) / GROUP * 1.5))) if nodes.count() > GROUP else 0)
    keyed = nodes.select("node", "vec", F.posexplode("signs").alias("s", "sign"))
    keyed = keyed.withColumn("sign", F.col("sign").bitwiseAND((1 << bits) - 1))
    # nodes of one sign are dealt into groups by a hash, so that a sign that very many share is not gathered
    size = keyed.groupBy("s", "sign").agg(F.count("*").alias("size"))
    keyed = keyed.join(size, ["s", "sign"]).withColumn("g", F.pmod(F.xxhash64("node", "s"), F.ceil(F.col("size") / GROUP)))
    item = F.struct(F.col("node").alias("id"), "vec", F.lit(-2.0).cast("float").alias("worst"), F.lit(True).alias("fresh"))
    lists = keyed.groupBy("s", "sign", "g").agg(F.collect_list(item).alias("items")).select("items")
    graph = stage.write(_top(compare(lists).distinct(), "a", best, neighbours).withColumn("fresh", F.lit(True)))
    worst = lambda g: g.groupBy("a").agg(F.count("*").alias("n"), F.min("sim").alias("w")).select(
        F.col("a").alias("node"), F.when(F.col("n") >= neighbours, F.col("w")).otherwise(-2.0).cast("float").alias("worst")
    )
    total = graph.count()
    while True:
        back = _top(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim", "fresh"), "a", best, neighbours)
        around = graph.select("a", "b", "fresh").unionByName(back.select("a", "b", "fresh"))
        around = around.groupBy("a", "b").agg(F.max("fresh").alias("fresh"))
        known = nodes.select("node", "vec").join(worst(graph), "node", "left").na.fill(-2.0, ["worst"])
        met = around.join(known, around["b"] == known["node"])
        item = F.struct(F.col("b").alias("id"), "vec", "worst", "fresh")
        lists = met.groupBy("a").agg(F.collect_list(item).alias("items")).select("items")
        old = graph.select("a", "b", "sim", F.lit(False).alias("fresh"))
        both = old.unionByName(compare(lists).withColumn("fresh", F.lit(True)))
        merged = both.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
        after = stage.write(_top(merged, "a", best, neighbours))
        stage.drop(graph)
        graph = after
        if graph.where("fresh").count() < ENOUGH * max(1, total):
            break
    return graph.select("a", "b", "sim")


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, stage: Stage) -> DataFrame:
    """Beams (q, b, sim) of the query nodes `queries` (q) after greedy search from their own nodes."""
    edges = stage.write(graph.select("a", "b").unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    vectors = nodes.select("node", "vec")
    wanted = stage.write(queries.join(vectors.withColumnRenamed("node", "q"), "q").select("q", F.col("vec").alias("qvec")))
    state = stage.write(wanted.select("q", F.col("q").alias("b"), F.lit(1.0).cast("float").alias("sim"), F.lit(False).alias("done")))
    while True:
        todo = _top(state.where("not done"), "q", [F.desc("sim"), "b"], max(1, BEAM // EXPAND)).select("q", F.col("b").alias("at"))
        reached = todo.join(edges.withColumnRenamed("a", "at"), "at").select("q", "b").distinct()
        new = reached.join(state.select("q", "b"), ["q", "b"], "left_anti")
        scored = _similar(new.join(wanted, "q").join(vectors.withColumnRenamed("node", "b"), "b").select("q", "b", "qvec", "vec"))
        hits = todo.select("q", F.col("at").alias("b"), F.lit(None).cast("float").alias("sim"), F.lit(True).alias("done"))
        seen = state.unionByName(hits).unionByName(scored.withColumn("done", F.lit(False)))
        seen = seen.groupBy("q", "b").agg(F.max("sim").alias("sim"), F.max("done").alias("done"))
        after = stage.write(_top(seen, "q", [F.desc("sim"), "b"], BEAM))
        stage.drop(state)
        state = after
        if state.where("not done").isEmpty():
            break
    return state.select("q", "b", "sim")


def _similar(pairs: DataFrame) -> DataFrame:
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "float32").reshape(b.num_rows, -1) for c in ("qvec", "vec"))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("b"), pa.array(np.einsum("ij,ij->i", x, y).astype("float32"))], names=["q", "b", "sim"])

    return pairs.mapInArrow(run, "q long, b long, sim float")


def nearest(df: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: about the k nearest by cosine of each row whose vec_id is divisible by `every`.

    Null, zero and non-finite vectors take no part; a vec_id that repeats counts once. Fewer rows than k give them all
    that are found.
    """
    stage = Stage(df.sparkSession, "nndescent")
    made, members = make_nodes(df.select("vec_id", "embedding"), k + 1)
    nodes, members = stage.write(made), stage.write(members)
    graph = build_graph(nodes, stage)
    own = one_each(usable(df.select("vec_id", "embedding").where(F.col("vec_id") % every == 0)))
    wanted = own.join(nodes.select("node", F.col("embedding").alias("e")), F.col("embedding") == F.col("e")).select(
        F.col("vec_id").alias("query_id"), F.col("node").alias("q")
    )
    wanted = stage.write(wanted)
    found = search(wanted.select("q").distinct(), nodes, graph, stage)
    exact = nodes.select("node", "embedding")
    pairs = found.select("q", "b").join(exact.withColumnRenamed("node", "q").withColumnRenamed("embedding", "x"), "q")
    pairs = pairs.join(exact.withColumnRenamed("node", "b").withColumnRenamed("embedding", "y"), "b")
    scored = cosines(pairs.select("q", "b", "x", "y"))
    rows = wanted.join(scored, "q").join(members.withColumnRenamed("node", "b"), "b").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def cosines(pairs: DataFrame) -> DataFrame:
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            x, y = matrix(b.column("x")), matrix(b.column("y"))
            d = min(x.shape[1], y.shape[1])
            dot = np.einsum("ij,ij->i", x[:, :d], y[:, :d])
            score = dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("b"), pa.array(score)], names=["q", "b", "score"])

    return pairs.mapInArrow(run, "q long, b long, score double")
