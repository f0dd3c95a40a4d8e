"""Exact top-k inner-product search by MaxScore.

Each component is a query term, its posting list the shard's values of that component. A term's contribution q * v is
measured from its least value in the shard, so contributions are not negative and have a bound. A query's terms are
ordered by bound. Terms whose bounds together can't lift a vector over the query's k-th best score so far are
non-essential: the essential postings are traversed for all vectors of the shard, and the others are probed term by term for
those vectors that the remaining bounds still leave competitive. The shards' lists are merged by a window.

Shards and query blocks have bounded sizes and meet in all pairs, so that a task holds one of each.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.llm.vectors import matrix, usable

SHARD, BLOCK = 16384, 4096
#: Vectors of a shard that are scored in full first, for a first threshold.
FIRST = 512


def quantised(df: DataFrame, scale: int = 64) -> DataFrame:
    return usable(df).select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def search_shard(ids, v, query_ids, q, k: int):
    """The k best (query row, vector row, score) of each query in one shard, exactly; ties go to the smaller id.

    `v` and `q` hold integers as doubles; sums below 2**53 are exact.
    """
    import numpy as np

    order = np.argsort(ids, kind="stable")
    ids, postings = ids[order], np.ascontiguousarray(v[order].T)
    low, high = postings.min(axis=1), postings.max(axis=1)
    head = postings[:, :FIRST]
    out = []
    for n, (own, w) in enumerate(zip(query_ids, q)):
        least = np.minimum(w * low, w * high)
        bound = np.abs(w) * (high - low)
        terms = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0.0)  # bound of the terms from each place on
        floor = least.sum()
        sample = (w @ head)[ids[:FIRST] != own]
        threshold = np.partition(sample, -k)[-k] if len(sample) >= k else -np.inf
        split = int(np.searchsorted(-rest, floor - threshold, side="right")) if np.isfinite(threshold) else len(w)
        split = max(1, min(split, len(w)))  # terms[split:] alone can't reach the threshold
        score = (w[terms[:split]] @ postings[terms[:split]]) - least[terms[:split]].sum() + floor
        alive = np.flatnonzero((score + rest[split] >= threshold) & (ids != own))
        score = score[alive]
        for at in range(split, len(w)):
            t = terms[at]
            score = score + w[t] * postings[t, alive] - least[t]
            if len(alive) > 4 * k and at % 4 == 3:
                threshold = max(threshold, np.partition(score, -k)[-k])
                keep = score + rest[at + 1] >= threshold
                alive, score = alive[keep], score[keep]
        if len(alive) > k:
            cut = np.partition(score, -k)[-k]
            alive, score = alive[score >= cut], score[score >= cut]
        best = np.lexsort((ids[alive], -score))[:k]
        out.append((np.full(len(best), n), alive[best], score[best]))
    rows, cols, scores = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int),) * 3
    return rows, ids[cols], scores


def top_k(df: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best among the other rows of `df` (vec_id, v: array<long>).

    `queries` has the same columns. Fewer rows than k give them all; an empty table gives none.
    """
    spark = df.sparkSession
    shards = max(math.ceil(df.count() / shard), spark.sparkContext.defaultParallelism)
    blocks = max(1, math.ceil(queries.count() / block))
    left = df.withColumn("s", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    left = left.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("b", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    right = right.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(vectors, wanted):
        import pyarrow as pa

        ids, own = vectors["vec_id"].to_numpy(), wanted["vec_id"].to_numpy()
        if not len(ids) or not len(own):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        v, q = matrix(vectors["v"]), matrix(wanted["v"])
        width = max(v.shape[1], q.shape[1])
        v, q = matrix(vectors["v"], width=width), matrix(wanted["v"], width=width)
        rows, found, score = search_shard(ids, v, own, q, k)
        return pa.table({"query_id": own[rows], "vec_id": found, "score": score.astype("int64")})

    found = left.groupBy("s", "b").cogroup(right.groupBy("s", "b")).applyInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(df: DataFrame) -> DataFrame:
    """The 20 best of each row whose vec_id is divisible by 20, over all other rows."""
    rows = quantised(df.select("vec_id", "embedding"))
    return top_k(rows, rows.where("vec_id % 20 = 0"))


ORACLE = """
with rows_ as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) score
  from rows_ q join rows_ c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""
