"""Mixing sources to target weights by cube-method balanced sampling.

A source with target r times its size (0 <= r <= 2) takes each document floor(r) times, and once more with probability
r - floor(r). The cube method turns these probabilities into decisions: the flight moves the vector of probabilities inside
the null space of the constraints (token total and document total), so both totals keep their expected values exactly,
until no more documents than constraints are fractional. Flights run in blocks of bounded size, side by side in Spark; the
few fractional documents that each block leaves meet in the next level's blocks. The landing decides the last ones of each
source, at most one block, by the rounding that is nearest to the token target, with a few exchanges inside that block.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.llm.common import WORD, Stage, free_names

WEIGHTS = (3, 1, 2)
#: Rows of a flight's block: its memory bound.
BLOCK = 2048
EPS = 1e-9
#: Decisions that a source's landing may exchange.
EXCHANGES = 8


def shares(sizes: dict, budget: float, most: float = 2.0, weights=WEIGHTS) -> dict:
    """Target by source: `budget` shared by weight, none above `most` times its size, the excess reshared by weight.

    Sources are ranked by code point, null last, and weigh `weights` in turn. A driver-side loop over the sources only.
    """
    ranked = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ranked)}
    target, open_, left = {}, set(ranked), float(budget)
    while open_:
        whole = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / whole > most * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / whole for s in open_}
        for s in full:
            target[s] = most * float(sizes[s])
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def flight(p, x, rng) -> None:
    """Moves probabilities `p` in place along null vectors of the constraint rows `x` until at most len(x) are fractional.

    Works on len(x) + 1 fractional units at a time, so its cost is linear in the number of units.
    """
    import numpy as np

    m = len(x)
    window, coming = [], iter(np.flatnonzero((p > EPS) & (p < 1 - EPS)))
    while True:
        while len(window) <= m and (i := next(coming, None)) is not None:
            window.append(i)
        if len(window) <= m:
            return
        u = _null(x[:, window])
        q = p[window]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = min(np.where(u > EPS, (1 - q) / u, np.inf).min(), np.where(u < -EPS, -q / u, np.inf).min())
            down = min(np.where(u > EPS, q / u, np.inf).min(), np.where(u < -EPS, (q - 1) / u, np.inf).min())
        q = q + u * up if rng.random() * (up + down) < down else q - u * down
        q[q < EPS], q[q > 1 - EPS] = 0.0, 1.0
        p[window] = q
        window = [i for i, v in zip(window, q) if 0.0 < v < 1.0]


def _null(a):
    """A unit vector that the 2 x 3 (or m x m+1) matrix `a` maps to zero."""
    import numpy as np

    if a.shape == (2, 3):
        u = np.cross(a[0], a[1])
        if np.abs(u).max() > 1e-12:
            return u / np.abs(u).max()
    return np.linalg.svd(a)[2][-1]


def _block(rows, last: bool, seed: int):
    """One block's flight; in the last level also its landing.

    Long documents stay fractional longest, so rounding them would miss the token target by up to half of one. The landing
    therefore goes on with a few exchanges of the last block's decisions, each the one that comes nearest to the target.
    The order and the chance depend on the rows alone, not on Spark.
    """
    import numpy as np

    rows = rows.sort_values(["size", "u", "copies"], ascending=False, kind="stable").reset_index(drop=True)
    p, size = rows["p"].to_numpy(copy=True), rows["size"].to_numpy("float64")
    rng = np.random.default_rng([seed, int(rows["u"].iloc[0]) & 0xFFFFFFFF, len(rows)])
    x = np.vstack([size / max(1.0, size.max()), np.ones(len(p))])
    expected, start = float(p @ size), p.copy()
    flight(p, x, rng)
    if last:
        flight(p, x[:1], rng)  # the document total is let go first
        for i in np.flatnonzero((p > 0) & (p < 1)):
            p[i] = 0.0
            p[i] = float(abs(p @ size + size[i] - expected) < abs(p @ size - expected))
        for _ in range(EXCHANGES if ((start > 0) & (start < 1)).all() else 0):
            gap = expected - float(p @ size)
            left = np.abs(gap - np.where(p == 0.0, size, -size))
            if left.min() >= abs(gap):
                break
            p[left.argmin()] = 1.0 - p[left.argmin()]
    rows["p"] = p
    return rows


def decide(units: DataFrame, stage: Stage, seed: int = 11) -> DataFrame:
    """Decides the fractional units (gid, u, size, copies, p): rows with p in {0, 1}. Groups are the sources' ids `gid`."""
    parts, now, level = [], units, 0
    while True:
        most = now.groupBy("gid").count().agg(F.max("count")).first()[0] or 0
        last = most <= BLOCK
        count = max(1, math.ceil(1.5 * most / BLOCK))
        block = F.lit(0) if last else F.pmod(F.xxhash64("u", F.lit(level)), F.lit(count)).cast("int")

        def run(rows, last=last, level=level):
            return _block(rows, last, seed + level)

        done = stage.write(now.withColumn("block", block).groupBy("gid", "block").applyInPandas(
            lambda rows: run(rows).drop(columns="block"), now.schema
        ))
        parts.append(done.where("p = 0 or p = 1"))
        if last:
            break
        now, level = done.where("p > 0 and p < 1"), level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix(df: DataFrame, share: float = 1.5, seed: int = 11) -> tuple[DataFrame, Stage]:
    """How often the mix takes each row: doc_id, th (the text's hash), dup (number among equal rows), source, size,
    source_size, target, copies.

    Size is the number of words; a null text has size 0. A source whose rows have no words has target 0 and its rows are
    never taken. Null doc_id and null source are values like any other, the null source ranks last. Repeated rows are
    decided one by one. Reruns agree, as all order and chance come from hashes of the rows.
    """
    spark, stage = df.sparkSession, Stage(df.sparkSession, "mix")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    thin = df.select("doc_id", "source", words.alias("size"), F.xxhash64("text").alias("th"))
    # Equal rows are counted first and numbered again afterwards, so that a row that repeats very often spreads over all blocks.
    thin = stage.write(thin.groupBy("doc_id", "source", "size", "th").agg(F.count("*").alias("rows")))
    sums = {r["source"]: int(r["n"] or 0) for r in thin.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("n")).collect()}
    targets = shares(sums, share * sum(sums.values()))
    order = list(targets)
    rows = [(i, s, int(sums[s]), float(targets[s])) for i, s in enumerate(order)]
    table = spark.createDataFrame(rows, "gid int, own_source string, source_size long, target double")
    known = thin.join(table, thin["source"].eqNullSafe(table["own_source"])).drop("own_source")
    known = known.withColumn("number", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("rows")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(ratio + EPS).cast("int")
    known = known.withColumn("copies", base).withColumn("p", F.greatest(ratio - base, F.lit(0.0)))
    known = known.withColumn("p", F.when(F.col("p") < EPS, 0.0).otherwise(F.col("p")))
    known = known.withColumn("u", F.xxhash64("doc_id", "th", "number", F.lit(seed))).drop("number")
    decided = decide(known, stage, seed)
    taken = decided.withColumn("copies", (F.col("copies") + F.col("p")).cast("int"))
    return taken.select("doc_id", "th", "source", "size", "source_size", "target", "copies"), stage


def report(df: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    taken, _ = mix(df.select("doc_id", "source", "text"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def apply_mix(df: DataFrame, share: float = 1.5) -> DataFrame:
    """The rows of `df`, each as often as the mix takes it; columns of any name are kept.

    Rows equal in doc_id, source and text are interchangeable: what the mix takes of them is dealt over them evenly. Whole rows
    move once, in the join with the thin plan; only where such rows exist they are numbered.
    """
    taken, stage = mix(df.select("doc_id", "source", "text"), share)
    name = free_names(df.columns)
    first, second, rows, copies, number, i = (name(x) for x in ("k1", "k2", "rows", "copies", "number", "i"))
    keys = F.xxhash64("doc_id", "th", "source"), F.xxhash64(F.lit(5), "source", "th", "doc_id")
    plan = taken.groupBy(keys[0].alias(first), keys[1].alias(second)).agg(F.count("*").alias(rows), F.sum("copies").alias(copies))
    plan = stage.write(plan.where(F.col(copies) > 0))
    th = F.xxhash64("text")
    marked = df.withColumn(first, F.xxhash64("doc_id", th, "source")).withColumn(second, F.xxhash64(F.lit(5), "source", th, "doc_id"))
    out = marked.join(plan, [first, second])
    if plan.where(F.col(rows) > 1).isEmpty():
        times = F.col(copies)
    else:
        out = out.withColumn(number, F.row_number().over(Window.partitionBy(first, second).orderBy(first)))
        times = F.floor(F.col(copies) / F.col(rows)) + F.when(F.col(number) <= F.col(copies) % F.col(rows), 1).otherwise(0)
    return out.withColumn(copies, times.cast("int")).where(F.col(copies) > 0).select(*df.columns, F.explode(F.sequence(F.lit(1), copies)).alias(i)).drop(i)
