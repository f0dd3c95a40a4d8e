"""Centroid clustering (Lloyd's rounds) over zone maps of vectors in the order of a Hilbert curve.

Vectors are sorted along the curve and cut into blocks of `BLOCK`, each with the least and greatest value of every component. In a
round the distances of a centroid to the nearest and farthest point of a block's box bound those to its vectors: a centroid whose
least distance is over the smallest greatest one can't be nearest to any of them, also not with a tie. Only the others are
compared with the block's vectors, exactly and in integers. Blocks are written once and read in each round; a round shuffles and
returns sums of `k` centroids.

Vectors that are null, of another length or hold null or non-finite components take no part, nor do null vec_ids. Repeated rows are vectors
of their own; of the first centroids equal hashes go by the vector. Fewer vectors than centroids start with as many
centroids; an empty table gives no rows. Components beyond +-2**27 after the scaling would leave 64-bit distances and stop the job.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ribolith.llm.common import Stage, release
from ribolith.llm.vectors import matrix, usable

#: Vectors of a block; bits of a component on the curve; vectors whose place on the curve is computed at once.
BLOCK, BITS, SLICE = 128, 3, 4096
LARGEST = 1 << 27
BLOCKS = "low array<int>, high array<int>, ids array<long>, vectors binary"


def curve(x, bits: int):
    """The places of the rows of `x` (integers of `bits` bits) on a Hilbert curve, as bytes that sort like them.

    The coordinates are turned into the transposed index by undoing excess work from the top bit down and a Gray code; the bits are then
    interleaved, the first component's first.
    """
    import numpy as np

    x = x.T.astype("uint32").copy()
    dims, n = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint32(q - 1)
        for i in range(dims):
            high = (x[i] & np.uint32(q)) > 0
            swap = np.where(high, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(n, "uint32"), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & np.uint32(q)) > 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    levels = np.arange(bits - 1, -1, -1, dtype="uint32")
    flat = (x.T[:, None, :] >> levels[None, :, None]) & np.uint32(1)  # row, bit, component
    return np.packbits(flat.reshape(n, bits * dims).astype("u1"), axis=1)


def placed(low, high):
    """Adds the place on the curve to batches of (vec_id, salt, v), with the components' range cut into 2**BITS cells."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        a, z = np.array(low, "float64"), np.array(high, "float64")
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                v = matrix(b.column("v"), "int64", len(low))
                cell = ((v - a) * (1 << BITS) / np.maximum(z - a, 1e-9)).clip(0, (1 << BITS) - 1).astype("uint32")
                keys = np.ascontiguousarray(curve(cell, BITS))
                made = pa.array([bytes(k) for k in keys], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("vec_id", "salt", "v")), made], names=["vec_id", "salt", "v", "place"])
        release()

    return run


def blocks(batches):
    """Blocks of rows (vec_id, v) that come in the order of the curve; the last of a task may be short."""
    import numpy as np
    import pyarrow as pa

    ids, rows, held = [], [], 0

    def cut(n):
        nonlocal ids, rows, held
        own, v = np.concatenate(ids), np.concatenate(rows)
        ids, rows, held = [own[n:]], [v[n:]], len(own) - n
        own, v = own[:n], v[:n]
        lists = lambda m: pa.array(m.tolist(), pa.list_(pa.int32()))
        groups = [v[i : i + BLOCK] for i in range(0, n, BLOCK)]
        return pa.RecordBatch.from_arrays(
            [
                lists(np.array([g.min(axis=0) for g in groups])), lists(np.array([g.max(axis=0) for g in groups])),
                pa.array([own[i : i + BLOCK] for i in range(0, n, BLOCK)], pa.list_(pa.int64())), pa.array([g.astype("<i4").tobytes() for g in groups], pa.binary()),
            ],
            names=["low", "high", "ids", "vectors"],
        )

    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            b = whole.slice(at, SLICE)
            ids.append(b.column("vec_id").to_numpy())
            rows.append(matrix(b.column("v"), "int64"))
            held += b.num_rows
            if held >= BLOCK:
                yield cut(held - held % BLOCK)
    if held:
        yield cut(held)
    release()


def zones(df: DataFrame, dims: int, scale: int, stage: Stage) -> DataFrame:
    """The blocks (low, high, ids, vectors) of all vectors of `dims` components that take part, written once."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    # the salt deals equal places, also of one vec_id, over tasks; it follows from the row's place in the input alone
    rows = usable(df).where(F.size("embedding") == dims).select("vec_id", F.xxhash64("vec_id", F.monotonically_increasing_id()).alias("salt"), v.alias("v"))
    far = F.exists("v", lambda x: F.abs(x) > LARGEST)
    rows = rows.withColumn("v", F.when(far, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(F.col("v")))
    part = lambda i: F.element_at("v", i + 1)
    ends = rows.agg(*(f(part(i)).alias(f"{n}{i}") for n, f in (("a", F.min), ("z", F.max)) for i in range(dims))).first()
    low, high = ([ends[f"{n}{i}"] or 0 for i in range(dims)] for n in "az")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.mapInArrow(placed(low, high), "vec_id long, salt long, v array<long>, place binary")
    ordered = keyed.repartitionByRange(parts, "place", "salt").sortWithinPartitions("place", "salt").select("vec_id", "v")
    return stage.write(ordered.mapInArrow(blocks, BLOCKS))


def candidates(low, high, centroids):
    """For each block the centroids that may be nearest to one of its vectors, ties included: a truth table (block, centroid)."""
    import numpy as np

    under, over = low[:, None, :] - centroids[None], centroids[None] - high[:, None, :]
    least = (np.maximum(np.maximum(under, over), 0) ** 2).sum(axis=2)
    most = (np.maximum(np.abs(under), np.abs(over)) ** 2).sum(axis=2)
    return least <= most.min(axis=1)[:, None]


def assigned(batch, centroids):
    """(vectors, cluster, squared distance) of each block of a batch."""
    import numpy as np

    dims = centroids.shape[1]
    chosen = candidates(matrix(batch.column("low"), "int64"), matrix(batch.column("high"), "int64"), centroids)
    for ok, raw in zip(chosen, batch.column("vectors")):
        v = np.frombuffer(raw.as_py(), "<i4").reshape(-1, dims).astype("int64")
        at = np.flatnonzero(ok)
        d = np.empty((len(v), len(at)), "int64")
        for j, c in enumerate(at):
            d[:, j] = ((v - centroids[c]) ** 2).sum(axis=1)
        best = d.argmin(axis=1)  # the first of equal ones, and so the smaller number
        yield v, at[best], d[np.arange(len(v)), best]


def sums(centroids):
    """Batches of blocks to each cluster's number of vectors and componentwise sums, a row for each that occurs in a task."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        k, dims = centroids.shape
        total, count = np.zeros((k, dims), "int64"), np.zeros(k, "int64")
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                for v, own, _ in assigned(whole.slice(at, 64), centroids):
                    count += np.bincount(own, minlength=k)
                    for c in np.unique(own):
                        total[c] += v[own == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])
        release()

    return run


def nearest(centroids):
    """Batches of blocks to rows (vec_id, cluster, distance)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                part = whole.slice(at, 64)
                found = list(assigned(part, centroids))
                own, d = (np.concatenate([f[i] for f in found]) for i in (1, 2))
                yield pa.RecordBatch.from_arrays([part.column("ids").flatten(), pa.array(own.astype("int32")), pa.array(d)], names=["vec_id", "cluster", "distance"])
        release()

    return run


def first_centroids(df: DataFrame, dims: int, scale: int, k: int):
    """The vectors of the `k` smallest hashes."""
    import numpy as np

    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    hashed = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).alias("h")
    rows = usable(df).where(F.size("embedding") == dims).select(hashed, v.alias("v")).orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], "int64").reshape(len(rows), dims)


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector after `rounds` rounds."""
    spark, stage = df.sparkSession, Stage(df.sparkSession, "zones")
    df = df.select("vec_id", "embedding")
    centroids = first_centroids(df, dims, scale, k)
    made = zones(df, dims, scale, stage)
    for _ in range(rounds if len(centroids) else 0):
        parts = made.mapInArrow(sums(centroids), "cluster int, n long, total array<long>")
        whole = parts.select("cluster", "n", F.posexplode("total").alias("i", "t")).groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("t").cast("decimal(38,0)")).alias("t"))
        for r in whole.collect():  # k * dims rows
            centroids[r["cluster"], r["i"]] = int(r["t"]) // r["n"]
    own = stage.write(made.mapInArrow(nearest(centroids), "vec_id long, cluster int, distance long"))
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    names = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    inertia = own.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(F.broadcast(names), "cluster")
    inertia = inertia.crossJoin(F.broadcast(own.agg(F.sum("distance").alias("inertia"))))
    return own.join(F.broadcast(inertia), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def report(df: DataFrame) -> DataFrame:
    return cluster(df)


def _oracle(rounds: int = 3) -> str:
    out = """
with recursive v0 as (
  select row_number() over () rid, vec_id, list_transform(embedding, lambda x: cast(floor(64 * x::double) as bigint)) v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as (
  select cast(row_number() over (order by sha256('1:' || vec_id), v) - 1 as integer) c, v from v0 qualify c < 16
)"""
    assign = """, d{k} as (
  select x.rid, x.vec_id, c.c, cast(list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) d from v0 x cross join c{k} c
), a{k} as (select rid, vec_id, c, d from d{k} qualify row_number() over (partition by rid order by d, c) = 1)"""
    move = """, s{k} as (
  select c, i, sum(t) t, count(*) n from (select a.c, unnest(range(64)) i, unnest(x.v) t from a{k} a join v0 x using (rid)) group by 1, 2
), c{m} as (
  select o.c, coalesce(m.v, o.v) v from c{k} o left join (
    select c, list(cast((t - ((t % n + n) % n)) // n as bigint) order by i) v from s{k} group by c) m on m.c = o.c
)"""
    for k in range(rounds):
        out += assign.format(k=k) + move.format(k=k, m=k + 1)
    out += assign.format(k=rounds)
    return out.replace("with recursive", "with", 1) + f"""
select a.vec_id, a.c as "cluster", a.d as distance, cast(sum(a.d) over (partition by a.c) as bigint) cluster_inertia, cast(sum(a.d) over () as bigint) inertia,
  sha256(array_to_string(c.v, ',')) centroid_sha256
from a{rounds} a join c{rounds} c on c.c = a.c
"""


ORACLE = _oracle()
