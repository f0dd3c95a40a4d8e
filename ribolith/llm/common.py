"""Small helpers shared by the training-data operators: table access, staging, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs without ASCII white space; ``bytes.split()`` cuts at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; without it a job fails before it writes anywhere else."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return path


class Stage:
    """Tables written to the shared folder to cut lineage; `drop` removes those that are no longer read.

    A written table survives the loss of executors. Shuffle files of the writing query are released when it ends, so
    that a job of many steps holds the disk of one step only.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.made = 0

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.made}"
        self.made += 1
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """Connected components of the undirected `edges` (a, b: long): rows (node, root), root the smallest node reached.

    Alternating large-star and small-star steps: every node links its larger neighbours, then its smaller ones, to the
    smallest node it sees, which halves path lengths. The smallest neighbour comes from a partial aggregate and a join,
    so a node with very many neighbours is never gathered into one task. Each round is written to the shared folder.
    """

    def to_smallest(pairs: DataFrame, keep) -> DataFrame:
        least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return pairs.join(least, "a").where(keep)

    now = stage.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = to_smallest(both, F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        kept = to_smallest(large, F.lit(True))
        small = kept.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            kept.select("a", F.col("m").alias("b"))
        )
        after = stage.write(small.distinct())
        stage.drop(now)
        now = after
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(seen)


def with_arrow(df: DataFrame, source: str, name: str, kind, fn, keep_source: bool = True, rows: int = 256) -> DataFrame:
    """`df` with column `name` of type `kind`, made by ``fn(column: pyarrow.Array) -> pyarrow.Array`` from column `source`.

    `fn` runs in the executors on slices of at most `rows` rows, so memory follows the slice and not the Arrow batch. A
    column that has the new name already is replaced.
    """
    from pyspark.sql import types as T

    kept = [f for f in df.schema.fields if f.name != name and (keep_source or f.name != source)]
    schema = T.StructType([*kept, T.StructField(name, kind)])
    names = [f.name for f in kept]

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                part = whole.slice(at, rows)
                made = fn(part.column(source))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), made], names=[*names, name])
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Gives a Python worker's free memory back at the end of a task, as workers live on beside the next stage's tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def free_names(columns: list):
    """A function that turns a name into one that `columns` lack."""
    taken = {c.lower() for c in columns}
    return lambda x: next(n for k in range(len(taken) + 1) if (n := f"__{x}{k or ''}") not in taken)


def as_bytes(column) -> list:
    """The UTF-8 bytes of an Arrow string column, nulls as b''."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
