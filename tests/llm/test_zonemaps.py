"""Clusters over zone maps against their SQL and plain rounds."""

import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ribolith.llm import zonemaps

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def by_sql(df):
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    return sorted(con.execute(zonemaps.ORACLE).df()[COLUMNS].values.tolist())


def own(df):
    return sorted(df.select(*COLUMNS).toPandas().values.tolist())


def test_report_equals_sql(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert own(zonemaps.report(df)) == by_sql(df)


def test_odd_vectors(spark):
    """Vectors that take no part, repeated rows and ids, ties, fewer vectors than centroids, columns with clashing names."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 0.2, (30, 64))
    rows = [(i % 25, x[i // 2].tolist(), i, "p") for i in range(60)]
    rows += [(200, None, 1, "a"), (201, [1.0] * 63, 1, None), (202, [float("nan")] * 64, 1, "a"), (203, [None] * 64, 1, "a"), (None, [0.0] * 64, 1, "a"), (204, [float("inf")] * 64, None, "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, place string")
    got = own(zonemaps.report(df))
    assert len(got) == 60 and got == by_sql(df)
    few = df.where("vec_id < 3")
    assert own(zonemaps.report(few)) == by_sql(few)
    assert zonemaps.report(df.where("false")).count() == 0


def test_a_third_of_the_rows_alike(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(0, 0.1, 64) if i % 3 else np.full(64, 0.25)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert own(zonemaps.report(df)) == by_sql(df)


def test_components_too_large_stop_the_job(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        zonemaps.report(df).count()


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_neighbours(dims, bits):
    """Each cell is visited once, and consecutive cells differ by one in one component."""
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = [bytes(k) for k in zonemaps.curve(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_boxes_leave_out_only_far_centroids(monkeypatch):
    """In clustered data some centroids go, and never one that is nearest to a vector, ties included."""
    monkeypatch.setattr(zonemaps, "BLOCK", 32)
    rng = np.random.default_rng(3)
    centres = rng.integers(-60, 60, (8, 6))
    v = np.repeat(centres, 64, axis=0) + rng.integers(-3, 4, (512, 6))
    batch = next(iter(zonemaps.blocks([pa.RecordBatch.from_arrays([pa.array(np.arange(512)), pa.array(v.tolist(), pa.list_(pa.int64()))], names=["vec_id", "v"])])))
    c = np.concatenate([centres, centres[:2]])  # two centroids twice: ties
    low, high = (np.array(batch.column(n).to_pylist()) for n in ("low", "high"))
    ok = zonemaps.candidates(low, high, c)
    assert ok.mean() < 0.5
    found = np.concatenate([own_ for _, own_, _ in zonemaps.assigned(batch, c)])
    d = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    assert (found == d.argmin(axis=1)).all()


def test_first_centroids(spark):
    df = spark.createDataFrame([(i, [float(i)] * 2) for i in range(50)], "vec_id long, embedding array<float>")
    order = sorted(range(50), key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())[:5]
    assert zonemaps.first_centroids(df, 2, 1, 5)[:, 0].tolist() == order
