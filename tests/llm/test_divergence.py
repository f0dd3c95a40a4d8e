"""Stripes of terms against their SQL and a plain count."""

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ribolith.llm import divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def by_sql(df):
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    return sorted(con.execute(divergence.ORACLE).df()[COLUMNS].values.tolist())


def own(df):
    return sorted(df.select(*COLUMNS).toPandas().values.tolist())


def test_report_equals_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert own(divergence.report(docs)) == by_sql(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    """Nulls count as '', repeated rows as documents; sources without kept terms and languages without any are there."""
    many = odd_docs.unionByName(odd_docs).unionByName(odd_docs).unionByName(odd_docs).unionByName(odd_docs)
    odd = spark.createDataFrame([(9, "Ünï " * k + "ÜNÏ A_b-c\x00d " * 9, "xx", s, 1, "f", 2) for k, s in enumerate(("p", "q", "é", ""))] * 4, many.schema)
    docs = many.unionByName(odd)
    got = own(divergence.report(docs))
    assert got == by_sql(docs) and {"pair", "term"} == {r[2] for r in got}
    assert {r[3] for r in got if r[2] == "term" and r[0] == "xx"} <= {"Ünï", "ÜnÏ", "a", "b", "c", "d"}
    assert divergence.report(no_docs).count() == 0


@pytest.mark.parametrize(("spill", "size"), [(1, 40), (200, 64), (10**6, 1 << 22)])
def test_folds_spill_and_merge(monkeypatch, spill, size):
    """Whatever the bounds, merged stripes are the plain counts; a text longer than a slice counts as one document."""
    monkeypatch.setattr(divergence, "SPILL", spill)
    monkeypatch.setattr(divergence, "SLICE", size)
    rng = np.random.default_rng(5)
    rows = [(" ".join(rng.choice(["Aa", "b", "cé", "d1d", "eee"], rng.integers(0, 60))), *rng.choice(["x", "y", "z"], 2)) for _ in range(80)]
    rows += [(None, None, "x"), ("one", None, None), ("b " * 500, "x", "y")]
    texts, langs, sources = (pa.array(list(c), pa.string()) for c in zip(*[tuple(None if x is None else str(x) for x in r) for r in rows]))
    made = pa.Table.from_batches(divergence.fold([pa.RecordBatch.from_arrays([texts, langs, sources], names=["text", "lang", "source"])]))
    made = made.sort_by([("lang", "ascending"), ("term", "ascending")])
    out = pa.Table.from_batches(divergence.merged_stripes(2)(iter(made.to_batches(max_chunksize=7))))
    held, times = Counter(), Counter()
    for text, lang, source in rows:
        words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        held.update({(lang or "", w) for w in words})
        times.update((lang or "", w, source or "") for w in words)
    got = {(r["lang"], r["term"]): (r["df"], dict(zip(r["sources"], r["counts"]))) for r in out.to_pylist()}
    assert len(got) == out.num_rows
    assert got == {k: (n, {s: c for (*g, s), c in times.items() if tuple(g) == k}) for k, n in held.items() if n >= 2}


def test_share_is_exact():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 9 * 10**15, 5000), rng.integers(1, 9 * 10**15, 5000)
    a %= b + 1
    assert divergence.share(a, b).tolist() == [10**9 * int(x) // int(y) for x, y in zip(a, b)]
