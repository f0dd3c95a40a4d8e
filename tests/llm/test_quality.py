"""The quality classifier: held-out labels, its updates against a plain version, odd inputs."""

import math
import zlib

import numpy as np

from ribolith.llm import quality
from ribolith.llm.words import token_hashes


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in quality.report(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for i, r in rows.items())
    known = [(rows[r["doc_id"]], r["quality"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    good, bad = ([x["score"] for x, q in known if q == k] for k in (1, 0))
    assert np.mean([s >= 0.7 for s in good]) > 0.99 and np.mean([s < 0.7 for s in bad]) > 0.85
    assert np.mean([np.mean(np.array(good) > s) for s in bad]) > 0.99


def test_scores_do_not_read_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "toxic", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end quality")
    first, second = (sorted((r["doc_id"], r["score"]) for r in quality.report(docs, x).collect()) for x in (labels, turned))
    assert first == second


def plain_updates(rows, passes):
    z, n, out = {}, {}, None

    def weight(i):
        x = z.get(i, 0.0)
        return 0.0 if abs(x) <= quality.L1 else -(x - math.copysign(quality.L1, x)) / ((quality.BETA + math.sqrt(n.get(i, 0.0))) / quality.ALPHA + quality.L2)

    for _ in range(passes):
        for places, values, y in rows:
            w = [weight(i) for i in places]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, values))))
            for i, v, wi in zip(places, values, w):
                g = (p - y) * v
                was = n.get(i, 0.0)
                n[i] = was + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(was)) / quality.ALPHA * wi
    return weight


def test_updates_equal_a_plain_version():
    texts = ["good words in a row", "bad!! bad!! words", "", "more good words here 12", "*** bad *** row"]
    rows = [(*quality.vector(t.encode()), int(k in (0, 3))) for k, t in enumerate(texts)]
    z, n = np.zeros(1 << quality.BITS), np.zeros(1 << quality.BITS)
    for _ in range(3):
        quality.learn(z, n, rows)
    w, want = quality.weights(z, n), plain_updates([(p.tolist(), v.tolist(), y) for p, v, y in rows], 3)
    used = sorted({i for p, _, _ in rows for i in p.tolist()})
    assert all(math.isclose(w[i], want(i), rel_tol=1e-9, abs_tol=1e-12) for i in used)
    assert np.flatnonzero(w).tolist() == [i for i in used if want(i)]


def test_vectors_do_not_depend_on_how_a_text_is_cut(monkeypatch):
    """Pieces that end at white space give the tokens of the whole; n-grams reach over them."""
    from ribolith.llm import words

    text = ("Some words, 12 and!! ümläut *** " * 40).encode()
    whole = quality.vector(text)
    monkeypatch.setattr(words, "SEGMENT", 64)
    assert len(list(token_hashes(text))) > 10
    cut = quality.vector(text)
    assert (whole[0] == cut[0]).all() and np.allclose(whole[1], cut[1])
    assert sum(map(len, token_hashes(b"x" * 1000))) >= 1 and math.isclose((whole[1][1:] ** 2).sum(), 1.0)


def test_odd_rows(spark, odd_docs, no_docs):
    marks = "doc_id long, quality int, toxic int, source string"
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, 0, 0, "x"), (3, None, 0, None), (None, 1, 1, "y"), (4, 1, 0, "z"), (4, 0, 0, "z"), (6, 0, 1, "y"), (5, 1, 0, "y")], marks)
    rows = quality.report(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (2, 3, 7)}
    assert len(empty) == 1  # nothing but the intercept
    none = spark.createDataFrame([], marks)
    assert {r["score"] for r in quality.report(odd_docs, none).collect()} == {0.5}
    assert {r["predicted"] for r in quality.report(odd_docs, labels.where("quality = 1")).collect()} == {1}
    assert quality.report(no_docs, labels).count() == quality.keep_good(no_docs, labels).count() == 0
    clash = odd_docs.withColumnRenamed("fp", "score").withColumnRenamed("node", "__score")
    kept = quality.keep_good(clash, labels.where("quality = 1"))
    assert kept.columns == clash.columns and kept.count() == clash.count()
