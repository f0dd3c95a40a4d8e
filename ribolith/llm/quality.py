"""Text quality by logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

A text's tokens are runs of letters, of digits and of other characters that are no white space; one and two tokens in a row are
hashed into 2**BITS weights, and a text is the unit vector of their counts. Training keeps for each weight the sum of its adjusted
gradients and of their squares, from which the weight follows, with few of them other than zero. Parts of the sample are trained
beside each other from the same state, one document after the other, and their states are averaged after each pass. A score is a
sparse dot product through the logistic function.

The sample: about `ROWS` labelled documents, chosen by a hash, of all whose checksum leaves a remainder other than 2 by 4. Null labels
and null doc_ids take no part, of labels that repeat a doc_id the largest counts. Null and empty texts are scored as such, by the
intercept. Without labels of both kinds each score is the share of good ones, or 0.5.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ribolith.llm.common import Stage, as_bytes, free_names, release, with_arrow
from ribolith.llm.langid import fold
from ribolith.llm.words import mixed, token_hashes

#: Bounds: weights (2 to this), labelled rows that are learnt from, parts that train beside each other, passes.
BITS, ROWS, PARTS, PASSES = 18, 32_000, 4, 4
#: Step size, its smoothing, and the penalties of absolute and squared weights.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.05
CUT = 0.7


def vector(text: bytes):
    """(places, values) of the unit vector of a text's n-grams; the intercept, at place 0, is 1."""
    import numpy as np

    key = np.uint64(64 - BITS)
    places, counts = np.zeros(0, "int64"), np.zeros(0, "int64")
    last = np.zeros(0, "uint64")
    for h in token_hashes(text):
        both = np.concatenate([last, h])
        pairs = mixed(both[:-1] * np.uint64(0x9E3779B97F4A7C15) + both[1:])
        last = h[-1:] if len(h) else last
        now, times = np.unique((np.concatenate([h, pairs]) >> key).astype("int64"), return_counts=True)
        places, counts = (now, times) if not len(places) else added(places, counts, now, times)
    values = counts / max(1.0, math.sqrt(float((counts.astype("float64") ** 2).sum())))
    kept = places > 0
    return np.append(0, places[kept]), np.append(1.0, values[kept])


def added(places, counts, more, times):
    import numpy as np

    out, own = np.unique(np.concatenate([places, more]), return_inverse=True)
    return out, np.bincount(own, np.concatenate([counts, times])).astype("int64")


def weights(z, n):
    """The weights that follow from the state."""
    import numpy as np

    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(z, n, rows) -> int:
    """Updates the state (z, n) by (places, values, label) of each row in turn; returns the number of rows."""
    import numpy as np

    seen = 0
    for places, values, label in rows:
        zi, ni = z[places], n[places]
        w = weights(zi, ni)
        g = (1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ values))))) - label) * values
        step = np.sqrt(ni + g * g)
        z[places] = zi + g - (step - np.sqrt(ni)) / ALPHA * w
        n[places] = ni + g * g
        seen += 1
    return seen


def train(z, n):
    """The function that trains from the state (z, n) on sorted rows (part, text, label) and returns a state for each part."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        part, state, seen = None, None, 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, seen, state[0].tobytes(), state[1].tobytes())], schema=pa.schema([("part", pa.int32()), ("seen", pa.int64()), ("z", pa.binary()), ("n", pa.binary())]))

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                for own, text, label in zip(b.column("part").to_pylist(), as_bytes(b.column("text")), b.column("label").to_pylist()):
                    if own != part:
                        if part is not None:
                            yield done()
                        part, state, seen = own, (np.array(z), np.array(n)), 0
                    seen += learn(*state, [(*vector(text), label)])
        if part is not None:
            yield done()
        release()

    return run


def fit(docs: DataFrame, labels: DataFrame, stage: Stage, rows: int = ROWS):
    """The weights; a place for each hash, the intercept at place 0."""
    import numpy as np

    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    known = docs.where(fold(4) != 2).select("doc_id", "text").join(marks.hint("merge"), "doc_id")
    u = F.xxhash64("doc_id", F.lit(12))
    known = stage.write(known.select("text", F.col("label").cast("int"), u.alias("u"), F.pmod(F.shiftright(u, 20), F.lit(PARTS)).cast("int").alias("part")))
    total, good = known.agg(F.count("*"), F.coalesce(F.sum((F.col("label") > 0).cast("int")), F.lit(0))).first()
    w = np.zeros(1 << BITS)
    if 0 < good < total:
        sample = known.where(F.pmod("u", F.lit(1_000_000)) < 1_000_000 * min(1.0, rows / total)).select("part", "u", "text", (F.col("label") > 0).cast("int").alias("label"))
        sample = stage.write(sample.repartition(PARTS, "part").sortWithinPartitions("part", "u", "label", "text"))
        z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        for _ in range(PASSES):
            # a written part is one file or more, whose rows must meet in their order again
            ordered = sample.repartition(PARTS, "part").sortWithinPartitions("part", "u", "label", "text").select("part", "text", "label")
            states = ordered.mapInArrow(train(z, n), "part int, seen long, z binary, n binary").collect()  # PARTS rows of fixed size
            share = np.array([r["seen"] for r in states], "float64")
            if not share.sum():
                break
            states = sorted(states, key=lambda r: r["part"])
            share = np.array([r["seen"] for r in states]) / share.sum()
            z, n = (sum(s * np.frombuffer(r[c]) for s, r in zip(share, states)) for c in "zn")
        w = weights(z, n)
        stage.drop(sample)
    elif total:
        w[0] = 35.0 if good else -35.0
    stage.drop(known)
    return w


def score(df: DataFrame, w, text: str = "text", keep_text: bool = True, out: str = "score") -> DataFrame:
    """`df` with the probability `out` that the whole `text` is good."""
    w = w.astype("float32")

    def run(column):
        import numpy as np
        import pyarrow as pa

        raw = np.array([float(w[at].astype("float64") @ x) for at, x in map(vector, as_bytes(column))])
        return pa.array(1 / (1 + np.exp(-np.clip(raw, -35, 35))), pa.float64())

    return with_arrow(df, text, out, T.DoubleType(), run, keep_text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score at least 0.7). Repeated rows are scored alike."""
    w = fit(docs, labels, Stage(docs.sparkSession, "quality"))
    rows = score(docs.select("doc_id", (fold(4) == 2).alias("held_out"), "text"), w, keep_text=False)
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are predicted good, unchanged, whatever their columns are called."""
    w = fit(docs, labels, Stage(docs.sparkSession, "quality"))
    names = docs.columns
    out = free_names(names)("score")
    return score(docs, w, out=out).where(F.col(out) >= CUT).select(*names)
