"""Language identification by a byte convolutional network.

Texts are cut into windows of fixed length. Filters of several widths slide over the bytes' embeddings, each filter keeps its
maximum over the window, and a softmax layer reads the maxima. The network is trained in numpy on a bounded sample of
labelled texts. In the executors a filter over bytes is a sum of table look-ups, one for each pair of bytes under it, so a
batch of windows costs a few gathers. A text's probabilities are the means over all its windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ribolith.llm.common import as_bytes

WINDOW, WIDTHS, FILTERS, EMBED = 128, (2, 3, 4), 16, 8
#: Bounds of the training sample: texts of each language, and windows of each text.
TEXTS, WINDOWS = 800, 4
#: Windows that are classified at once.
BATCH = 256
UNKNOWN = "und"
_tables: dict = {}


def windows(texts: list[bytes]):
    """All windows of the texts, each text padded with spaces to whole windows, and the number of windows of each."""
    import numpy as np

    counts = [max(1, -(-len(t) // WINDOW)) for t in texts]
    data = b"".join(t.lower().ljust(n * WINDOW) for t, n in zip(texts, counts))
    return np.frombuffer(data, "uint8").reshape(-1, WINDOW), counts


def train(x, y, classes: int, epochs: int = 6, batch: int = 64, rate: float = 4e-3, seed: int = 5) -> dict:
    """Fits the network to windows `x` (n, WINDOW) of classes `y` with Adam; returns its arrays."""
    import numpy as np

    rng = np.random.default_rng(seed)
    w = {"embed": rng.normal(0, 0.3, (256, EMBED)), "out": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes)), "bias": np.zeros(classes)}
    for k in WIDTHS:
        w[f"f{k}"] = rng.normal(0, (k * EMBED) ** -0.5, (k * EMBED, FILTERS))
        w[f"b{k}"] = np.zeros(FILTERS)
    m, v, step = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            b, n = x[rows], len(rows)
            e = w["embed"][b]
            pooled, where, patches = [], {}, {}
            for k in WIDTHS:
                p = np.concatenate([e[:, i : WINDOW - k + 1 + i] for i in range(k)], axis=2)
                z = p @ w[f"f{k}"] + w[f"b{k}"]
                where[k] = z.argmax(axis=1)
                patches[k] = p[np.arange(n)[:, None], where[k]]
                pooled.append(np.take_along_axis(z, where[k][:, None], axis=1)[:, 0])
            h = np.maximum(np.hstack(pooled), 0)
            logits = h @ w["out"] + w["bias"]
            prob = np.exp(logits - logits.max(axis=1, keepdims=True))
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(n), y[rows]] -= 1
            prob /= n
            g = {"out": h.T @ prob, "bias": prob.sum(axis=0), "embed": np.zeros_like(w["embed"])}
            dh = (prob @ w["out"].T) * (h > 0)
            for j, k in enumerate(WIDTHS):
                d = dh[:, j * FILTERS : (j + 1) * FILTERS]
                g[f"f{k}"] = np.einsum("nfi,nf->if", patches[k], d)
                g[f"b{k}"] = d.sum(axis=0)
                de = d[:, :, None] * w[f"f{k}"].T[None]
                for i in range(k):
                    np.add.at(g["embed"], b[np.arange(n)[:, None], where[k] + i], de[:, :, i * EMBED : (i + 1) * EMBED])
            step += 1
            for name in w:
                m[name] = 0.9 * m[name] + 0.1 * g[name]
                v[name] = 0.999 * v[name] + 0.001 * g[name] ** 2
                w[name] -= rate * (1 - epoch / epochs) * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
    return {k: a.astype("float32") for k, a in w.items()}


class Network:
    """The trained arrays as look-up tables over pairs of bytes."""

    def __init__(self, w: dict):
        import numpy as np

        self.w, self.tables = w, {}
        for k in WIDTHS:
            f = w[f"f{k}"].reshape(k, EMBED, FILTERS)
            one = [w["embed"] @ f[i] for i in range(k)]
            pairs = [(one[i][:, None] + one[i + 1][None]).reshape(-1, FILTERS) for i in range(0, k - 1, 2)]
            pairs[0] = pairs[0] + w[f"b{k}"]
            self.tables[k] = [np.ascontiguousarray(p, "float32") for p in pairs] + ([one[-1].astype("float32")] if k % 2 else [])

    def __call__(self, x):
        """Probabilities of the classes for each window."""
        import numpy as np

        pair = x[:, :-1].astype("int32") * 256 + x[:, 1:]
        pooled = []
        for k in WIDTHS:
            n = WINDOW - k + 1
            z = None
            for i, t in enumerate(self.tables[k]):
                index = pair[:, 2 * i : 2 * i + n] if len(t) > 256 else x[:, 2 * i : 2 * i + n]
                z = t.take(index, axis=0) if z is None else np.add(z, t.take(index, axis=0), out=z)
            pooled.append(z.max(axis=1))
        logits = np.maximum(np.hstack(pooled), 0) @ self.w["out"] + self.w["bias"]
        prob = np.exp(logits - logits.max(axis=1, keepdims=True))
        return prob / prob.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, texts: int = TEXTS) -> tuple[list[str], dict]:
    """Languages and network from the rows of `docs` (doc_id, text, lang) with a lang and a letter in the text.

    The sample has about `texts` texts of each language, chosen by a hash of the row, and at most `WINDOWS` windows of each
    text, spread over the whole text.
    """
    import numpy as np

    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in docs.where(F.col("lang").isNotNull()).groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return [], {}
    chance = F.create_map(*(F.lit(x) for k in langs for x in (k, min(1.0, texts / counts[k]))))
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < chance[F.col("lang")] * 1_000_000)

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            parts, names = [], []
            for t, lang in zip(as_bytes(b.column("text")), b.column("lang").to_pylist()):
                own, _ = windows([t])
                full = own[:-1] if len(own) > 1 and len(t) % WINDOW else own
                for i in sorted({round(j * (len(full) - 1) / max(1, WINDOWS - 1)) for j in range(WINDOWS)}):
                    parts.append(full[i].tobytes())
                    names.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), pa.array(names, pa.string())], names=["part", "lang"])

    sample = drawn.select("text", "lang").mapInArrow(cut, "part binary, lang string").limit(2 * texts * WINDOWS * len(langs)).toPandas()
    if sample.empty:
        return [], {}
    sample = sample.sort_values(["lang", "part"], kind="stable")
    x = np.frombuffer(b"".join(map(bytes, sample["part"])), "uint8").reshape(-1, WINDOW)
    y = sample["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy()
    return langs, train(x, y, len(langs))


def predict(df: DataFrame, langs: list[str], weights: dict, text: str = "text") -> DataFrame:
    """`df` without `text`, with lang_pred and score. A null text or one without a letter is `und` with score 0."""
    kept = [f for f in df.schema.fields if f.name not in (text, "lang_pred", "score")]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import regex

        letter, net = regex.compile(r"\p{L}").search, Network(weights) if langs else None
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                raw = b.column(text).to_pylist()
                known = [bool(net and t and letter(t)) for t in raw]
                data = [t.encode("utf-8", "replace") for t, k in zip(raw, known) if k]
                sums = []
                if data:
                    x, counts = windows(data)
                    prob = np.vstack([net(x[i : i + BATCH]) for i in range(0, len(x), BATCH)])
                    sums = np.add.reduceat(prob.astype("float64"), np.cumsum([0, *counts[:-1]]), axis=0) / np.array(counts)[:, None]
                rows, best, score = iter(sums), [], []
                for k in known:
                    p = next(rows) if k else None
                    best.append(langs[int(p.argmax())] if k else UNKNOWN)
                    score.append(min(1.0, float(p.max())) if k else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(n) for n in names), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                    names=[*names, "lang_pred", "score"],
                )

    return df.mapInArrow(run, schema)


def fold(parts: int):
    """The remainder of the checksum of doc_id as text; a null doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learnt from the documents that are not held out."""
    langs, weights = fit(docs.where(fold(4) != 2).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", (fold(4) == 2).alias("held_out"), "text")
    return predict(rows, langs, weights)
