"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learnt from the labelled training rows: Spark counts in how many toxic and other texts each word and word
beginning stands, and terms with high smoothed log-odds stay. The features of a text are the densities of lexicon words, how
many stand near a second person, and the rates of capitals, punctuation and obfuscated spellings. Histogram trees are
boosted in numpy on a bounded sample of feature rows and calibrated by isotonic regression. Both are cross-fitted in `FOLDS` parts:
the features of a training row come from the lexicon of the other parts, and the sums that calibrate come from trees that were
grown without the row. Texts are scored in the executors.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ribolith.llm.common import Stage, free_names, with_arrow
from ribolith.llm.langid import fold

#: Bounds: terms of the lexicon, and feature rows that the trees and the calibration are fitted to.
LEXICON, ROWS, FOLDS = 4096, 24_000, 4
#: Least number of toxic training texts that hold a term of the lexicon (2 to this, with their number), and its least log-odds.
SUPPORT, ODDS = 4, 1.5
CUT = 0.7
PREFIXES = (4, 5, 6)
#: Words for the second person in English, German, French and Spanish.
SECOND = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer eure sie tu te toi ton ta tes vous "
    "votre vos tú ti tus usted ustedes vosotros vuestro os".split()
)
#: Characters that stand for letters in obfuscated spellings.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "+": "t"})
TOKEN = re.compile(r"[^\W\d_]+")
MASKED = re.compile(r"(?<![\w@$*!])(?=[\w@$*!+]*[^\W\d_])[^\W\d_]+(?:[@$*!013457+]+[^\W\d_]+)+")
MASKED_PART = re.compile(r"[^\W\d_][@$*!013457+]+[^\W\d_]")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\w)")
STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
FEATURES = (
    "mean", "top", "second", "third", "strong", "strong_rate", "mild_rate", "any_rate", "near", "near_rate", "seconds",
    "capitals", "shouted", "exclamations", "questions", "runs", "punctuation", "masked", "masked_hits", "stretched", "spaced", "words",
)


def terms(word: str) -> list[str]:
    """The word, and its beginnings marked by a hyphen."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]


def learn_lexicons(rows: DataFrame, stage: Stage, size: int = LEXICON) -> list[dict[str, float]]:
    """Log-odds by term from all `rows` (text, toxic, fold): without the rows of each fold, and last from all of them.

    Texts are counted in the executors, combined before the shuffle.
    """

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                seen = [Counter() for _ in range(2 * FOLDS)]
                for text, toxic, fold_ in zip(*(b.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                    words = set(map(str.lower, TOKEN.findall(text or "")))
                    seen[2 * fold_ + (toxic > 0)].update(words.union(f"{w[:n]}-" for w in words for n in PREFIXES if len(w) > n))
                names = list(set().union(*seen))
                numbers = (pa.array([c[t] for t in names], pa.int64()) for c in seen)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *numbers], names=["term", *cols])

    cols = [f"{kind}{k}" for k in range(FOLDS) for kind in "cb"]
    totals = rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).collect()
    sums = rows.mapInArrow(count, "term string, " + ", ".join(f"{c} long" for c in cols)).groupBy("term").agg(*(F.sum(c).alias(c) for c in cols))
    sums = stage.write(sums.where(sum(F.col(c) for c in cols if c[0] == "b") >= 2))
    out = []
    for left in (*range(FOLDS), None):
        kept = [k for k in range(FOLDS) if k != left]
        bad, clean = (sum((F.col(f"{kind}{k}") for k in kept), F.lit(0)) for kind in "bc")
        n, toxic = (sum(r[c] for r in totals if r["fold"] in kept) for c in ("n", "bad"))
        odds = F.log((bad + 0.5) / (toxic + 1.0)) - F.log((clean + 0.5) / (n - toxic + 1.0))
        terms_ = sums.select("term", bad.alias("bad"), odds.alias("odds")).where((F.col("bad") >= max(2, min(SUPPORT, toxic // 10))) & (F.col("odds") >= ODDS))
        best = terms_.orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "term").limit(size)
        out.append({r["term"]: float(r["odds"]) for r in best.collect()})
    return out


class Features:
    """The dense features of texts under one lexicon. What a word adds is looked up once and kept, in one number.

    The number's parts: the word's log-odds, 100 for a second person, 1000 for three or more capitals, 10,000 for a single
    letter, 100,000 for each stretched letter.
    """

    def __init__(self, lexicon: dict[str, float]):
        from ribolith.llm.bpe import _Memo

        self.lexicon = lexicon
        self.memo = _Memo(self.worth, 150_000)

    def odds(self, word: str) -> float:
        return max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)

    def worth(self, word: str) -> float:
        low = word.lower()
        shouted = len(word) > 2 and word.isupper()
        return min(self.odds(low), 99.0) + 100 * (low in SECOND) + 1000 * shouted + 10_000 * (len(word) == 1) + 100_000 * len(STRETCHED.findall(low))

    def __call__(self, text: str | None) -> list[float]:
        import numpy as np

        text = text or ""
        words = TOKEN.findall(text)
        n, size = max(1, len(words)), max(1, len(text))
        s = np.fromiter(map(self.memo.__getitem__, words), "float64", len(words))
        stretched, s = np.divmod(s, 100_000)
        single, s = np.divmod(s, 10_000)
        shouted, s = np.divmod(s, 1000)
        second, s = np.divmod(s, 100)
        hits, you = np.flatnonzero(s >= 2.5), np.flatnonzero(second)
        top = np.sort(s[s > 0])[::-1][:3].tolist() + [0.0] * 3
        near = int((np.searchsorted(you, hits + 6) > np.searchsorted(you, hits - 5)).sum()) if len(you) and len(hits) else 0
        plain = [m.lower().translate(LEET) for m in MASKED.findall(text)] if MASKED_PART.search(text) else []
        run = single[3:] + single[2:-1] + single[1:-2] + single[:-3] if len(single) > 3 else single[:0]
        spaced = len(SPACED.findall(text)) if (run == 4).any() else 0
        return [
            float(s.sum()) / n, top[0], top[1], top[2], float(len(hits)), len(hits) / n, float((s >= ODDS).sum()) / n,
            float((s > 0).sum()) / n, float(near), near / n, len(you) / n, capitals(text) / size,
            float(shouted.sum()) / n, text.count("!") / size, text.count("?") / size,
            (text.count("!!") + text.count("??")) / n, sum(map(text.count, ".,;:")) / size, len(plain) / n,
            float(sum(self.odds(p) >= 2.5 for p in plain)), float(stretched.sum()) / n, spaced / n,
            math.log1p(len(words)),
        ]


def capitals(text: str) -> int:
    """Upper-case characters of a text."""
    import numpy as np

    if text.isascii():
        raw = np.frombuffer(text.encode(), "u1")
        return int(((raw >= 65) & (raw <= 90)).sum())
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    odd, times = np.unique(raw[raw > 127], return_counts=True)
    return int(((raw >= 65) & (raw <= 90)).sum()) + sum(int(k) for c, k in zip(odd.tolist(), times) if chr(c).isupper())


def boost(x, y, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 48, least: float = 8.0):
    """Boosted histogram trees for logistic loss: (base, [(feature, threshold, value) arrays of a full binary tree]).

    Either side of a split keeps a Hessian of `least`, or of a fiftieth of that of all rows where this is less.
    """
    import numpy as np

    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    b = np.stack([np.searchsorted(c, col) for c, col in zip(cuts, x.T)], axis=1)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = math.log(share / (1 - share))
    score, out = np.full(len(y), base), []
    least = min(least, 0.02 * len(y) * share * (1 - share))
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node, feature, cut = np.zeros(len(y), "int64"), np.zeros(inner, "int64"), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6), np.zeros(width, "int64"), np.full(width, -1)
            for f in range(x.shape[1]):
                key = (node - first) * (bins + 1) + b[:, f]
                gs = np.bincount(key, g, width * (bins + 1)).reshape(width, -1).cumsum(axis=1)
                hs = np.bincount(key, h, width * (bins + 1)).reshape(width, -1).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(hs < least) | (ht - hs < least)] = 0
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = top > best[0]
                best[0][better], best[1][better], best[2][better] = top[better], f, at[better]
            ok = best[2] >= 0
            feature[first : first + width] = best[1]
            cut[first : first + width] = [cuts[f][a] if o and a < len(cuts[f]) else np.inf for o, f, a in zip(ok, best[1], best[2])]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        score += value[leaf]
        out.append((feature, cut, value))
    return base, out


def raw_score(x, model):
    """Sums of the trees' values for feature rows `x`."""
    import numpy as np

    base, trees = model
    score, rows = np.full(len(x), base), np.arange(len(x))
    for feature, cut, value in trees:
        node = np.zeros(len(x), "int64")
        for _ in range(int(math.log2(len(value)))):
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        score += value[node - len(feature)]
    return score


def isotonic(score, y) -> tuple:
    """Knots (score, probability) of the isotonic fit of `y` on `score`, by pooling adjacent violators."""
    import numpy as np

    order = np.argsort(score, kind="stable")
    blocks = []
    for s, v in zip(score[order], y[order]):
        blocks.append([float(v), 1.0, float(s)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            v1, n1, s1 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + v1, blocks[-1][1] + n1, blocks[-1][2] + s1]
    return np.array([b[2] / b[1] for b in blocks]), np.array([(b[0] + 0.1) / (b[1] + 0.2) for b in blocks])


def fit(docs: DataFrame, labels: DataFrame, stage: Stage, rows: int = ROWS) -> tuple[dict, tuple, tuple]:
    """(lexicon, trees, calibration) from the labelled documents whose checksum leaves no remainder 1 by 3.

    Of labels that repeat a doc_id the largest counts; null labels and null doc_ids take no part. The lexicon counts all
    training rows; trees and calibration see about `rows` of them, chosen by a hash. Labels grow with the documents and are never
    broadcast, so the join's plan is the same at every size.
    """
    import numpy as np

    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.where(fold(3) != 1).select("doc_id", "text").join(marks.hint("merge"), "doc_id")
    u = F.xxhash64("doc_id", F.lit(9))
    known = stage.write(known.select("text", F.col("toxic").cast("int"), u.alias("u"), F.pmod(F.shiftright(u, 20), F.lit(FOLDS)).cast("int").alias("fold")))
    lexicons = learn_lexicons(known.select("text", "toxic", "fold"), stage)
    total = known.count()
    part = known.where(F.pmod("u", F.lit(1_000_000)) < 1_000_000 * min(1.0, rows / max(1, total)))
    made = None
    for k in range(FOLDS):
        own = features(part.where(F.col("fold") == k), lexicons[k]).select("features", "toxic", "u", "fold")
        made = own if made is None else made.unionByName(own)
    made = made.toPandas().sort_values(["u", "toxic"], kind="stable")
    stage.drop(known)
    if made.empty or made["toxic"].nunique() < 2:
        return lexicons[-1], (0.0, []), (np.array([0.0]), np.array([float(made["toxic"].mean()) if len(made) else 0.0]))
    x, y, own = np.array(made["features"].tolist()), made["toxic"].to_numpy("float64"), made["fold"].to_numpy()
    sums = np.zeros(len(y))
    for k in np.unique(own):
        rest = own != k
        sums[~rest] = raw_score(x[~rest], boost(x[rest], y[rest])) if rest.any() else 0.0
    return lexicons[-1], boost(x, y), isotonic(sums, y)


def features(df: DataFrame, lexicon: dict, text: str = "text", keep_text: bool = False) -> DataFrame:
    """`df` with the feature row (array<double>) of the whole `text`."""

    def run(column):
        import pyarrow as pa

        own = _features(lexicon)
        return pa.array([own(t) for t in column.to_pylist()], pa.list_(pa.float64()))

    return with_arrow(df, text, "features", T.ArrayType(T.DoubleType()), run, keep_text)


_kept: dict = {}


def _features(lexicon: dict) -> Features:
    key = hash(frozenset(lexicon.items()))
    if key not in _kept:
        _kept.clear()
        _kept[key] = Features(lexicon)
    return _kept[key]


def score(df: DataFrame, model: tuple, text: str = "text", keep_text: bool = True, out: str = "score") -> DataFrame:
    """`df` with the calibrated toxicity `out` in [0, 1] of the whole `text`; null and empty texts are scored as empty."""
    lexicon, trees, (knots, values) = model

    def run(column):
        import numpy as np
        import pyarrow as pa

        own = _features(lexicon)
        raw = raw_score(np.array([own(t) for t in column.to_pylist()]).reshape(len(column), -1), trees)
        fitted = 0.995 * np.interp(raw, knots, values) + 0.005 / (1 + np.exp(-raw))
        return pa.array(np.clip(fitted, 0.0, 1.0))

    return with_arrow(df, text, out, T.DoubleType(), run, keep_text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score at least 0.7). Repeated rows are scored alike."""
    stage = Stage(docs.sparkSession, "toxicity")
    model = fit(docs, labels, stage)
    rows = score(docs.select("doc_id", (fold(3) == 1).alias("held_out"), "text"), model, keep_text=False)
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, unchanged, whatever their columns are called."""
    model = fit(docs, labels, Stage(docs.sparkSession, "toxicity"))
    names = docs.columns
    out = free_names(names)("score")
    return score(docs, model, out=out).where(F.col(out) < CUT).select(*names)
