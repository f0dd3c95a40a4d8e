"""Divergence of a language's sources from each other, by in-mapper stripes.

Each partition folds whole documents into hash stripes: for a term of a language the number of documents that hold it and its
occurrences by source. Stripes are spilled when they have `SPILL` cells, shuffled and sorted by (language, term), and merged in that
order, so that a task holds one term's stripe and one batch. Kept terms meet the totals of their language in buckets of bounded
size, where stripes become divergences: a row for each pair of sources, and each source's best terms.

Nulls in text, lang and source count as ''. Repeated rows are documents of their own. An empty table gives no rows; a source without
any kept term is there too. Counts are exact as long as a language has less than 9 * 10**15 tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ribolith.llm.common import Stage, release

#: Cells (term, source) that a partition folds before it spills; bytes of text that are cut into terms at once.
SPILL, SLICE = 1_000_000, 1 << 22
#: Cells (kept term, source) of a bucket of terms that is turned into divergences at once.
CELLS = 500_000
STRIPES = "lang string, term string, df long, sources array<string>, counts array<long>"


def _table():
    """Bytes of terms, A-Z lower-cased; 0 for all others."""
    import numpy as np

    out = np.zeros(256, "u1")
    out[97:123] = np.arange(97, 123)
    out[65:91] = np.arange(97, 123)
    out[128:] = np.arange(128, 256)
    return out


def cut(texts: list[bytes], letters):
    """The terms of the texts as an Arrow binary array, and the text that each is of."""
    import numpy as np
    import pyarrow as pa

    raw = letters[np.frombuffer(b" ".join([*texts, b""]), "u1")]
    inside = raw > 0
    place = np.cumsum(inside, dtype="int32")
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    offsets = np.append(place[starts] - 1, place[-1] if len(place) else 0).astype("int32")
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), "int64", len(texts)))
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    return terms, np.searchsorted(ends, starts, side="right")


class Fold:
    """Hash stripes of the documents added so far: occurrences by (term, group) and documents by (term, language)."""

    def __init__(self):
        self.letters, self.groups = _table(), {}
        self.clear()

    def clear(self):
        self.terms, self.cells, self.docs, self.pending = {}, [], [], 0

    def add(self, texts: list[bytes], groups: list[tuple[str, str]]):
        """Adds whole documents; one that is longer than a slice is cut between terms, and still counts as one document."""
        import numpy as np

        codes = np.array([self.groups.setdefault(g, len(self.groups)) for g in groups], "int64")
        if len(texts) == 1 and len(texts[0]) > SLICE:
            seen = [self.count([part], codes) for part in pieces(texts[0], self.letters)]
            docs = np.unique(np.concatenate([s // len(texts) for s in seen])) if seen else np.zeros(0, "int64")
        else:
            docs = self.count(texts, codes)
        term, own = docs // len(texts), docs % len(texts)
        self.docs.append(np.unique(term << 32 | codes[own], return_counts=True))

    def count(self, texts, codes):
        """Adds the occurrences; returns the distinct (term, text) as term * number of texts + text."""
        import numpy as np

        terms, own = cut(texts, self.letters)
        coded = terms.dictionary_encode()
        ids = self.terms
        known = np.fromiter((ids.setdefault(t, len(ids)) for t in coded.dictionary.to_pylist()), "int64", len(coded.dictionary))
        term = known[coded.indices.to_numpy()] if len(terms) else np.zeros(0, "int64")
        pairs, times = np.unique(term * len(texts) + own, return_counts=True)
        key = (pairs // len(texts)) << 32 | codes[pairs % len(texts)]
        self.cells.append(summed(key, times))
        self.pending += len(self.cells[-1][0])
        if self.pending > SPILL // 2:
            self.cells = [summed(*map(np.concatenate, zip(*self.cells)))]
            self.pending = len(self.cells[0][0]) // 2  # what is merged weighs half, so that it is merged again when it has grown by as much
        return pairs

    def full(self) -> bool:
        return len(self.terms) * 2 > SPILL or sum(len(k) for k, _ in self.cells) > SPILL

    def stripes(self):
        """The stripes as record batches; the fold is empty after."""
        import numpy as np
        import pyarrow as pa

        names = list(self.groups)
        if not self.cells or not names:
            return
        key, times = summed(*map(np.concatenate, zip(*self.cells)))
        dkey, dtimes = summed(*map(np.concatenate, zip(*self.docs)))
        langs, lang = np.unique(np.array([g[0] for g in names], object), return_inverse=True)
        terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
        source = pa.array([g[1] for g in names], pa.string())
        self.clear()
        line = lambda k: (k >> 32) * len(langs) + lang[k & 0xFFFFFFFF]
        order = np.argsort(line(key), kind="stable")
        rows, first = np.unique(line(key)[order], return_index=True)
        df = summed(line(dkey), dtimes)[1]
        offsets, group, times = np.append(first, len(order)), (key & 0xFFFFFFFF)[order], times[order]
        for at in range(0, len(rows), 10_000):
            part = rows[at : at + 10_000]
            edge = offsets[at : at + len(part) + 1]
            list_of = lambda flat: pa.ListArray.from_arrays(pa.array(edge - edge[0], pa.int32()), flat)  # noqa: E731, B023
            own = slice(edge[0], edge[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs[part % len(langs)], pa.string()), terms.take(pa.array(part // len(langs))), pa.array(df[at : at + len(part)]),
                    list_of(source.take(pa.array(group[own]))), list_of(pa.array(times[own])),
                ],
                names=["lang", "term", "df", "sources", "counts"],
            )


def pieces(text: bytes, letters):
    """A text in parts that end between terms, of about a slice each."""
    at, inside = 0, bytes(int(c > 0) for c in letters)
    while at < len(text):
        end = min(at + SLICE, len(text))
        while end < len(text) and inside[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def summed(key, times):
    """Distinct keys in order, with the sums of their times."""
    import numpy as np

    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, "int64")
    return key[first], np.add.reduceat(times, first) if len(first) else times


def fold(batches):
    """Record batches of stripes from record batches of (text, lang, source)."""
    from ribolith.llm.common import as_bytes

    own, texts, groups, size = Fold(), [], [], 0
    for batch in batches:
        for text, lang, source in zip(as_bytes(batch.column("text")), batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
            if texts and size + len(text) > SLICE:
                own.add(texts, groups)
                texts, groups, size = [], [], 0
                if own.full():
                    yield from own.stripes()
            texts.append(text)
            groups.append((lang or "", source or ""))
            size += len(text)
    if texts:
        own.add(texts, groups)
    yield from own.stripes()
    release()


def merge_rows(batch):
    """Rows of equal (lang, term) that follow each other become one."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = batch.num_rows
    new = np.ones(n, bool)
    if n > 1:
        differ = lambda c: pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[1:] = differ("lang") | differ("term")
    first = np.flatnonzero(new)
    sources = batch.column("sources").flatten().dictionary_encode()
    width = max(1, len(sources.dictionary))
    row = np.repeat(np.cumsum(new) - 1, batch.column("sources").value_lengths().to_numpy(zero_copy_only=False).astype("int64"))
    key, times = summed(row * width + sources.indices.to_numpy(), batch.column("counts").flatten().to_numpy())
    offsets = pa.array(np.searchsorted(key, np.arange(len(first) + 1) * width), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(c).take(pa.array(first)) for c in ("lang", "term")), pa.array(np.add.reduceat(batch.column("df").to_numpy(), first)),
            pa.ListArray.from_arrays(offsets, sources.dictionary.take(pa.array(key % width))), pa.ListArray.from_arrays(offsets, pa.array(times)),
        ],
        names=["lang", "term", "df", "sources", "counts"],
    )


def merged_stripes(least: int):
    """Merges stripes that come sorted by (lang, term) and keeps the terms of at least `least` documents."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.concat_batches([last, batch.cast(last.schema)])
            rows = merge_rows(batch)
            done, last = rows.slice(0, rows.num_rows - 1), rows.slice(rows.num_rows - 1)
            yield done.filter(pc.greater_equal(done.column("df"), least))
        if last is not None:
            yield last.filter(pc.greater_equal(last.column("df"), least))
        release()

    return run


def stripes(docs: DataFrame, least: int = 10) -> DataFrame:
    """lang, term, df, sources, counts: a row for each term that at least `least` documents of its language hold."""
    rows = docs.select("text", "lang", "source").mapInArrow(fold, STRIPES)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(parts, "lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInArrow(merged_stripes(least), STRIPES)


def share(a, b):
    """floor(10**9 * a / b) of int64 arrays, exactly, for 0 <= a and 0 < b < 9 * 10**15."""
    q = a // b
    r = a - q * b
    for _ in range(3):
        r = r * 1000
        d = r // b
        q, r = q * 1000 + d, r - d * b
    return q


def divergences(top: int):
    """The function that turns a bucket's stripes and its language's totals into parts of divergences."""

    def run(terms, totals):
        import numpy as np
        import pyarrow as pa

        names = totals["source"].to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i].encode())
        names = [names[i] for i in order]
        n, v = totals["n"].to_numpy()[order], int(totals["v"][0].as_py()) if len(names) else 0
        if int(n.sum()) + 2 * v >= 9 * 10**15:
            raise ValueError("a language has more tokens than the exact arithmetic holds")
        text = terms["term"].to_pylist()
        rank = np.array(sorted(range(len(text)), key=lambda i: text[i].encode()), "int64")
        place = np.empty(len(text), "int64")
        place[rank] = np.arange(len(text))
        code = {s: i for i, s in enumerate(names)}
        count = np.zeros((len(text), len(names)), "int64")
        lengths = terms["sources"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype("int64") if len(text) else np.zeros(0, "int64")
        own = np.fromiter((code[s] for s in terms["sources"].combine_chunks().flatten().to_pylist()), "int64", int(lengths.sum()))
        count[np.repeat(place, lengths), own] = terms["counts"].combine_chunks().flatten().to_numpy() if len(text) else 0
        lang = totals["lang"][0].as_py() if len(names) else ""
        out = [[], [], [], []]

        def add(source, part, items, values):
            for column, x in zip(out, ([source] * len(items), [part] * len(items), items, values)):
                column.extend(x)

        if len(text):
            p = 1 + share(count + 2, n + 2 * v)
            q = (1 + share(count.sum(axis=1) + 2, np.full(len(text), n.sum() + 2 * v)))[:, None]
            apart = (p - q) ** 2 // (p + q)
            best = (count > 0) & (p > q)
        for s, source in enumerate(names):
            if len(text):
                against = ((p - p[:, s : s + 1]) ** 2 // (p + p[:, s : s + 1])).sum(axis=0).tolist()
                at = np.flatnonzero(best[:, s])
                at = at[np.argsort(-apart[at, s], kind="stable")[:top]]  # rows are in the order of the terms
                add(source, "term", [text[i] for i in rank[at]], apart[at, s].tolist())
            else:
                against = [0] * len(names)
            add(source, "pair", names[:s] + names[s + 1 :], against[:s] + against[s + 1 :])
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
        return pa.table([pa.array([lang] * len(out[0]), pa.string()), *(pa.array(x, k) for x, k in zip(out, kinds))], names=["lang", "source", "part", "item", "value"])

    return run


def report(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: each source's divergence from the other sources of its language, and its `top` terms."""
    stage = Stage(docs.sparkSession, "divergence")
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    kept = stage.write(stripes(docs, least))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    cells = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("n"))
    totals = stage.write(
        groups.join(sizes, "lang", "left").join(cells, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    )
    widest = totals.groupBy("lang").agg((F.count("*") * F.max("v")).alias("x")).agg(F.max("x")).first()[0] or 0
    buckets = max(64, math.ceil(widest / CELLS))
    left = kept.withColumn("b", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    right = totals.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    parts = left.groupBy("lang", "b").cogroup(right.groupBy("lang", "b")).applyInArrow(divergences(top), "lang string, source string, part string, item string, value long")
    rows = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))


ORACLE = r"""
with docs as (
  select row_number() over () rid, coalesce(text, '') text, coalesce(lang, '') lang, coalesce(source, '') source from documents
), tok as (
  select rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from docs
), kept as (select lang, term from tok group by 1, 2 having count(distinct rid) >= 10),
groups_ as (select distinct lang, source from docs),
cell as (select lang, source, term, count(*) n from tok where (lang, term) in (select lang, term from kept) group by 1, 2, 3),
grid as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) n from groups_ g join kept k on g.lang = k.lang
  left join cell c on c.lang = g.lang and c.source = g.source and c.term = k.term
), v as (select lang, count(*) v from kept group by 1),
total as (select lang, source, sum(n) nn from grid group by 1, 2),
p as (
  select g.lang, g.source, g.term, g.n, cast(1 + (1000000000::hugeint * (g.n + 2)) // (t.nn + 2 * v.v) as bigint) p
  from grid g join total t on g.lang = t.lang and g.source = t.source join v on g.lang = v.lang
), whole as (select lang, term, sum(n) n from grid group by 1, 2), whole_n as (select lang, sum(n) nn from grid group by 1),
q as (
  select w.lang, w.term, cast(1 + (1000000000::hugeint * (w.n + 2)) // (t.nn + 2 * v.v) as bigint) q from whole w join whole_n t on w.lang = t.lang join v on w.lang = v.lang
), pair as (
  select a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3
), rows_ as (
  select a.lang, a.source, 'pair' part, b.source item, cast(coalesce(x.value, 0) as bigint) value
  from groups_ a join groups_ b on a.lang = b.lang and a.source <> b.source left join pair x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select p.lang, p.source, 'term', p.term, cast(((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) as bigint) from p join q on p.lang = q.lang and p.term = q.term where p.n > 0 and p.p > q.q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from rows_
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""
