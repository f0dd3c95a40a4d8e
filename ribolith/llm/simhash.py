"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints at `distance` or fewer differing bits leave at least ``blocks - distance`` of their blocks untouched, so such
pairs meet on one of the choices of that many blocks. They are joined there and verified by their Hamming distance.
Texts of one fingerprint are one node. A bucket with more than `crowd` different fingerprints is not joined with itself:
its fingerprints are linked through the values one bit away. Two fingerprints share such a value exactly if at most two
bits differ, so this loses no link, adds none, and its rows grow in proportion.
"""

from __future__ import annotations

import math
from itertools import accumulate, combinations, repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ribolith.llm.common import Stage, as_bytes, components, free_names, release, with_arrow
from ribolith.llm.words import mixed, word_hashes

BITS = 64
#: Shingles whose bits are counted at once, so that a very long text takes little memory.
CHUNK = 1 << 15
#: Words of 64 bits of a wide fingerprint.
WIDE = 4
#: Share of bits in which fingerprints of word pairs differ at a similarity of 0.8 of five-word shingles (measured), and the chance that such a pair shares no block.
PAIR_BITS, MISSED = 0.086, 0.01
#: Nodes of a block that meet in a join, nodes of a larger group that are compared in one task, and pairs for each node of that task that are listed.
CROWD, PART, PAIRS = 8, 2048, 8


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles, repeats included; 0 without a word."""
    import numpy as np
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    row = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + 1 + b))
    if len(words) <= width:
        shingles = [row]
    else:
        starts = [0, *(e + 1 for e in ends)]
        shingles = [row[a:b] for a, b in zip(starts, ends[width - 1 :])]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8", len(shingles))
    counts = np.zeros(BITS, "int64")
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK]
        counts += np.unpackbits(part.view("uint8").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp", width: int = 3, seed: int = 42, keep_text: bool = True) -> DataFrame:
    """`df` with the fingerprint of the whole `text` as a long of the same bits. A null text counts as empty."""

    def run(column):
        import numpy as np
        import pyarrow as pa

        made = np.fromiter((fingerprint(x, width, seed) for x in as_bytes(column)), "<u8", len(column))
        return pa.array(made.view("<i8"))

    return with_arrow(df, text, out, T.LongType(), run, keep_text)


def links(nodes: DataFrame, stage: Stage, distance: int = 2, blocks: int = 4, crowd: int = 64) -> DataFrame:
    """Edges (a, b) between the different fingerprints `fp` of `nodes` that connect all at `distance` or fewer bits."""
    if distance != 2:
        raise ValueError("crowded buckets are linked through values one bit away, which is exact for a distance of 2")
    width = BITS // blocks
    part = [f"(shiftrightunsigned(fp, {i * width}) & {(1 << width) - 1})" for i in range(blocks)]
    chosen = list(combinations(range(blocks), blocks - distance))
    key = [f"{n} * {1 << (width * len(c))} + " + " + ".join(f"{part[i]} * {1 << (width * k)}" for k, i in enumerate(c)) for n, c in enumerate(chosen)]
    keyed = nodes.select("fp", F.explode(F.expr(f"array({', '.join(key)})")).alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage.write(keyed.join(buckets, "key"))
    few = shared.where(F.col("n") <= crowd).select("key", "fp")
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key")
    pairs = pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.expr("a ^ b")) <= distance)).select("a", "b")
    near = (
        shared.where(F.col("n") > crowd)
        .select("fp").distinct()
        .select("fp", F.explode(F.expr(f"concat(array(fp), transform(sequence(0, {BITS - 1}), i -> fp ^ shiftleft(1L, i)))")).alias("near"))
    )
    least = near.groupBy("near").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top").select("near", "a")
    crowded = near.join(least, "near").where("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(crowded).distinct()


def near_duplicates(df: DataFrame, text: str = "text", width: int = 3, distance: int = 2, keep_text: bool = True) -> tuple[DataFrame, Stage]:
    """`df` with `fp` and `component_id`, the smallest doc_id whose fingerprint its own reaches over links.

    Null and empty texts have fingerprint zero and link like any other. Rows without doc_id take part; a component of such
    rows alone has a null id. Repeated rows get the same values. Returns the rows and the stage that holds its tables.
    """
    stage = Stage(df.sparkSession, "simhash")
    marked = stage.write(fingerprints(df, text, width=width, keep_text=keep_text))
    nodes = stage.write(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(nodes, stage, distance), stage)
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(named, "fp"), stage


def report(df: DataFrame) -> DataFrame:
    """One row per document: doc_id, its fingerprint in hex and its component."""
    rows, _ = near_duplicates(df.select("doc_id", "text"), keep_text=False)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def wide_fingerprints(texts: list[bytes], width: int):
    """A row of `WIDE` unsigned 64-bit words for each text: the majority bits of its word shingles, repeats included."""
    import numpy as np

    offsets = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.zeros(0, "int64")
    words, starts = word_hashes(b" ".join(texts).lower())
    row = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(row, np.arange(len(texts)))
    size = np.bincount(row, minlength=len(texts)) if len(row) else np.zeros(len(texts), "int64")
    n = np.where(size > 0, np.maximum(size - width + 1, 1), 0)  # fewer words than a shingle are one shingle
    doc = np.repeat(np.arange(len(texts)), n)
    at = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    last = first + size
    h = np.zeros(len(at), "uint64")
    for j in range(width):
        there = at + j < last[doc]
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.where(there, words[np.minimum(at + j, max(len(words) - 1, 0))], np.uint64(j)) if len(words) else h
    counts = np.zeros((len(texts), 64 * WIDE), "int64")
    for a in range(0, len(h), CHUNK):
        part, own = h[a : a + CHUNK], doc[a : a + CHUNK]
        wide = np.stack([mixed(part + np.uint64((0xD6E8FEB86659FD93 * (k + 1)) % (1 << 64))) for k in range(WIDE)], axis=1)
        bits = np.unpackbits(np.ascontiguousarray(wide).view("uint8").reshape(len(part), -1), axis=1, bitorder="little")
        new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        # sums of at most 255 rows fit a byte
        cuts = np.unique(np.concatenate([new, *(np.arange(x, y, 255) for x, y in zip(new, np.append(new[1:], len(own))) if y - x > 255)]))
        np.add.at(counts, own[cuts], np.add.reduceat(bits, cuts, axis=0, dtype="uint8").astype("int64"))
    return np.packbits(2 * counts > n[:, None], axis=1, bitorder="little").view("<u8")


def _thin(df: DataFrame, width: int) -> DataFrame:
    """(doc_id, th: a hash of the text, v0.. of shingles of `width` words, b0.. of word pairs, node: a hash of both) for each row of `df` (doc_id, text)."""
    names = [f"{kind}{k}" for kind in "vb" for k in range(WIDE)]

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts = as_bytes(b.column("text"))
                cols = [x.view("<i8")[:, k] for x in (wide_fingerprints(texts, width), wide_fingerprints(texts, 2)) for k in range(WIDE)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), *(pa.array(c) for c in cols)], names=["doc_id", "th", *names])
        release()

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    made = rows.mapInArrow(run, "doc_id long, th long, " + ", ".join(f"{n} long" for n in names))
    return made.withColumn("node", F.xxhash64(*names))


def block_plan(nodes: int) -> tuple[int, int]:
    """(bits of a block, number of blocks) for that many nodes.

    A block has six bits more than it takes to number the nodes, so that few unlike nodes share one, at any size. Blocks are so many that a pair at the
    bar, whose fingerprints of word pairs differ in about `PAIR_BITS` of their bits, shares none with a chance of `MISSED`, were its bits
    independent. Both follow from the number of nodes alone; blocks overlap when they have more bits than there are.
    """
    width = min(64, max(16, math.ceil(math.log2(max(2, nodes))) + 6))
    return width, math.ceil(math.log(MISSED) / math.log(1 - (1 - PAIR_BITS) ** width))


def near_links(nodes: DataFrame, stage: Stage, distance: int, crowd: int = CROWD, sets=None, similarity: float = 0.0) -> DataFrame:
    """Edges (a, b) between `nodes` (node, v0.., b0..) that share a block of b and whose fingerprints v differ in at most `distance` bits.

    Nodes of a block that at most `crowd` share meet in a join of their names; fingerprints come to the pairs after. Larger groups are dealt into parts by a
    hash, so that two parts have some `PART` nodes, and each two parts meet in a task of their own, which compares them in full; so no group is gathered.
    All pairs of a task are edges while they are few (`PAIRS` a node). Where they are more, the task gives edges that connect what all pairs would: of those pairs
    whose shingles, from `sets` (a function from nodes to rows (node, s)), have the `similarity`, if it is given, so that no edge that fails there hides another.
    Work in a group grows with the square of its size, its memory does not.
    """
    verify = [f"v{k}" for k in range(WIDE)]
    width, count = block_plan(nodes.count())
    key = [_block([f"b{k}" for k in range(WIDE)], round(i * 64 * WIDE / count) % (64 * WIDE), width) for i in range(count)]
    keyed = nodes.select("node", F.posexplode(F.array(*key)).alias("i", "x")).select("node", F.xxhash64("i", "x").alias("key"))
    keyed = keyed.repartition("key")
    several = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage.write(keyed.join(several.hint("merge"), "key"))
    few = shared.where(F.col("n") <= crowd)
    pairs = few.select("key", F.col("node").alias("a")).join(few.select("key", F.col("node").alias("b")).hint("merge"), "key").where("a < b").select("a", "b").distinct()
    prints = lambda end: nodes.select(F.col("node").alias(end), *(F.col(v).alias(f"{end}{v}") for v in verify))
    apart = sum((F.bit_count(F.col(f"a{v}").bitwiseXOR(F.col(f"b{v}"))) for v in verify), F.lit(0))
    edges = stage.write(pairs.join(prints("a").hint("merge"), "a").join(prints("b").hint("merge"), "b").where(apart <= distance).select("a", "b"))
    left = shared.where(F.col("n") > crowd).select("key", "node", F.when(F.col("n") > PART, F.ceil(F.col("n") / (PART // 2))).otherwise(1).cast("long").alias("parts"))
    own, other = F.pmod(F.xxhash64("key", "node"), "parts"), F.col("other")
    met = left.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).where((other != own) | (F.col("parts") == 1))
    met = met.select("key", (F.least(own, other) * F.col("parts") + F.greatest(own, other)).alias("part"), "node")
    tiled = lambda rows: rows.repartition("key", "part").sortWithinPartitions("key", "part")
    kind = "key long, part long, a long, b long"
    made = stage.write(tiled(met.join(nodes.select("node", *verify).hint("merge"), "node")).mapInArrow(_met_parts(distance), kind))
    edges = edges.unionByName(made.where("b is not null").select("a", "b"))
    dense = made.where("b is null").select("key", "part")
    if not dense.isEmpty():
        rows = stage.write(met.join(dense.hint("merge"), ["key", "part"]))
        thick = nodes.select("node", *verify)
        if sets is not None:
            thick = thick.join(sets(rows.select("node").distinct()).hint("merge"), "node", "left")
        else:
            thick = thick.withColumn("s", F.lit(None).cast("array<int>"))
        made = stage.write(tiled(rows.join(thick.hint("merge"), "node")).mapInArrow(_joined_parts(distance, similarity), kind))
        edges = edges.unionByName(made.select("a", "b"))
    return edges.distinct()


def _block(words: list[str], at: int, width: int):
    """The `width` bits from bit `at` on of a fingerprint in words of 64 bits, which goes round."""
    k, shift = at // 64, at % 64
    low = F.shiftrightunsigned(words[k % len(words)], shift)
    if shift:
        low = low.bitwiseOR(F.shiftleft(words[(k + 1) % len(words)], 64 - shift))
    return low if width == 64 else low.bitwiseAND((1 << width) - 1)


def _parts(solve, names: list[str]):
    """A function over batches whose rows come sorted by (key, part): what `solve` gives for each part's columns `names`, as edges (key, part, a, b)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def solved(held):
            made = pa.Table.from_batches(held)
            a, b = solve(made)
            same = lambda c: pa.array(np.full(len(a), made.column(c)[0].as_py()), pa.int64())
            return pa.RecordBatch.from_arrays([same("key"), same("part"), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["key", "part", "a", "b"])

        held, own = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, part = batch.column("key").to_numpy(), batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), len(key)]
            for x, z in zip(cuts, cuts[1:]):
                if own is not None and own != (key[x], part[x]):
                    yield solved(held)
                    held = []
                own = key[x], part[x]
                held.append(batch.slice(x, z - x).select(["key", "part", *names]))
        if own is not None:
            yield solved(held)
        release()

    return run


def _prints(table):
    """The nodes of a part and their fingerprints, in order."""
    import numpy as np

    nodes = table.column("node").to_numpy()
    order = np.argsort(nodes)
    return order, nodes[order], np.stack([table.column(f"v{k}").to_numpy().view("uint64") for k in range(WIDE)], axis=1)[order]


def _met_parts(distance: int):
    """All pairs of each part of the rows (key, part, node, v0..) that differ in at most `distance` bits; one row without a and b if they are over `PAIRS` a node."""

    def solve(table):
        import numpy as np

        _, nodes, prints = _prints(table)
        a, b, n = [], [], 0
        for i in range(len(nodes) - 1):
            near = np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]).sum(axis=1) <= distance) + i + 1
            n += len(near)
            if n > PAIRS * len(nodes):
                return [None], [None]
            a += [int(nodes[i])] * len(near)
            b += nodes[near].tolist()
        return a, b

    return _parts(solve, ["node", *(f"v{k}" for k in range(WIDE))])


def _joined_parts(distance: int, similarity: float):
    """Edges that connect each part of the rows (key, part, node, v0.., s) as all pairs of `distance` bits and `similarity` of the sets `s` do; a null set is like any."""

    def solve(table):
        import numpy as np
        import pyarrow.compute as pc

        order, nodes, prints = _prints(table)
        sets = table.column("s").combine_chunks().take(order)
        given = sets.is_valid().to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(sets), 0).to_numpy(zero_copy_only=False))
        flat = sets.flatten().to_numpy()
        kinds, flat = np.unique(flat, return_inverse=True)
        size = np.diff(np.append(0, ends))
        mark = np.zeros(len(kinds), bool)

        def alike(at, near):
            """Which of the nodes `near` have the similarity to the node `at`."""
            ok = ~given[near] | ~given[at]
            some = near[~ok]
            if len(some):
                mark[flat[ends[at] - size[at] : ends[at]]] = True
                n = size[some]
                place = np.repeat(ends[some] - np.cumsum(n), n) + np.arange(n.sum())  # the places of their sets, one behind the other
                both = np.bincount(np.repeat(np.arange(len(some)), n), mark[flat[place]], len(some))
                mark[flat[ends[at] - size[at] : ends[at]]] = False
                ok[~ok] = both >= similarity * (size[at] + n - both)
            return near[ok]

        reached, a, b = np.zeros(len(nodes), bool), [], []
        for i in range(len(nodes)):  # breadth first from each node that is not reached yet
            if reached[i]:
                continue
            reached[i] = True
            todo = [i]
            while todo:
                at = todo.pop()
                open_ = np.flatnonzero(~reached)
                near = alike(at, open_[np.bitwise_count(prints[open_] ^ prints[at]).sum(axis=1) <= distance])
                reached[near] = True
                todo += near.tolist()
                a += [int(nodes[at])] * len(near)
                b += nodes[near].tolist()
        return a, b

    return _parts(solve, ["node", *(f"v{k}" for k in range(WIDE)), "s"])


def shingle_sets(texts: list[bytes], width: int) -> list:
    """The distinct 32-bit hashes of each text's shingles of `width` words, sorted; fewer words are one shingle, none give none."""
    import numpy as np

    out = []
    for text in texts:
        words = word_hashes(text.lower())[0]
        n = min(len(words), max(1, len(words) - width + 1))
        h = np.zeros(n, "uint64")
        for j in range(min(width, len(words))):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n]
        out.append(np.unique((mixed(h) >> np.uint64(32)).astype("uint32")).view("int32"))
    return out


def node_sets(ends: DataFrame, nodes: DataFrame, df: DataFrame, width: int) -> DataFrame:
    """(node, s) of the nodes `ends` (node, each once): the shingles of the row with the least doc_id. Nodes whose rows all lack one have no row.

    Only these nodes have their text read, and only hashes of shingles travel further.
    """
    ends = ends.join(nodes.select("node", "least", "th"), "node").where("least is not null")

    def run(batches):
        import pyarrow as pa

        last = None
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                own = b.column("node").to_pylist()
                fresh = [i for i, x in enumerate(own) if x != (own[i - 1] if i else last)]  # repeated rows follow each other
                last = own[-1]
                sets = shingle_sets(as_bytes(b.column("text").take(pa.array(fresh, pa.int64()))), width)
                yield pa.RecordBatch.from_arrays([pa.array([own[i] for i in fresh], pa.int64()), pa.array(sets, pa.list_(pa.int32()))], names=["node", "s"])
        release()

    texts = df.select(F.col("doc_id").cast("long").alias("least"), F.xxhash64("text").alias("th"), "text").join(ends.hint("merge"), ["least", "th"]).select("node", "text")
    return texts.mapInArrow(run, "node long, s array<int>")


def verified(edges: DataFrame, nodes: DataFrame, df: DataFrame, stage: Stage, width: int, similarity: float) -> DataFrame:
    """The `edges` (a, b) whose texts' sets of shingles have the Jaccard `similarity` at least.

    A node's text is that of its row with the least doc_id; nodes whose rows all lack one keep their edges.
    """
    sets = stage.write(node_sets(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, df, width))
    own = lambda end: sets.select(F.col("node").alias(end), F.col("s").alias(f"s{end}")).hint("merge")
    met = edges.join(own("a"), "a", "left").join(own("b"), "b", "left")
    both = F.size(F.array_intersect("sa", "sb"))
    alike = both >= similarity * (F.size("sa") + F.size("sb") - both)
    return met.where(F.col("sa").isNull() | F.col("sb").isNull() | alike).select("a", "b").distinct()


def bits_apart(similarity: float) -> int:
    """Differing bits of `WIDE` words of fingerprint to expect at a Jaccard similarity of the shingles, and two standard deviations."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(64 * WIDE * share + 2 * math.sqrt(64 * WIDE * share * (1 - share)))


def one_of_each(df: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of `df` that stay when of each group of near duplicates only the document with the smallest doc_id does.

    Near duplicates are linked where their sets of shingles of `width` words have the Jaccard `similarity` at least; a group is what links
    connect. Candidates share a block of a fingerprint of word pairs, which an edit changes less, and have fingerprints of the shingles that differ in no more bits
    than `bits_apart` expects. Null and empty texts are copies of each other. Rows without doc_id stay only where no row of their group has
    one, and then one does. Of rows that repeat a doc_id and a text one stays. All columns are kept, whatever their names.
    """
    stage = Stage(df.sparkSession, "neardup")
    thin = stage.write(_thin(df.select("doc_id", "text"), width))
    named = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "th"))).alias("l")
    nodes = thin.groupBy("node").agg(named, *(F.first(c).alias(c) for c in thin.columns if c not in ("node", "doc_id", "th")))
    nodes = stage.write(nodes.select("node", F.col("l.doc_id").alias("least"), F.col("l.th").alias("th"), *(c for c in nodes.columns if c not in ("node", "l"))))
    sets = lambda some: stage.write(node_sets(some, nodes, df, width))
    edges = stage.write(near_links(nodes, stage, bits_apart(similarity), sets=sets, similarity=similarity))
    found = components(verified(edges, nodes, df, stage, width, similarity), stage)
    rooted = nodes.select("node", "least").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("id"), F.min("node").alias("one"))
    stay = rooted.join(ids, "root").where(F.col("least").eqNullSafe(F.col("id")) & (F.col("id").isNotNull() | (F.col("node") == F.col("one"))))
    name = free_names(df.columns)
    kept_id, kept_node = name("kept_id"), name("kept_node")
    keep = stage.write(thin.join(stay.select("node", "id"), "node").where("doc_id <=> id").groupBy("doc_id", "node").agg(F.count("*").alias("n")))
    again = keep.groupBy("doc_id").agg(F.sum("n").alias("n")).where("n > 1 or doc_id is null")
    if again.isEmpty():
        # the ids grow with the documents: one plan at every size
        return df.join(keep.select(F.col("doc_id").alias(kept_id)).hint("merge"), df["doc_id"] == F.col(kept_id), "left_semi")
    # Rows that repeat an id: their texts decide, by hashes that the thin rows had not kept.
    h1, h2 = name("h1"), name("h2")
    texts = _with_node(df.select("doc_id", "text"), width).join(keep.select(F.col("doc_id").alias(kept_id), F.col("node").alias(kept_node)), F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col("node") == F.col(kept_node)), "left_semi")
    texts = texts.groupBy("doc_id", "node").agg(F.min(F.struct(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(3), "text").alias("h2"))).alias("t"))
    texts = texts.select(F.col("doc_id").alias(kept_id), F.col("t.h1").alias(h1), F.col("t.h2").alias(h2))
    same = df["doc_id"].eqNullSafe(F.col(kept_id)) & (F.xxhash64(df["text"]) == F.col(h1)) & (F.xxhash64(F.lit(3), df["text"]) == F.col(h2))
    marked = df.withColumn(name("x"), F.xxhash64("text"))
    return marked.join(texts, same, "left_semi").dropDuplicates(["doc_id", name("x")]).drop(name("x"))


def _with_node(df: DataFrame, width: int) -> DataFrame:
    """`df` (doc_id, text) with the hash `node` of its fingerprints."""

    def run(column):
        import pyarrow as pa

        texts = as_bytes(column)
        import numpy as np

        both = np.concatenate([wide_fingerprints(texts, width), wide_fingerprints(texts, 2)], axis=1).view("<i8")
        return pa.array(both.tolist(), pa.list_(pa.int64()))

    made = with_arrow(df, "text", "f", T.ArrayType(T.LongType()), run)
    return made.select("doc_id", "text", F.xxhash64(*(F.col("f")[k] for k in range(2 * WIDE))).alias("node"))
