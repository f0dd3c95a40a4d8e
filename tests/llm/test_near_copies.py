"""Near copies of the pipeline's stage against the Jaccard similarity of their five-word shingles, by brute force."""

import random

import pytest

from ribolith.llm import simhash


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("part", [2048, 32])
def test_near_copies_go_and_others_stay(spark, monkeypatch, part):
    """Also with groups that are dealt into many parts."""
    monkeypatch.setattr(simhash, "PART", part)
    rng, rows, near = random.Random(3), [], {}
    for i in range(150):
        n = rng.choice([60, 100, 300, 1000])
        a = words(rng, n)
        b = list(a)
        for k in range(rng.choice([1, 2, 3, n // 60])):
            b[rng.randrange(n)] = f"edit{i}x{k}"
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
        near[2 * i + 1] = jaccard(a, b)
    for i in range(120, 150):  # far copies: over half of the shingles change
        a = rows[2 * i][1].split()
        b = [w if k % 9 else f"far{i}x{k}" for k, w in enumerate(a)]
        rows[2 * i + 1] = (2 * i + 1, " ".join(b))
        near[2 * i + 1] = jaccard(a, b)
    base = words(rng, 200)
    rows += [(5000 + i, " ".join(w if p != i % 200 else f"q{i}" for p, w in enumerate(base))) for i in range(300)]  # a large group
    clean = [(10_000 + i, " ".join(words(rng, 60 + i % 50))) for i in range(500)]
    kept = {r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    alike = [d for d, s in near.items() if s >= 0.8]
    assert sum(d not in kept for d in alike) >= 0.9 * len(alike) and len(alike) > 80
    assert all(d not in kept for d, s in near.items() if s >= 0.9)
    assert all(d in kept for d, s in near.items() if s < 0.8) and sum(s < 0.7 for s in near.values()) >= 30
    assert {d for d, _ in clean} <= kept and {2 * i for i in range(150)} <= kept
    assert [d for d in kept if 5000 <= d < 6000] == [5000]


def test_odd_rows_of_the_stage(spark, odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 2, 4, 5, 8] and sum(r["doc_id"] is None for r in kept) == 1
    assert simhash.one_of_each(no_docs).count() == 0 and simhash.one_of_each(odd_docs).columns == odd_docs.columns
    same = spark.createDataFrame([(1, "one text of some words"), (1, "one text of some words"), (1, "another text, quite unlike it"), (None, "x y"), (None, "x y")], "doc_id long, text string")
    assert sorted(map(str, (r["text"] for r in simhash.one_of_each(same).collect()))) == ["another text, quite unlike it", "one text of some words", "x y"]


def test_wide_fingerprints_equal_a_plain_count():
    import numpy as np

    texts = [b"", b" \n", b"one", b"one two", b"a b c d e f g", b"A b c d e f G", b"w " * 700]
    made = simhash.wide_fingerprints(texts, 5)
    assert (made[0] == 0).all() and (made[1] == 0).all() and (made[4] == made[5]).all() and len({x.tobytes() for x in made}) == 5
    alone = np.concatenate([simhash.wide_fingerprints([t], 5) for t in texts])
    assert (alone == made).all()


def test_unlike_nodes_of_one_block_end(spark, monkeypatch):
    """Nodes that share every block and are all unlike: rounds end and give no edges."""
    monkeypatch.setattr(simhash, "PART", 8)
    rng = random.Random(2)
    word = lambda: rng.getrandbits(64) - (1 << 63)
    rows = [(i, *(word() for _ in range(4)), 1, 2, 3, 4) for i in range(60)]
    nodes = spark.createDataFrame(rows, "node long, " + ", ".join(f"{n} long" for n in ("v0", "v1", "v2", "v3", "b0", "b1", "b2", "b3")))
    assert simhash.near_links(nodes, simhash.Stage(spark, "unlike"), 50).count() == 0


def test_blocks_are_the_bits_of_the_fingerprint(spark):
    rng = random.Random(4)
    rows = [tuple(rng.getrandbits(64) - (1 << 63) for _ in range(4)) for _ in range(20)]
    df = spark.createDataFrame(rows, "b0 long, b1 long, b2 long, b3 long")
    names = [f"b{k}" for k in range(4)]
    for at, width in ((0, 17), (60, 24), (250, 30), (128, 64), (100, 64)):
        got = [r["x"] % (1 << 64) for r in df.select(simhash._block(names, at, width).alias("x")).collect()]
        whole = [sum((x % (1 << 64)) << (64 * k) for k, x in enumerate(r)) for r in rows]
        assert got == [((w >> at) | (w << (256 - at))) % (1 << width) for w in whole]


def test_links_between_parts_are_found(spark, monkeypatch):
    """Each pair of like nodes of one crowded block, also where a hash deals them to two parts."""
    monkeypatch.setattr(simhash, "PART", 8)
    rng, rows, want = random.Random(7), [], set()
    for i in range(40):
        v = [rng.getrandbits(64) for _ in range(4)]
        for k in range(2):
            w = [x ^ sum(1 << rng.randrange(64) for _ in range(8 * k)) for x in v]
            rows.append((2 * i + k, *((x % (1 << 64)) - (1 << 63) for x in w), 1, 2, 3, 4))
        apart = sum(bin((x + (1 << 63)) ^ (y + (1 << 63))).count("1") for x, y in zip(rows[-1][1:5], rows[-2][1:5]))
        if apart <= 50:
            want.add((2 * i, 2 * i + 1))
    nodes = spark.createDataFrame(rows, "node long, " + ", ".join(f"{n} long" for n in ("v0", "v1", "v2", "v3", "b0", "b1", "b2", "b3")))
    assert {tuple(r) for r in simhash.near_links(nodes, simhash.Stage(spark, "parts"), 50).collect()} == want and len(want) > 30


@pytest.mark.parametrize("part", [2048, 64])
def test_copies_of_one_text_that_are_unlike_each_other_go(spark, monkeypatch, part):
    """Each copy is like the first text alone; edges between copies, which fail, must not stand for those to it."""
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(8)
    base = words(rng, 400)
    rows, near = [(0, " ".join(base))], {}
    for i in range(1, 200):
        copy = list(base)
        for k, at in enumerate(rng.sample(range(10, 390), 7)):
            copy[at] = f"q{i}x{k}"
        rows.append((i, " ".join(copy)))
        near[i] = jaccard(base, copy)
    kept = {r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 0 in kept and sum(s >= 0.82 for s in near.values()) > 150
    assert len([i for i, s in near.items() if s >= 0.82 and i in kept]) <= 4
