"""The text operators against brute force, the tokenizer library and planted cases."""

import hashlib
import itertools
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from ribolith.llm import bpe, html, langid, mixing, sharding, simhash, substrings, toxicity

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_bpe_equals_the_library_for_any_joint(reference, monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_CHARS", 5)
    own, rng = bpe.Codec(bpe.read_ranks(PATH), PATTERN), random.Random(3)
    parts = ["a", "b", " ", "\n", "'", "s", "re", "1", "é", "the", "ing", "  ", "\t", "!", "日本", "🙂", "'ll", "²", "\x1c", "́"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))
        ids = own.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert own.decode(ids) == text.encode()
    for text in ("a" * 3000, "ab" * 2000, " " * 999, "abc" * 500 + " " * 99 + "x"):
        assert own.encode(text) == reference.encode_ordinary(text)


def test_bpe_rows(spark, odd_docs, no_docs, reference):
    rows = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(odd_docs, PATH, PATTERN).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for r in odd_docs.collect():
        ids = reference.encode_ordinary(r["text"] or "")
        want.add((r["doc_id"], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r["text"] or "").encode())))
    assert rows == want
    assert bpe.digests(no_docs, PATH, PATTERN).count() == 0


def brute_components(rows):
    prints = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        bits = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
        prints.setdefault(sum(1 << b for b, n in bits.items() if 2 * n > len(shingles)), []).append(doc)
    group = {fp: fp for fp in prints}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    keys = list(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 2:
                group[root(a)] = root(b)
    least = {}
    for fp, docs in prints.items():
        known = [d for d in docs if d is not None]
        if known:
            least[root(fp)] = min(least.get(root(fp), known[0]), *known)
    return sorted((str(d), f"{fp:016x}", str(least.get(root(fp)))) for fp, docs in prints.items() for d in docs)


def test_simhash_equals_brute_force(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select(F.col("doc_id") + 5000, "text").toDF("doc_id", "text"))
    got = sorted((str(r[0]), r[1], str(r[2])) for r in simhash.report(docs).collect())
    assert got == brute_components([tuple(r) for r in docs.collect()])
    assert simhash.report(no_docs).count() == 0


def test_crowded_buckets_lose_and_add_no_link(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64) - (1 << 63)
    values = {base} | {base ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for _ in range(150)}
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    found = []
    for crowd in (4, 100_000):
        stage = simhash.Stage(spark, "test")
        found.append(sorted(map(tuple, simhash.components(simhash.links(nodes, stage, crowd=crowd), stage).collect())))
    assert found[0] == found[1] and found[0]


def test_one_document_of_each_group_stays(odd_docs, no_docs):
    kept = [r["doc_id"] for r in simhash.one_of_each(odd_docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 4, 5, 8, None], key=str)
    assert simhash.one_of_each(odd_docs).columns == odd_docs.columns
    assert simhash.one_of_each(no_docs).count() == 0


def test_shards_differ_by_one_row(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_docs.drop("fp", "node"))
    rows = sharding.report(docs).collect()
    assert len(rows) == docs.count()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.report(no_docs).count() == 0


def test_overflow_goes_clockwise():
    points = [(0, 0), (10, 1), (20, 2)]
    assert sharding.walk(points, {0: 5, 2: 1}, [2, 2, 2]) == [(0, 0, 2, 0, 0), (2, 0, 1, 2, 0), (0, 2, 4, 1, 0), (0, 4, 5, 2, 1)]


def test_mix_meets_targets(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.report(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    source = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    taken, target = Counter(), {}
    for r in rows:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - t) <= 0.01 * t + 5 for s, t in target.items())
    assert sorted(rows) == sorted(mixing.report(docs.repartition(7)).collect())
    assert mixing.report(odd_docs).count() == odd_docs.count() and mixing.report(no_docs).count() == 0
    again = mixing.apply_mix(docs)
    assert again.columns == docs.columns
    assert again.agg(F.sum(F.size(F.split(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), " ")))).first()[0] == pytest.approx(sum(taken.values()), rel=0.01)


def test_shares_are_capped_and_reshared():
    got = mixing.shares({"a": 10, "b": 100, None: 50}, 240.0)
    assert got["a"] == 20.0 and sum(got.values()) == pytest.approx(240.0) and all(v <= 2 * {"a": 10, "b": 100, None: 50}[k] for k, v in got.items())


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def test_planted_passages_are_found_and_cut(spark):
    rng = random.Random(8)
    passage = words(rng, 80)
    fuzzy = list(passage)
    fuzzy[20], fuzzy[50] = "other", "words"
    rows = [(1, words(rng, 100) + passage + words(rng, 50)), (2, words(rng, 30) + passage), (3, fuzzy + words(rng, 60)), (4, words(rng, 200)), (5, list(passage)), (6, [])]
    docs = spark.createDataFrame([(i, " ".join(w), len(" ".join(w))) for i, w in rows] + [(None, " ".join(passage), 1), (7, None, None)], "doc_id long, text string, n_chars long")
    found = {(r["doc_id"], r["ref_doc_id"]): r for r in substrings.report(docs).collect()}
    assert {d for d, _ in found} == {2, 3, 5}
    assert (found[2, 1]["start"], found[2, 1]["end"], found[2, 1]["ref_start"], found[2, 1]["ref_end"]) == (30, 110, 100, 180)
    assert found[3, 1]["matched"] == 78
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in substrings.cut_repeats(docs).collect()}
    assert set(left) == {1, 2, 3, 4, 6, 7, None}
    assert left[2][0].split() == rows[1][1][:30] and left[2][1] == len(left[2][0])
    assert left[1][0].split() == rows[0][1] and left[None][0] == " ".join(passage)


def test_passages_of_odd_documents(odd_docs, no_docs):
    assert {(r["doc_id"], r["ref_doc_id"]) for r in substrings.report(odd_docs).collect()} == {(6, 5)}
    assert substrings.report(no_docs).count() == 0


def test_chain_follows_order_and_gaps():
    def best(d, f):
        return substrings.best_chains(d, f, [substrings.WORDS] * len(d), [1] * len(d))[0]

    assert best([0, 5, 10, 15], [0, 5, 900, 15]) == [0, 1, 3]
    rng = random.Random(2)
    for _ in range(40):  # against all chains
        d, f = sorted(rng.sample(range(40), 7)), [rng.randrange(40) for _ in range(7)]

        def worth(chain):
            gaps = sum(d[b] - d[a] + f[b] - f[a] - 2 * substrings.WORDS for a, b in zip(chain, chain[1:]))
            return len(chain) - substrings.COST * gaps

        every = [c for k in range(1, 8) for c in itertools.combinations(range(7), k) if all(d[a] < d[b] and f[a] < f[b] for a, b in zip(c, c[1:]))]
        assert abs(worth(best(d, f)) - max(map(worth, every))) < 1e-9
    assert substrings.align(["a", "b", "c"], ["a", "x", "c"]) == 2


PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><nav><a href=x>Menu, one. Two.</a></nav>
<article><h1>Head</h1><p>First part, with <b>bold</b> words &amp; signs. It is long enough, is it not?<p>Second&nbsp;part.
<script>var a = "<p>no</p>";</script></p></article><section class="comments"><p>I agree, totally. Great post, thanks, bye.</p></section>
<aside>Side, text.</aside><footer>Foot, note.</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE) == "Head First part, with bold words & signs. It is long enough, is it not? Second part."
    assert html.main_text(None) == html.main_text("") == html.main_text("<p></p>") == ""
    assert html.main_text("plain text") == "plain text"


def test_pages_give_their_articles(spark):
    rows = html.report(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    assert len(rows) == 50 and all(r["n_chars"] == len(r["text"]) for r in rows)
    odd = spark.createDataFrame([(1, None, None), (2, "u", "<p>" * 5000 + "deep"), (3, "u", "x")], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html.report(odd).collect()} == {1: "", 2: "deep", 3: "x"}


def test_languages_of_held_out_texts(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in langid.report(docs).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    got = {r["doc_id"]: r for r in langid.report(odd_docs).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (2, 3, 7, 8)) and got[4]["lang_pred"] == "en"
    assert langid.report(no_docs).count() == 0


def test_toxicity_of_held_out_texts(spark, odd_docs, no_docs):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in toxicity.report(docs, labels).collect() if r["held_out"] and r["doc_id"] in toxic]
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in held) >= 0.97 * len(held)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.report(odd_docs, none).count() == odd_docs.count() and toxicity.report(no_docs, labels).count() == 0


def test_isotonic_rises():
    import numpy as np

    knots, values = toxicity.isotonic(np.array([0.0, 1.0, 2.0, 3.0]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert list(values) == sorted(values) and list(knots) == sorted(knots)
