"""Haplotypes and their logs against a plain search over all combinations."""

import itertools
import random

from pyspark.sql import functions as F

from ribolith.functions.sequence import codon_table
from ribolith.operators import haplotypes as H

CODONS = codon_table()


def translate(seq):
    return "".join(CODONS.get(seq[i : i + 3], "X") for i in range(0, len(seq) - 2, 3))


def plain(seq, variants):
    """{(sequence, log): least number} of one sequence; variants have distinct places."""
    out = {}
    options = [([None] if af < 0.51 else []) + list(dict.fromkeys(alt.split(","))) for _, _, alt, af in variants]
    for choice in itertools.product(*(range(len(o)) for o in options)):
        now, offset, until, log, number, stride = seq, 0, 0, [], 0, 1
        for (pos, ref, _, af), o, c in zip(variants, options, choice):
            number, stride = number + c * stride, stride * len(o)
            if o[c] is None or pos <= until:
                continue
            at = pos + offset
            now = now[: at - 1] + o[c] + now[at - 1 + len(ref) :]
            log.append((at, ref, o[c], af))
            offset, until = offset + len(o[c]) - len(ref), pos + len(ref) - 1
        key = now, tuple(log)
        out[key] = min(number, out.get(key, number))
    return out


def plain_changes(seq, log):
    whole, out = translate(seq), []
    read = whole.index("*") + 1 if "*" in whole else len(whole)
    for pos, ref, alt, af in log:
        back = seq[: pos - 1] + ref + seq[pos - 1 + len(alt) :]
        if (pos - 1) // 3 < read and (len(ref) != len(alt) or translate(back) != whole):
            out.append((pos, ref, alt, af))
    return out


def made(n=60):
    rng = random.Random(11)
    orfs, variants = [], []
    for i in range(n):
        seq = "ATG" + "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 90)))
        orfs.append((i, seq))
        for pos in rng.sample(range(1, len(seq) + 1), min(len(seq), rng.randint(0, 6))):
            ref = "".join(rng.choice("ACGT") for _ in range(rng.choice((1, 1, 1, 2, 4))))
            alt = ",".join("".join(rng.choice("ACGT") for _ in range(rng.choice((1, 1, len(ref), 3)))) for _ in range(rng.choice((1, 1, 2))))
            variants.append((i, pos, ref, alt, rng.choice((1.0, 0.5, 0.5, 0.3))))
    return orfs, variants


def test_haplotypes_equal_all_combinations(spark):
    orfs, variants = made()
    used = [v for v in variants if v[4] > 0.99 or 0.49 < v[4] < 0.51]
    whole, out = H.apply_variants(spark.createDataFrame(orfs, "orf_id long, seq string"), spark.createDataFrame(variants, "orf_id long, tr_pos long, ref string, alt string, af double"), most=24)
    rows = whole.withColumn("changes", H.nonsynonymous(F.col("seq"), F.col("log"))).collect()
    lost = {(r["orf_id"], r["tr_pos"], r["reason"]) for r in out.collect()}
    changed = 0
    for i, seq in orfs:
        own = sorted(v[1:] for v in used if v[0] == i)
        many = 1
        for _, _, alt, af in own:
            many *= len(set(alt.split(","))) + (af < 0.51)
        got = {(r["seq"], tuple(map(tuple, r["log"]))): r for r in rows if r["orf_id"] == i}
        if many > 24:
            assert not got and {(i, v[0], "haplotypes") for v in own} == {x for x in lost if x[0] == i}
            continue
        assert {k: r["haplotype"] for k, r in got.items()} == plain(seq, own)
        for (hap, log), r in got.items():
            assert r["offset"] == len(hap) - len(seq) or own and max(v[0] + len(v[1]) for v in own) > len(seq)
            assert [tuple(x) for x in r["changes"]] == plain_changes(hap, log)
            changed += len(r["changes"])
    assert changed > 50 and any(x[2] == "haplotypes" for x in lost)


def test_odd_variants(spark):
    """Nulls, places outside, copies of one place, repeated rows, no variants, none at all."""
    orfs = spark.createDataFrame([(1, "ATGAAATAA"), (2, "ATG"), (3, None), (4, "")], "orf_id long, seq string")
    rows = [(1, 4, "A", "C", 1.0), (1, 4, "A", "C", 1.0), (1, 4, "A", "G", 0.5), (1, 0, "A", "C", 1.0), (1, 10, "A", "C", 0.5), (1, None, "A", "C", 1.0), (1, 5, None, "C", 1.0), (3, 1, "A", "C", 1.0), (9, 1, "A", "C", 1.0), (4, 1, "A", "C", 1.0)]
    variants = spark.createDataFrame(rows, "orf_id long, tr_pos long, ref string, alt string, af double")
    whole, out = H.apply_variants(orfs, variants)
    assert {(r["orf_id"], r["haplotype"], r["seq"]) for r in whole.collect()} == {(1, 0, "ATGCAATAA"), (2, 0, "ATG"), (4, 0, "")}
    assert sorted((r["orf_id"], r["tr_pos"], r["alt"], r["reason"]) for r in out.collect()) == [(1, 0, "C", "position"), (1, 4, "G", "copy"), (1, 10, "C", "position"), (4, 1, "C", "position")]
    whole, out = H.apply_variants(orfs, variants.where("false"))
    assert whole.count() == 3 and out.count() == 0


def test_sequences_are_not_grouped(spark):
    """Equal haplotypes are told by their options: sequences of haplotypes meet no shuffle."""
    orfs = spark.createDataFrame([(1, "ATGACGTAA")], "orf_id long, seq string")
    variants = spark.createDataFrame([(1, 4, "ACG", "A", 1.0), (1, 5, "C", "G,T", 0.5)], "orf_id long, tr_pos long, ref string, alt string, af double")
    rows = H.apply_variants(orfs, variants)[0]
    assert [tuple(r)[:4] for r in rows.collect()] == [(1, 0, "ATGATAA", -2)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Aggregate" in line and "seq" in line for line in plan.splitlines())


def test_all_haplotypes_of_a_crowded_sequence(spark):
    """Without a bound a sequence of more than 4,096 combinations is built as a whole, run by run, beside one without variants (F8)."""
    from ribolith.plans import catalog

    rng = random.Random(5)
    seq = "".join(rng.choice("ACGT") for _ in range(60))
    variants = [(1, 3 + 4 * i, seq[2 + 4 * i], "C,G" if i == 4 else "TT", 0.5) for i in range(11)] + [(1, 4, "AC", "A", 0.5), (1, 50, "ACGT", "C,T", 1.0)]
    orfs = spark.createDataFrame([(1, seq), (2, seq)], "orf_id long, seq string")
    rows, out = H.apply_variants(orfs, spark.createDataFrame(variants, "orf_id long, tr_pos long, ref string, alt string, af double"), most=None)
    rows = rows.collect()
    got = {(r["seq"], tuple(map(tuple, r["log"]))): r["haplotype"] for r in rows if r["orf_id"] == 1}
    assert got == plain(seq, sorted(v[1:] for v in variants)) and len(got) > 4096 and len(rows) == len(got) + 1
    assert out.count() == 0
    assert "> 256" not in catalog.ORACLES["nonsynonymous_variants"] and "> 256" in catalog.ORACLES["haplotypes"]
