"""The registered queries of the training-data operators; each applies its operator to the whole of its table."""

from __future__ import annotations

from ribolith.llm import bpe, divergence, html, langid, maxscore, mixing, nndescent, quality, sharding, simhash, substrings, toxicity, zonemaps
from ribolith.llm.common import table


def op1_tag_paths(spark, sf_dir):
    return html.report(table(spark, sf_dir, "pages"))


def op3_toxicity_trees(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_byte_cnn(spark, sf_dir):
    return langid.report(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_collinear_chains(spark, sf_dir):
    return substrings.report(table(spark, sf_dir, "documents"))


def op6_cube_mixing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


def op7_maxscore(spark, sf_dir):
    return maxscore.report(table(spark, sf_dir, "embeddings"))


def op9_nn_descent(spark, sf_dir):
    return nndescent.nearest(table(spark, sf_dir, "embeddings"))


def op8_ring_shards(spark, sf_dir):
    return sharding.report(table(spark, sf_dir, "documents"))


def op10_simhash(spark, sf_dir):
    return simhash.report(table(spark, sf_dir, "documents"))


def op11_stripes(spark, sf_dir):
    return divergence.report(table(spark, sf_dir, "documents"))


def op12_ftrl_quality(spark, sf_dir):
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hilbert_zones(spark, sf_dir):
    return zonemaps.report(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_tag_paths, op2_byte_bpe, op3_toxicity_trees, op4_byte_cnn, op5_collinear_chains, op6_cube_mixing, op7_maxscore, op8_ring_shards, op9_nn_descent, op10_simhash, op11_stripes, op12_ftrl_quality, op13_hilbert_zones)}


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
ORACLES: dict[str, str] = {"op7_maxscore": maxscore.ORACLE, "op11_stripes": divergence.ORACLE, "op13_hilbert_zones": zonemaps.ORACLE}
