"""How many keys move on the ring when a shard is added, by slack."""

import numpy as np
import pytest

from ribolith.llm import sharding


def shards_of(keys, shards, slack):
    points = sharding.ring(shards, 64)
    arcs = np.searchsorted(np.array([p for p, _ in points]), keys) % len(points)
    counts = dict(zip(*(x.tolist() for x in np.unique(arcs, return_counts=True))))
    most = sharding.bounds(len(keys), shards, slack)
    order = np.lexsort((keys, arcs))
    start = dict(zip(*np.unique(arcs[order], return_index=True)))
    out = np.full(len(keys), -1)
    for arc, first, end, shard, _ in sharding.walk(points, counts, most):
        out[order[start[arc] + first : start[arc] + end]] = shard
    assert (out >= 0).all() and (np.bincount(out, minlength=shards) <= np.array(most)).all()
    return out


@pytest.mark.parametrize("slack, moved", [(10.0, 0.04), (0.5, 0.04), (0.25, 0.08), (0.0, 0.08)])
def test_few_keys_move_to_one_more_shard(slack, moved):
    keys = np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, 20_000)
    before, after = shards_of(keys, 40, slack), shards_of(keys, 41, slack)
    share = (before != after).mean()
    assert 0.01 < share <= moved
    if slack == 10.0:
        assert set(after[before != after]) == {40}  # no shard is full: keys go to the new shard only
