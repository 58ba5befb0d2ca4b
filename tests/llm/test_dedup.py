import random

import numpy as np
import pytest

import brute
from conftest_odd import ODD
from tierstone.llm import simhash


def test_fingerprints_match_brute_force():
    rng = random.Random(1)
    texts = [None, "", " ", "One", "a b c d", "a b c d e", "É é A b \x1c c d"]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    assert [simhash.fingerprint(t) for t in texts] == [brute.fingerprint(t) for t in texts]


def test_long_text_is_hashed_whole():
    text = " ".join(str(i % 977) for i in range(80_000))
    assert simhash.fingerprint(text) == brute.fingerprint(text)


def clusters(rng, groups, size, spread):
    out = []
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, size)):
            out.append(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, spread))))
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("spread", [2, 4, 6])
def test_trees_find_the_components(spread):
    rng = random.Random(spread)
    fps = np.array(clusters(rng, 40, 12, spread), np.uint64)
    everything = np.ones(len(fps), bool)
    a, b = simhash.tree_links(fps, np.zeros(len(fps), np.int64), everything, everything, 4, step=17)
    label = simhash.smallest_linked(len(fps), a, b)
    assert label.tolist() == brute.linked([int(f) for f in fps])


def test_search_follows_only_edges_in_reach():
    rng = random.Random(3)
    fps = np.array([rng.getrandbits(64) for _ in range(3000)], np.uint64)
    forest = simhash.Forest(fps, np.zeros(3000, np.int64), np.ones(3000, bool))
    visited = sum(len(x) for x, _ in ((q, f) for q, f in forest.search(np.arange(3000), np.zeros(3000, np.int64), 64)))
    assert visited == 3000 * 3000  # a radius of 64 finds all: no node is lost
    hits = [(int(q), int(f)) for x in forest.search(np.arange(3000), np.zeros(3000, np.int64), 4) for q, f in zip(*x)]
    assert sorted(hits) == [(i, i) for i in range(3000)]


@pytest.mark.parametrize("shard_rows", [2048, 5])
def test_components_match_brute_force(spark, shard_rows):
    rng = random.Random(9)
    fps = clusters(rng, 30, 25, 3)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    found = dict(simhash.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), shard_rows=shard_rows)).collect())
    expected = brute.linked(fps)
    groups = {}
    for i, e in enumerate(expected):
        groups.setdefault(e, set()).add(found.get(signed[i], signed[i]))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {tuple(r) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(301)}


def test_documents(make):
    rows = [r[:2] for r in ODD]
    got = sorted(map(tuple, simhash.near_duplicates(make(*ODD)).collect()), key=repr)
    fps = [brute.fingerprint(t) for _, t in rows]
    label = brute.linked(fps)
    low = {}
    for (doc_id, _), k in zip(rows, label):
        if doc_id is not None:
            low[k] = min(doc_id, low.get(k, doc_id))
    expected = [(d, f"{f:016x}", low.get(k)) for (d, _), f, k in zip(rows, fps, label)]
    assert got == sorted(expected, key=repr)


def test_empty_table(make):
    assert simhash.near_duplicates(make()).collect() == []
    assert simhash.keep_one(make()).collect() == []


def test_keep_one_keeps_different_texts_of_one_id(make):
    docs = make((1, "alpha beta gamma delta epsilon zeta"), (1, "other words that stand here for themselves"), (2, "Alpha beta gamma delta epsilon zeta"), (None, "alpha beta gamma delta epsilon zeta"))
    clashing = docs.selectExpr("*", "1 as fp", "2 as row")
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted((r.doc_id, r.text[:5]) for r in kept.collect()) == [(1, "alpha"), (1, "other")]
