"""Ranked search against a plain version, and the bounds of the tree."""

import math
import random
import re
from collections import Counter

import numpy as np

import brute
from conftest_odd import ODD
from tierstone.llm import balltree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_rank(docs, items, top=50):
    bags = [Counter(TERM.findall(brute.lower(t))) for _, t in docs]
    n_docs, length = sum(bool(b) for b in bags), sum(b.total() for b in bags)
    df = Counter(t for b in bags for t in b)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall(brute.lower(text)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for (doc_id, _), bag in zip(docs, bags):
            m = 50 + (50 * bag.total() * n_docs) // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in terms if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item is None, item or 0, rank, none, doc_id, -score))
    return sorted(out)


def got_rows(df):
    return sorted((r.item_id is None, r.item_id or 0, r.rank, r.doc_id is None, r.doc_id or 0, r.score) for r in df.collect())


def corpus(rng, n):
    kinds = [[f"{a}{b}" for b in range(rng.randint(3, 30))] for a in "abcdef"]
    return [(i, rng.choice([" ", ", ", "-"]).join(rng.choice(rng.choice(kinds)).upper() for _ in range(rng.randint(0, 40)))) for i in range(n)]


def test_matches_plain_version(spark, make, monkeypatch):
    monkeypatch.setattr(balltree, "SHARD_ROWS", 90)
    rng = random.Random(3)
    docs = corpus(rng, 400)
    docs += docs[:30] * 3 + [(None, docs[3][1]), (None, docs[3][1])] + [r[:2] for r in ODD]
    items = [(i, text) for i, text in corpus(rng, 25)] + [(2, "a1 été word"), (None, "B2 b3"), (77, None), (78, " , "), (79, "absent entirely")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got_rows(balltree.rank_documents(make(*docs), bench)) == plain_rank(docs, items)
    monkeypatch.setattr(balltree, "BLOCK_TERMS", 40)
    assert got_rows(balltree.rank_documents(make(*docs), bench, top=7)) == plain_rank(docs, items, 7)


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert balltree.rank_documents(make((1, "a b")), none).collect() == []
    one = spark.createDataFrame([(1, "a b")], none.schema)
    assert balltree.rank_documents(make(), one).collect() == []
    assert balltree.rank_documents(make((1, None), (2, "..")), one).collect() == []


def tree_of(rng, n, n_terms, clusters):
    centres = [rng.choice(n_terms, 25, replace=False) for _ in range(clusters)]
    rows = [np.sort(rng.choice(centres[i * clusters // n], 15, replace=False)) for i in range(n)]
    ptr = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    impacts = rng.integers(1, 10**6, ptr[-1])
    weights = rng.integers(1, 9000, n_terms)
    return balltree.BallTree(ptr, np.concatenate(rows), impacts, weights), centres


def test_bounds_hold_and_subtrees_are_pruned():
    rng = np.random.default_rng(1)
    tree, centres = tree_of(rng, 4096, 2000, 64)
    leaves = sum(not c for c in tree.children)
    for k in range(12):
        item = np.sort(rng.choice(centres[k], 10, replace=False))
        bounds = tree.bounds(item)
        tree.dense[item] = tree.weights[item]
        best = {}
        for node in reversed(range(len(tree.low))):
            below = [best[c] for c in tree.children[node]]
            best[node] = max(below) if below else int(tree.leaf_scores(node).max())
            assert bounds[node] >= best[node]
        tree.dense[item] = 0
        heap = []
        scored = tree.search(item, heap, list(range(4096)), 50, 1)
        assert len(heap) == 50 and max(heap)[0] == best[0]
        assert scored <= leaves / 2  # most document clusters of other items are never looked at
