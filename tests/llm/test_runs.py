"""Periodic runs: the catchers and the query against plain versions."""

import hashlib
import os
import random
import zlib
from fractions import Fraction

import duckdb
import pytest

from brute import WORD
from conftest_odd import ODD
from tierstone.llm import registry, runs

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain_runs(words, min_length=24, exponent=3):
    """Every period in turn: maximal stretches of words equal to those a period before."""
    n, smallest = len(words), {}
    for q in range(1, n // exponent + 1):
        s = q
        while s < n:
            e = s
            while e < n and words[e] == words[e - q]:
                e += 1
            if e - s + q >= max(min_length, exponent * q):
                smallest.setdefault((s - q, e - s + q), q)
            s = e + 1
    return sorted((start, length, q) for (start, length), q in smallest.items())


def random_words(rng):
    n, kinds = rng.randint(0, 200), rng.choice([1, 2, 3, 50])
    words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
        for i in range(a + p, rng.randint(a, n)):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_catchers_match_plain_runs(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words, least, exponent = random_words(rng), rng.choice([2, 6, 24]), rng.choice([2, 3])
        stretch = rng.choice([1, 3, 50, 1000])
        assert runs.runs_of(words, least, exponent, stretch) == plain_runs(words, least, exponent)


def test_long_periodic_texts_take_one_extension():
    assert runs.runs_of([b"w"] * 200_000) == [(0, 200_000, 1)]
    assert runs.runs_of([b"%d" % (i % 7919) for i in range(100_000)]) == [(0, 100_000, 7919)]
    thue_morse = [b"%d" % (i.bit_count() % 2) for i in range(1 << 14)]  # has squares but no cubes
    assert runs.runs_of(thue_morse) == []


def test_rows_columns_and_odd_texts(spark, make):
    odd = make(*ODD).withColumnRenamed("lang", "runs").withColumnRenamed("source", "Collapsed")
    got = runs.find_runs(odd)
    assert got.columns == ["doc_id", "text", "runs", "Collapsed", "n_chars", "_runs", "_collapsed"]
    rows = got.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        words = WORD.findall(r.text or "")
        if r.doc_id == 6:
            assert [tuple(x) for x in r._runs] == [(0, 30_000, 1)] and r._collapsed == "word"
        else:
            assert r._runs == [] and r._collapsed == " ".join(words)
    assert runs.find_runs(make()).collect() == []


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = sha("".join(f"{s},{length},{q}\n" for s, length, q in found))
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, listed, sha(kept))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_query_matches_plain_version(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    short = {i: t for i, t in docs if len(t or "") < 12_000}  # the plain version is quadratic
    assert len(short) > 0.9 * len(docs)
    rows = registry.QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        if r.doc_id in short:
            got = (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
            assert got == expected(r.doc_id, short[r.doc_id])
    assert sum(r.n_runs > 0 for r in rows) >= 0.05 * len(rows)
