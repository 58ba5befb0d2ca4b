"""Substring dedup against a plain version, and the cover's promise."""

import hashlib
import random
from collections import Counter

import pytest

from brute import WORD
from conftest_odd import ODD
from tierstone.llm import substrings


def plain(texts, window):
    """(n_words, kept words, removed) per text."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        out.append((len(w), [x for p, x in enumerate(w) if p not in gone], len(gone)))
    return out


def found(rows):
    out = []
    for r in rows:
        removed = sum(s.stop - s.start for s in r.spans)
        assert (r.kept_text is None) == (not r.spans)
        out.append((r.doc_id is None, r.doc_id or 0, r.n_words, removed, r.words_sha256 if r.kept_text is None else hashlib.sha256(r.kept_text.encode()).hexdigest()))
    return sorted(out)


def expected(docs, window):
    rows = zip(docs, plain([t for _, t in docs], window))
    return sorted((d is None, d or 0, n, removed, hashlib.sha256(" ".join(kept).encode()).hexdigest()) for (d, _), (n, kept, removed) in rows)


@pytest.mark.parametrize("window", [1, 4, 10, 12, 20, 35])
def test_any_two_offsets_share_a_place_of_the_cover(window):
    period, places, width = substrings.cover_of(window)
    assert width + period - 1 == window
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in places and (j + d) % period in places for d in range(period))
    n = 3 * window + 5
    assert set(substrings.anchor_places(n, window).tolist()) == {p for p in range(n - width + 1) if p % period in places}


@pytest.mark.parametrize("window", [4, 10, 35])
def test_matches_plain_version(spark, make, monkeypatch, window):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 5000)
    rng = random.Random(window)
    pool = [[f"w{rng.randrange(12)}" for _ in range(rng.randint(window, 3 * window))] for _ in range(6)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5:
                part = list(rng.choice(pool))
                cut = rng.randint(0, 3)
                part = part[cut : len(part) - rng.randint(0, 3)]
                if part and rng.random() < 0.3:
                    part[rng.randrange(len(part))] = "changed"
            else:
                part = [f"x{rng.randrange(10**6)}" for _ in range(rng.randint(0, 2 * window))]
            words += part
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    docs += [docs[5], docs[6], (None, docs[7][1])] + [r[:2] for r in ODD if r[0] != 6] + [(6, "word " * 300)]
    got = found(substrings.find_repeated(make(*docs), window).collect())
    assert got == expected(docs, window)
    assert 0 < sum(r[3] > 0 for r in got) < len(got)


def test_chunks_do_not_change_the_result(spark, make):
    docs = [(i, " ".join(f"w{(i * k) % 17}" for k in range(60))) for i in range(40)]
    look = lambda row: ((), substrings.anchor_hashes(substrings.WordValues().of(substrings.split(row["text"])), 10))
    got = []
    for size in (50, 10**6):
        substrings_limit, substrings.CHUNK_ENTRIES = substrings.CHUNK_ENTRIES, size
        try:
            rows = make(*docs).selectExpr("text", "unhex(md5(text)) as text_key")
            index = substrings.packed(rows, look, {}, ["text_key"], 3, "test-anchors")
            found_ = substrings.repeated_entries(index, "text_key", 1).collect()
        finally:
            substrings.CHUNK_ENTRIES = substrings_limit
        got.append(sorted((bytes(r.text_key), substrings.from_steps(r.places).tolist()) for r in found_))
    assert got[0] == got[1] and got[0]


def test_removal_keeps_rows_and_columns(spark, make):
    same = " ".join(f"a{i}" for i in range(40))
    docs = make((1, f"start {same}  end"), (2, same), (2, same), (3, None), (4, "short  text")).withColumnRenamed("lang", "text_key").withColumnRenamed("source", "kept_text")
    got = substrings.remove_repeated(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in got.collect()) == [(1, "start end"), (2, ""), (2, ""), (3, ""), (4, "short  text")]
    assert substrings.find_repeated(make()).collect() == []
