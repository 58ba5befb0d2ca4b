"""The registered queries over whole small tables, against plain versions of their contracts."""

import os
import zlib
from collections import defaultdict

import duckdb
import pytest

import brute
from test_corpus_tables import check_mix
from tierstone.llm import registry, tokens

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text, lang, source from '{SF_DIR}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def labels():
    return dict(duckdb.sql(f"select doc_id, quality from '{SF_DIR}/labels.parquet'").fetchall())


def rows_of(spark, name):
    return {r.doc_id: r for r in registry.QUERIES[name](spark, SF_DIR).collect()}


def test_near_duplicates(spark, docs):
    got = rows_of(spark, "op3_simhash")
    docs = sorted(docs)
    fps = [brute.fingerprint(text) for _, text, _, _ in docs]
    for (doc_id, *_), fp, low in zip(docs, fps, brute.linked(fps)):
        assert (got[doc_id].fingerprint, got[doc_id].component_id) == (f"{fp:016x}", docs[low][0])


def test_language(spark, docs):
    got = rows_of(spark, "op4_language_id")
    assert len(got) == len(docs)
    held = [(i, lang) for i, _, lang, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].lang_pred == lang for i, lang in held) / len(held) >= 0.97


def test_mixing(spark, docs):
    got = registry.QUERIES["op5_mixing"](spark, SF_DIR).collect()
    source_of = {i: s for i, _, _, s in docs}

    class Row:
        def __init__(self, r):
            self.__dict__.update(r.asDict(), source=source_of[r.doc_id])

    check_mix(docs, [Row(r) for r in got], slack=64)


def test_quality_counts(spark, docs, labels):
    got = rows_of(spark, "op7_quality_rules")
    for doc_id, text, _, _ in docs:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality_counts(text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
    good = [i for i, q in labels.items() if q == 1 and not got[i].base_failed]
    assert sum(got[i].kept for i in good) / len(good) >= 0.98


def test_tokens(spark, docs):
    got, model = rows_of(spark, "op8_token_counts"), tokens.load(tokens.default_tokenizer_path())
    for doc_id, text, _, _ in docs:
        n = len(model.encode(text))
        assert (got[doc_id].n_bytes, got[doc_id].n_tokens, got[doc_id].over_limit) == (len(text.encode()), n, n > 4096)


def test_site_quality(spark, docs, labels):
    got = rows_of(spark, "op9_site_quality")
    assert len(got) == len(docs)
    held = [(i, q) for i, q in labels.items() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].kept != bool(q) for i, q in held) <= max(3, 0.05 * len(held))  # the smallest table holds out 19


def test_personal_data(spark, docs):
    got = rows_of(spark, "op10_pii")
    for doc_id, text, _, _ in docs:
        spans, r = brute.base_spans(text), got[doc_id]
        kinds = defaultdict(int)
        for _, kind, _ in spans:
            kinds[kind] += 1
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == brute.digest(spans)
        listed = [s for s in r.spans.split(",") if s]
        assert {f"{k}:{a}:{b}" for a, k, b in spans} <= set(listed)
        starts = [int(s.split(":")[1]) for s in listed]
        assert starts == sorted(starts)
