"""Registered queries against DuckDB, brute force, exact round trips and held-out labels."""

from __future__ import annotations

import collections
import hashlib
import math
import zlib

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from vitalgrid.llm import order_minhash, queries
from vitalgrid.llm.tokens import default_vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


@pytest.fixture(scope="module")
def run(spark):
    def rows(name, sf=SF):
        return queries.queries()[name](spark, sf).toPandas().sort_values("doc_id").reset_index(drop=True)
    return rows


@pytest.fixture(scope="module")
def token_ids(docs):
    tokenizer = Tokenizer.from_file(default_vocabulary())
    found = tokenizer.encode_batch(docs.text.tolist(), add_special_tokens=False)
    return [np.array([*e.ids, 1], "<u4") for e in found]


@pytest.mark.parametrize("name", ["op1_token_rollup", "op4_near_dedup", "op8_exact_dedup", "op9_mixing",
                                  "op11_ngram_join", "op13_bisector_clusters"])
def test_sql(against_sql, name):
    assert against_sql(name)


def test_exact_groups_of_many_rows(against_sql, monkeypatch):
    """Frequent texts by broadcast, all others by a join, as with more rows than tests have."""
    from vitalgrid.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "HEAVY_SHARE", 60)
    assert against_sql("op8_exact_dedup")


def test_mix_meets_its_targets(run):
    found = run("op9_mixing", "/root/testdata/sf0.01")
    assert (found.taken <= 3 * found["size"]).all()
    sources = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").sort_values("doc_id").source.values
    for _, rows in found.groupby(sources):
        assert abs(rows.taken.sum() - rows.target.iloc[0]) <= max(0.05 * rows.target.iloc[0], rows["size"].max())


def test_fingerprints(run, docs):
    found = run("op2_order_minhash")
    n = len(docs)
    prints = [order_minhash.fingerprint(t) for t in docs.text]
    for i, row in found.iterrows():
        after = (i - 1) % n  # ascending here: the next smaller id, and after the smallest the largest
        edited = order_minhash.edited_text(docs.text[i], docs.text[after])
        changed = order_minhash.fingerprint(edited)
        assert row.n_chars == len(docs.text[i])
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (
            order_minhash.as_text(prints[i]), order_minhash.as_text(changed))
        assert row.near_edited == order_minhash.likeness(prints[i], changed)
        assert row.near_next == order_minhash.likeness(prints[i], prints[after])
    assert found.near_edited.mean() > 10 * found.near_next.mean()


def components_of(docs: pd.DataFrame) -> dict:
    sets, parent = {}, {}
    for i, text in zip(docs.doc_id, docs.text):
        words = text.encode().lower().split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        parent[i] = i

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, found in sets.items():
        for shingle in found:
            holders[shingle].append(i)
    for i, found in sets.items():
        for j, shared in collections.Counter(j for s in found for j in holders[s] if j > i).items():
            if 100 * shared >= 85 * (len(found) + len(sets[j]) - shared):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_near_groups(run):
    sf = "/root/testdata/sf0.01"
    found = run("op4_near_dedup", sf)
    expected = components_of(pd.read_parquet(f"{sf}/documents.parquet"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == expected
    assert (found.kept == (found.doc_id == found.component_id)).all()


def test_token_files(run, docs, token_ids):
    found = run("op5_token_output")
    lengths = np.array([len(x) for x in token_ids])
    assert (found.doc_id == docs.doc_id).all() and (found.n_tokens == lengths).all()
    assert (found.start == np.cumsum(lengths) - lengths).all()
    assert found.ids_crc32.tolist() == [zlib.crc32(x.tobytes()) for x in token_ids]


def test_packing(run, docs, token_ids):
    found = run("op10_packing").sort_values(["doc_id", "start"])
    of = dict(zip(docs.doc_id, token_ids))
    assert found.sequence_id.is_unique and (found.offset == 0).all()
    assert set(found.length) <= {1 << i for i in range(12)}
    for doc_id, rows in found.groupby("doc_id"):
        ids = of[doc_id]
        assert (rows.doc_tokens == len(ids)).all() and rows.length.sum() == len(ids)
        assert (rows.start == rows.length.cumsum() - rows.length).all()
        for r in rows.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())


def held(ids, divisor, rest):
    return np.array([zlib.crc32(str(i).encode()) % divisor == rest for i in ids])


def test_quality_on_held_out_labels(run):
    sf = "/root/testdata/sf0.01"
    found = run("op3_quality", sf)
    assert (found.held_out == held(found.doc_id, 5, 0)).all()
    assert (found.predicted == (found.score >= 0.3)).all()
    labelled = found.merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    fresh = labelled[labelled.held_out]
    assert (fresh.predicted == fresh.quality).mean() > 0.95
    assert fresh[fresh.quality == 1].predicted.mean() > 0.98


def test_language_on_held_out_documents(run):
    sf = "/root/testdata/sf0.01"
    found = run("op6_language", sf)
    assert (found.held_out == held(found.doc_id, 4, 2)).all()
    known = found.merge(pd.read_parquet(f"{sf}/documents.parquet")[["doc_id", "lang"]], on="doc_id")
    fresh = known[known.held_out & (known.lang_pred != "und")]
    assert (fresh.lang == fresh.lang_pred).mean() > 0.97 and known.score.between(0, 1).all()


@pytest.mark.parametrize("shares", [None, (200, 500)])
def test_language_model(run, docs, monkeypatch, shares):
    from vitalgrid.llm import hmm

    if shares:  # most words are looked up by the join
        monkeypatch.setattr(hmm, "HELD_SYMBOLS", shares[0])
        monkeypatch.setattr(hmm, "LISTED_SHARE", shares[1])
    found = run("op7_hmm_scores")
    out = held(docs.doc_id, 5, 1)
    tokens = [[*t.encode().lower().split(), b""] for t in docs.text]
    counts = collections.Counter(w for t, o in zip(tokens, out) if not o for w in t)
    total, distinct = sum(counts.values()), len(counts)
    assert (found.held_out == out).all() and (found.train_tokens == total).all()
    assert (found.n_tokens == [len(t) for t in tokens]).all()
    assert (found.n_known == [sum(w in counts for w in t) for t in tokens]).all()
    base = [sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t) for t in tokens]
    assert np.allclose(found.base_score, base, rtol=1e-9)
    assert found[found.held_out].score.sum() > found[found.held_out].base_score.sum()


def test_symbols_do_not_depend_on_shares(run, monkeypatch):
    """Words that tasks do not hold are learned as well: scores are those with all symbols held."""
    from vitalgrid.llm import hmm

    whole = run("op7_hmm_scores")
    for held_symbols, fan_in in ((200, 2), (0, 64)):
        monkeypatch.setattr(hmm, "HELD_SYMBOLS", held_symbols)
        monkeypatch.setattr(hmm, "LISTED_SHARE", 500)
        monkeypatch.setattr(hmm, "FAN_IN", fan_in)
        joined = run("op7_hmm_scores")
        assert np.allclose(joined.base_score, whole.base_score, rtol=1e-9)
        # the same words begin alike and learn alike, wherever their counts are kept
        assert np.allclose(joined.score, whole.score, rtol=1e-5)
