"""The join over prefix trees against all pairs."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from vitalgrid.llm import families, near_dedup, ngram_join
from vitalgrid.llm.ngrams import ngram_sets, set_names, word_hashes
from vitalgrid.llm.prefix_tree import Groups, PrefixTree


def linked(a, b, percent):
    shared = len(a & b)
    return bool(a) and bool(b) and 100 * shared >= percent * (len(a) + len(b) - shared)


def shingles(text, width=5):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_groups(rows, percent=80):
    """``doc_id, n, smallest reachable id`` by comparing all pairs of rows."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if linked(sets[i], sets[j], percent):
            top[find(j)] = find(i)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((d, len(s), low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def groups(spark, rows, percent=80):
    frame = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, key int, tokens string")
    return sorted(map(tuple, ngram_join.ngram_groups(frame, percent).collect()), key=str)


def family(rng, words, members, edits):
    """Texts that differ from one text in some words, at places of their own."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(members):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(text))
            if rng.random() < 0.5:
                text[at] = f"e{rng.randrange(200)}"
            else:
                del text[at]
        yield " ".join(text)


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    for words in (1, 3, 5, 6, 7, 9, 14, 30, 60, 60, 90, 150, 300, 340, 380, 430, 520, 700):
        texts += family(rng, words, rng.randint(2, 14), max(1, words // 28))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} own{i} words{i}" for i in range(20)] + [f"lead{i} {passage}" for i in range(20)]
    texts += texts[:25] + [t.upper() for t in texts[30:40]] + [t.replace(" ", "\t\n ") for t in texts[60:80]]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    return rows + [(1, None), (2, ""), (3, " \n "), (None, texts[0]), (None, "only here"), (None, "only here"), (7, texts[5]),
                   (7, texts[5]), (7, "another text under the same id as others have")]


@pytest.mark.parametrize("percent", [80, 60, 95])
def test_components_are_those_of_all_pairs(spark, percent):
    rows = corpus(percent)
    assert groups(spark, rows, percent) == plain_groups(rows, percent)


def test_split_families_and_frequent_tokens(spark, monkeypatch):
    """Blocks of a few sets each, and every token of ten sets counts as frequent."""
    monkeypatch.setattr(families, "BLOCK_WEIGHT", 900)
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", 10)
    monkeypatch.setattr(ngram_join, "FREQUENT_SHARE", 10 ** 9)
    rows = corpus(4)
    rng = random.Random(5)
    rows += list(enumerate(family(rng, 120, 60, 6), 10_000)) + list(enumerate(family(rng, 400, 30, 20), 20_000))
    assert groups(spark, rows) == plain_groups(rows)


@pytest.mark.parametrize(("percent", "weight"), [(80, 400_000), (85, 900)])
def test_signatures_find_the_same(spark, monkeypatch, percent, weight):
    """Near-dedup by signatures against all pairs, in large and in small blocks."""
    monkeypatch.setattr(families, "BLOCK_WEIGHT", weight)
    rows = corpus(percent + 1)
    rng = random.Random(6)
    rows += list(enumerate(family(rng, 120, 60, 6), 10_000)) + list(enumerate(family(rng, 60, 60, 9), 20_000))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r)[:3] for r in near_dedup.near_groups(frame, percent).collect()), key=str)
    assert found == plain_groups(rows, percent)


def test_chains_reach_the_smallest_id(spark):
    """Each text is linked with its neighbours only."""
    words = [f"c{i}" for i in range(200)]
    rows = [(100 - i, " ".join(words[2 * i:2 * i + 60])) for i in range(60)]
    found = groups(spark, rows)
    assert found == plain_groups(rows) and {r[2] for r in found} == {41}


def test_odd_tables(spark):
    assert groups(spark, []) == []
    assert groups(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]
    long = " ".join(str(i) for i in range(150_000))
    rows = [(1, long), (2, long + " more"), (3, long.replace("7", "x")), (4, "a")]
    assert [r[2] for r in groups(spark, rows)] == [1, 1, 3, 4]
    with pytest.raises(ValueError, match="similarity"):
        ngram_join.ngram_groups(spark.createDataFrame([], "doc_id int, text string"), 0)


def test_repeated_rows_of_one_id(spark):
    """A third of all rows share one id and text, or have no id."""
    rng = random.Random(2)
    texts = list(family(rng, 40, 40, 3))
    rows = [(5, texts[0])] * 40 + [(None, t) for t in texts] + list(enumerate(texts, 50))
    assert groups(spark, rows) == plain_groups(rows)


def some_sets(rng):
    sets = set()
    for _ in range(rng.integers(1, 5)):
        base = set(rng.choice(200, rng.integers(1, 60), replace=False).tolist())
        for _ in range(rng.integers(1, 15)):
            changed = set(base)
            for _ in range(rng.integers(0, 6)):
                changed ^= {int(rng.integers(0, 260))}
            if changed:
                sets.add(frozenset(changed))
    return [np.array(sorted(s), np.uint64) for s in sets]


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_tree_finds_all_pairs(percent):
    rng = np.random.default_rng(percent)
    for _ in range(60):
        sets = some_sets(rng)
        probes = sets + [np.unique(rng.integers(0, 300, 20)).astype(np.uint64), np.zeros(0, np.uint64)]
        tree = PrefixTree(sets, percent)
        wanted = {(i, j) for i, a in enumerate(probes) for j, b in enumerate(sets)
                  if linked(set(a.tolist()), set(b.tolist()), percent)}
        assert set(zip(*map(list, tree.search(probes)))) == wanted
        apart = {(i, j) for i, j in wanted if i != j and i < len(sets)}
        assert set(zip(*map(list, tree.search(sets, np.arange(len(sets)))))) == apart
        # by groups: fewer pairs, the same components
        groups, at, step = Groups(np.arange(len(sets))), 0, 1
        while at < len(sets):
            some = np.arange(at, min(at + step, len(sets)))
            probe, found = tree.search([sets[i] for i in some], some, groups.of[some], groups.of)
            groups.merge(some[probe], found)
            at, step = at + step, 4 * step
        every = Groups(np.arange(len(sets)))
        every.merge(*(np.array([p[k] for p in apart], np.int64) for k in (0, 1)))
        assert groups.of.tolist() == every.of.tolist()


def test_tree_shares_paths_and_leaves_hopeless_subtrees():
    core = np.arange(100, dtype=np.uint64)
    sets = [np.append(core, np.uint64(200 + i)) for i in range(50)]
    tree = PrefixTree(sets, 80)
    assert len(tree.parent) == 52  # root, the shared path, one end for each set
    other = np.arange(1000, 1100, dtype=np.uint64)
    assert len(tree.search([other])[0]) == 0
    assert len(tree.search([sets[3]])[0]) == 50


def test_hashes_of_many_texts_at_once():
    """Words and n-grams are those of each text by itself, wherever it lies in the column."""
    rng = random.Random(1)
    seen = {}
    for _ in range(200):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("abAB  \t\n\x0b \u0085é中") for _ in range(rng.randint(0, 60)))
                 for _ in range(rng.randint(0, 8))]
        column = pa.array(["before", *texts], pa.string() if rng.random() < 0.5 else pa.large_string()).slice(1)
        hashes, number = word_hashes(column)
        words = [(t or "").encode().lower().split() for t in texts]
        assert number.tolist() == list(map(len, words))
        for word, found in zip((w for t in words for w in t), hashes.tolist()):
            assert seen.setdefault(word, found) == found
        tokens, number = ngram_sets(column, 5)
        assert number.tolist() == [len(shingles(t)) for t in texts]
        alone = [ngram_sets(pa.array([t], pa.string()), 5)[0].tolist() for t in texts]
        assert [t for a in alone for t in a] == tokens.tolist()
        assert set_names(tokens, number).tolist() == [set_names(np.array(a, np.uint64), np.array([len(a)]))[0] for a in alone]
    assert len(set(seen.values())) == len(seen)
