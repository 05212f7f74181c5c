"""The operators' parts against plain versions."""

from __future__ import annotations

import io
import json
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vitalgrid.llm import binary_output as bits
from vitalgrid.llm import hmm, language, near_dedup, order_minhash, packing, quality, tokens
from vitalgrid.llm.common import crc_remainder, in_ranges, range_points, shared_folder, ship_package, stored
from vitalgrid.llm.components import components
from vitalgrid.llm.mixing import source_targets
from vitalgrid.llm.token_rollup import Rollup

# ---- tokens, packing, bits ---------------------------------------------------------------------

TOKENIZER = tokens.word_tokenizer(tokens.default_vocabulary())
PLAIN = Tokenizer.from_file(tokens.default_vocabulary())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.one_of(
    st.characters(exclude_categories=["Cs"]), st.sampled_from("aäéİΣß's 12.\n\t|<>ll")), max_size=60)), max_size=6))
def test_ids_are_the_tokenizers_own(texts):
    ids, lengths = TOKENIZER.encode(texts)
    want = [[*PLAIN.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [x for w in want for x in w]


@pytest.mark.parametrize("change", [
    {"normalizer": None}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}])
def test_other_tokenizer_files_give_their_own_ids(tmp_path, change):
    path = str(tmp_path / "other.json")
    with open(path, "w") as file:
        json.dump(json.loads(PLAIN.to_str()) | change, file)
    plain, texts = Tokenizer.from_file(path), ["The Quick brown FOX's  12 dogs\n über", "", None, "plain words"]
    ids, lengths = tokens.WordTokenizer(path).encode(texts)
    want = [[*plain.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and lengths.tolist() == [len(w) for w in want]


def test_words_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_WORDS", 3)
    own = tokens.WordTokenizer(tokens.default_vocabulary())
    for text in ("one two three four five", "six seven one", "one <|endoftext|> two"):
        assert own.encode([text])[0].tolist() == [*PLAIN.encode(text, add_special_tokens=False).ids, 1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10_000), max_size=20))
def test_binary_pieces(lengths):
    doc, start, size = packing.binary_pieces(np.array(lengths, np.int64))
    for i, n in enumerate(lengths):
        own = size[doc == i]
        assert own.sum() == n and (start[doc == i] == np.cumsum(own) - own).all()
        assert all(x <= 2048 and x & (x - 1) == 0 for x in own.tolist())
        small = own[own < 2048].tolist()
        assert len(set(small)) == len(small)


def test_buckets_hold_pieces_of_one_length(spark, tmp_path):
    ship_package(spark)
    docs = spark.createDataFrame([(i, "one two three four " * i) for i in range(30)], "doc_id long, text string")
    packed = packing.pack(docs)
    packing.write_buckets(packed, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert sorted(back.select(packed.columns).collect()) == sorted(packed.collect())
    one = spark.read.parquet(str(tmp_path / "buckets" / "length=4"))
    assert one.count() and {len(r["ids"]) for r in one.collect()} == {16}


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 21, 32])
def test_bits_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001, dtype=np.uint64).astype(np.uint32)
    packed = bits.pack_bits(ids, width)
    assert len(packed) == -(-1001 * width // 8)
    assert (bits.unpack_bits(packed, width, 1001) == ids).all()


def test_bits_for():
    assert [bits.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_shard_random_access():
    ids = np.arange(1000, dtype=np.uint32) * 7 % 5000
    lengths = [0, 10, 500, 1, 489]
    file = io.BytesIO()
    bits.write_shard(file, [5, None, 7, 7, 9], lengths, ids, 13, block=64)
    file.seek(0)
    shard = bits.Shard(file)
    assert shard.doc_ids.tolist() == [5, bits.NULL_ID, 7, 7, 9]
    ends = np.cumsum(lengths)
    for i, n in enumerate(lengths):
        assert (shard.document(i) == ids[ends[i] - n:ends[i]]).all()
    assert (shard.read(63, 130) == ids[63:193]).all()
    with pytest.raises(IndexError):
        shard.read(990, 11)


# ---- ranges, components, targets, rollups ------------------------------------------------------

def test_ranges(spark):
    ship_package(spark)
    rows = spark.createDataFrame([(i * 37 % 1000,) for i in range(1000)] + [(None,)], "k long")
    points = range_points(rows, "k", 7)
    found = {r["k"]: r["bucket"] for r in in_ranges(rows, "k", points).collect()}
    assert found[None] == 0
    assert all(b == sum(p < k for p in points) for k, b in found.items() if k is not None)
    assert range_points(rows.where("false"), "k", 7) == []


def test_components(spark):
    chance = random.Random(4)
    links = [(chance.randrange(300), chance.randrange(300)) for _ in range(220)] + [
        (i, i + 1) for i in range(400, 480)] + [(600, i) for i in range(500, 560)]
    parent = {x: x for link in links for x in link}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: top(x) for link in links if link[0] != link[1] for x in link}


@settings(max_examples=8, deadline=None)
@given(sizes=st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets_by_repeated_sharing(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    weights = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    size = dict(zip(names, sizes))
    target, capped = dict.fromkeys(names, 0.0), set()
    while True:
        left = sum(sizes) - sum(3 * size[n] for n in capped)
        free = [n for n in names if n not in capped]
        target = {n: 3.0 * size[n] if n in capped else left * weights[n] / sum(weights[m] for m in free) for n in names}
        above = [n for n in free if target[n] > 3 * size[n]]
        if not above:
            break
        capped |= set(above)
    found = source_targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()
    for r in found:
        assert r["target"] == pytest.approx(target[r["source"]])


def test_rollup(spark):
    schema = "doc_id long, op string, source string, lang string, tokenizer string, n_tokens long, extra int"
    rollup = Rollup.create(spark, shared_folder(spark, "rollup-test"))

    def totals():
        return {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in rollup.totals().collect()}

    def batch(*rows):
        return spark.createDataFrame([(*r, 0) for r in rows], schema)

    assert totals() == {}
    first = batch((1, "insert", "a", "en", "t1", 10), (2, "insert", "a", "en", "t1", 5), (3, "insert", None, None, "t1", None),
                  (1, "insert", "a", "en", "t2", 12), (2, "insert", "a", "en", "t1", 5))
    assert rollup.commit("one", first) and not rollup.commit("one", first)
    assert totals() == {("a", "en", "t1"): (2, 15), (None, None, "t1"): (1, 0), ("a", "en", "t2"): (1, 12)}
    with pytest.raises(ValueError):
        rollup.commit("one", batch((9, "insert", "a", "en", "t1", 1)))
    changes = batch((1, "revise", "b", "en", "t1", 11), (2, "delete", None, None, "t1", None), (8, "delete", None, None, "t1", 0),
                    (9, "revise", "b", "de", "t1", 4), (None, "insert", "b", "de", "t1", 6))
    assert rollup.commit("two", changes)
    after = {("b", "en", "t1"): (1, 11), (None, None, "t1"): (1, 0), ("a", "en", "t2"): (1, 12), ("b", "de", "t1"): (2, 10)}
    assert totals() == after
    rollup.compact()
    assert totals() == after and not rollup.commit("two", changes) and not rollup.commit("one", first)
    assert rollup.commit("empty", first.where("false")) and totals() == after
    assert rollup.commit("three", batch((None, "delete", None, None, "t1", None), (1, "delete", "x", "y", "t2", 1)))
    assert totals() == {("b", "en", "t1"): (1, 11), (None, None, "t1"): (1, 0), ("b", "de", "t1"): (1, 4)}
    with pytest.raises(Exception, match="unknown operation"):
        rollup.commit("bad", batch((1, "move", "a", "en", "t1", 1)))
    assert "bad" not in {r["batch_id"] for r in rollup.commits()}


# ---- MinHash -----------------------------------------------------------------------------------

def test_estimates_follow_similarity(spark):
    chance = np.random.default_rng(5)
    errors, missed = [], 0
    for similarity in np.linspace(0.3, 0.95, 60):
        shared = int(1000 * similarity / (1 + similarity) * 2)
        both = chance.integers(0, 2 ** 63, 2000 - shared, dtype=np.uint64)
        a, b = both[:1000], both[1000 - shared:2000 - shared]
        true = shared / (2000 - shared)
        left, right = near_dedup.minima(a), near_dedup.minima(b)
        equal = np.mean((left & 3) == (right & 3))
        errors.append((equal - 0.25) / 0.75 - true)
        missed += true >= 0.85 and not (near_dedup.band_keys(left) == near_dedup.band_keys(right)).any()
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05 and not missed


def test_packed_bits_in_spark(spark):
    chance = np.random.default_rng(6)
    left = chance.integers(0, 2 ** 32, (20, near_dedup.MINIMA), dtype=np.uint32)
    right = np.where(chance.random(left.shape) < 0.5, left, chance.integers(0, 2 ** 32, left.shape, dtype=np.uint32))
    names = [f"s{i}" for i in range(near_dedup.SIGNATURE)]
    frames = [spark.createDataFrame(
        [(i, *map(int, r)) for i, r in enumerate(near_dedup.packed_bits(m).view(np.int64))],
        "id int, " + ", ".join(f"{n} long" for n in names)) for m in (left, right)]
    found = frames[0].alias("l").join(frames[1].alias("r"), "id").select(
        "id", near_dedup.unequal_lanes("l", "r").alias("n")).collect()
    assert {r["id"]: r["n"] for r in found} == dict(enumerate(((left & 3) != (right & 3)).sum(1).tolist()))


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 95, 100])
def test_bands_cover_the_threshold(percent):
    plan = near_dedup.banding(percent)
    assert (1 - (percent / 100) ** plan.rows) ** plan.bands <= 1e-6
    assert plan.rows * plan.bands <= plan.minima <= near_dedup.MOST_MINIMA


def test_thresholds_that_bands_cannot_cover_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    for percent in (0, 2, 101):
        with pytest.raises(ValueError):
            near_dedup.near_groups(docs, percent)


def test_pipeline_links_from_80_percent(spark):
    """Pairs of texts that share 45 of 55 shingles are one group in the pipeline, two in op4."""
    import corpus_pipeline

    ship_package(spark)
    rows = []
    for i in range(40):
        words = [f"w{i}x{j}" for j in range(49)]  # 45 shingles, 5 more on either side
        rows += [(2 * i, " ".join(words + [f"p{i}x{j}" for j in range(5)])),
                 (2 * i + 1, " ".join(words + [f"q{i}x{j}" for j in range(5)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' lang", "'a' source", "length(text) n_chars")
    assert corpus_pipeline.one_of_near_copies(spark, docs, "").count() == 40
    assert near_dedup.near_groups(docs).where("kept").count() == 80


def discarded_share(shared, union, pairs, seed=1):
    """Share of pairs of small sets with the similarity that the kept bits rule out."""
    chance, lost = np.random.default_rng(seed), 0
    floor = near_dedup.least_estimate()
    for _ in range(pairs):
        values = chance.integers(0, 2 ** 64, union, dtype=np.uint64)
        own = (union - shared) // 2
        sets = values[:shared + own], np.concatenate([values[:shared], values[shared + own:]])
        left, right = (near_dedup.packed_bits(near_dedup.scrambled(near_dedup.minima(x))) for x in sets)
        differing = left ^ right
        ones = np.bitwise_count((differing | differing >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum()
        lost += (1 - ones / near_dedup.MINIMA - 0.25) / 0.75 < floor
    return lost / pairs


def test_short_texts_are_not_ruled_out():
    """6 of 7 shingles shared: low bits of bare minima lost about 10 of 10,000 such pairs."""
    assert discarded_share(6, 7, 10_000) <= 2e-4


def test_shingles():
    assert len(near_dedup.shingle_hashes("a b c d e f")) == 2
    assert len(near_dedup.shingle_hashes("A b\tc")) == 1 and len(near_dedup.shingle_hashes(" \n")) == 0
    assert (near_dedup.shingle_hashes("X y Z") == near_dedup.shingle_hashes(" x Y z")).all()
    assert (near_dedup.shingle_hashes("É b") != near_dedup.shingle_hashes("é b")).all()  # A-Z only
    assert len(near_dedup.shingle_hashes("a b c d e a b c d e")) == 5


def test_family_without_a_common_leader(spark):
    """Near copies of which many link only through others, and exact copies among them."""
    from test_queries import components_of

    ship_package(spark)
    chance = random.Random(9)
    word = [f"w{i}" for i in range(4000)]
    original = [chance.choice(word) for _ in range(200)]
    rows = []
    for i in range(150):
        text = list(original)
        for _ in range(chance.choice([0, 1, 2, 3, 4, 6])):
            text[chance.randrange(200)] = chance.choice(word)
        rows.append((i, " ".join(text)))
    rows += [(200 + i, rows[i % 40][1].upper()) for i in range(80)] + [(400 + i, f"other text number {i} of these") for i in range(9)]
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == components_of(
        pd.DataFrame(rows, columns=["doc_id", "text"]))


def test_order_matters():
    one = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 6
    pieces = [one[i:i + 60] for i in range(0, len(one), 60)]
    moved = "".join(reversed(pieces))
    a, b = order_minhash.fingerprint(one + "tail of it"), order_minhash.fingerprint(moved + "tail of it")
    same = order_minhash.likeness(a, order_minhash.fingerprint(one + "tail of it"))
    kmers = [set(order_minhash.kmer_hashes(order_minhash.code_points(t)).tolist()) for t in (one, moved)]
    assert same == 1.0 and order_minhash.likeness(a, b) < len(kmers[0] & kmers[1]) / len(kmers[0] | kmers[1])


def test_likeness_falls_with_edits():
    chance = random.Random(2)
    text = "".join(chance.choice("abcdefghij ") for _ in range(4000))
    found = []
    for edits in (1, 20, 100, 400):
        changed = list(text)
        for i in chance.sample(range(4000), edits):
            changed[i] = "Z"
        found.append(order_minhash.likeness(order_minhash.fingerprint(text), order_minhash.fingerprint("".join(changed))))
    assert found == sorted(found, reverse=True) and found[0] > 0.9 > 0.2 > found[-1]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=400))
def test_fingerprints_are_of_whole_texts(text):
    assert (order_minhash.fingerprint(text) == order_minhash.fingerprint("".join(list(text)))).all()
    if text:
        assert order_minhash.fingerprint(text).any()


# ---- models ------------------------------------------------------------------------------------

def test_gradients_of_the_network():
    network = language.fresh_network(["a", "b", "c"], 1, 3)
    chance = np.random.default_rng(0)
    windows = chance.integers(97, 103, (7, 4)).astype(np.int16)
    windows[5:, 1] = language._PAD
    labels = np.array([0, 1, 2, 1])

    def loss():
        found = network.probabilities(windows)[:, np.arange(4), labels].astype(float)
        real = windows != language._PAD
        return -(np.log(found) * real).sum() / real.sum()

    for weight, gradient in zip(network.weights(), network.gradients(windows, labels)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before = weight[at]
        weight[at] = before + 0.01
        above = loss()
        weight[at] = before - 0.01
        below = loss()
        weight[at] = before
        assert gradient[at] == pytest.approx((above - below) / 0.02, rel=2e-2)


def test_long_texts_are_labelled_whole(monkeypatch):
    network = language.train({"x": [b"abab" * 24] * 4, "y": [b"cdcd" * 24] * 4}, steps=60)
    monkeypatch.setattr(language, "SIDE_BY_SIDE", 4)
    found, scores = language.classify(["abab" * 3000 + "cdcd" * 4000, "ab", "12", None], network)
    assert found[0] == "y" and 0.5 < scores[0] < 0.65 and found[1:] == ["x", "und", "und"]


def test_forward_and_counts_of_the_markov_model():
    chance = np.random.default_rng(1)
    symbols, states = 7, hmm.STATES
    model = hmm.Model(chance.dirichlet(np.ones(states)), chance.dirichlet(np.ones(states), states),
                      hmm._padded(chance.dirichlet(np.ones(symbols), states).T))
    lengths = np.array([1, 5, 32, 33, 100, 64, 2])
    seen = chance.integers(0, symbols, lengths.sum())
    expected = hmm.Expected(states, symbols)
    expected.add(model, seen, lengths)
    likelihood, emits, moves = [], np.zeros((states, symbols)), np.zeros((states, states))
    for end, n in zip(np.cumsum(lengths), lengths):
        now, logs, ahead = model.start, 0.0, [model.start]
        for x in seen[end - n:end]:
            now = (now @ model.moves) * model.emits[x]
            logs += np.log(now.sum())
            now = now / now.sum()
            ahead.append(now)
        likelihood.append(logs)
        back = np.ones(states)
        for t in reversed(range(n)):
            x = seen[end - n + t]
            share = ahead[t + 1] * back
            emits[:, x] += share / share.sum()
            step = ahead[t][:, None] * model.moves * (model.emits[x] * back)
            moves += step / step.sum()
            back = model.moves @ (model.emits[x] * back)
            back /= back.sum()
    assert np.allclose(hmm.log_likelihoods(model, seen, lengths), likelihood)
    assert np.allclose(expected.emits[:, :symbols], emits) and np.allclose(expected.moves, moves)
    assert expected.likelihood == pytest.approx(sum(likelihood))


def test_rounds_raise_the_likelihood(spark):
    ship_package(spark)
    texts = ["a b a b a b c " * 9, "x y x y z " * 9] * 8
    rows = spark.createDataFrame([(t, False) for t in texts], "text string, held_out boolean")
    words = hmm.describe_words(hmm.word_counts(rows))
    assert words.tokens == 8 * (63 + 45 + 2) and words.distinct == 7
    ids, at, lengths = hmm.tokens_of(pa.array(texts))
    symbols = np.searchsorted(words.symbols, ids)[at]
    model, history = hmm.first_model(words), []
    for _ in range(4):
        expected = hmm.Expected(hmm.STATES, len(model.emits) - 1)
        expected.add(model, symbols, lengths)
        model, likelihood = hmm.reestimated(pa.Table.from_batches([expected.packed()]), words)
        history.append(likelihood)
    assert history == sorted(history)


def test_scores_are_those_of_a_plain_forward_pass(spark):
    """The whole query's score from its own model, word by word in plain Python."""
    ship_package(spark)
    texts = ["a b a b a b c " * 9, "x y x y z " * 9, "once twice", "a x unseen a", "", "b " * 100] * 6
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in hmm.score_texts(rows).collect()}
    marked = rows.select("doc_id", (crc_remainder("doc_id", 5) == 1).alias("held_out"), "text")
    counts = stored(hmm.word_counts(marked), "counts")
    words = hmm.describe_words(counts)
    encoded = stored(marked.mapInArrow(lambda b: hmm._encode(b, words), hmm.ENCODED.format(id="bigint")).selectExpr(
        "*", "monotonically_increasing_id() part"), "encoded")
    model, weights, _ = hmm.train(encoded, words, None)
    assert weights is None
    times = {r["word"]: r["n_train"] for r in counts.collect()}
    for i, text in enumerate(texts):
        now, score = model.start, 0.0
        for word in [*text.encode().split(), b""]:
            word_id = hmm.word_id(word)
            at = np.flatnonzero(words.symbols == word_id)
            kind = word_id & 255
            now = (now @ model.moves) * model.emits[at[0] if len(at) else len(words.symbols) + kind]
            if not len(at):
                score += np.log10((times.get(word_id, 0) + 0.5) / words.class_totals[kind])
            score += np.log10(now.sum())
            now = now / now.sum()
        assert found[i] == pytest.approx(score, rel=1e-6), text


def test_emissions_of_joined_symbols(spark, monkeypatch):
    """Held and joined symbols make one model: emissions of each state sum to 1, and each round learns."""
    ship_package(spark)
    monkeypatch.setattr(hmm, "HELD_SYMBOLS", 4)
    texts = ["a b a b a b c " * 9, "x y x y z " * 9, "once twice"] * 8
    rows = spark.createDataFrame([(i, t, i == 5) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    counts = hmm.word_counts(rows)
    words = hmm.describe_words(counts)
    assert 0 < len(words.symbols) < 7 and words.other_words == 7 - len(words.symbols)
    encoded = stored(rows.select("doc_id", "held_out", "text").mapInArrow(
        lambda b: hmm._encode(b, words), hmm.ENCODED.format(id="bigint")).selectExpr(
        "*", "monotonically_increasing_id() part"), "encoded")
    others = hmm.other_symbols(encoded, counts, words)
    assert others.count() == words.other_words
    model, weights, history = hmm.train(encoded, words, others)
    assert history == sorted(history) and history[-1] > history[0] and len(history) == hmm.ROUNDS
    rest = np.array([[r[f"w{k}"] for k in range(hmm.STATES)] for r in weights.collect()])
    assert np.allclose(model.emits[:-1].sum(0) + (rest / model.total).sum(0), 1)


def test_quality_learns_subwords():
    good = [f"the calm reader number{i} walks along quiet rivers" for i in range(40)]
    bad = [f"BUYNOW{i}!! cheapcheap{i} clickclick{i}" for i in range(40)]
    model = quality.train([(k, *quality.text_features(t)) for k, part in ((1, good), (0, bad)) for t in part], 0.5)
    scores = model.scorer().scores(["a quiet reader walks", "BUYNOW77!! cheapcheap77", "", None])
    assert scores[0] > 0.5 > scores[1] and scores[2] == scores[3]
    one_by_one = [model.scorer().scores([t])[0] for t in good[:5]]
    assert model.scorer().scores(good[:5]).tolist() == pytest.approx(one_by_one)
