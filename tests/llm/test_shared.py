"""Every operator on rows that break things: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalgrid.llm.common import handing_back
from vitalgrid.llm import (
    binary_output, common, exact_dedup, hmm, language, mixing, near_dedup, order_minhash, packing, quality,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog while the cat sleeps on the warm mat "
ROWS = [
    (1, PROSE * 3, "en", "a", 1),
    (2, PROSE * 3, "en", "b", 1),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, " \t\n ", "de", "b", 4),
    (6, (PROSE + "und zwei ") * 2500, "de", "a", 9),
    (7, "zwei", "de", None, 4),
    (7, "zwei", "de", None, 4),
    (8, "ein anderer Text mit einigen Wörtern darin und noch mehr davon", "de", "c", 1),
    (None, "no name at all in this one here", "en", "c", 1),
    (9, "!!! ??? 123", None, "c", 1),
]
#: names that operators might use themselves
CLASHING = ("uid", "node", "key1", "component", "hash", "class", "size", "digest", "kept_id", "copies",
            "own_size", "bucket", "tie", "guest", "to", "label", "score", "shingles", "band", "symbols", "rows")


@pytest.fixture(scope="module")
def odd(spark):
    common.ship_package(spark)
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(f"x-{c}") for c in CLASHING})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 1), (9, 0), (7, 0), (7, 1), (8, None), (None, 1)], "doc_id long, quality int")


def by_id(df):
    return sorted(([r["doc_id"], r] for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0))


def test_exact(odd):
    found = exact_dedup.exact_groups(odd)
    rows = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for _, r in by_id(found)]
    assert (1, 2, 2, False) in rows and (2, 2, 2, True) in rows
    # null and empty are equal; of a repeated row one stays
    assert (3, 4, 2, False) in rows and (4, 4, 2, True) in rows
    assert sorted(r[3] for r in rows if r[0] == 7) == [False, True]
    assert (None, None, 1, True) in rows and len(rows) == len(ROWS)
    kept = exact_dedup.keep_distinct(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, [2, 4, 5, 6, 7, 8, None, 9]))
    assert {r["digest"] for r in rows} == {"x-digest"} and {r["kept_id"] for r in rows} == {"x-kept_id"}


def test_near(odd):
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_groups(odd).collect()}
    assert rows[2][1:] == (1, False) and rows[1][1:] == (1, True)
    assert [rows[i] for i in (3, 4, 5)] == [(0, 3, True), (0, 4, True), (0, 5, True)]
    assert rows[7] == (1, 7, True) and rows[None][1:] == (None, True)
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        map(str, [1, 3, 4, 5, 6, 7, 7, 8, 9, None]))


def test_mix(odd):
    rows = [r for _, r in by_id(mixing.systematic_copies(odd))]
    assert len(rows) == len(ROWS)
    assert all(0 <= r["copies"] <= 3 for r in rows)
    assert {r["source"] for r in rows} == {"a", "b", "c", None}
    assert [r["size"] for r in rows if r["doc_id"] in (3, 4, 5)] == [0, 0, 0]
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and {r["copies"] for r in mixed.collect()} == {"x-copies"}


def test_rows_that_share_an_id_are_taken_by_themselves(spark):
    """Of two rows of an id only that which is no copy of another document stays; null ids have their own copies."""
    common.ship_package(spark)
    other = "pack my box with five dozen liquor jugs and then some more of them"
    rows = [(1, PROSE * 3), (2, PROSE * 3), (2, other), (None, PROSE * 3), (None, "nobody else has this text " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = near_dedup.keep_one(docs).collect()
    assert sorted(str(tuple(r)) for r in kept) == sorted(map(str, [rows[0], rows[2], rows[4]]))
    docs = spark.createDataFrame(
        [(None, "one two three four", "a") for _ in range(1000)] + [(i, "one two three four", "b") for i in range(1000)],
        "doc_id long, text string, source string")
    sized = mixing.systematic_copies(docs).groupBy("source").agg(F.sum("copies").alias("n"), F.max("target").alias("t"))
    want = {r["source"]: r["n"] for r in sized.collect()}
    assert want["a"] * 4 == pytest.approx(sized.where("source = 'a'").first()["t"], abs=4)
    assert {r["source"]: r["count"] for r in mixing.mix(docs).groupBy("source").count().collect()} == want


def test_pack(odd):
    rows = packing.pack(odd).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    whole = {}
    for r in rows:
        whole.setdefault(r["doc_id"], []).append(r)
    assert [(r["length"], r["doc_tokens"]) for r in whole[3]] == [(1, 1)]  # null: the end alone
    assert len(whole[7]) == 2 * len({r["start"] for r in whole[7]})
    long = sorted(whole[6], key=lambda r: r["start"])
    assert sum(r["length"] for r in long) == long[0]["doc_tokens"] > 40_000


def test_binary(odd, tmp_path):
    rows = binary_output.read_tokens(binary_output.write_tokens(odd, f"{tmp_path}/t x", shard_ids=100)).collect()
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == [None, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9]
    ends = np.cumsum([r["n_tokens"] for r in ordered])
    assert [r["start"] for r in ordered] == [0, *ends[:-1]]
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)


def test_fingerprints(odd):
    rows = order_minhash.compare_with_next(odd).collect()
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["fingerprint"] == found[2]["fingerprint"]
    assert found[2]["near_next"] == 1.0 and found[4]["near_next"] == 1.0  # 4 and 3 are both empty
    assert found[3]["n_chars"] == 0 and set(found[3]["fingerprint"]) == {"0"}
    assert {r["doc_id"]: r["fingerprint"] for r in order_minhash.fingerprints(odd).collect()} == {
        k: r["fingerprint"] for k, r in found.items()}


def test_quality(odd, labels):
    model = quality.fit(odd, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.keep_good(odd, model, 0.0).count() == len(ROWS)
    blank = quality.fit(odd, labels.where("false"))
    assert {r["score"] for r in quality.score(odd, blank).collect()} == {0.5}


def test_language(odd):
    network = language.fit(odd)
    rows = language.identify(odd, network).collect()
    assert len(rows) == len(ROWS)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert [found[i] for i in (3, 4, 5, 9)] == [("und", 0.0)] * 4
    assert {found[i][0] for i in (1, 2, 6, 7, 8)} <= {"en", "de"}
    unlearned = language.fit(odd.where("false"))
    assert {r["lang_pred"] for r in language.identify(odd, unlearned).collect()} == {"und"}


def test_hmm(odd):
    rows = hmm.score_texts(odd).collect()
    assert len(rows) == len(ROWS) and all(r["score"] < 0 and r["base_score"] < 0 for r in rows)
    found = {r["doc_id"]: r for r in rows}
    assert found[3]["n_tokens"] == 1 and found[6]["n_tokens"] == 19 * 2500 + 1
    assert found[1]["held_out"] == (zlib.crc32(b"1") % 5 == 1)


def test_empty_table(spark, odd, labels, tmp_path):
    none = odd.where("false")
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.keep_distinct(none).count() == 0
    assert near_dedup.near_groups(none).count() == 0 and near_dedup.keep_one(none).count() == 0
    assert mixing.systematic_copies(none).count() == 0 and mixing.mix(none).count() == 0
    assert packing.pack(none).count() == 0
    assert binary_output.read_tokens(binary_output.write_tokens(none, f"file:{tmp_path}/t")).count() == 0
    assert order_minhash.compare_with_next(none).count() == 0
    assert quality.score(none, quality.fit(none, labels)).count() == 0
    assert language.identify(none, language.fit(none)).count() == 0
    assert hmm.score_texts(none).count() == 0


def test_pipeline_on_odd_rows(spark, odd, labels, tmp_path):
    import corpus_pipeline

    labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and len({r["sequence_id"] for r in rows}) == len(rows)
    odd.where("false").write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_memory_is_handed_back_at_the_end_of_a_task():
    """Many arrays of some kilobytes, below one that stays, would else be kept by the process."""
    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096 / 1e6

    def task():
        # a frame that ends frees its arrays, below one that stays
        held = [np.ones(7000) for _ in range(4000)]
        stays.append(np.ones(7000))
        yield resident()

    stays, begun = [], resident()
    most, = handing_back(task())
    after = resident()
    assert most - begun > 150 and after - begun < 75, (begun, most, after)
