"""Token counts, and the rollup query on odd rows against SQL."""

from __future__ import annotations

import collections
import random
import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from vitalgrid.llm import oracle, queries
from vitalgrid.llm.token_rollup import count_tokens

WORDS, MARKS = r"[^\x20\x09-\x0D]+", r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"


def some_texts(rng, n):
    letters = "ab1 Z\t\n\n\r.,é中😀\x0b-"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(n)] + [
        "", None, "one\none\ntwo", "\n\n", "x" * 5000, "a b\n" * 300]


def test_counts(spark):
    rng = random.Random(3)
    rows = list(enumerate(some_texts(rng, 300)))
    frame = spark.createDataFrame([(i, t, 9) for i, t in rows], "id int, text string, words int")
    found = {r["id"]: (r["words"], r["marks"], r["words_once"]) for r in count_tokens(frame, "id").collect()}
    for i, text in rows:
        text = text or ""
        once = "\n".join(dict.fromkeys(text.split("\n")))
        assert found[i] == (len(re.findall(WORDS, text)), len(re.findall(MARKS, text)), len(re.findall(WORDS, once))), repr(text)
    assert count_tokens(frame.limit(0), "id").count() == 0


def test_query_on_odd_rows(spark, tmp_path):
    """Null sources and languages, copies, null and empty texts; distinct ids, which the changes are named by."""
    rng = random.Random(4)
    texts = some_texts(rng, 60)
    texts += texts[:30]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["web", "books", None])) for i, t in enumerate(texts)]
    table = pa.table({c: [r[k] for r in rows] for k, c in enumerate(("doc_id", "text", "lang", "source"))})
    pq.write_table(table.append_column("n_chars", pa.array([0] * len(rows))), tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    wanted = con.execute(f"select source, lang, tokenizer, documents, tokens from ({oracle.oracle_sql()['op1_token_rollup']})").fetchall()
    found = queries.op1_token_rollup(spark, str(tmp_path)).collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter(wanted)


def test_query_on_null_and_repeated_ids(spark, tmp_path):
    """An id names one document: of rows that share one, null among them, the last change counts once."""
    texts = ["a b", "a b", "c d e", "c d e", "f", "f g", "h"]
    ids = [1, 2, None, None, 5, 5, 7]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "lang": ["en"] * 7, "source": ["s"] * 7,
                             "n_chars": [0] * 7}), tmp_path / "documents.parquet")
    found = {r["tokenizer"]: r["documents"] for r in queries.op1_token_rollup(spark, str(tmp_path)).collect()}
    assert found["words/1"] == found["words/2"] == 4  # 2, null, 5 and 7
