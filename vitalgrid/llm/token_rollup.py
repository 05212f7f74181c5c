"""Token counts: totals by source, language and tokenizer version, kept by signed deltas.

A batch of changes (``insert``, ``delete``, ``revise``) is turned into signed rows: minus what a document
has contributed so far, plus what it contributes now. Their sums by group are added to the totals, so a
batch costs what it changes and not what is there. Committing the same batch again changes nothing.

A store is a folder: ``documents`` and ``totals`` hold one folder of signed rows for each attempt to commit
a batch, ``manifest`` one row for each batch that was committed, written last. Folders that no manifest
row names are leftovers of failed attempts and never read. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vitalgrid.llm.common import stored
from vitalgrid.llm.ngrams import text_bytes
from vitalgrid.llm.tokens import text_slices

GROUP = ("source", "lang", "tokenizer")
MANIFEST = "batch_id string, seq long, digest long, documents string, totals string, compacts boolean"
KEY = ("doc_id", "tokenizer")

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_ALNUM = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123)])
COUNTS = ("words", "marks", "words_once")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        letters = np.frombuffer(data, np.uint8)
        begins = np.zeros(len(letters) + 1, bool)
        begins[offsets] = True

        def of_texts(marked: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(marked)])
            return total[offsets[1:]] - total[offsets[:-1]]

        def runs(kind: np.ndarray) -> np.ndarray:
            return kind & (begins[:-1] | ~np.concatenate([[False], kind[:-1]]))

        space, alnum = _SPACE[letters], _ALNUM[letters]
        words = of_texts(runs(~space))
        # a mark of several bytes counts where it begins
        marks = of_texts(runs(alnum)) + of_texts(~alnum & ~space & ((letters & 0xC0) != 0x80))
        once = words.copy()
        for i, (first, last) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            lines = data[first:last].split(b"\n")
            kept = dict.fromkeys(lines)
            if len(kept) < len(lines):
                once[i] = len(b"\n".join(kept).split())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(words), pa.array(marks), pa.array(once)],
            names=[*batch.schema.names[:-1], *COUNTS])


def count_tokens(docs: DataFrame, *columns: str, text_col: str = "text") -> DataFrame:
    """The columns of each row and three token counts of its whole text: ``words`` (runs of anything but ASCII
    white space), ``marks`` (runs of ASCII letters and digits, every other mark by itself) and
    ``words_once`` (words without lines that repeat an earlier one). Null and empty texts count 0; repeated
    rows are counted each; an empty table gives no rows. Nothing is shuffled."""
    chosen = docs.select(*columns, F.col(text_col).cast("string").alias("text"))
    schema = StructType([*chosen.schema.fields[:-1], *[StructField(c, LongType()) for c in COUNTS]])
    return chosen.mapInArrow(_counts, schema)


@dataclass(frozen=True)
class Rollup:
    """Totals of token counts in a store below ``path``, a folder that all executors share."""

    spark: SparkSession
    path: str
    id_type: str = "long"

    @classmethod
    def create(cls, spark: SparkSession, path: str, id_type: str = "long") -> Rollup:
        spark.createDataFrame([], MANIFEST).write.parquet(f"{path}/manifest/created")
        return cls(spark, path, id_type)

    def commits(self) -> list:
        """One row for each committed batch, oldest first."""
        read = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", True)
        return sorted(read.parquet(f"{self.path}/manifest").collect(), key=lambda r: r["seq"])

    def _folders(self, kind: str) -> list[str]:
        """Folders to read: those from the last compaction on."""
        commits = self.commits()
        last = max((i for i, r in enumerate(commits) if r["compacts"]), default=0)
        return [r[kind] for r in commits[last:]]

    def _signed_documents(self) -> DataFrame:
        schema = f"doc_id {self.id_type}, tokenizer string, source string, lang string, n_tokens long, sign long"
        folders = self._folders("documents")
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def documents(self) -> DataFrame:
        """``doc_id, tokenizer, source, lang, n_tokens`` of what counts now."""
        columns = ["doc_id", "tokenizer", "source", "lang", "n_tokens"]
        return self._signed_documents().groupBy(*columns).agg(F.sum("sign").alias("sign")).where(
            "sign > 0").select(*columns)

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens``; groups that hold nothing are left out."""
        schema = "source string, lang string, tokenizer string, documents long, tokens long"
        folders = self._folders("totals")
        deltas = self.spark.read.schema(schema).parquet(*folders) if folders \
            else self.spark.createDataFrame([], schema)
        return deltas.groupBy(*GROUP).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where(
            "documents != 0 or tokens != 0")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it is committed already.

        ``changes`` has ``doc_id, op, source, lang, tokenizer, n_tokens``. An insert of a document that
        is there counts as a revision, a revision of one that is not as an insert, a delete of one that
        is not changes nothing. Of several changes to a document the one with the largest ``seq`` counts
        (without such a column the largest operation and count, so repeated rows count once). Null is a
        value like others in every column but two: a null count is 0, a null or unknown operation fails.
        An empty batch is committed and changes nothing. Further columns are ignored. A batch that was
        committed with other content fails.
        """
        done = {r["batch_id"]: r for r in self.commits()}
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        known = F.coalesce(F.col("op").isin("insert", "delete", "revise"), F.lit(False))
        op = F.when(known, F.col("op")).otherwise(F.raise_error(F.lit("unknown operation")).cast("string"))
        wanted = changes.select(
            "doc_id", "tokenizer", F.struct(
                seq.cast("long").alias("seq"), op.alias("op"),
                F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"), "source", "lang",
            ).alias("change")).groupBy(*KEY).agg(F.max("change").alias("change"))
        digest = F.coalesce(F.bit_xor(F.xxhash64("doc_id", "tokenizer", "change")), F.lit(0))
        if batch_id in done:
            if wanted.agg(digest.alias("d")).first()["d"] != done[batch_id]["digest"]:
                raise ValueError(f"batch {batch_id!r} was committed with other content")
            return False
        wanted = stored(wanted, "token-changes")  # computed once, for the rows and the digest
        folder = f"{self.path}/{{}}/{uuid.uuid4().hex}"
        now = self.documents().select(
            F.col("doc_id").alias("_id"), F.col("tokenizer").alias("_tokenizer"),
            F.struct("source", "lang", "n_tokens").alias("old"))
        joined = wanted.join(now, F.col("doc_id").eqNullSafe(F.col("_id"))
                             & F.col("tokenizer").eqNullSafe(F.col("_tokenizer")), "left")
        new = F.when(F.col("change.op") != "delete", F.struct("change.source", "change.lang", "change.n_tokens"))
        # minus what was, plus what is; nothing where these are the same
        rows = joined.where(~F.col("old").eqNullSafe(new)).select(*KEY, F.explode(F.array(
            F.struct(F.lit(-1).cast("long").alias("sign"), F.col("old").alias("value")),
            F.struct(F.lit(1).cast("long").alias("sign"), new.alias("value")))).alias("row")).where(
            "row.value is not null")
        signed = rows.select(*KEY, "row.value.source", "row.value.lang", "row.value.n_tokens", "row.sign")
        documents, totals = folder.format("documents"), folder.format("totals")
        self._write(signed, documents, totals)
        value = wanted.agg(digest.alias("d")).first()["d"]
        self._enter(batch_id, value, documents, totals, False, len(done))
        return True

    def compact(self) -> None:
        """Fold all batches into one set of rows; their ids stay known."""
        commits = self.commits()
        folder = f"{self.path}/{{}}/{uuid.uuid4().hex}"
        documents, totals = folder.format("documents"), folder.format("totals")
        self._write(self.documents().withColumn("sign", F.lit(1).cast("long")), documents, totals)
        self._enter(f"compaction {uuid.uuid4().hex}", 0, documents, totals, True, len(commits))

    def _write(self, signed: DataFrame, documents: str, totals: str) -> None:
        signed.select("doc_id", "tokenizer", "source", "lang", "n_tokens", "sign").write.parquet(documents)
        self.spark.read.schema(signed.schema).parquet(documents).groupBy(*GROUP).agg(
            F.sum("sign").alias("documents"), F.sum(F.col("sign") * F.col("n_tokens")).alias("tokens"),
        ).coalesce(1).write.parquet(totals)

    def _enter(self, batch_id, digest, documents, totals, compacts, seq) -> None:
        # the folder's name is the batch: a second writer of the same batch fails here
        name = uuid.uuid5(uuid.NAMESPACE_OID, batch_id).hex
        self.spark.createDataFrame([(batch_id, seq, digest, documents, totals, compacts)], MANIFEST).coalesce(
            1).write.mode("error").parquet(f"{self.path}/manifest/{name}")
