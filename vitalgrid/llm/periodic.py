"""Periodic runs of words, by recursive frequency splitting and a scan of lags.

A run is a maximal stretch of words with smallest period ``q`` (words ``q`` apart are identical) that is
at least ``LEAST_WORDS`` and ``LEAST_TIMES * q`` words long. Each of its words occurs ``LEAST_TIMES`` times
in it, so a word that occurs more rarely in a segment can be in no run there: it splits the segment, and
its parts are split again by their own counts until nothing changes. Parts too short for a run go.

What survives is scanned by lag. For lags up to ``w`` and above ``w / 2`` the lag of a position is the
distance to the next equal window of ``w`` words. A run's window recurs after exactly one period, since a
nearer copy would mean a smaller period; so runs are the stretches of constant lag. Windows double in
width, and their numbers follow from those of half the width: n log n steps in all, whatever the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import crc_remainder
from vitalgrid.llm.tokens import Numbers, text_slices

LEAST_WORDS = 24
LEAST_TIMES = 3
RUNS = "array<struct<start:long,length:long,period:long>>"
#: changes a document's words before the search, given a number of the document
Edit = Callable[[list[bytes], int], list[bytes]]


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _segments(place: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Numbers of the stretches of consecutive places with one owner."""
    if not len(place):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum((np.diff(place) != 1) | (np.diff(owner) != 0))])


def surviving(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places that can be in a run, ascending: rare words split the segments until none is rare.

    ``words`` are numbers of words, ``owner`` the document of each; documents are segments at first.
    """
    place, segment = np.arange(len(words)), _segments(np.arange(len(words)), owner)
    width = int(words.max()) + 1 if len(words) else 1
    while len(place):
        long_enough = np.bincount(segment)[segment] >= LEAST_WORDS
        place, segment = place[long_enough], segment[long_enough]
        _, at, times = np.unique(segment * width + words[place], return_inverse=True, return_counts=True)
        often = times[at] >= LEAST_TIMES
        if often.all():
            break
        place = place[often]
        segment = _segments(place, segment[often])
    return place


def _next_equal(ranks: np.ndarray) -> np.ndarray:
    """Distance from each place to the next one with the same rank; 0 without one."""
    order = np.argsort(ranks, kind="stable")
    same = ranks[order[1:]] == ranks[order[:-1]]
    distance = np.zeros(len(ranks), np.int64)
    distance[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return distance


def lag_scan(words: np.ndarray) -> np.ndarray:
    """Rows of start, length and period of all runs of a sequence of numbers, by start, then period."""
    n = len(words)
    ranks, width = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    found = [np.zeros((0, 3), np.int64)]
    while width // 2 + 1 <= n // LEAST_TIMES:
        lag = _next_equal(ranks)
        lag[(lag > width) | (2 * lag <= width)] = 0
        edge = np.flatnonzero(np.diff(lag, prepend=0, append=0))
        first, last = edge[:-1], edge[1:]
        period = lag[first] if len(first) else np.zeros(0, np.int64)
        length = last - first - 1 + width + period
        good = (period > 0) & (length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period))
        found.append(np.column_stack([first, length, period])[good])
        if len(ranks) <= width:
            break
        pairs = ranks[:-width] * n + ranks[width:]
        ranks, width = np.unique(pairs, return_inverse=True)[1].astype(np.int64), 2 * width
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners of all runs, ascending, and rows of start (counted from the first of all words), length, period."""
    place = surviving(words, owner)
    segment = _segments(place, owner[place])
    cuts = np.flatnonzero(np.diff(segment, prepend=-1)) if len(place) else np.zeros(0, np.int64)
    found = [np.zeros((0, 3), np.int64)]
    for first, upto in zip(cuts, [*cuts[1:], len(place)]):
        runs = lag_scan(words[place[first:upto]])
        runs[:, 0] += place[first]
        found.append(runs)
    rows = np.concatenate(found)
    return owner[rows[:, 0]], rows


def _found(batches: Iterator[pa.RecordBatch], edit: Edit | None) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        numbers = Numbers()
        texts = [words_of(t.as_py()) for t in batch.column(1)]
        if edit is not None:
            texts = [edit(words, n) for words, n in zip(texts, batch.column(2).to_pylist())]
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = [w for t in texts for w in t]
        words = np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))
        starts = np.cumsum(sizes) - sizes
        owner, rows = runs_of(words, np.repeat(np.arange(len(sizes)), sizes))
        # words that repeat what stands a period before them, counted by the ends of their stretches
        change = np.zeros(len(flat) + 1, np.int64)
        np.add.at(change, rows[:, 0] + rows[:, 2], 1)
        np.add.at(change, rows[:, 0] + rows[:, 1], -1)
        kept = np.cumsum(change)[:-1] == 0
        has_run = np.bincount(owner, minlength=len(sizes)) > 0
        collapsed = []
        for i, text in enumerate(texts):
            if has_run[i]:
                text = [w for w, k in zip(text, kept[starts[i]:starts[i] + sizes[i]]) if k]
            collapsed.append(b" ".join(text).decode("utf-8", "surrogatepass"))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))])
        values = pa.StructArray.from_arrays(
            [pa.array(rows[:, 0] - starts[owner]), pa.array(np.ascontiguousarray(rows[:, 1])),
             pa.array(np.ascontiguousarray(rows[:, 2]))], names=["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
             pa.array(collapsed, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, edit: Edit | None = None, number_col: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    ``runs`` holds ``start`` (number of the first word, from 0), ``length`` and ``period`` of each run, by
    start, then period; runs may overlap. ``collapsed`` are the words joined by one space, without those
    that lie in a run after its first ``period`` words. Null and empty texts have no words, no runs and
    an empty collapsed text. Null and repeated ids are rows like others; an empty table gives no rows;
    other columns are ignored. A text is searched whole, by the task that holds it; nothing is shuffled.
    ``edit`` changes the words of each document first; it is given them and the row's ``number_col``.
    """
    number = F.lit(0) if number_col is None else F.col(number_col)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         number.cast("long").alias("number"))
    return chosen.mapInArrow(lambda batches: _found(batches, edit),
                             f"doc_id {dict(chosen.dtypes)['doc_id']}, n_words long, runs {RUNS}, collapsed string")


def densest(runs: str = "runs") -> Column:
    """The run with the greatest length / period, compared exactly; of equals the first. Null without runs."""
    def better(best, run):
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def planted(words: list[bytes], hashed: int) -> list[bytes]:
    """Every tenth document by hash repeats a stretch of its own words from some word on."""
    n, g = len(words), hashed // 10
    if hashed % 10 or not n:
        return words
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % period] for i in range(n - a)]


def run_digests(docs: DataFrame) -> DataFrame:
    """Runs of the documents with planted repetitions: count, densest run and digests of runs and kept words."""
    numbered = docs.select("doc_id", "text", crc_remainder("doc_id", 2 ** 32).alias("hashed"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[
        r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    found = periodic_runs(numbered, planted, "hashed").withColumns({
        "best": densest(), "listed": F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")})
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
