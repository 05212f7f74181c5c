"""Hidden Markov language model over words, trained by Baum-Welch over partitions.

Latent states emit symbols. A word that occurs ``SYMBOL_COUNT`` times in training is a symbol of its own,
whatever the size of the input; every other word is a symbol of its class (by its ending), and the class
emits the word in proportion to its smoothed count. Counts of words cover all training documents. Each
round of Baum-Welch computes expected counts of states, transitions and emissions in every partition and
sums them up by symbol. The driver and all tasks hold the emissions of frequent words and classes only;
those of all other symbols are a written table, which meets the blocks of texts by joins in every round.

Sequences are cut into pieces that all run side by side: a piece yields the product of its steps for
every state it may begin in, and these products are chained along each document. So the scaled forward
recursion is exact over whole texts of any length, without a step-by-step loop over the longest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import crc_remainder, handing_back, stored
from vitalgrid.llm.ngrams import mix64, words_of
from vitalgrid.llm.tokens import text_slices

STATES = 4
ROUNDS = 4
CLASSES = 256
#: a word is a symbol if it occurs so often in training; rarer words teach their classes how likely rare words are
SYMBOL_COUNT = 10
#: all tasks hold the most frequent symbols, at most so many; all others come by joins
HELD_SYMBOLS = 800_000
#: ranges of symbols in which expected counts are summed, and tasks summed at once
RANGES, FAN_IN = 64, 64
#: a word's count is handed to all tasks if it makes up one in so many tokens: at most as many words
LISTED_SHARE = 2_000_000
#: steps of a piece, and steps between two scalings
PIECE, SCALED = 32, 8
#: tokens computed side by side
GROUP_TOKENS = 300_000
#: words a task counts before it hands them on
COUNTED_WORDS = 700_000
#: pseudo-counts: of the unigram distribution in each state, of each transition
PRIOR_EMISSIONS, PRIOR_TRANSITIONS = 500.0, 1.0
#: a row has the number of a symbol that tasks hold, or the word that another symbol is
SUMS = "range int, group int, symbols binary, counts binary, word long, " + ", ".join(f"c{s} double" for s in range(STATES))


#: the end of a text: an id that no word has, of class 0
END_ID = -256


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the distinct tokens of all texts, the number in this list of each token, ends included, and the
    number of tokens of each text.

    An id is 56 bits of a hash of the word, then its class, which its last two bytes decide.
    """
    words = words_of(texts)
    kind = mix64(words.last_letters() + np.uint64(1)) & np.uint64(255)
    ids = ((words.hashes & ~np.uint64(255)) | kind).view(np.int64)
    tokens = np.insert(ids, np.cumsum(words.number), END_ID)
    distinct, at = np.unique(tokens, return_inverse=True)
    return distinct, at, words.number + 1


def word_id(word: bytes) -> int:
    """The id of one word; the end of a text is empty."""
    ids, at, _ = tokens_of(pa.array([word.decode("utf-8")]))
    return int(ids[at[0]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> pa.RecordBatch:
        ids, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        learned, everywhere = (np.bincount(at, np.concatenate([f[k] for f in found]), len(ids)).astype(np.int64) for k in (1, 2))
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(learned), pa.array(everywhere)], names=["word", "n_train", "n_all"])

    for batch in text_slices(batches, "text"):
        held = np.array(batch.column(1).to_pylist(), bool)
        ids, at, lengths = tokens_of(batch.column(0))
        found.append((ids, np.bincount(at[~np.repeat(held, lengths)], minlength=len(ids)), np.bincount(at, minlength=len(ids))))
        if sum(len(f[0]) for f in found) >= COUNTED_WORDS:
            yield merged()
    if found:
        yield merged()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n_train, n_all`` over all whole texts of ``docs(text, held_out)``."""
    return docs.select("text", "held_out").mapInArrow(
        lambda batches: handing_back(_count(batches)), "word long, n_train long, n_all long").groupBy(
        "word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


@dataclass
class Words:
    """What every task knows of the vocabulary; all parts are bounded by the shares above."""

    tokens: int  # training tokens
    distinct: int  # distinct training tokens
    symbols: np.ndarray  # ids of the words that are symbols held by all tasks, ascending
    symbol_counts: np.ndarray
    listed: np.ndarray  # ids of the words whose counts are known here, ascending
    listed_counts: np.ndarray
    class_tokens: np.ndarray  # training tokens and words of each class, symbols aside
    class_words: np.ndarray
    other_tokens: float = 0.0  # training tokens and words of the symbols that tasks do not hold
    other_words: float = 0.0
    least: int = SYMBOL_COUNT  # occurrences of the symbols that all tasks hold

    @property
    def base_total(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    @property
    def class_totals(self) -> np.ndarray:
        return self.class_tokens + 0.5 * (self.class_words + 1)

    def unigram(self) -> np.ndarray:
        """Smoothed shares of the symbols that tasks hold, classes last."""
        return (np.concatenate([self.symbol_counts, self.class_tokens]) + 0.5) / self.smoothed

    @property
    def smoothed(self) -> float:
        """Smoothed counts of all symbols."""
        return float(self.symbol_counts.sum() + self.class_tokens.sum() + self.other_tokens
                     + 0.5 * (len(self.symbol_counts) + CLASSES + self.other_words))

    @property
    def other_share(self) -> float:
        return (self.other_tokens + 0.5 * self.other_words) / self.smoothed


def _is_symbol() -> Column:
    return F.col("n_train") >= SYMBOL_COUNT


def _is_held(least: int) -> Column:
    """Symbols that all tasks hold: those of so many occurrences."""
    return _is_symbol() & (F.col("n_train") >= F.lit(least))


def least_held(counts: DataFrame) -> int:
    """A number of occurrences that at most ``HELD_SYMBOLS`` words reach: a power of two, or ``SYMBOL_COUNT``.

    One row for each binary length of a number of occurrences comes to the driver.
    """
    lengths = counts.where(_is_symbol()).groupBy(F.length(F.bin("n_train")).alias("length")).agg(F.count("*").alias("words"))
    held, least = 0, 2 ** 62
    for row in sorted(lengths.collect(), key=lambda r: -r["length"]):
        held += row["words"]
        if held > HELD_SYMBOLS:
            break
        least = max(SYMBOL_COUNT, 2 ** (row["length"] - 1))
    return least


def describe_words(counts: DataFrame) -> Words:
    """Bring the bounded parts of a table of word counts to the driver."""
    total = counts.agg(F.sum("n_train").alias("t"), F.sum("n_all").alias("a"),
                       F.count_if(F.col("n_train") > 0).alias("v")).first()
    tokens, everywhere = total["t"] or 0, total["a"] or 0
    least = least_held(counts)
    is_held = _is_held(least)
    symbols = counts.where(is_held).select("word", "n_train").toArrow().sort_by("word")
    listed = counts.where(F.col("n_all") * LISTED_SHARE >= F.lit(everywhere)).select(
        "word", "n_train").toArrow().sort_by("word")
    others = counts.where(_is_symbol() & ~is_held).agg(F.sum("n_train").alias("n"), F.count("*").alias("v")).first()
    per_class = counts.where(~_is_symbol()).groupBy(F.col("word").bitwiseAND(F.lit(255)).alias("class")).agg(
        F.sum("n_train").alias("n"), F.count_if(F.col("n_train") > 0).alias("v")).collect()
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in per_class:
        class_tokens[row["class"]], class_words[row["class"]] = row["n"], row["v"]
    return Words(tokens, total["v"], symbols["word"].to_numpy(), symbols["n_train"].to_numpy().astype(float),
                 listed["word"].to_numpy(), listed["n_train"].to_numpy().astype(float), class_tokens, class_words,
                 float(others["n"] or 0), float(others["v"]), least)


def _position(sorted_ids: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the ids stand in a sorted list, and whether they are there."""
    if not len(sorted_ids):
        return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    at = np.minimum(np.searchsorted(sorted_ids, ids), len(sorted_ids) - 1)
    return at, sorted_ids[at] == ids


#: one row for each block of texts: what its documents are, and their symbols one after another. Numbers
#: from the held symbols on point into ``others``, the words that may be symbols which tasks do not hold.
ENCODED = ("docs array<struct<doc_id:{id},held_out:boolean,n_tokens:bigint,n_known:bigint,base:double,inside:double,"
           "rare:array<bigint>>>, lengths array<long>, held_out array<boolean>, symbols binary, others array<long>")


def _encode(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[pa.RecordBatch]:
    """Symbols of each block of texts, and the parts of its scores that listed words decide."""
    totals = words.class_totals
    held = len(words.symbols) + CLASSES

    def learn(ids: np.ndarray) -> tuple:
        at, is_symbol = _position(words.symbols, ids)
        kind = (ids & 255).astype(np.int64)
        count_at, is_listed = _position(words.listed, ids)
        count = np.where(is_listed, words.listed_counts[count_at] if len(words.listed) else 0, 0)
        symbol_count_at = words.symbol_counts[at] if len(words.symbols) else np.zeros(len(ids))
        count = np.where(is_symbol, symbol_count_at, count)
        decided = is_symbol | is_listed
        of_class = decided & (count < SYMBOL_COUNT)
        return (np.where(is_symbol, at, len(words.symbols) + kind).astype(np.int32),
                decided & (count > 0),
                np.where(decided, np.log10((count + 0.5) / words.base_total), 0.0),
                np.where(of_class, np.log10((count + 0.5) / totals[kind]), 0.0),
                ~decided, ~is_symbol & ~of_class)

    for batch in text_slices(batches, "text"):
        ids, at, lengths = tokens_of(batch.column(2))
        symbol, known, base, inside, rare, other = learn(ids)
        text = np.repeat(np.arange(len(lengths)), lengths)
        n = len(lengths)
        others = np.flatnonzero(np.bincount(at[other[at]], minlength=len(other)))
        symbol[others] = held + np.arange(len(others))
        is_rare = rare[at]
        rare_ends = np.concatenate([[0], np.cumsum(is_rare)])[
            np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
        docs = pa.StructArray.from_arrays([
            batch.column(0), batch.column(1), pa.array(lengths),
            pa.array(np.bincount(text, known[at], n).astype(np.int64)),
            pa.array(np.bincount(text, base[at], n)), pa.array(np.bincount(text, inside[at], n)),
            pa.ListArray.from_arrays(pa.array(rare_ends), pa.array(ids[at][is_rare])),
        ], names=["doc_id", "held_out", "n_tokens", "n_known", "base", "inside", "rare"])

        def whole(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        yield pa.RecordBatch.from_arrays(
            [whole(docs), whole(pa.array(lengths)), whole(batch.column(1)),
             pa.array([symbol[at].astype("<i4").tobytes()], pa.binary()), whole(pa.array(ids[others]))],
            names=["docs", "lengths", "held_out", "symbols", "others"])


# ---- the model ---------------------------------------------------------------------------------

@dataclass
class Model:
    start: np.ndarray  # (S,): state before the first token
    moves: np.ndarray  # (S, S): rows sum to 1
    emits: np.ndarray  # (symbols + 1, S): columns sum to 1 with those of the symbols that tasks do not hold;
    # the last row is padding and emits with 1
    total: np.ndarray | None = None  # (S,): what the weights of all symbols were divided by

    def products(self, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece and each state before it: scaled state weights after it and their logs."""
        n, s = steps.shape[1], len(self.start)
        held = np.broadcast_to(np.eye(s), (n, s, s)).copy()
        logs = np.zeros((n, s))
        for t in range(len(steps)):
            held = (held.reshape(-1, s) @ self.moves).reshape(n, s, s)
            held *= self.emits.take(steps[t], axis=0)[:, None, :]
            if t % SCALED == SCALED - 1 or t == len(steps) - 1:
                size = held.sum(2)
                logs += np.log(size)
                held /= size[..., None]
        return held, logs


@dataclass
class Pieces:
    """Sequences cut into pieces of ``PIECE`` steps; the longest sequences come first."""

    steps: np.ndarray  # (PIECE, pieces): symbols, padded
    first: np.ndarray  # first piece of each sequence
    number: np.ndarray  # pieces of each sequence, falling
    order: np.ndarray  # the sequence's place in the input

    def at(self, j: int) -> tuple[slice, np.ndarray]:
        """The sequences that have a piece ``j``, and that piece of each."""
        upto = slice(0, int(np.searchsorted(-self.number, -j, side="left")))
        return upto, self.first[upto] + j


def cut(symbols: np.ndarray, lengths: np.ndarray, padding: int) -> Pieces:
    order = np.argsort(-lengths, kind="stable")
    number = -(-lengths[order] // PIECE)
    first = np.cumsum(number) - number
    begin = (np.cumsum(lengths) - lengths)[order]
    within = np.arange(int(number.sum())) - np.repeat(first, number)
    start = np.repeat(begin, number) + within * PIECE
    end = np.repeat(begin + lengths[order], number)
    at = start[None, :] + np.arange(PIECE)[:, None]
    steps = np.where(at < end, symbols[np.minimum(at, len(symbols) - 1)], padding)
    return Pieces(steps, first, number, order)


def _chain(model: Model, pieces: Pieces, held: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State shares before each piece, and the log likelihood of each sequence."""
    n, s = len(pieces.first), len(model.start)
    now = np.broadcast_to(model.start, (n, s)).copy()
    before = np.empty((held.shape[0], s))
    total = np.zeros(n)
    for j in range(int(pieces.number[0]) if n else 0):
        who, which = pieces.at(j)
        before[which] = now[who]
        top = logs[which].max(1)
        after = np.einsum("ns,nst->nt", now[who] * np.exp(logs[which] - top[:, None]), held[which])
        size = after.sum(1)
        total[who] += top + np.log(size)
        now[who] = after / size[:, None]
    return before, total


def log_likelihoods(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Exact natural log likelihood of each sequence by the scaled forward recursion."""
    pieces = cut(symbols, lengths, len(model.emits) - 1)
    _, total = _chain(model, pieces, *model.products(pieces.steps))
    found = np.empty(len(lengths))
    found[pieces.order] = total
    return found


@dataclass
class Expected:
    """Expected counts, summed over sequences."""

    states: int
    symbols: int
    start: np.ndarray = field(init=False)
    moves: np.ndarray = field(init=False)
    emits: np.ndarray = field(init=False)
    likelihood: float = 0.0

    def __post_init__(self):
        self.start = np.zeros(self.states)
        self.moves = np.zeros((self.states, self.states))
        self.emits = np.zeros((self.states, self.symbols + 1))

    def add(self, model: Model, symbols: np.ndarray, lengths: np.ndarray) -> None:
        """Forwards and backwards over whole sequences, piece by piece side by side."""
        pieces = cut(symbols, lengths, self.symbols)
        held, logs = model.products(pieces.steps)
        before, total = _chain(model, pieces, held, logs)
        self.likelihood += float(total.sum())
        n, s = len(pieces.first), self.states
        # weights of what follows each piece, from the last piece back
        follows = np.ones((n, s))
        after = np.empty_like(before)
        for j in reversed(range(int(pieces.number[0]) if n else 0)):
            who, which = pieces.at(j)
            after[which] = follows[who]
            weight = np.exp(logs[which] - logs[which].max(1)[:, None])
            earlier = weight * np.einsum("nst,nt->ns", held[which], follows[who])
            follows[who] = earlier / earlier.sum(1, keepdims=True)
        states = np.empty((len(pieces.steps) + 1, len(before), s))
        states[0] = before
        for t, step in enumerate(pieces.steps):
            now = (states[t] @ model.moves) * model.emits.take(step, axis=0)
            states[t + 1] = now / now.sum(1, keepdims=True)
        back = after
        for t in reversed(range(len(pieces.steps))):
            step = pieces.steps[t]
            real = (step != self.symbols)[:, None]
            share = states[t + 1] * back
            share /= share.sum(1, keepdims=True)
            for k in range(s):
                self.emits[k] += np.bincount(step, share[:, k], self.symbols + 1)
            ahead = back * model.emits.take(step, axis=0)
            norm = ((states[t] @ model.moves) * ahead).sum(1, keepdims=True)
            self.moves += model.moves * (states[t].T @ (ahead / norm * real))
            back = ahead @ model.moves.T
            back /= back.sum(1, keepdims=True)
        begin = before[pieces.first] * back[pieces.first]
        self.start += (begin / begin.sum(1, keepdims=True)).sum(0)

    def packed(self) -> pa.RecordBatch:
        """A row for each range of symbols seen, with their numbers and counts; range -1 holds all other counts."""
        likelihood = np.zeros(self.states)
        likelihood[0] = self.likelihood
        seen = np.flatnonzero(self.emits[:, :self.symbols].sum(0))
        cuts = np.searchsorted(seen, np.arange(RANGES + 1) * _range_width(self.symbols))
        rows = [(-1, b"", np.concatenate([self.moves, self.start[None], likelihood[None]]).tobytes())]
        for r, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if i < j:
                rows.append((r, seen[i:j].astype("<i4").tobytes(), self.emits[:, seen[i:j]].T.astype("<f4").tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2)]],
            names=["range", "symbols", "counts"])


def _range_width(symbols: int) -> int:
    return -(-max(1, symbols) // RANGES)


def _summed(table: pa.Table, states: int) -> pa.Table:
    """The counts of a range of symbols from several tasks as one row."""
    part, group = table.column("range")[0].as_py(), table.column("group")[0].as_py()
    if part < 0:
        names, total = b"", sum(np.frombuffer(c.as_py(), np.float64) for c in table.column("counts")).tobytes()
    else:
        found, at = np.unique(np.concatenate([np.frombuffer(n.as_py(), "<i4") for n in table.column("symbols")]), return_inverse=True)
        values = np.concatenate([np.frombuffer(c.as_py(), "<f4").reshape(-1, states) for c in table.column("counts")])
        names = found.tobytes()
        total = np.column_stack([np.bincount(at, values[:, k], len(found)) for k in range(states)]).astype("<f4").tobytes()
    return pa.table({"range": pa.array([part], pa.int32()), "group": pa.array([group], pa.int32()),
                     "symbols": pa.array([names], pa.binary()), "counts": pa.array([total], pa.binary())})


PACKED = "range int, group int, symbols binary, counts binary"


def _sum_by_tree(packed: DataFrame, tasks: int) -> pa.Table:
    """The sums over all tasks, ``FAN_IN`` rows at a time, so that no sum takes more however many tasks there are.

    What comes to the driver is one row for each range of the symbols that tasks hold.
    """
    packed = packed.select("range", "group", "symbols", "counts")
    while True:
        packed = packed.withColumn("group", F.floor(F.col("group") / FAN_IN).cast("int")).groupBy("range", "group").applyInArrow(
            lambda table: _summed(table, STATES), PACKED)
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            return packed.toArrow()


def token_groups(lengths: np.ndarray) -> Iterator[slice]:
    """Slices of sequences of about ``GROUP_TOKENS`` tokens, one sequence at least."""
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        done = ends[first - 1] if first else 0
        upto = max(first + 1, int(np.searchsorted(ends, done + GROUP_TOKENS, side="right")))
        yield slice(first, upto)
        first = upto


@dataclass
class Block:
    """Texts of a block, with symbols numbered anew and a model of these only."""

    symbols: np.ndarray
    lengths: np.ndarray
    model: Model
    held: np.ndarray  # numbers that all tasks know of the first symbols
    words: np.ndarray  # words that the symbols after them are


def _block(row: dict, model: Model, learned: bool) -> Block:
    """The block of a row; ``learned`` leaves out texts that are not learned from."""
    lengths, others = (row[c].flatten().to_numpy(zero_copy_only=False) for c in ("lengths", "others"))
    symbols = np.frombuffer(row["symbols"][0].as_buffer(), "<i4")
    if learned:
        stay = ~row["held_out"].flatten().to_numpy(zero_copy_only=False)
        symbols, lengths = symbols[np.repeat(stay, lengths)], lengths[stay]
    at = row["at"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    own = np.column_stack([row[f"e{k}"].flatten().to_numpy(zero_copy_only=False) for k in range(len(model.start))])
    n = len(model.emits) - 1
    # a word that turned out to be no symbol is one of its class
    place = np.concatenate([np.arange(n), n - CLASSES + (others & 255)])
    place[n + at] = n + np.arange(len(at))
    symbols = place[symbols]
    seen = np.flatnonzero(np.bincount(symbols, minlength=n + len(at)))
    number = np.zeros(n + len(at), np.int64)
    number[seen] = np.arange(len(seen))
    held = seen[seen < n]
    emits = np.concatenate([model.emits[held], own[seen[len(held):] - n]])
    return Block(number[symbols], lengths, Model(model.start, model.moves, _padded(emits)), held,
                 others[at][seen[len(held):] - n])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name).slice(i, 1) for name in batch.schema.names}


def _parts(block: Block) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    ends = np.concatenate([[0], np.cumsum(block.lengths)])
    for part in token_groups(block.lengths):
        yield part, block.symbols[ends[part.start]:ends[part.stop]], block.lengths[part]


def _expect(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Expected counts of a task: packed for the symbols that all hold, a row for each block and other word."""
    states, total = len(model.start), Expected(len(model.start), len(model.emits) - 1)
    columns = [f"c{k}" for k in range(states)]
    for batch in batches:
        for row in _rows(batch):
            block = _block(row, model, True)
            n = len(block.held)
            expected = Expected(states, n + len(block.words))
            for _, symbols, lengths in _parts(block):
                expected.add(block.model, symbols, lengths)
            total.start += expected.start
            total.moves += expected.moves
            total.likelihood += expected.likelihood
            total.emits[:, block.held] += expected.emits[:, :n]
            if m := len(block.words):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()),
                     pa.array(block.words), *[pa.array(np.ascontiguousarray(c[n:-1])) for c in expected.emits]],
                    names=["range", "group", "symbols", "counts", "word", *columns])
    rows = total.packed()
    m = rows.num_rows
    yield pa.RecordBatch.from_arrays(
        [rows.column("range"), pa.array(np.full(m, TaskContext.get().partitionId(), np.int32)), rows.column("symbols"),
         rows.column("counts"), pa.nulls(m, pa.int64()), *[pa.nulls(m, pa.float64())] * states],
        names=["range", "group", "symbols", "counts", "word", *columns])


def first_model(words: Words, states: int = STATES, seed: int = 3, others: np.ndarray | float = 0.0) -> Model:
    """States that rarely change, each with the words' shares scattered at random.

    ``others`` are the summed weights of the symbols that tasks do not hold.
    """
    unigram = words.unigram()
    # classes are words of their own here
    names = np.concatenate([words.symbols, np.arange(CLASSES)]).astype(np.int64)
    emits = unigram[:, None] * scattered(names, states, seed)
    moves = np.full((states, states), 0.03 / max(1, states - 1))
    np.fill_diagonal(moves, 0.97)
    total = emits.sum(0) + others
    return Model(np.full(states, 1 / states), moves / moves.sum(1, keepdims=True), _padded(emits / total), total)


def _padded(emits: np.ndarray) -> np.ndarray:
    return np.concatenate([emits, np.ones((1, emits.shape[1]))])


def reestimated(sums: pa.Table, words: Words, states: int = STATES,
                others: np.ndarray | float = 0.0) -> tuple[Model, float]:
    """The next model from packed sums of expected counts, and the log likelihood under the last one.

    ``others`` are the summed weights of the symbols that tasks do not hold.
    """
    unigram = words.unigram()
    counts, rest = np.zeros((len(unigram), states)), np.zeros((states + 2, states))
    for part, names, values in zip(*(sums.column(c) for c in ("range", "symbols", "counts"))):
        if part.as_py() < 0:
            rest += np.frombuffer(values.as_py(), np.float64).reshape(-1, states)
        else:
            counts[np.frombuffer(names.as_py(), "<i4")] += np.frombuffer(values.as_py(), "<f4").reshape(-1, states)
    emits = counts + PRIOR_EMISSIONS * unigram[:, None]
    moves = rest[:states] + PRIOR_TRANSITIONS
    start = rest[states] + PRIOR_TRANSITIONS
    total = emits.sum(0) + others
    return Model(start / start.sum(), moves / moves.sum(1, keepdims=True), _padded(emits / total), total), rest[-1, 0]


def other_symbols(encoded: DataFrame, counts: DataFrame, words: Words) -> DataFrame | None:
    """``word, share, places`` of the symbols that tasks do not hold: smoothed share, blocks and places there.

    None without any. Such words are less frequent than ``HELD_SYMBOLS`` others, which bounds their lists to that share of
    all tokens.
    """
    found = counts.where(_is_symbol() & ~_is_held(words.least)).select("word", "n_train")
    if not words.other_words:
        return None
    places = encoded.select("part", F.posexplode("others").alias("at", "word"))
    return places.join(found, "word").groupBy("word").agg(
        ((F.first("n_train") + F.lit(0.5)) / F.lit(words.smoothed)).alias("share"),
        F.collect_list(F.struct("part", "at")).alias("places"))


def _uniform(names: np.ndarray, number: int) -> np.ndarray:
    return (mix64(mix64(names.view(np.uint64)) + np.uint64(number)) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def scattered(names: np.ndarray, states: int = STATES, seed: int = 3) -> np.ndarray:
    """A log-normal factor for each word and state, from a hash of the word: alike wherever it is kept."""
    draws = [np.sqrt(-2 * np.log(_uniform(names, 2 * (seed * states + k)) + 2.0 ** -54))
             * np.cos(2 * np.pi * _uniform(names, 2 * (seed * states + k) + 1)) for k in range(states)]
    return np.exp(0.7 * np.column_stack(draws))


def _first_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        factor = scattered(batch.column("word").to_numpy()) * batch.column("share").to_numpy()[:, None]
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("places"), *[pa.array(np.ascontiguousarray(factor[:, k])) for k in range(STATES)]],
            names=["word", "places", *[f"w{k}" for k in range(STATES)]])


def _with_emissions(encoded: DataFrame, weights: DataFrame | None, model: Model) -> DataFrame:
    """The blocks with the emissions of their symbols that tasks do not hold; without such symbols nothing is joined."""
    blocks = encoded.select("part", "lengths", "held_out", "symbols", "others")
    if weights is None:
        return blocks.withColumns({"at": F.lit(None).cast("array<int>"), **{
            f"e{k}": F.lit(None).cast("array<double>") for k in range(STATES)}})
    own = [(F.col(f"w{k}") / F.lit(float(model.total[k]))).alias(f"e{k}") for k in range(STATES)]
    lists = ["at", *[f"e{k}" for k in range(STATES)]]
    # lists of numbers take less than half the room of a list of structs; no value is null, so they keep step
    found = weights.select(F.inline("places"), *own).groupBy("part").agg(
        *[F.collect_list(c).alias(c) for c in lists])
    return blocks.join(found, "part", "left")


def train(encoded: DataFrame, words: Words, others: DataFrame | None,
          rounds: int = ROUNDS) -> tuple[Model, DataFrame | None, list[float]]:
    """Baum-Welch over all documents that are not held out.

    Gives the model, the weights of the symbols that tasks do not hold, and the likelihood before each round.
    """
    columns = [f"c{k}" for k in range(STATES)]
    tasks = (encoded.agg(F.max(F.shiftright("part", 33))).first()[0] or 0) + 1
    weights, rest = None, [0.0] * STATES
    if others is not None:
        weights = others.mapInArrow(lambda batches: handing_back(_first_weights(batches)), "word long, places array<struct<part:long,at:int>>, "
                                    + ", ".join(f"w{k} double" for k in range(STATES)))
        rest = weights.agg(*[F.sum(f"w{k}") for k in range(STATES)]).first()
    model, history = first_model(words, others=np.array([x or 0.0 for x in rest])), []
    for _ in range(rounds):
        def expect(batches, model=model):
            return handing_back(_expect(batches, model))
        sums = _with_emissions(encoded, weights, model).mapInArrow(expect, SUMS)
        if others is not None:
            sums = stored(sums, "emission-sums")
            tasks = max(tasks, (sums.agg(F.max("group")).first()[0] or 0) + 1)
        # what comes to the driver is the symbols that tasks hold, and one row for all others
        held = _sum_by_tree(sums.where("range is not null"), tasks)
        if not held.num_rows:
            break
        if others is not None:
            own = stored(sums.where("word is not null").groupBy(F.col("word").alias("_word")).agg(
                *[F.sum(c).alias(c) for c in columns]), "emissions")
            rest = own.agg(*[F.sum(c) for c in columns]).first()
            weights = others.join(own, F.col("word") == F.col("_word"), "left").select("word", "places", *[
                (F.coalesce(f"c{k}", F.lit(0.0)) + F.lit(PRIOR_EMISSIONS) * F.col("share")).alias(f"w{k}")
                for k in range(STATES)])
        more = PRIOR_EMISSIONS * words.other_share if others is not None else 0.0
        model, likelihood = reestimated(held, words, others=np.array([x or 0.0 for x in rest]) + more)
        history.append(likelihood)
    return model, weights, history


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            block = _block(row, model, False)
            n = len(block.lengths)
            found = np.zeros(n)
            for part, symbols, lengths in _parts(block):
                found[part] = log_likelihoods(block.model, symbols, lengths) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row["part"][0].as_py())), pa.array(np.arange(n, dtype=np.int32)), pa.array(found)],
                names=["part", "at", "sequence"])


def score_texts(docs: DataFrame, held_out_divisor: int = 5, held_out_rest: int = 1) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``base_score`` is the smoothed unigram log10 probability, ``score`` the model's. Null and empty texts
    are one end token. Documents whose id has the given remainder are not learned from; a null id counts
    as an empty one. Repeated rows are documents of their own; an empty table gives no rows; other
    columns are ignored. If nothing may be learned all words are unknown.

    Counts of rare words come by a join on the word; since frequent words never take part, no key of it
    holds more than one in ``LISTED_SHARE`` tokens.
    """
    rows = docs.select(
        "doc_id", (crc_remainder("doc_id", held_out_divisor) == held_out_rest).alias("held_out"),
        F.col("text").cast("string").alias("text"))
    counts = stored(word_counts(rows), "word-counts")
    words = describe_words(counts)
    kind = dict(rows.dtypes)["doc_id"]
    encoded = stored(rows.mapInArrow(lambda batches: handing_back(_encode(batches, words)), ENCODED.format(id=kind)).withColumn(
        "part", F.monotonically_increasing_id()), "encoded-texts")
    others = other_symbols(encoded, counts, words)
    others = None if others is None else stored(others, "other-symbols")
    model, weights, _ = train(encoded, words, others)
    sequences = _with_emissions(encoded, weights, model).mapInArrow(
        lambda batches: handing_back(_score(batches, model)), "part long, at int, sequence double")
    texts = encoded.select("part", F.posexplode("docs").alias("at", "doc")).select("part", "at", "doc.*")

    listed_share = F.col("n_all") * LISTED_SHARE >= F.lit(int(counts.agg(F.sum("n_all")).first()[0] or 0))
    class_totals = F.array(*[F.lit(float(x)) for x in words.class_totals])
    rare = texts.select("part", "at", F.explode("rare").alias("word")).groupBy("part", "at", "word").agg(
        F.count("*").alias("times"))
    found = rare.join(counts.where(~listed_share).select("word", "n_train"), "word", "left").withColumn(
        "n_train", F.coalesce("n_train", F.lit(0)))
    smoothed = F.col("n_train") + F.lit(0.5)
    kind_total = F.get(class_totals, F.col("word").bitwiseAND(F.lit(255)).cast("int"))
    decided = found.groupBy("part", "at").agg(
        F.sum(F.when(F.col("n_train") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(smoothed / F.lit(float(words.base_total)))).alias("rare_base"),
        F.sum(F.when(~_is_symbol(), F.col("times") * F.log10(smoothed / kind_total)).otherwise(0)).alias("rare_inside"))

    def added(column: str, more: str):
        return F.col(column) + F.coalesce(F.col(more), F.lit(0))

    return texts.drop("rare").join(sequences, ["part", "at"]).join(decided, ["part", "at"], "left").select(
        "doc_id", "held_out", "n_tokens", added("n_known", "rare_known").alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        added("base", "rare_base").alias("base_score"),
        (F.col("sequence") + added("inside", "rare_inside")).alias("score"))
