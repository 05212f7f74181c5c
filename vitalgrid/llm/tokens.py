"""Whole-text tokenization inside tasks, with a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vitalgrid.llm.ngrams import Words, words_of

#: id appended to each document
END_ID = 1
#: distinct words, and distinct pieces of words, whose ids a worker remembers; beyond that it starts anew
REMEMBERED_WORDS, REMEMBERED_PIECES = 1_500_000, 800_000
#: where texts are cut: spaces and line ends
_CUTS = np.isin(np.arange(256), [0x20, 0x0A])


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number

    def after(self, number: int) -> list[str]:
        """The words numbered from ``number`` on."""
        return list(islice(self, number, None)) if number < len(self) else []


class _Runs:
    """Runs of ids by name: names are numbered when asked for and learned afterwards."""

    def __init__(self):
        self.number = Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def numbered(self, names: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))

    def new(self) -> list[str]:
        return self.number.after(len(self.size))

    def learn(self, names: list[str] | None, sizes, ids) -> None:
        """Runs of new names, or of numbers that are kept elsewhere."""
        for name in names or ():
            self.number[name]
        size = np.asarray(sizes, np.int64)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, np.asarray(ids, np.uint32)])

    def expand(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the runs numbered ``at`` one after another, and where each run ends."""
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(self.start[at] - (ends - size), size)], ends


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else the next free one."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of whole texts, equal to the tokenizer's own.

    The vocabulary drops white space and never merges across it, so a text may be cut at spaces and
    line ends and each distinct word be encoded once. A word of plain Latin letters is in normal
    form already but for its case; its pieces go straight to the tokenizer's model, which is several
    times as fast as the whole chain. All other words go through the whole chain. Null is an empty text.
    With a file that normalizes or splits in another way, whole texts go through the whole chain.
    """

    #: how this vocabulary splits words before it merges letters (a fixed pattern)
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: what needs the whole chain: letters that lower case alone does not normalize, special tokens
    NOT_PLAIN = "[\u0130\u0250-\U0010ffff]|<\\|"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cuts_at_spaces = self._cuts_at_spaces()
        self.split = regex.compile(self.PIECES + r"|\n").findall
        self.not_plain = re.compile(self.NOT_PLAIN).search
        self.letters = _byte_letters()
        self._forget()

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _cuts_at_spaces(self) -> bool:
        """Whether the file normalizes and splits in the way that is built in here."""
        chain = json.loads(self.tokenizer.to_str())
        return (chain["normalizer"] == {"type": "Sequence", "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
            and chain["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": self.PIECES}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
            and not chain["truncation"] and not chain["padding"]
            and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                    for t in chain["added_tokens"]))

    def _forget(self) -> None:
        self.words, self.pieces = _Runs(), _Runs()
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # of the words known, by hash
        self.pieces.learn(["\n"], [0], [])  # what ends a word has no ids

    def _piece_ids(self, piece: str) -> list[int]:
        spelled = piece if piece.isascii() and piece.isprintable() else \
            piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(spelled)]

    def _learn(self, words: list[str]) -> None:
        """The ids of new words: those of their pieces, in one pass over all of them."""
        odd = {i: self.tokenizer.encode(w, add_special_tokens=False).ids
               for i, w in enumerate(words) if self.not_plain(w)}
        plain = ["" if i in odd else w for i, w in enumerate(words)] if odd else words
        found = self.split("\n".join(plain).lower() + "\n")
        at = self.pieces.numbered(found)
        if new := self.pieces.new():
            ids = [self._piece_ids(p) for p in new]
            self.pieces.learn(new, list(map(len, ids)), [x for i in ids for x in i])
        ids, ends = self.pieces.expand(at)
        sizes = np.diff(ends[at == 0], prepend=0)
        if odd:
            cuts = np.cumsum(sizes)
            where = np.fromiter(odd, np.int64)
            added = np.array([len(x) for x in odd.values()], np.int64)
            ids = np.insert(ids, np.repeat(cuts[where], added),
                            np.array([x for i in odd.values() for x in i], np.uint32))
            sizes[where] += added
        self.words.learn(None, sizes, ids)

    def _numbered(self, found: Words) -> np.ndarray:
        """The numbers of the words among those known, once new ones are learned."""
        distinct, example, at = np.unique(found.hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > REMEMBERED_WORDS or len(self.pieces.size) > REMEMBERED_PIECES:
            self._forget()
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == distinct[inside]
        if not known.all():
            new, raw = example[~known], found.letters.tobytes()
            begin, end = found.first[new], found.first[new] + found.length[new]
            before = len(self.words.size)
            self._learn([raw[i:j].decode() for i, j in zip(begin.tolist(), end.tolist())])
            self.numbers = np.insert(self.numbers, place[~known], before + np.arange(len(new)))
            self.hashes = np.insert(self.hashes, place[~known], distinct[~known])
            place = np.searchsorted(self.hashes, distinct)
        return self.numbers[place][at]

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, each text with its end id, and each text's number of ids."""
        if not self.cuts_at_spaces:
            listed = texts.to_pylist() if isinstance(texts, pa.Array) else texts
            own = [[*self.tokenizer.encode(t or "", add_special_tokens=False).ids, END_ID] for t in listed]
            return (np.array([x for ids in own for x in ids], np.uint32),
                    np.array([len(ids) for ids in own], np.int64))
        found = words_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), _CUTS, lower=False)
        at = self._numbered(found)
        ids, ends = self.words.expand(at)
        # ids of each text: the difference of the running total at its first and last word
        total = np.concatenate([[0], ends])
        upto = np.cumsum(found.number)
        lengths = total[upto] - total[upto - found.number]
        return np.insert(ids, np.cumsum(lengths), END_ID), lengths + 1


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each worker process."""
    return WordTokenizer(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def text_slices(batches, column: str, most_bytes: int = 2_000_000):
    """The rows of Arrow batches in slices that hold about so many bytes of text, or one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            upto = max(first + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
            yield batch.slice(first, upto - first)
            first = upto
