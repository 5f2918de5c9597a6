"""Token ids of texts by a public tokenizer, with the ids of words remembered.

The tokenizer drops white space, never joins what white space parts, and splits ASCII marks from an
ASCII letter or digit before them. So a text's ids are those of its words, and of the marks behind
them, in a row. Each Python worker encodes a word with the tokenizer once and keeps its ids in a
hash table of numpy arrays under the word's 64-bit hash. The table is emptied when it is full.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from storelens.llm.bytewords import SPACE_WORDS, U64, range_hashes, words_of

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
TABLE_BITS = 20  # places for words; a worker's table takes about 30 MB with their ids
FULL = 0.6

# What may stand behind a letter or digit and is split from it by the tokenizer. An apostrophe can
# begin a contraction, so it is left out.
MARKS = np.zeros(256, bool)
MARKS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True
PLAIN = np.zeros(256, bool)
PLAIN[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
SPECIAL = b"<|"  # begins a special token, which capitals would not make
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = dict(zip((b for b in range(256) if b not in VISIBLE), range(256, 512)))


def default_path() -> str:
    return public_tokenizers.path(TOKENIZER)


class WordTable:
    """Ids of words by their hashes: open addressing in arrays, looked up for many words at once."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        size = 1 << TABLE_BITS
        self.keys = np.zeros(size, U64)
        self.at = np.zeros(size, np.int32)
        self.count = np.zeros(size, np.int32)
        self.ids = np.zeros(1 << 19, np.uint32)
        self.used = self.words = 0

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> U64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the words, -1 for those that are missing."""
        slot = self._slots(hashes)
        out = np.full(len(hashes), -1)
        left = np.arange(len(hashes))
        while len(left):
            here = self.keys[slot]
            same = here == hashes[left]
            out[left[same]] = slot[same]
            on = ~same & (here != 0)
            left, slot = left[on], (slot[on] + 1) & ((1 << TABLE_BITS) - 1)
        return out

    def add(self, hashes: np.ndarray, words: list[bytes]) -> None:
        encoded = [self.encode_word(w) for w in words]
        lengths = np.array([len(e) for e in encoded])
        total = int(lengths.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used : self.used + total] = [i for e in encoded for i in e]
        starts = self.used + np.cumsum(lengths) - lengths
        left, slot = np.arange(len(hashes)), self._slots(hashes)
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[left[free]]
            won = self.keys[slot] == hashes[left]
            self.at[slot[won]], self.count[slot[won]] = starts[left[won]], lengths[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & ((1 << TABLE_BITS) - 1)
        self.used += total
        self.words += len(words)

    def encode_word(self, word: bytes) -> list[int]:
        text = word.decode("utf-8", "replace")
        if text.isalpha() and max(text) < "ɐ":
            # letters alone are one unit of the tokenizer: straight to its merges
            letters = text if text.isascii() else unicodedata.normalize("NFC", text).lower()
            if letters.isalpha() and max(letters) < "ɐ":
                spelled = letters.encode().decode("latin-1").translate(BYTE_LETTERS)
                return [t.id for t in self.model.tokenize(spelled)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids


_tables: dict[str, WordTable] = {}


def encode(texts: list[bytes], path: str, end_id: int = END_ID) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers, `end_id` last.

    An empty text has `end_id` alone.
    """
    table = _tables.get(path)
    if table is None:
        table = _tables[path] = WordTable(path)
    end = np.array([end_id], "<u4").tobytes()
    if any(SPECIAL in t for t in texts):
        # one by one with the tokenizer: special tokens depend on capitals
        return [_whole(t, table) + end if SPECIAL in t else _remembered([t], table)[0] + end for t in texts]
    return [ids + end for ids in _remembered(texts, table)]


def _whole(text: bytes, table: WordTable) -> bytes:
    ids = table.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


def _units(texts: list[bytes]):
    """Lower-case bytes, starts and ends of words and of the marks behind them, first unit of each text."""
    words = words_of(texts, SPACE_WORDS, lower=True)
    data, start, end = words.data, words.start, words.end
    core = end.copy()
    for _ in range(4):  # up to four marks are split off; with more the word stays whole
        core -= MARKS[data[core - 1]] & (core > start + 1)
    core[~PLAIN[data[core - 1]]] = 0
    marked = (core > 0) & (core < end)
    core[~marked] = end[~marked]
    units = 1 + marked
    place = np.cumsum(units) - units
    starts = np.empty(int(units.sum()), np.int64)
    ends = np.empty(len(starts), np.int64)
    starts[place], ends[place] = start, core
    starts[place[marked] + 1], ends[place[marked] + 1] = core[marked], end[marked]
    return data, starts, ends, np.append(place, len(starts))[words.first]


def _remembered(texts: list[bytes], table: WordTable) -> list[bytes]:
    data, start, end, first = _units(texts)
    hashes = range_hashes(data, start, end)
    hashes[hashes == 0] = 1
    # a stretch has no more words than an empty table takes; ids of units follow one another
    most = int(FULL * (1 << TABLE_BITS))
    packed, counts = [], [np.zeros(0, np.int64)]
    for at in range(0, len(hashes), most):
        part = slice(at, at + most)
        ids, lengths = _looked_up(data, start[part], end[part], hashes[part], table)
        packed.append(ids.astype("<u4").tobytes())
        counts.append(lengths)
    joined = b"".join(packed)
    stops = np.cumsum(np.concatenate(counts))
    bounds = (4 * np.concatenate(([0], stops))[first]).tolist()
    return [joined[a:b] for a, b in zip(bounds, bounds[1:])]


def _looked_up(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, table: WordTable):
    """The ids of units, and how many each has."""
    place = table.find(hashes)
    missing = np.flatnonzero(place < 0)
    if len(missing):
        if table.words + len(missing) > FULL * (1 << TABLE_BITS):
            table.clear()
            missing = np.arange(len(hashes))
        new, nth = np.unique(hashes[missing], return_index=True)
        at = missing[nth]
        table.add(new, [data[s:e].tobytes() for s, e in zip(start[at].tolist(), end[at].tolist())])
        place[missing] = table.find(hashes[missing])
    lengths = table.count[place].astype(np.int64)
    stops = np.cumsum(lengths)
    ids = table.ids[np.repeat(table.at[place].astype(np.int64) - stops + lengths, lengths) + np.arange(int(stops[-1]) if len(stops) else 0)]
    return ids, lengths
