"""Byte-level BPE ids by the tokenizers library, each distinct word encoded once per worker.

The library's pre-tokenizer cuts a text into words that are encoded one by one. Here the cuts
are found over whole batches with arrays, words are told apart by a 64-bit hash, and only words
not met before go to the library. Texts that hold an added token's string go there whole.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablewright.llm.base import segments, utf8, word_hashes

#: Words kept per worker process (about 40 bytes each); the cache starts anew beyond it.
CACHE_WORDS = 500_000

OTHER, LETTER, NUMBER, BLANK, WHITE = range(5)


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, the space, other white space, or none of these."""
    kinds = np.zeros(sys.maxunicode + 1, np.uint8)
    for code in range(sys.maxunicode + 1):
        first = unicodedata.category(chr(code))[0]
        if first in "LN":
            kinds[code] = LETTER if first == "L" else NUMBER
    kinds[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
    kinds[32] = BLANK
    return kinds


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8 bytes, and the place of each one's first byte."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    codes = data[at].astype(np.uint32)
    wide = np.flatnonzero(codes >= 0xC0)
    if len(wide):
        lead, place = codes[wide], at[wide]
        code = lead & np.where(lead >= 0xF0, 0x07, np.where(lead >= 0xE0, 0x0F, 0x1F))
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            more = np.flatnonzero(lead >= least)
            code[more] = (code[more] << 6) | (data[place[more] + k] & 0x3F)
        codes[wide] = code
    return codes, at


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the words that the byte-level pre-tokenizer makes, rows apart.

    Its pattern: contractions; runs of letters, of numbers, or of anything else but white space,
    each with one space before it; white space up to the last one before a word.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    codes, at = code_points(data)
    kinds = char_classes()[codes]
    n = len(codes)
    row_start = np.zeros(n + 1, bool)
    row_start[np.searchsorted(at, offsets)] = True
    white = kinds >= BLANK
    runs = np.where(white, BLANK, kinds)
    change = np.ones(n, bool)
    change[1:] = runs[1:] != runs[:-1]
    change |= row_start[:n]
    begin = change.copy()
    # The last white space of a run, if a word follows, stands alone or joins that word.
    last = np.zeros(n, bool)
    last[:-1] = white[:-1] & change[1:] & ~row_start[1:n]
    begin |= last
    joined = np.flatnonzero(last & (kinds == BLANK)) + 1
    begin[joined] = False
    # Contractions, where a word may start at the apostrophe.
    quote = np.flatnonzero((codes == 39) & begin)
    if len(quote):
        padded = np.concatenate([codes, np.zeros(3, np.uint32)])
        one, two = padded[quote + 1], padded[quote + 2]
        same1 = ~row_start[np.minimum(quote + 1, n)]
        same2 = same1 & ~row_start[np.minimum(quote + 2, n)]
        short = same1 & np.isin(one, [ord(c) for c in "stmd"])
        long = same2 & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
                        | ((one == ord("l")) & (two == ord("l"))))
        begin[quote[short] + 1] = False
        begin[quote[long] + 1] = False
        ends = np.concatenate([quote[short] + 2, quote[long] + 3])
        begin[ends[ends < n]] = True
    return at[begin]


class WordCache:
    """Values (runs of ids) of byte words, found by hash; ``encode`` is asked for new words only."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 limit: int = CACHE_WORDS) -> None:
        self._encode, self._limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._starts = np.zeros(0, np.int64)
        self._counts = np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.int32)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin in ``flat``, and how many there are."""
        if len(self._keys) > self._limit:
            self._clear()
        unique, first, back = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        rows = np.searchsorted(self._keys, unique)
        known = np.zeros(len(unique), bool)
        inside = rows < len(self._keys)
        known[inside] = self._keys[rows[inside]] == unique[inside]
        new = np.flatnonzero(~known)
        if len(new):
            text = data.tobytes()
            flat, counts = self._encode([text[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            at = rows[new]
            self._keys = np.insert(self._keys, at, unique[new])
            self._starts = np.insert(self._starts, at, len(self._flat) + np.cumsum(counts) - counts)
            self._counts = np.insert(self._counts, at, counts)
            self._flat = np.concatenate([self._flat, flat])
            rows = np.searchsorted(self._keys, unique)
        return self._starts[rows][back], self._counts[rows][back]

    def gather(self, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self._flat[np.repeat(starts, counts) + segments(counts)]


class WordTokenizer:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self._library = Tokenizer.from_file(path)
        self._added = [t.content for t in self._library.get_added_tokens_decoder().values()]
        # Byte-level pieces: one character of a piece stands for one byte.
        vocabulary = self._library.get_vocab(with_added_tokens=False)
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self._bytes[list(vocabulary.values())] = [len(p) for p in vocabulary]
        self._cache = WordCache(self._encode_words)

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word: letter words in one text, a line each, the others by themselves."""
        texts = [w.decode("utf-8") for w in words]
        plain = [i for i, t in enumerate(texts) if t.lstrip(" ").isalpha()]
        alone = sorted(set(range(len(texts))).difference(plain))
        results: list = [None] * len(texts)
        blocks = [plain[i:i + 2000] for i in range(0, len(plain), 2000)]
        encodings = self._library.encode_batch_fast(["\n".join(texts[i] for i in b) for b in blocks], add_special_tokens=False)
        for block, encoding in zip(blocks, encodings):
            ids = np.array(encoding.ids, np.int32)
            ends = np.cumsum([len(words[i]) + 1 for i in block])
            cuts = np.searchsorted(np.cumsum(self._bytes[ids]), ends - 1) + 1
            begin = 0
            for i, end in zip(block, cuts.tolist()):
                results[i] = ids[begin:end]
                begin = end + 1  # the line end is one id
        for i, e in zip(alone, self._library.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)):
            results[i] = np.array(e.ids, np.int32)
        counts = np.fromiter(map(len, results), np.int64, len(results))
        return np.concatenate(results) if results else np.zeros(0, np.int32), counts

    def _words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = utf8(column)
        starts = word_starts(data, offsets)
        ends = np.append(starts[1:], len(data))[:len(starts)]
        at, counts = self._cache.find(data, starts, ends)
        total = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets)]
        return at, counts, np.diff(total)

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of ids of every text, added tokens' strings read as ordinary text."""
        return self._words(column)[2]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every text (flat) and how many each has, as the library gives them."""
        if column.null_count:
            column = column.fill_null("")
        whole = {}
        for added in self._added:
            for i in np.flatnonzero(pc.match_substring(column, added)):
                whole[int(i)] = self._library.encode(column[int(i)].as_py(), add_special_tokens=False).ids
        at, counts, lengths = self._words(column)
        flat = self._cache.gather(at, counts)
        if whole:
            parts = np.split(flat, np.cumsum(lengths)[:-1])
            for i, ids in whole.items():
                parts[i], lengths[i] = np.array(ids, np.int32), len(ids)
            flat = np.concatenate(parts)
        return flat, lengths


_KEPT: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary file."""
    if path not in _KEPT:
        _KEPT[path] = WordTokenizer(path)
    return _KEPT[path]
