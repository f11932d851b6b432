"""Token ids of whole texts from a public byte-level BPE file, with a per-worker cache of word codes.

The vocabulary splits a text into words before any merge, so a text's ids are its words' ids in order. Words
repeat: a block of texts is split and its words are numbered with array operations, and only words that the
worker hasn't met go to the tokenizer library. Texts with characters outside U+0000 to U+00FF, where the split
could differ, go to the library whole. The ids are the library's own in every case.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd

_PLAIN = re.compile("[\t\n\r -~¡-ÿ]*")
#: Between a visible character and a space with a letter, a word always ends.
_SAFE_CUT = re.compile(r"(?<=\S)(?= [A-Za-z])")
_SPECIAL = "<|endoftext|>"

#: Classes of the plain characters; 0 parts texts.
_END, _SPACE, _LETTER, _DIGIT, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[0] = _END
_CLASS[[9, 10, 13, 32]] = _SPACE
for _c in range(33, 256):
    if chr(_c).isalpha():
        _CLASS[_c] = _LETTER
    elif chr(_c).isnumeric():
        _CLASS[_c] = _DIGIT

_BLOCK_CHARS = 1_500_000
_CACHED_WORDS = 200_000  # in each of two generations

#: Word hashes are sums of random values times powers of an odd number, modulo 2**64; they only number the
#: words of one block, and words are kept by their characters.
_VALUES = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def _word_starts(raw: np.ndarray) -> np.ndarray:
    """Where the words of the byte-level split begin in Latin-1 characters, of which 0 ends a text.

    A word is a run of letters, digits or other signs with one space before it, or a run of white space
    without the character that a word follows. An apostrophe at the start of a word takes s, t, d, m, re, ve
    or ll with it.
    """
    kind = _CLASS[raw]
    space = kind == _SPACE
    visible = kind >= _LETTER
    start = np.empty(raw.size, bool)
    start[0] = True
    start[1:] = np.where(space[1:], ~space[:-1], (kind[1:] != kind[:-1]) & (raw[:-1] != 32))
    start[:-1] |= space[:-1] & visible[1:]
    ends = kind == _END
    start |= ends
    start[1:] |= ends[:-1]
    quote = np.flatnonzero(raw == 39)
    if quote.size:
        quote = quote[start[quote] & (kind[np.minimum(quote + 1, raw.size - 1)] == _LETTER)]
        a, b = raw[quote + 1], raw[np.minimum(quote + 2, raw.size - 1)]
        two = ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)
        one = np.isin(a, (115, 116, 100, 109)) & ~two
        start[quote[one | two] + 1] = False
        after = np.concatenate((quote[one] + 2, quote[two] + 3))
        after = after[after < raw.size]
        start[after[kind[after] == _LETTER]] = True
    return np.flatnonzero(start)


class WordCachedEncoder:
    """encode(texts) -> little-endian uint32 ids of each text as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._width = np.zeros(size, np.int64)
        for token, i in self._tokenizer.get_vocab(with_added_tokens=True).items():
            self._width[i] = len(token)  # one character stands for one byte
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._up = _powers(_BASE, 1 << 16)
        self._down = _powers(pow(_BASE, -1, 1 << 64), 1 << 16)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        block: list[str] = []
        chars = 0
        for text in texts:
            if block and chars + len(text) > _BLOCK_CHARS:
                out += self._encode(block)
                block, chars = [], 0
            block.append(text)
            chars += len(text)
        return out + self._encode(block) if block else out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(texts) == 1 and len(texts[0]) > 2 * _BLOCK_CHARS:
            return [b"".join(self._encode([part])[0] for part in _parts(texts[0]))]
        plain = [_PLAIN.fullmatch(t) is not None and _SPECIAL not in t for t in texts]
        quick = iter(self._split_and_join([t for t, p in zip(texts, plain) if p]))
        others = iter(self._library([t for t, p in zip(texts, plain) if not p]))
        return [next(quick) if p else next(others) for p in plain]

    def _split_and_join(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        chars = ("\0".join(texts) + "\0").encode("latin-1")
        raw = np.frombuffer(chars, np.uint8)
        starts = _word_starts(raw)
        stops = np.append(starts[1:], raw.size)
        if self._up.size < raw.size:
            self._up, self._down = _powers(_BASE, raw.size), _powers(pow(_BASE, -1, 1 << 64), raw.size)
        sums = np.zeros(raw.size + 1, np.uint64)
        np.cumsum(_VALUES[raw] * self._up[: raw.size], out=sums[1:])
        hashes = (sums[stops] - sums[starts]) * self._down[starts]
        number, unique = pd.factorize(hashes)
        first = np.empty(len(unique), np.int64)
        first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
        words = [chars[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist())]
        codes = self._codes(words)
        pool = np.frombuffer(b"".join(codes), "<u4")
        size = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        at = np.cumsum(size) - size
        sizes = size[number]
        ends = np.cumsum(sizes)
        ids = pool[np.repeat(at[number] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        marks = (4 * ends[raw[starts] == 0]).tolist()
        return [ids[a:b] for a, b in zip([0, *marks], marks)]

    def _codes(self, words: list[bytes]) -> list[bytes]:
        young, old = self._young, self._old
        codes = list(map(young.get, words))
        missing = [i for i, c in enumerate(codes) if c is None]
        new = []
        for i in missing:
            c = old.get(words[i])
            if c is None:
                new.append(i)
            else:
                codes[i] = young[words[i]] = c
        if new:
            for i, c in zip(new, self._learn([words[i] for i in new])):
                codes[i] = young[words[i]] = c
        if len(young) > _CACHED_WORDS:
            self._young, self._old = {}, young
        return codes

    def _library(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        return [np.asarray(e.ids, "<u4").tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Codes of new words: those of letters are encoded joined, and cut again by the bytes of their tokens."""
        texts = [w.decode("latin-1") for w in words]
        out: list[bytes | None] = [b"" if t == "\0" else None for t in texts]
        joined = [i for i, t in enumerate(texts) if (t[1:] if t[0] == " " else t).isalpha()]
        alone = [i for i in set(range(len(texts))) - set(joined) if out[i] is None]
        for i, c in zip(alone, self._library([texts[i] for i in alone])):
            out[i] = c
        for k in range(0, len(joined), 256):
            part = joined[k : k + 256]
            parted = [texts[i] if texts[i][0] == " " else "\n" + texts[i] for i in part]  # a line end never merges with letters
            raw = self._library(["".join(parted)])[0]
            ends = np.cumsum(self._width[np.frombuffer(raw, "<u4")])
            after = np.cumsum([len(w.encode()) for w in parted])
            stops = np.searchsorted(ends, after) + 1
            starts = np.concatenate(([0], stops[:-1])) + [w[0] == "\n" for w in parted]
            for i, a, b in zip(part, (4 * starts).tolist(), (4 * stops).tolist()):
                out[i] = raw[a:b]
        return out


def _parts(text: str):
    start = 0
    while len(text) - start > _BLOCK_CHARS:
        cut = _SAFE_CUT.search(text, start + _BLOCK_CHARS)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


_encoders: dict[str, WordCachedEncoder] = {}


def encoder(path: str) -> WordCachedEncoder:
    """The worker's encoder for this vocabulary file, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordCachedEncoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
