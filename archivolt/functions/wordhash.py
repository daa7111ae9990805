"""Words of whole batches of texts as 64-bit hashes, without a Python loop over words."""

from __future__ import annotations

import numpy as np

from archivolt.functions import codepoints

_LONGEST = 64


def _fold() -> np.ndarray:
    """Code point -> its small letter plus one, 0 where no letter or digit."""
    t = np.zeros(codepoints.TABLE_SIZE, np.uint64)
    for k in range(codepoints.TABLE_SIZE):
        c = chr(k)
        if c.isalnum():
            t[k] = ord(c.lower()[0]) + 1
    return t


_FOLD = _fold()
#: Scripts written without spaces: Chinese characters and Japanese syllables are words of their own.
_ALONE = np.zeros(codepoints.TABLE_SIZE, bool)
for _a, _b in ((0x2E80, 0x2FE0), (0x3040, 0x3100), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0x20000, 0x32000)):
    _ALONE[_a:_b] = True
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(_LONGEST)], np.uint64)


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of the text, start, end) of every run of letters and digits, and of every sign of scripts without spaces.

    Case is folded.
    Letters beyond the 64th of a word weigh alike, so only such words could be confused."""
    cp, begin = codepoints.join(texts)
    f = _FOLD[cp]
    letter = f > 0
    if cp.max(initial=0) >= 0x2E80:
        alone = _ALONE[cp]
        joined = np.append(letter[1:] & ~alone[1:] & ~alone[:-1], False)  # whether the next sign goes on with the word
    else:
        joined = np.append(letter[1:], False)
    start = np.flatnonzero(letter & ~np.append(False, letter[:-1] & joined[:-1]))
    end = np.flatnonzero(letter & ~joined) + 1
    if not len(start):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    length = end - start
    first = np.cumsum(length) - length
    at = np.flatnonzero(letter)
    place = np.minimum(np.arange(len(at)) - np.repeat(first, length), _LONGEST - 1)
    h = np.add.reduceat(f[at] * _POWERS[place], first)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    owner = np.searchsorted(begin, start, side="right") - 1
    return h, owner, start - begin[owner], end - begin[owner]
