"""Whole batches of texts as arrays of code points, so that numpy can work on them without a loop over characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: An entry for every code point.
TABLE_SIZE = 0x110000


def slices(texts: list[str | None], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of texts of about limit characters together; a longer text stands alone. None counts as empty."""
    lo, size = 0, 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield lo, k
            lo, size = k, 0
        size += n + 1
    if lo < len(texts):
        yield lo, len(texts)


def join(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, start of each text): the texts one after another, a 0 after each."""
    body = "\0".join([*((t or "").replace("\0", " ") for t in texts), ""])
    cp = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts)) + 1
    return cp.view(np.int32), np.cumsum(lengths) - lengths


def lookup(**classes: str) -> dict[str, np.ndarray]:
    """Boolean tables over code points, one for each named class of characters."""
    out = {}
    for name, chars in classes.items():
        t = np.zeros(TABLE_SIZE, bool)
        t[[ord(c) for c in chars]] = True
        out[name] = t
    return out
