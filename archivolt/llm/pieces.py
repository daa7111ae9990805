"""Problem 5: oversized chunks cut at natural boundaries.

Method: agglomerative merging. A text starts as atomic segments (sentences, table or plain lines; only where one of these
is itself too long: clauses, words, and at last fixed runs of characters). Adjacent pairs wait in a heap ordered by the
strength of the boundary between them, and the weakest boundary whose joined size plus overlap still fits is removed first.

Defined cases: a null text is no chunk to cut; an empty one is never oversized; an unknown or null chunker uses the default
profile; with null offsets the pieces' document offsets are null while their offsets in the chunk remain; an overlap not
below the limit is cut to limit - 1.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Boundary strengths, strongest last: between characters, words, clauses, sentences, lines, paragraphs.
CHAR, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH = range(6)
_LEVELS = (
    (PARAGRAPH, re.compile(r"\n[ \t\r]*\n\s*")),
    (LINE, re.compile(r"\n\s*")),
    (SENTENCE, re.compile(r"[.!?…]+[\"'»”’)\]]*\s+")),
    (CLAUSE, re.compile(r"[,;:–—]\s+")),
    (WORD, re.compile(r"\s+")),
)
#: A fixed small table; a larger one is refused.
MAX_PROFILES = 10_000
SCHEMA = "chunk_id string, document_id string, ordinal int, text string, piece_start long, piece_end long, start_char long, end_char long"


def _atoms(text: str, limit: int) -> tuple[list[int], list[int]]:
    """Cut points (with both ends) and the strength of each inner cut; no atom is longer than the limit."""
    cuts: dict[int, int] = {}
    for strength, pattern in _LEVELS[:3]:
        for m in pattern.finditer(text):
            if 0 < m.end() < len(text):
                cuts.setdefault(m.end(), strength)
    for strength, pattern in _LEVELS[3:]:
        points = [0, *sorted(cuts), len(text)]
        for a, b in zip(points, points[1:]):
            if b - a > limit:
                for m in pattern.finditer(text, a, b):
                    if a < m.end() < b:
                        cuts.setdefault(m.end(), strength)
    points = [0, *sorted(cuts), len(text)]
    for a, b in zip(points, points[1:]):
        for c in range(a + limit, b, limit):
            cuts[c] = CHAR
    points = [0, *sorted(cuts), len(text)]
    return points, [cuts[p] for p in points[1:-1]]


def cut_text(text: str, max_chars: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of each piece, overlap included: pieces cover the text, each at most max_chars, neighbours sharing overlap."""
    if len(text) <= max_chars:
        return [(0, len(text))]
    overlap = max(0, min(overlap, max_chars - 1))
    room = max_chars - overlap
    points, strengths = _atoms(text, room)
    n = len(points) - 1
    start, end = points[:-1], points[1:]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(s, end[i + 1] - start[i], i, i + 1, end[i + 1]) for i, s in enumerate(strengths)]
    heapq.heapify(heap)
    while heap:
        strength, length, i, j, e = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j] and right[i] == j and end[j] == e and e - start[i] == length) or length > room:
            continue
        end[i], alive[j], right[i] = end[j], False, right[j]
        if right[j] < n:
            left[right[j]] = i
            k = right[i]
            heapq.heappush(heap, (strengths[k - 1], end[k] - start[i], i, k, end[k]))
        if left[i] >= 0:
            h = left[i]
            heapq.heappush(heap, (strengths[i - 1], end[i] - start[h], h, i, end[i]))
    spans = [(start[i], end[i]) for i in range(n) if alive[i]]
    return [(max(0, a - overlap), b) for a, b in spans]


def _cut_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            base = None if pd.isna(r.start_char) else int(r.start_char)
            for k, (a, b) in enumerate(cut_text(r.text, int(r.max_chars), int(r.overlap_chars))):
                rows.append((r.chunk_id, r.document_id, k, r.text[a:b], a, b, None if base is None else base + a, None if base is None else base + b))
            if len(rows) >= 2000:
                yield pd.DataFrame(rows, columns=_COLS).astype(_TYPES)
                rows = []
        yield pd.DataFrame(rows, columns=_COLS).astype(_TYPES)


_COLS = [c.split()[0] for c in SCHEMA.split(", ")]
_TYPES = {"ordinal": "int32", "piece_start": "int64", "piece_end": "int64", "start_char": "Int64", "end_char": "Int64"}


def oversized(chunks: DataFrame, profiles: DataFrame) -> DataFrame:
    """Chunks longer, in code points, than their profile allows. The filter runs in the JVM, before any Python.

    The profiles, a fixed table, become a map; a null or unknown chunker takes the default. Too many are refused."""
    rows = profiles.select("chunker_id", "max_chars", "overlap_chars", "is_default").where("max_chars is not null").orderBy("chunker_id").limit(MAX_PROFILES + 1).collect()
    if len(rows) > MAX_PROFILES:
        raise ValueError(f"more than {MAX_PROFILES} chunk profiles")
    default = next((r for r in rows if r.is_default), None)

    limits = {r.chunker_id: r for r in reversed(rows) if r.chunker_id is not None}

    def pick(field: str):
        own = F.lit(None if default is None else default[field]).cast("long")
        if not limits:
            return own
        known = F.create_map(*[F.lit(x) if isinstance(x, str) else F.lit(x[field]).cast("long") for kv in sorted(limits.items()) for x in kv])
        return F.when(F.col("chunker_id").isin(*limits), known[F.col("chunker_id")]).otherwise(own)

    return (
        chunks.select("chunk_id", "document_id", "text", "start_char", pick("max_chars").alias("max_chars"), F.coalesce(pick("overlap_chars"), F.lit(0)).alias("overlap_chars"))
        .where(F.length("text") > F.col("max_chars"))
    )


def pieces(chunks: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pieces of the oversized chunks. Profiles are a fixed table of a few rows, hence its broadcast."""
    return oversized(chunks, profiles).mapInPandas(_cut_batches, SCHEMA)


def found(chunks: DataFrame, profiles: DataFrame) -> DataFrame:
    """The chunks that were cut: those with a first piece."""
    return pieces(chunks, profiles).where("ordinal = 0 and chunk_id is not null").select("chunk_id")
