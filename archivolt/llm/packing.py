"""Problem 8: documents packed into containers of fixed token capacity.

Method: bounded-space online packing. Documents are measured once in tokens of a public tokenizer; each packing profile
sees them as items, cut only where longer than a container. Every partition keeps a fixed number of open windows, places
each item where it leaves least room, and emits the fullest window when none fits; items arrive longest first. At last the
windows left clearly unfilled are packed again, as whole items, across partitions.

Defined cases: rows without a doc_id are left out; null and empty texts have no tokens and take no place; equal texts are separate items; a profile without a
positive capacity packs nothing; a document longer than the capacity fills whole containers, and its remainder is an item.
"""

from __future__ import annotations

import base64
import bisect
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.session import cut

#: Place and file of the tokenizer's ranks; both are parameters of the operator.
TOKENIZERS, RANKS = "/opt/tokenizers", "byte_bpe_multi_50k.tiktoken"
#: Open windows of a partition, items of a partition, share of a window below which it is packed again.
OPEN, PARTITION_ITEMS, FULL = 4096, 20_000, 0.98
#: A fixed small table; a larger one is refused.
MAX_PROFILES = 10_000
#: Characters handed to the tokenizer at once; a longer text is cut only where its pre-splitting ends a piece anyway.
STRETCH = 200_000
_SEAM = re.compile(r"(?<=[^\s]) (?=[^\W\d_])")
#: Fixed value: the pre-splitting pattern that belongs to these byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer whose ranks are in the file; loaded once in a Python worker."""
    import tiktoken

    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        token, rank = line.split()
        ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def stretches(text: str, limit: int = STRETCH) -> Iterator[str]:
    """The text in stretches of about limit characters, each cut before a single space between a sign and a letter, where the
    pattern always starts a new piece; so the tokens are those of the whole text. Without such a place a stretch is longer."""
    at = 0
    while len(text) - at > limit and (m := _SEAM.search(text, at + limit)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def _count(name: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(SparkFiles.get(name)).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [sum(len(encode(s)) for s in stretches(t)) for t in pdf["text"]]})

    return run


def token_counts(documents: DataFrame, tokenizers: str = TOKENIZERS, ranks: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens) of every document with a text. The ranks, a file of a megabyte, are sent to the executors once."""
    sc = documents.sparkSession.sparkContext
    if not os.path.exists(os.path.join(SparkFiles.getRootDirectory(), ranks)):
        sc.addFile(os.path.join(tokenizers, ranks))
    return documents.where("doc_id is not null and length(text) > 0").select("doc_id", "text").mapInPandas(_count(ranks), "doc_id long, n_tokens long")


class Windows:
    """Open windows ordered by room left; the fullest leaves when a new one would exceed the bound."""

    def __init__(self, capacity: int, bound: int):
        self.capacity, self.bound, self.rooms, self.held = capacity, bound, [], {}
        self.next = 0

    def place(self, item, size: int):
        """Put the item where it leaves least room; returns the (number, items, used) of a window pushed out, or None."""
        at = bisect.bisect_left(self.rooms, (size, -1))
        out = None
        if at < len(self.rooms):
            room, number = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.bound:
                out = self._take(*self.rooms.pop(0))
            room, number = self.capacity, self.next
            self.next += 1
            self.held[number] = []
        self.held[number].append(item)
        if room > size:
            bisect.insort(self.rooms, (room - size, number))
        elif out is None:
            out = self._take(0, number)
        else:
            bisect.insort(self.rooms, (0, number))
        return out

    def _take(self, room: int, number: int):
        return number, self.held.pop(number), self.capacity - room

    def rest(self):
        for room, number in self.rooms:
            yield self._take(room, number)
        self.rooms = []


_PLACED = "profile_id string, capacity long, container string, used long, doc_id long, part int, token_start long, n_tokens long"


def _pack(bound: int):
    """Pack each slot's items; rows of a slot follow one another, so only one slot's windows are open."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, windows = None, None
        rows: list[tuple] = []

        def emit(window):
            number, items, used = window
            rows.extend((key[0], key[1], f"{key[2]}-{number}", used, *item) for item in items)

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if key != (at := (r.profile_id, int(r.capacity), int(r.slot))):
                    for window in windows.rest() if windows else ():
                        emit(window)
                    key, windows = at, Windows(at[1], bound)
                if (out := windows.place((r.doc_id, r.part, r.token_start, r.n_tokens), int(r.n_tokens))) is not None:
                    emit(out)
            yield pd.DataFrame(rows, columns=_COLS)
            rows.clear()
        for window in windows.rest() if windows else ():
            emit(window)
        yield pd.DataFrame(rows, columns=_COLS)

    return run


_COLS = [c.split()[0] for c in _PLACED.split(", ")]


def _repack(bound: int):
    """Pack unfilled windows, as whole items, into merged ones; slot by slot as above."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, windows = None, None
        rows: list[tuple] = []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if key != (at := (r.profile_id, int(r.capacity), int(r.slot))):
                    rows += [(key[0], c, f"m{key[2]}-{n}") for n, items, _ in (windows.rest() if windows else ()) for c in items]
                    key, windows = at, Windows(at[1], bound)
                if (out := windows.place(r.container, int(r.used))) is not None:
                    rows += [(key[0], c, f"m{key[2]}-{out[0]}") for c in out[1]]
            yield pd.DataFrame(rows, columns=["profile_id", "container", "merged"])
            rows = []
        rows += [(key[0], c, f"m{key[2]}-{n}") for n, items, _ in (windows.rest() if windows else ()) for c in items]
        yield pd.DataFrame(rows, columns=["profile_id", "container", "merged"])

    return run


def _slots(df: DataFrame, key: str, size: str, per_slot: int) -> DataFrame:
    """Rows hashed to slots of about per_slot rows, each slot sorted by size, longest first, in one task."""
    n = df.count()
    slots = max(1, -(-n // per_slot))
    return (
        df.withColumn("slot", F.pmod(F.xxhash64(key), F.lit(slots)).cast("int"))
        .repartition(max(1, min(slots * 3, 2000)), "profile_id", "slot")
        .sortWithinPartitions("profile_id", "slot", F.desc(size), key)
    )


def pack(documents: DataFrame, profiles: DataFrame, tokenizers: str = TOKENIZERS, ranks: str = RANKS, open_windows: int = OPEN, partition_items: int = PARTITION_ITEMS) -> DataFrame:
    """(profile_id, container_id, doc_id, part, token_start, n_tokens, capacity): every document's place in each profile."""
    sizes = [(r.profile_id, int(r.capacity_tokens)) for r in profiles.where("purpose = 'packing' and capacity_tokens > 0").orderBy("profile_id").limit(MAX_PROFILES + 1).collect()]
    if len(sizes) > MAX_PROFILES:
        raise ValueError(f"more than {MAX_PROFILES} packing profiles")
    if not sizes:
        return documents.sparkSession.createDataFrame([], "profile_id string, container_id string, doc_id long, part int, token_start long, n_tokens long, capacity long")
    counts = cut(token_counts(documents, tokenizers, ranks))
    each = F.array(*[F.struct(F.lit(p).alias("profile_id"), F.lit(c).cast("long").alias("capacity")) for p, c in sizes])
    cuts = counts.select("doc_id", "n_tokens", F.explode(each).alias("p")).select("doc_id", "n_tokens", "p.*")
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / F.col("capacity")))).alias("part")
    items = (
        cuts.where("n_tokens > 0")
        .select("doc_id", "n_tokens", "profile_id", "capacity", start)
        .select("profile_id", "capacity", "doc_id", F.col("part").cast("int").alias("part"), (F.col("part") * F.col("capacity")).alias("token_start"), F.least(F.col("n_tokens") - F.col("part") * F.col("capacity"), F.col("capacity")).alias("n_tokens"))
    )
    placed = cut(_slots(items, "doc_id", "n_tokens", partition_items * len(sizes)).mapInPandas(_pack(open_windows), _PLACED))
    unfilled = placed.where(F.col("used") < F.col("capacity") * FULL).select("profile_id", "capacity", "container", "used").distinct()
    merged = _slots(unfilled, "container", "used", partition_items * len(sizes)).mapInPandas(_repack(open_windows), "profile_id string, container string, merged string")
    return placed.join(merged, ["profile_id", "container"], "left").select("profile_id", F.coalesce("merged", "container").alias("container_id"), "doc_id", "part", "token_start", "n_tokens", "capacity")


def fill(packed: DataFrame) -> DataFrame:
    """(profile_id, containers, tokens, unused_share): how much room the arrangement leaves."""
    used = packed.groupBy("profile_id", "container_id", "capacity").agg(F.sum("n_tokens").alias("used"))
    return used.groupBy("profile_id").agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.round(1 - F.sum("used") / F.sum("capacity"), 6).alias("unused_share"))
