"""Problem 9: evaluation passages inside the corpus.

Method: latent semantic retrieval. Texts become overlapping passages of TF-IDF weighted words (document frequencies over all
documents, words hashed to buckets). A randomised SVD, by distributed power iteration, gives the latent axes; passages and
the passages of the items meet by cosine in that space. A candidate pair is kept if it shares enough rare words, and proved
by the longest common subsequence of words around it: the longest dense run of the item must cover a third of its words.

Bounds: the axes are fitted on a bounded sample of passages, drawn by hash; every passage of every document is searched.
Items are a fixed small table. Their passages are dealt to cells of the latent space; by the triangle inequality of angles a
passage skips every cell whose members must all lie beyond the least cosine, so no candidate is lost.

Defined cases: rows without a doc_id are left out; null texts match nothing; an item without words matches nothing; items shorter than a passage are one passage;
repeated documents are found alike; words split by a line break count as differing words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.functions import codepoints, wordhash
from archivolt.session import cut

#: Buckets of hashed words, latent axes, words of half a passage, rounds of the SVD, and the bound of its sample of passages.
BUCKETS, AXES, HALF, ROUNDS, SAMPLE = 1 << 15, 64, 16, 3, 40_000
#: Least cosine of a candidate; a word is rare if at most this share of documents holds it; least rare words in common.
COSINE, RARE_SHARE, RARE_COMMON = 0.6, 0.04, 3
#: A run must cover this share of the item; between matches a differing word costs MISS, each further word of the page in between SKIP.
SHARE, MISS, SKIP = 1 / 3, 3.0, 0.15
SEED = 7
_SIGNATURE = 8  # words of 64 bits


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(33)) % np.uint64(BUCKETS)).astype(np.int64)


def _halves(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of HALF words that don't cross texts, and the text of each."""
    n = len(owner)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    size = np.diff(np.append(first, n))
    place = np.arange(n) - np.repeat(first, size)
    starts = np.flatnonzero(place % HALF == 0)
    return starts, owner[starts]


def _df(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df, n, passages = np.zeros(BUCKETS, np.int64), 0, 0
    for pdf in batches:
        texts = pdf["text"].tolist()
        for lo, hi in codepoints.slices(texts):
            h, owner, _, _ = wordhash.words(texts[lo:hi])
            df += np.bincount(np.unique(owner * BUCKETS + _bucket(h)) % BUCKETS, minlength=BUCKETS)
            n += hi - lo
            passages += len(_halves(owner)[0])
    seen = np.flatnonzero(df)
    yield pd.DataFrame({"bucket": np.append(seen, [-1, -2]), "n": np.append(df[seen], [n, passages])})


def frequencies(documents: DataFrame) -> tuple[np.ndarray, int, int]:
    """Document frequency of each bucket, the number of documents and of passages, over all of them: BUCKETS numbers reach the driver."""
    rows = documents.where("length(text) > 0").select("text").mapInPandas(_df, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, size = np.zeros(BUCKETS, np.int64), {-1: 0, -2: 0}
    for r in rows:
        if r.bucket < 0:
            size[r.bucket] = r.n
        else:
            df[r.bucket] = r.n
    return df, size[-1], size[-2]


def _passages(share: float):
    """Passages, each drawn by a hash of its words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for lo, hi in codepoints.slices(texts):
                h, owner, _, _ = wordhash.words(texts[lo:hi])
                if not len(h):
                    continue
                starts, _ = _halves(owner)
                draw = (np.add.reduceat(h, starts) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(34)
                parts = np.split(_bucket(h).astype(np.int32), starts[1:])
                yield pd.DataFrame({"words": [parts[k].tobytes() for k in np.flatnonzero(draw < share * (1 << 30))]})

    return run


def _power(shared):
    """A^T A G of one partition's passages: gather the rows of G, add them up, scatter them back."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g, idf = shared.value
        out = np.zeros((BUCKETS, g.shape[1]), np.float32)
        weighted = g * idf[:, None]
        for pdf in batches:
            for lo in range(0, len(pdf), 4000):
                parts = [np.frombuffer(x, np.int32) for x in pdf["words"].iloc[lo : lo + 4000]]
                parts = [p for p in parts if len(p)]
                if not parts:
                    continue
                w = np.concatenate(parts)
                size = np.array([len(p) for p in parts])
                y = np.add.reduceat(weighted[w], np.cumsum(size) - size, axis=0)
                row = np.repeat(np.arange(len(parts)), size)
                order = np.argsort(w, kind="stable")
                first = np.flatnonzero(np.diff(w[order], prepend=-1))
                out[w[order][first]] += np.add.reduceat(y[row[order]], first, axis=0)
        yield pd.DataFrame({"z": [(out * idf[:, None]).tobytes()]})

    return run


def axes(documents: DataFrame, df: np.ndarray, n: int, total: int, k: int = AXES, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(idf, right singular vectors: buckets x k) of the TF-IDF passages, from a bounded sample of them."""
    idf = np.log((n + 1) / (df + 1)).astype(np.float32)
    # documents are drawn at four times the share, and of their passages a quarter: neither one long text nor one copied often decides
    share = min(1.0, sample / max(1, total))
    wide = min(1.0, 4 * share)
    drawn = documents.where((F.length("text") > 0) & (F.pmod(F.xxhash64("doc_id", "document_id"), F.lit(1 << 30)) < F.lit(int(wide * (1 << 30)) + 1)))
    passages = cut(drawn.select("text").mapInPandas(_passages(share / wide), "words binary").where(F.length("words") > 0).repartition(4))
    sc = documents.sparkSession.sparkContext
    g = np.linalg.qr(np.random.default_rng(SEED).normal(size=(BUCKETS, k + 8)).astype(np.float32))[0]
    for _ in range(ROUNDS):
        shared = sc.broadcast((g, idf))
        z = np.zeros(g.shape, np.float32)
        for r in passages.mapInPandas(_power(shared), "z binary").toLocalIterator():  # one matrix a partition, four partitions
            z += np.frombuffer(r.z, np.float32).reshape(g.shape)
        small = g.T @ z
        g, _ = np.linalg.qr(z)
        shared.unpersist()
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return idf, (g @ turn[:, ::-1])[:, :k].astype(np.float32) if len(values) else g[:, :k]


class Matcher:
    """The items prepared for the search; lives in every Python worker."""

    def __init__(self, items: list[tuple[str, str]], idf: np.ndarray, v: np.ndarray, df: np.ndarray, n: int):
        self.ids = [i for i, _ in items]
        self.m = np.ascontiguousarray(v * idf[:, None], dtype=np.float32)
        self.rare = df <= max(2, RARE_SHARE * n)
        h, owner, start, end = wordhash.words([t for _, t in items])
        self.words = [h[owner == k] for k in range(len(items))]
        self.texts = [[t[a:b].lower() for a, b in zip(start[owner == k], end[owner == k])] for k, (_, t) in enumerate(items)]
        self.query, self.query_item, self.query_at, self.query_bits = self.embed(h, owner)
        self.cells = self._cells(self.query)

    @staticmethod
    def _cells(query: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(centres, least cosine with the centre that a passage needs, members) of about as many cells as each has members."""
        count = int(np.sqrt(len(query)))
        if count < 2:
            return np.zeros((1, query.shape[1]), np.float32), np.array([-2.0], np.float32), [np.arange(len(query))]
        centre = query[np.random.default_rng(SEED).choice(len(query), count, replace=False)].copy()
        for _ in range(8):
            near = (query @ centre.T).argmax(1)
            for c in range(count):
                if (near == c).any():
                    centre[c] = query[near == c].sum(0)
                    centre[c] /= np.linalg.norm(centre[c]) + 1e-9
        near = (query @ centre.T).argmax(1)
        members = [np.flatnonzero(near == c) for c in range(count)]
        wide = np.array([np.arccos(np.clip((query[m] @ centre[c]).min(initial=1.0), -1, 1)) for c, m in enumerate(members)])
        return centre, np.cos(np.minimum(np.pi, wide + np.arccos(COSINE))).astype(np.float32) - 1e-4, members

    def _near(self, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item passage, cosine) of all pairs above the least cosine."""
        centre, need, members = self.cells
        reach = vec @ centre.T >= need
        p, q, c = [], [], []
        for k, m in enumerate(members):
            rows = np.flatnonzero(reach[:, k])
            if len(rows) and len(m):
                cos = vec[rows] @ self.query[m].T
                i, j = np.nonzero(cos > COSINE)
                p.append(rows[i])
                q.append(m[j])
                c.append(cos[i, j])
        none = np.zeros(0, np.int64)
        return (np.concatenate(p), np.concatenate(q), np.concatenate(c)) if p else (none, none, np.zeros(0, np.float32))

    def embed(self, h: np.ndarray, owner: np.ndarray):
        """Unit vectors of passages of two halves, their text and first word, and the bits of their rare words."""
        b = _bucket(h)
        starts, text = _halves(owner)
        if not len(starts):
            return np.zeros((0, self.m.shape[1]), np.float32), text, starts, np.zeros((0, _SIGNATURE), np.uint64)
        half = np.empty((len(starts), self.m.shape[1]), np.float32)
        step = 4096
        for lo in range(0, len(starts), step):
            s = starts[lo : lo + step]
            e = starts[lo + step] if lo + step < len(starts) else len(b)
            half[lo : lo + step] = np.add.reduceat(self.m[b[s[0] : e]], s - s[0], axis=0)
        bit = (h >> np.uint64(11)) % np.uint64(64 * _SIGNATURE)
        rare = self.rare[b]
        bits = np.zeros((len(starts), _SIGNATURE), np.uint64)
        which = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(b))))
        np.bitwise_or.at(bits, (which[rare], (bit[rare] // np.uint64(64)).astype(np.int64)), np.uint64(1) << (bit[rare] % np.uint64(64)))
        joined = np.append(text[1:] == text[:-1], False)
        vec = half.copy()
        vec[joined] += half[1:][joined[:-1]]
        both = bits.copy()
        both[joined] |= bits[1:][joined[:-1]]
        # a lone last half is covered by the passage before it
        keep = joined | ~np.append(False, joined[:-1])
        vec /= np.linalg.norm(vec, axis=1, keepdims=True) + 1e-9
        return vec[keep], text[keep], starts[keep], both[keep]

    def search(self, texts: list[str]) -> list[tuple[int, int, float, float, int, int]]:
        """(text, item, share of the item, cosine, first char, last char) of every leak in the texts."""
        h, owner, start, end = wordhash.words(texts)
        vec, text, at, bits = self.embed(h, owner)
        first_word = np.searchsorted(owner, np.arange(len(texts)))
        best: dict[tuple[int, int], list] = {}
        for lo in range(0, len(vec), 8192):
            p, q, cos = self._near(vec[lo : lo + 8192])
            if not len(p):
                continue
            common = np.zeros(len(p), np.int64)
            for w in range(_SIGNATURE):
                common += np.bitwise_count(bits[lo + p, w] & self.query_bits[q, w])
            fine = common >= RARE_COMMON
            for x, y, c in zip((p[fine] + lo).tolist(), q[fine].tolist(), cos[fine].tolist()):
                best.setdefault((int(text[x]), int(self.query_item[y])), []).append((x, c))
        out = []
        for (t, item), hits in best.items():
            f, last = int(first_word[t]), int(np.searchsorted(owner, t, side="right"))
            top = max(c for _, c in hits)
            found = self._prove(h[f:last], item, sorted({int(at[x]) - f for x, _ in hits}), (texts[t], start[f:last], end[f:last]))
            if found is not None:
                share, a, b = found
                out.append((t, item, share, top, int(start[f + a]), int(end[f + b])))
        return out

    def _prove(self, doc: np.ndarray, item: int, places: list[int], source) -> tuple[float, int, int] | None:
        """The longest dense run of the item's words around any of the candidate places, if it covers SHARE of the item."""
        words = self.words[item]
        best = None
        done_to = -1
        for place in places:
            if place <= done_to:
                continue
            lo, hi = max(0, place - len(words)), min(len(doc), place + 2 * HALF + len(words))
            region = doc[lo:hi]
            found = self._run(region, words, item, source, lo)
            if found is not None and (best is None or found[0] > best[0]):
                best = found
                if best[0] >= 0.95:
                    break
            done_to = place + 2 * HALF  # the region reaches a whole item further
        return best if best is not None and best[0] >= SHARE - 1e-9 else None

    def _run(self, region: np.ndarray, words: np.ndarray, item: int, source, lo: int) -> tuple[float, int, int] | None:
        equal = words[:, None] == region[None, :]
        exact = self._longest(equal, lo)
        # damaged words are worth a look only where intact ones already make a start
        if exact is None or exact[0] >= SHARE or exact[3] < max(6, 0.3 * SHARE * len(words)):
            return exact and exact[:3]
        found = self._longest(equal | self._alike(equal, item, source, lo), lo)
        return found and found[:3]

    @staticmethod
    def _longest(equal: np.ndarray, lo: int) -> tuple[float, int, int, float] | None:
        """(share of the item, first and last word, score) of the best run along a longest common subsequence."""
        n, m = equal.shape
        # longest common subsequence, a row of the table at a time: bit j of a row is set where its length grows at column j
        full = (1 << m) - 1
        grows, v = [0], full
        bits, wide = np.packbits(equal, axis=1, bitorder="little").tobytes(), (m + 7) // 8
        for at in range(0, len(bits), wide or 1):
            u = v & int.from_bytes(bits[at : at + wide], "little")
            v = ((v + u) | (v - u)) & full
            grows.append(v ^ full)
        i, size, pairs = n, grows[-1].bit_count(), []
        while size:
            if (grows[i - 1] & full).bit_count() == size:
                i -= 1
                continue
            j = (grows[i] & full).bit_length() - 1
            i, full, size = i - 1, (1 << j) - 1, size - 1
            pairs.append((i, j))
        pairs.reverse()
        # the best run of matches: each counts one, words missed in the item and far jumps in the document cost
        best, score, begin = (0.0, 0, 0), 0.0, 0
        before = pairs[0] if pairs else None
        for k, (i, j) in enumerate(pairs):
            missed, extra = i - before[0] - 1, j - before[1] - 1
            before = i, j
            if missed > 0 or extra > 0:
                score -= MISS * max(missed, min(extra, 1)) + SKIP * max(0, extra - missed - 1)
                if score < 0:
                    score, begin = 0.0, k
            score += 1
            if score > best[0]:
                best = (score, begin, k)
        if not pairs:
            return None
        a, b = pairs[best[1]], pairs[best[2]]
        return (b[0] - a[0] + 1) / n, lo + a[1], lo + b[1], best[0]

    def _alike(self, equal: np.ndarray, item: int, source, lo: int) -> np.ndarray:
        """Words that differ by a character or two, only where their neighbours on the diagonal match."""
        text, start, end = source
        near = np.zeros_like(equal)
        near[1:, 1:] |= equal[:-1, :-1]
        near[:-1, :-1] |= equal[1:, 1:]
        near &= ~equal
        own = self.texts[item]
        for i, j in zip(*np.nonzero(near)):
            a, b = own[i], text[start[lo + j] : end[lo + j]].lower()
            if len(a) > 3 and abs(len(a) - len(b)) <= 2 and (a[:2] == b[:2] or a[-2:] == b[-2:]):
                near[i, j] = _distance_at_most(a, b, 1 if len(a) < 6 else 2)
            else:
                near[i, j] = False
        return near


def _distance_at_most(a: str, b: str, limit: int) -> bool:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
        if min(row) > limit:
            return False
    return row[-1] <= limit


_OUT = "doc_id long, document_id string, evaluation_item_id string, covered double, cosine double, start_char long, end_char long"


def _search(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = shared.value
        for pdf in batches:
            texts, ids, names = pdf["text"].tolist(), pdf["doc_id"].tolist(), pdf["document_id"].tolist()
            for lo, hi in codepoints.slices(texts, 600_000):
                rows = [(ids[lo + t], names[lo + t], matcher.ids[i], round(s, 6), round(c, 6), a, b) for t, i, s, c, a, b in matcher.search(texts[lo:hi])]
                yield pd.DataFrame(rows, columns=["doc_id", "document_id", "evaluation_item_id", "covered", "cosine", "start_char", "end_char"])

    return run


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, document_id, evaluation_item_id, covered, cosine, start_char, end_char): the items found in each document.

    The items are a fixed table of held-out passages; the corpus is searched once, however many there are."""
    spark = documents.sparkSession
    stated = [(r.evaluation_item_id, r.query_text) for r in items.where("evaluation_item_id is not null and length(query_text) > 0").select("evaluation_item_id", "query_text").groupBy("evaluation_item_id").agg(F.min("query_text").alias("query_text")).orderBy("evaluation_item_id").toLocalIterator()]
    df, n, passages = frequencies(documents)
    idf, v = axes(documents, df, n, passages)
    shared = spark.sparkContext.broadcast(Matcher(stated, idf, v, df, n))
    return documents.where("doc_id is not null and length(text) > 0").select("doc_id", "document_id", "text").mapInPandas(_search(shared), _OUT)


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, evaluation_item_id) of the leaks."""
    return leaks(documents, items).select("doc_id", "evaluation_item_id").distinct()
