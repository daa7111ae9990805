"""Problem 3: variant spellings of the same person or organisation.

Method: metric-space partitioning. A name is a bag of words. Which of them are common property (given names, lines of
business, their abbreviations) and which are distinctive is told by the archive's own statistics: a common word stands beside
many different rarer words, now before and now after them. The distinctive words, joined, are the core, compared by a true
edit metric. Cells are rings around the first pivot, the empty name, whose distance is the length; by the triangle inequality
a name within the radius of a ring's border is also copied to the ring below, so no pair is lost.
Inside a cell lower bounds of the distance rule pairs out: common letters, and the distances to further pivots by the same
inequality; the rest get their exact distance.
Crowded cells are split into blocks that meet pairwise. (Rings around further pivots would copy more than they separate:
edit distances of unrelated names crowd together, see the README.)

Linked cores form clusters; inside a cluster the common words decide: given names and initials for people, the line of
business for firms. So relatives and sister firms stay apart. Short forms (Liz, Mfg., Hans) are learned: they keep company
with the same cores as the long form, but don't stand beside it in one name. A few more may be given as a parameter.

Defined cases: null and empty names are entities of their own; equal names are compared once, whatever their number; an
initial that fits several relatives goes to the one that shares its second name, else to the most frequent; a name all of
whose words are common has the rarest of them as its core; in an archive too small for statistics every word is distinctive.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.operators.components import connected_components
from archivolt.session import cut

#: Largest radius; names of up to so many letters get a radius of 1, 2 and 3. Ring width, pivots, rows of a block.
RADIUS, SHORT, MEDIUM, LONG = 4, 6, 10, 14
RING, PIVOTS, BLOCK = 8, 12, 5000
#: Transliteration of Cyrillic small letters.
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "ґ": "g", "д": "d", "е": "e", "ё": "e", "є": "e", "ж": "zh", "з": "z", "и": "i", "і": "i", "ї": "i", "й": "i",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch",
    "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}
#: Titles and forms of address; legal forms of companies; endings of Russian and Ukrainian patronymics.
TITLES = "dr prof mr mrs ms herr frau ing inzh proph ph gn gzha professor doktor inzhener dipl".split()
LEGAL = "ltd limited inc incorporated gmbh mbh ag aktiengesellschaft gesellschaft co kg und ooo ao zao oao pao llc plc corp company obshchestvo ogranichennoi ogranichennoy otvetstvennostyu aktsionernoe zakrytoe otkrytoe".split()
PATRONYMIC = ("ovich", "evich", "ovna", "evna", "ichna")
#: A common word has at least so many different rarer neighbours (told by their first and last letter), that share of its names,
#: and stands on its rarer side of the neighbour in that share of them; the last line asks for no second side.
COMMON = ((5, 0.55, 0.12), (6, 0.45, 0.12), (8, 0.25, 0.12), (16, 0.3, 0.0))
#: Least share of all names of a common word, so that their number can't grow with the archive; share of names with a legal
#: form that makes it a line of business.
LEAST_SHARE, FIRM_SHARE = 1e-6, 0.25
#: A short form shares at least so many clusters with its long form, that share of its own, and so many times what chance gives;
#: first for short forms spelt from letters of the long one in order, then for any other.
LEARNED = ((2, 0.25, 2.5), (3, 0.4, 4.0))
_LEGAL, _TITLES = set(LEGAL), set(TITLES)


def latin(text: str) -> str:
    """Small Latin letters: compatibility forms folded, Cyrillic transliterated, accents dropped, digits in words read as letters."""
    t = "".join(LATIN.get(c, c) for c in unicodedata.normalize("NFKC", text).lower())
    t = "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)).replace("ß", "ss")
    return re.sub(r"(?<=[a-z])[015](?=[a-z])|(?<=[a-z]{2})0|0(?=[a-z]{2})", lambda m: {"0": "o", "1": "l", "5": "s"}[m[0]], t)


def distance(a: str, b: str) -> int:
    """Levenshtein distance, by rows."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def tokens(text: str) -> list[tuple[str, str]]:
    """(word, kind) of a name in order: 'legal' forms, 'title's, 'initial's, 'short' words that end in a stop, and other 'word's."""
    t = re.sub(r"\bg-(n|zha)\b\.?", r"g\1", latin(text)).replace("'", "").replace("’", "")
    out = []
    for m in re.finditer(r"(?:[a-z]\.\s?){2,}(?![a-z])|[a-z]+\.?", t):
        w = m[0]
        letters = re.sub("[^a-z]", "", w)
        if w.count(".") > 1:  # two letters may be initials as well as a legal form
            out.append((letters, "legal" if len(letters) > 2 and letters in _LEGAL else "dotted"))
        elif letters in _TITLES or len(letters) > 3 and _slip_of(letters, "title"):
            out.append((letters, "title"))
        elif len(letters) > 1 and (letters in _LEGAL or len(letters) > 6 and _slip_of(letters, "legal")):
            out.append((letters, "legal"))
        elif len(letters) == 1 or len(letters) == 2 and w.endswith(".") and letters in ("yu", "ya", "zh", "kh", "ts", "ch", "sh"):
            out.append((letters, "initial"))
        else:
            out.append((letters, "short" if w.endswith(".") else "word"))
    return out


_slips: dict[tuple[str, str], bool] = {}


def _slip_of(word: str, kind: str) -> bool:
    """Whether a word is a slip of a title or of a legal form of seven letters or more."""
    key = (kind, word)
    if key not in _slips:
        table = [x for x in LEGAL if len(x) > 6] if kind == "legal" else [x for x in TITLES if len(x) > 3]
        if len(_slips) > 200_000:
            _slips.clear()
        _slips[key] = any(abs(len(x) - len(word)) <= 2 and slips(word, x) <= (2 if len(x) > 6 else 1) for x in table)
    return _slips[key]


def slips(a: str, b: str) -> int:
    """Edits between two words, where two neighbouring letters changing places is one."""
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            n = min(row[-1] + 1, one[j] + 1, one[j - 1] + (x != y))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                n = min(n, two[j - 2] + 1)
            row.append(n)
        two, one = one, row
    return one[-1]


def spelt_from(short: str, long: str) -> bool:
    """Whether a short form's letters stand in the long form in that order, the first at its start: mfg of manufacturing."""
    if not short or short[0] != long[0] or 4 * len(short) > 3 * len(long):
        return False
    rest = iter(long)
    return all(c in rest for c in short)


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for k, text in enumerate(pdf["alias_text"]):
            t = tokens(text)
            legal = any(kind == "legal" for _, kind in t)
            rows += [(text, w, i, legal) for i, (w, kind) in enumerate(t) if kind in ("word", "short")]
        yield pd.DataFrame(rows, columns=["alias_text", "word", "place", "legal"])


class Lexicon:
    """The common words of the archive: their frequency, whether they name lines of business, and which word a slip stands for."""

    def __init__(self, words: dict[str, int], firms: set[str], nicknames: dict[str, str] | None = None):
        self.words, self.firms, self.nicknames = words, firms, nicknames or {}
        self.near: dict[str, list[str]] = defaultdict(list)
        for w in words:
            if len(w) > 2:
                for d in self._deletes(w):
                    self.near[d].append(w)
        self._kept: dict[str, str | None] = {}
        self.same = {w: self._frequent(w) for w in words}

    def __getstate__(self):
        return self.__dict__ | {"_kept": {}}

    @staticmethod
    def _radius(word: str) -> int:
        return 1 if len(word) < 7 else 2

    @classmethod
    def _deletes(cls, word: str) -> set[str]:
        out = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}
        if cls._radius(word) > 1:
            out |= {d[:i] + d[i + 1 :] for d in list(out) for i in range(len(d))}
        return out

    def _matches(self, word: str) -> list[tuple[int, int, str]]:
        seen = {w for d in self._deletes(word) for w in self.near.get(d, ())} - {word}
        near = [(slips(word, w), -self.words[w], w) for w in seen]
        # short words only change the places of letters
        return sorted(x for x in near if x[0] <= min(self._radius(word), self._radius(x[2])) and (min(len(word), len(x[2])) > 4 or sorted(word) == sorted(x[2])))

    def _frequent(self, word: str) -> str:
        """A common word that is itself a slip of one eight times as frequent stands for that."""
        near = [w for _, n, w in self._matches(word) if -n >= 8 * self.words[word]]
        return near[0] if near else word

    def common(self, word: str) -> str | None:
        """The common word that a word is or is a slip of; None for a distinctive one."""
        if word in self.words:
            return self.same[word]
        if word.endswith(PATRONYMIC) and len(word) < 14:
            return word
        if word not in self._kept:
            if len(self._kept) > 200_000:
                self._kept.clear()
            near = self._matches(word) if len(word) > 2 else []
            self._kept[word] = self.same[near[0][2]] if near else None
        return self._kept[word]

    def parse(self, text: str) -> tuple[str, str, list[str], str | None]:
        """(kind, core, rest, prefixes): rest are common words and initials in order; prefixes only for names beyond the statistics."""
        given, core, legal, dotted = [], [], False, []
        short = False
        for w, kind in tokens(text):
            if kind == "legal":
                legal = True
            elif kind == "dotted":
                dotted.append(w)
                given += list(w)
            elif kind == "initial":
                given.append(w[0])
            elif kind in ("word", "short"):
                c = self.common(w)
                if c is None:
                    core.append(w)
                    short |= kind == "short"
                else:
                    given.append(c)
        plain = [w for w in given if len(w) > 1]
        firm = any(w in self.firms for w in plain) or legal and not any(w not in self.firms for w in plain)
        if firm:  # dotted letters are a legal form
            given = [w for w in plain if w in self.firms] or plain
        if not core and plain:
            rare = min(plain, key=lambda w: (self.words.get(w, 0), -len(w), w))
            core = [rare]
            if rare in given:  # a firm's rest holds lines of business only
                given.remove(rare)
        given = [self.nicknames.get(w, w) for w in given]
        prefixes = " ".join(sorted({w[:3] for w in core})) + (" ." if short else "") if len(core) > 1 and not any(len(w) > 1 for w in given) else None
        return "firm" if firm else "person", " ".join(core), given, prefixes


def lexicon(texts: DataFrame, nicknames: dict[str, str] | None = None) -> Lexicon:
    """The common words, from all names: their number is bounded by LEAST_SHARE, and only they reach the driver."""
    words = cut(texts.mapInPandas(_bags, "alias_text string, word string, place int, legal boolean"))
    n = texts.count()
    df = words.groupBy("word").agg(F.count_distinct("alias_text").alias("df"), F.avg(F.col("legal").cast("int")).alias("firm"))
    bag = words.join(df.select("word", "df"), "word").groupBy("alias_text").agg(F.collect_list(F.struct("df", "word", "place")).alias("bag"))
    one = bag.select("bag", F.explode("bag").alias("x"))
    others = F.filter("bag", lambda y: y["word"] != F.col("x.word"))
    rarest = F.array_min(F.transform(others, lambda y: F.struct(y["df"].alias("df"), (-F.length(y["word"])).alias("size"), y["place"].alias("place"), y["word"].alias("word"))))
    pairs = one.select(F.col("x.word").alias("word"), F.col("x.place").alias("place"), F.col("x.df").alias("df"), rarest.alias("r")).where("r.df <= df")
    ends = F.concat(F.substring("r.word", 1, 1), F.expr("right(r.word, 1)"))
    per = pairs.groupBy("word", ends.alias("ends")).agg(F.count("*").alias("n"), F.count_if(F.col("place") < F.col("r.place")).alias("before"))
    sums = per.groupBy("word").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.sum("before").alias("before"))
    least = max(4, int(LEAST_SHARE * n))
    share, side = F.col("kinds") / F.col("df"), F.least("before", F.col("n") - F.col("before")) / F.col("n")
    fits = F.lit(False)
    for kinds, part, both in COMMON:
        # neighbours told by two letters run out at some hundreds, so a frequent word needs no greater share
        fits |= (F.col("kinds") >= kinds) & ((share >= part) | (F.col("kinds") >= 60)) & (side >= both)
    rows = sums.join(df.where(F.col("df") >= least), "word").where(fits).select("word", "df", "firm").collect()
    return Lexicon({r.word: r.df for r in rows}, {r.word for r in rows if r.firm >= FIRM_SHARE}, nicknames)


def _parsed(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = shared.value
        for pdf in batches:
            rows = [(t, *lex.parse(t)) for t in pdf["alias_text"]]
            yield pd.DataFrame(rows, columns=["alias_text", "kind", "core", "rest", "prefixes"])

    return run


def _spellings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(core, spelling): the joined words, also from their smallest on, since parts may be reordered."""
    for pdf in batches:
        rows = set()
        for core in pdf["core"]:
            w = core.split(" ")
            rows.add((core, "".join(w)))
            if len(w) > 1:
                k = w.index(min(w))
                rows.add((core, "".join(w[k:] + w[:k])))
        yield pd.DataFrame(sorted(rows), columns=["core", "spelling"])


def _company(clusters: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b, n): in how many clusters two common words occur; b is null for the number of a word's clusters."""
    seen: Counter = Counter()
    for pdf in clusters:
        for kind, words in zip(pdf["kind"], pdf["words"]):
            w = sorted(words)
            seen.update((kind, x, "") for x in w)
            seen.update((kind, x, y) for x, y in combinations(w, 2))
            seen[(kind, "", "")] += 1
            if len(seen) > 500_000:
                yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["kind", "a", "b", "n"])
                seen.clear()
    yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["kind", "a", "b", "n"])


def short_forms(forms: DataFrame) -> dict[str, list[tuple[str, float]]]:
    """For each word its possible long forms, likeliest first: (word, share of the word's clusters that hold it).

    forms has (cluster, kind, rest). Both tables that reach the driver are over pairs of common words."""
    words = forms.select("cluster", "kind", F.explode(F.filter("rest", lambda w: F.length(w) > 1)).alias("word")).groupBy("cluster", "kind").agg(F.collect_set("word").alias("words"))
    counts = words.select("kind", "words").mapInPandas(_company, "kind string, a string, b string, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    both = forms.select("kind", F.array_distinct(F.filter("rest", lambda w: F.length(w) > 1)).alias("words")).where("size(words) > 1")
    beside = {(r.kind, r.a, r.b): r.n for r in both.mapInPandas(_company, "kind string, a string, b string, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).where("b <> ''").collect()}
    table = {(r.kind, r.a, r.b): r.n for r in counts.where("b = '' or n >= 2").collect()}
    out: dict[str, list[tuple[str, float]]] = defaultdict(list)
    for (kind, a, b), n in table.items():
        if not b:
            continue
        total, na, nb = table[(kind, "", "")], table[(kind, a, "")], table[(kind, b, "")]
        short, long = (a, b) if (na, a) <= (nb, b) else (b, a)
        few, many = min(na, nb), max(na, nb)
        spelt = spelt_from(short, long) or spelt_from(long, short)
        least, share, lift = LEARNED[0] if spelt else LEARNED[1]
        if n >= least and n / few >= share and n / few >= lift * many / total and beside.get((kind, a, b), 0) <= 0.2 * n:
            if spelt_from(long, short):
                short, long = long, short
            # of several words that fit, the one that begins alike leads the name as the short form does
            out[short].append((long, round(n / table[(kind, short, "")] + (0.3 if short[0] == long[0] else 0.0) + (0.3 if spelt else 0.0), 4)))
    return {k: sorted(v, key=lambda x: (-x[1], x[0])) for k, v in out.items()}


def _codes(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters, lengths) of names as a matrix."""
    length = np.array([len(n) for n in names], np.int32)
    out = np.zeros((len(names), max(1, int(length.max(initial=0)))), np.uint8)
    for k, n in enumerate(names):
        out[k, : len(n)] = np.frombuffer(n.encode("ascii", "replace"), np.uint8)
    return out, length


def distances(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Levenshtein distance of each row of a to the same row of b, all rows at once."""
    n, wa, wb = len(a), a.shape[1], b.shape[1]
    out = np.zeros(n, np.int16)
    row = np.repeat(np.arange(wb + 1, dtype=np.int16)[None, :], n, 0)
    every = np.arange(n)
    done = la == 0
    out[done] = lb[done]
    for i in range(1, wa + 1):
        new = np.empty_like(row)
        new[:, 0] = i
        cost = (a[:, i - 1, None] != b).astype(np.int16)
        best = np.minimum(row[:, 1:] + 1, row[:, :-1] + cost)
        for j in range(1, wb + 1):
            new[:, j] = np.minimum(best[:, j - 1], new[:, j - 1] + 1)
        row = new
        at = la == i
        out[at] = row[every[at], lb[at]]
    return out


def _spread(pivots: list[str]):
    pc, pl = _codes(pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 20_000):
                part = pdf.iloc[lo : lo + 20_000]
                names = part["core"].tolist()
                c, length = _codes(names)
                to = [distances(c, length, np.repeat(pc[k : k + 1], len(c), 0), np.repeat(pl[k], len(c))) for k in range(len(pivots))]
                matrix = np.minimum(np.stack(to, 1), 255).astype(np.uint8) if to else np.zeros((len(c), 0), np.uint8)
                yield pd.DataFrame({"core": names, "length": length, "pivots": [r.tobytes() for r in matrix]})

    return run


def radius(length: np.ndarray) -> np.ndarray:
    """The radius for names of these lengths (the shorter of a pair counts)."""
    return np.where(length <= SHORT, 1, np.where(length <= MEDIUM, 2, np.where(length <= LONG, 3, RADIUS)))


def _letters(codes: np.ndarray, times: int = 3) -> np.ndarray:
    """For each name and letter, whether it occurs once, twice, thrice: products of two rows count common letters."""
    out = np.zeros((len(codes), 26, times), np.float32)
    for letter in range(26):
        n = (codes == 97 + letter).sum(1)
        for k in range(times):
            out[:, letter, k] = n > k
    return out.reshape(len(codes), -1)


def _join_cell(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Pairs within their radius in one cell: lower bounds rule out (length, common letters, pivots), exact distances decide."""
    _, one, two = key
    pdf = pdf.assign(length=pdf["core"].str.len()).sort_values(["length", "core"])
    names, length = pdf["core"].to_numpy(), pdf["length"].to_numpy().astype(np.int32)
    c, _ = _codes(list(names))
    x = _letters(c)
    # letters beyond the third of a kind count as common, so the bound stays a lower one
    spare = length - x.sum(1).astype(np.int32)
    p = np.stack([np.frombuffer(v, np.uint8) for v in pdf["pivots"]]).astype(np.int16)
    block, home = pdf["block"].to_numpy(), pdf["home"].to_numpy()
    out = []
    for lo in range(0, len(pdf), 512):
        hi = min(lo + 512, len(pdf))
        end = int(np.searchsorted(length, length[hi - 1] + RADIUS, side="right"))
        common = x[lo:hi] @ x[lo:end].T
        need = length[lo:end][None, :] - radius(length[lo:hi])[:, None]  # the longer name less the shorter one's radius
        i, j = np.nonzero(common + np.minimum(spare[lo:hi][:, None], spare[lo:end][None, :]) >= need)
        i, j = i + lo, j + lo
        # each pair once: in the blocks it belongs to, and not where both are copies
        keep = (i < j) & (home[i] | home[j]) & ((block[i] == one) & (block[j] == two) | (block[i] == two) & (block[j] == one))
        i, j = i[keep], j[keep]
        r = radius(length[i])
        near = length[j] - length[i] <= r
        for k in range(p.shape[1]):
            near &= np.abs(p[i, k] - p[j, k]) <= r
        i, j, r = i[near], j[near], r[near]
        for at in range(0, len(i), 50_000):
            a, b, q = i[at : at + 50_000], j[at : at + 50_000], r[at : at + 50_000]
            near = distances(c[a], length[a], c[b], length[b]) <= q
            out.append(pd.DataFrame({"src": names[a[near]], "dst": names[b[near]]}))
    return pd.concat(out) if out else pd.DataFrame({"src": [], "dst": []}, dtype=object)


def links(cores: DataFrame, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(src, dst): pairs of distinct cores within their radius."""
    drawn = [r.core for r in cores.where(F.length("core") > 8).orderBy(F.xxhash64("core"), "core").limit(60).collect()]
    chosen = drawn[:1]
    while drawn and len(chosen) < min(pivots, len(drawn)):  # pivots far from each other
        chosen.append(max(drawn, key=lambda d: (min(distance(d, c) for c in chosen), d)))
    parts = int(cores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(cores.repartition(parts, "core").mapInPandas(_spread(chosen), "core string, length int, pivots binary").withColumn("ring", F.floor(F.col("length") / RING).cast("int")))
    below = placed.where(F.col("length") % RING < RADIUS).withColumn("ring", F.col("ring") - 1)
    cells = placed.withColumn("home", F.lit(True)).unionByName(below.withColumn("home", F.lit(False)))
    size = cells.groupBy("ring").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    split = cells.join(F.broadcast(size), "ring").withColumn("block", F.pmod(F.xxhash64("core"), F.col("blocks")).cast("int"))  # a row a ring: as many as name lengths
    meet = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = meet.select("ring", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "core", "pivots", "block", "home")
    return met.groupBy("ring", "one", "two").applyInPandas(_join_cell, "src string, dst string")


def _resolver(shared):
    def long_form(word: str, known: dict, here: set[str]) -> str:
        for _ in range(3):
            options = known.get(word)
            if not options:
                break
            word = next((w for w, _ in options if w in here), options[0][0])
        return word

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        known = shared.value
        if (pdf["kind"] == "firm").any():  # a bare core beside firms is one
            pdf = pdf.assign(kind=["firm" if not len(rest) else kind for kind, rest in zip(pdf["kind"], pdf["rest"])])
        here = {w for rest in pdf["rest"] for w in rest if len(w) > 1}
        first, second = [], []
        for kind, rest in zip(pdf["kind"], pdf["rest"]):
            rest = [w if len(w) == 1 else long_form(w, known, here) for w in rest]
            first.append(rest[0] if len(rest) else "")
            second.append(rest[1][0] if kind == "person" and len(rest) > 1 else "")
        return _resolve(key, pdf.assign(first=first, second=second))

    return run


def _resolve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Entities among the forms of one cluster."""
    names = {}
    firms = pdf[pdf["kind"] == "firm"]
    count = firms.groupby("first")["n"].sum().to_dict()
    lines = {k: v for k, v in count.items() if k}
    for r in firms.itertuples():
        line = r.first or (max(sorted(lines), key=lambda k: lines[k]) if lines else "")
        names[r.Index] = f"firm:{line}"
    people = pdf[pdf["kind"] == "person"]
    full = people[people["first"].str.len() > 1]
    seconds: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for r in full.itertuples():
        seconds[r.first][r.second] += int(r.n)
    weight = {f: sum(s.values()) for f, s in seconds.items()}
    known = {f: {s: n for s, n in v.items() if s} for f, v in seconds.items()}
    for r in people.itertuples():
        if len(r.first) > 1:
            fits = [r.first]
        else:
            fits = [f for f in weight if f[0] == r.first or not r.first]
            if r.second:
                same = [f for f in fits if r.second in known[f]]
                open_ = [f for f in fits if not known[f]]
                fits = same or open_ or []
        if fits:
            names[r.Index] = "person:" + max(sorted(fits), key=lambda f: weight[f])
        else:
            names[r.Index] = f"person:{r.first}"
    lone = set(names.values())
    # forms without any given name join the only person there is
    people_found = {n for n in lone if n not in ("person:",) and n.startswith("person:")}
    fix = next(iter(people_found)) if len(people_found) == 1 else "person:"
    entity = [fix if names[i] == "person:" else names[i] for i in pdf.index]
    return pd.DataFrame({"cluster": key[0], "form": pdf["form"], "entity": entity})


def entities(aliases: DataFrame, nicknames: dict[str, str] | None = None) -> DataFrame:
    """(alias_id, entity_id): entity_id is the smallest alias_id of the entity. nicknames are short forms beside the learned ones."""
    sc = aliases.sparkSession.sparkContext
    rows = aliases.where("alias_id is not null").select("alias_id", "alias_text")
    counted = cut(rows.where("length(alias_text) > 0").groupBy("alias_text").count())
    texts = counted.select("alias_text")
    lex = sc.broadcast(lexicon(texts, nicknames))
    parsed = cut(counted.mapInPandas(_with_count(_parsed(lex)), "alias_text string, kind string, core string, rest array<string>, prefixes string, n long").where("core <> ''"))
    cores = parsed.select("core").distinct()
    spelt = cut(cores.mapInPandas(_spellings, "core string, spelling string"))
    near = links(cut(spelt.select(F.col("spelling").alias("core")).distinct()))
    # spellings and cores are vertices of one graph; a core is linked to its own spellings, an abbreviated name to its long one
    own = spelt.select(F.concat(F.lit("core "), "core").alias("src"), F.col("spelling").alias("dst"))
    full = parsed.where("prefixes is not null and prefixes not like '% .'").select("prefixes", F.col("core").alias("long")).distinct()
    cut_short = parsed.where("prefixes like '% .'").select(F.expr("left(prefixes, length(prefixes) - 2)").alias("prefixes"), F.col("core").alias("short")).distinct()
    extended = F.forall(F.split("short", " "), lambda w: F.exists(F.split(F.col("long"), " "), lambda x: x.startswith(w)))
    abbreviated = cut_short.join(full, "prefixes").where(extended).select(F.concat(F.lit("core "), "short").alias("src"), F.concat(F.lit("core "), "long").alias("dst"))
    edges = own.union(near).union(abbreviated)
    vertices = spelt.select(F.concat(F.lit("core "), "core").alias("id")).distinct()
    cluster = cut(connected_components(vertices, edges).select(F.expr("substring(id, 6)").alias("core"), F.col("component").alias("cluster")))
    named = cut(parsed.join(cluster, "core").withColumn("form", F.sha2(F.concat_ws("|", "kind", "core", F.array_join("rest", " ")), 256)))
    forms = cut(named.groupBy("cluster", "form").agg(F.first("kind").alias("kind"), F.first("rest").alias("rest"), F.sum("n").alias("n")))
    known = sc.broadcast(short_forms(forms))
    # a cluster holds the different forms of one surname or firm, however often each occurs
    parts = int(aliases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    solved = forms.repartition(parts, "cluster").groupBy("cluster").applyInPandas(_resolver(known), "cluster string, form string, entity string")
    resolved = named.select("alias_text", "cluster", "form").join(solved, ["cluster", "form"]).select("alias_text", F.sha2(F.concat_ws("|", "cluster", "entity"), 256).alias("name"))
    of = cut(rows.join(resolved, "alias_text", "left").select("alias_id", F.coalesce("name", F.concat(F.lit("alone "), "alias_id")).alias("name")))
    smallest = of.groupBy("name").agg(F.min("alias_id").alias("entity_id"))
    return of.join(smallest, "name").select("alias_id", "entity_id")


def _with_count(parse):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for out in parse(iter([pdf])):
                yield out.assign(n=pdf["count"].to_numpy())

    return run


def found(aliases: DataFrame) -> DataFrame:
    """(alias_id_a, alias_id_b): each pair of aliases of one entity, as the stated result asks."""
    e = cut(entities(aliases))
    a, b = e.withColumnRenamed("alias_id", "alias_id_a"), e.withColumnRenamed("alias_id", "alias_id_b")
    return a.join(b, "entity_id").where("alias_id_a < alias_id_b").select("alias_id_a", "alias_id_b")
