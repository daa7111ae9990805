"""Problem 1: the language of each document and of each single-language stretch.

Method: hyperdimensional profiles. Every letter has a seeded random vector of +-1; a trigram is bound as the product of its
letters' vectors, rotated by their place; a text bundles its trigrams, and languages are prototypes bundled from labelled
texts. A sentence takes the language whose prototype has the greatest cosine with its bundle. Since the cosine is linear
in the bundle, each trigram's product with each prototype is tabulated once, and a sentence adds up table rows: the dot
products are exact, only the sentence's own norm is taken as that of nearly orthogonal trigrams.

Prototypes are fitted on a bounded sample of labelled rows, by sentence; sentences whose label is wrong move to the nearest
prototype in further rounds. Garbled texts are first restored, so they count in the language they were written in; the offsets
of stretches are those of the text as it stands.

Defined cases: null texts and texts without a full sentence are `und` with confidence 0; headings, tables, number lists and
single words take no part; unsure sentences follow their document; repeated documents are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.functions import codepoints
from archivolt.llm import encoding

LANGUAGES = ("deu", "eng", "rus", "ukr")
#: Codes of the same languages; the first two letters decide ("de-AT" is German).
CODES = {"de": "deu", "ger": "deu", "deu": "deu", "en": "eng", "eng": "eng", "ru": "rus", "rus": "rus", "uk": "ukr", "ukr": "ukr"}
MISSING = ("", "und", "unk", "n/a", "none", "null", "unknown", "zxx", "mul", "mis")
#: Bound of the training sample: labelled documents, and characters of each (longer ones are not drawn).
SAMPLE, SAMPLE_CHARS = 2400, 6000
DIMENSIONS, SEED, ROUNDS = 4096, 20240229, 3
#: A full sentence has at least so many words and letters; a sentence is sure if its margin, in units of noise, is at least SURE.
MIN_WORDS, MIN_LETTERS, SURE = 4, 18, 1.0

_ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüß" + "абвгдежзийклмнопрстуфхцчшщъыьэюяёіїєґ"
A = len(_ALPHABET) + 1


def _symbols() -> np.ndarray:
    """Code point -> letter number, 0 for all else; capitals count as small letters."""
    t = np.zeros(codepoints.TABLE_SIZE, np.int32)
    for k, c in enumerate(_ALPHABET, 1):
        for x in {c, c.upper()}:
            if len(x) == 1:
                t[ord(x)] = k
    return t


_SYMBOL = _symbols()
_IS = codepoints.lookup(digit="0123456789", stop=".!?…", close="\"'»”’)]“", space=" \t\n\r\0  ", line="\n\0 ", cell="|\t")


def sentences(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Full sentences of all texts: number of the text, start and end in it, letters; and the trigram codes with their owners."""
    cp, begin = codepoints.join(texts)
    n = len(cp)
    sym = _SYMBOL[cp]
    line = _IS["line"][cp]
    # tables: all of a line that holds a cell mark is out
    line_id = np.cumsum(line) - line
    cells = np.bincount(line_id, weights=_IS["cell"][cp], minlength=int(line_id[-1]) + 1 if n else 1) > 0
    table = cells[line_id]
    sym = np.where(table, 0, sym)
    nxt = np.append(cp[1:], 0)
    space_next = _IS["space"][nxt]
    stop = _IS["stop"][cp]
    closing = _IS["close"][cp] & np.append(False, stop[:-1])
    number_after = np.append(_IS["digit"][nxt[1:]], False)  # "p. 12" ends no sentence
    ends = (stop | closing) & space_next & ~table & ~number_after
    blank = line & np.append(line[1:], True)
    hard = blank | (cp == 0) | (line & (table | np.append(table[1:], False)))
    cut = ends | hard
    seg = np.cumsum(cut) - cut  # segment of each character; a cut belongs to the segment it ends
    count = int(seg[-1]) + 1 if n else 0
    letter = sym > 0
    word_start = letter & ~np.append(False, letter[:-1])
    letters = np.bincount(seg, weights=letter, minlength=count)
    words = np.bincount(seg, weights=word_start, minlength=count)
    last = np.flatnonzero(cut)
    last = np.append(last, n - 1) if n and len(last) < count else last
    first = np.append(0, last[:-1] + 1)
    full = ends[last] & (words >= MIN_WORDS) & (letters >= MIN_LETTERS)
    owner = np.searchsorted(begin, first, side="right") - 1
    code = sym.copy()
    code[2:] += A * sym[1:-1] + A * A * sym[:-2]
    code[:2] = 0
    gaps = (~letter).astype(np.int8)
    weak = gaps.copy()
    weak[1:] += gaps[:-1]
    weak[2:] += gaps[:-2]
    keep = (weak <= 1) & full[seg]
    return {"text": owner[full], "start": (first - begin[owner])[full], "end": (last + 1 - begin[owner])[full], "letters": letters[full].astype(np.int64), "code": code[keep], "sentence": (np.cumsum(full) - 1)[seg[keep]]}


class Profiles:
    """Language prototypes as a table: trigram -> product with each prototype."""

    def __init__(self, table: np.ndarray):
        self.table = table.astype(np.float32)

    @staticmethod
    def _vectors() -> np.ndarray:
        return np.random.default_rng(SEED).choice(np.array([-1, 1], np.float32), size=(A, DIMENSIONS))

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> "Profiles":
        """Prototypes bundled from trigram counts (languages x trigrams); frequent trigrams are damped."""
        weight = np.log1p(counts * (200_000 / np.maximum(1, counts.sum(1, keepdims=True))))
        v = cls._vectors()
        one, two = np.roll(v, 1, axis=1), np.roll(v, 2, axis=1)
        pair = (one[:, None, :] * v[None, :, :]).reshape(A * A, DIMENSIONS)
        proto = np.zeros((len(counts), DIMENSIONS), np.float32)
        for a in range(A):
            w = weight[:, a * A * A : (a + 1) * A * A]
            seen = np.flatnonzero(w.any(0))
            if len(seen):
                proto += (w[:, seen].astype(np.float32) @ pair[seen]) * two[a]
        proto -= proto.mean(0)  # what all languages share tells none
        proto /= np.maximum(np.linalg.norm(proto, axis=1, keepdims=True), 1e-9)
        table = np.empty((A**3, len(counts)), np.float32)
        for a in range(A):
            table[a * A * A : (a + 1) * A * A] = pair @ (proto * two[a]).T / np.sqrt(DIMENSIONS)
        return cls(table)

    @classmethod
    def fit(cls, texts: list[str], labels: list[str]) -> "Profiles":
        s = sentences(texts)
        label = np.array([LANGUAGES.index(x) for x in labels])[s["text"]] if len(texts) else np.zeros(0, int)
        model = None
        for _ in range(ROUNDS):
            counts = np.array([np.bincount(s["code"][label[s["sentence"]] == k], minlength=A**3) for k in range(len(LANGUAGES))], np.float64)
            model = cls.of_counts(counts)
            label = model.similarity(s).argmax(1)
        return model

    def similarity(self, s: dict[str, np.ndarray]) -> np.ndarray:
        """Cosine of each sentence with each prototype, times the square root of the dimensions' noise: sentences x languages."""
        n = len(s["text"])
        out = np.zeros((n, len(LANGUAGES)))
        if len(s["code"]):
            starts = np.flatnonzero(np.diff(s["sentence"], prepend=-1))
            sums = np.add.reduceat(self.table[s["code"]], starts, axis=0)
            length = np.diff(np.append(starts, len(s["code"])))
            out[s["sentence"][starts]] = sums / np.sqrt(length)[:, None]
        return out

    def judge(self, texts: list[str | None]) -> pd.DataFrame:
        """One row a sentence: text, start, end, letters, language, confidence."""
        s = sentences(texts)
        sim = self.similarity(s)
        n = len(sim)
        order = np.sort(sim, axis=1)
        margin = (order[:, -1] - order[:, -2]) * np.sqrt(DIMENSIONS) if n else np.zeros(0)
        best = sim.argmax(1) if n else np.zeros(0, int)
        # unsure sentences follow the language of most letters of their text
        weight = np.zeros((len(texts), len(LANGUAGES)))
        np.add.at(weight, (s["text"], best), s["letters"] * np.minimum(1, margin / SURE))
        main = weight.argmax(1)
        sure = margin >= SURE
        best = np.where(sure, best, main[s["text"]]) if n else best
        own = np.take_along_axis(sim, best[:, None], 1)[:, 0] if n else np.zeros(0)
        spread = np.exp((sim - own[:, None]) * np.sqrt(DIMENSIONS))
        return pd.DataFrame({"text": s["text"], "start": s["start"], "end": s["end"], "letters": s["letters"], "language": np.array(LANGUAGES)[best], "confidence": 1 / spread.sum(1)})


def code_of(column):
    """A label as one of LANGUAGES, 'other' for another language, null if missing."""
    x = F.lower(F.trim(F.regexp_replace(column, r"(?U)^\s+|\s+$", "")))
    base = F.split(F.regexp_replace(x, "_", "-"), "-")[0]
    known = F.create_map(*[F.lit(v) for kv in CODES.items() for v in kv])
    return F.when(column.isNull() | x.isin(*MISSING), F.lit(None).cast("string")).otherwise(F.coalesce(known[base], F.lit("other")))


def newest_labels(records: DataFrame) -> DataFrame:
    """(document_id, label) of each document's newest record."""
    newest = records.where("document_id is not null").groupBy("document_id").agg(F.max(F.struct("loaded_at", "language")).alias("r"))
    return newest.select("document_id", F.col("r.language").alias("label"))


def fit(documents: DataFrame, records: DataFrame, limit: int = SAMPLE) -> tuple[encoding.Decoder, Profiles]:
    """The decoder of garbled text and the language profiles, both from a bounded sample of labelled documents.

    Rows are drawn by their own hash against limit / rows; no more than twice the limit reach the driver."""
    n = max(1, documents.count())
    draw = F.pmod(F.xxhash64("document_id"), F.lit(1 << 30)) < F.lit(int(min(1.0, limit / n) * (1 << 30)) + 1)
    rows = documents.where(draw & F.length("text").between(1, SAMPLE_CHARS)).select("document_id", "text")
    labels = newest_labels(records.where(draw)).select("document_id", code_of(F.col("label")).alias("code"))
    drawn = sorted(rows.join(labels, "document_id", "left").select("document_id", "text", "code").limit(2 * limit).collect(), key=lambda r: (r.document_id or "", r.text, r.code or ""))
    decoder = encoding.Decoder.fit([r.text for r in drawn])
    clean = [(r.text, r.code) for r in drawn if r.code in LANGUAGES and encoding.plausible(r.text)]
    return decoder, Profiles.fit([t for t, _ in clean], [c for _, c in clean])


def _restored(decoder: encoding.Decoder, texts: list[str | None]) -> list[str | None]:
    flags = decoder.suspicious([t or "" for t in texts])
    return [(decoder.repair_one(t) or (t,))[0] if f else t for t, f in zip(texts, flags)]


def _to_raw(judged: pd.DataFrame, raw: list[str | None], restored: list[str | None]) -> None:
    """Turn offsets in restored texts into those of the texts as they stand.

    No encoding makes or takes a space or line end, so the n-th of them is the same one before and after; sentences end at one."""
    for k, rows in judged.groupby("text").groups.items():
        before, after = raw[int(k)], restored[int(k)]
        if before == after:
            continue
        a, b = (np.array([-1, *(m.start() for m in re.finditer("[ \n]", t)), len(t)]) for t in (before, after))
        start, end = judged.loc[rows, "start"].to_numpy(), judged.loc[rows, "end"].to_numpy()
        if len(a) == len(b):
            left, right = np.searchsorted(b, start, side="right") - 1, np.searchsorted(b, end)
            start, end = a[left] + start - b[left], a[right] + end - b[right]
        else:
            start, end = (np.rint(x * (len(before) / max(1, len(after)))).astype(int) for x in (start, end))
        judged.loc[rows, "start"], judged.loc[rows, "end"] = np.clip(start, 0, len(before)), np.clip(end, 0, len(before))


_STRETCHES = "document_id string, start_char long, end_char long, language string, confidence double, sentences int, letters long"


def _stretches(shared, whole: bool):
    """Runs of sentences of one language; whole: one row for each language of a document instead."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder, profiles = shared.value
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["document_id"].to_numpy()
            for lo, hi in codepoints.slices(texts, 400_000):
                part = texts[lo:hi]
                restored = _restored(decoder, part)
                judged = profiles.judge(restored)
                if not whole:
                    _to_raw(judged, part, restored)
                if whole:
                    key = [judged["text"], judged["language"]]
                else:
                    run_id = ((judged["language"] != judged["language"].shift()) | (judged["text"] != judged["text"].shift())).cumsum()
                    key = [judged["text"], run_id, judged["language"]]
                judged["weighted"] = judged["confidence"] * judged["letters"]
                g = judged.groupby(key, sort=False)
                out = g.agg(start_char=("start", "min"), end_char=("end", "max"), weighted=("weighted", "sum"), sentences=("start", "size"), letters=("letters", "sum"))
                out["confidence"] = out["weighted"] / out["letters"].clip(lower=1)
                out["document_id"] = ids[lo:hi][out.index.get_level_values(0).to_numpy().astype(int)]
                out["language"] = out.index.get_level_values(-1)
                yield out.reset_index(drop=True)[["document_id", "start_char", "end_char", "language", "confidence", "sentences", "letters"]]

    return run


def _judge(documents: DataFrame, records: DataFrame, whole: bool) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, records))  # fixed tables of a few MB
    return documents.where("document_id is not null and length(text) > 0").select("document_id", "text").mapInPandas(_stretches(shared, whole), _STRETCHES)


def stretches(documents: DataFrame, records: DataFrame) -> DataFrame:
    """(document_id, start_char, end_char, language, confidence, sentences, letters): each single-language stretch."""
    return _judge(documents, records, False)


def languages(documents: DataFrame, records: DataFrame) -> DataFrame:
    """The same columns with one row for each language of a document, restored first where garbled."""
    return _judge(documents, records, True)


def labels(documents: DataFrame, records: DataFrame) -> DataFrame:
    """(document_id, language, confidence): the language of most letters, its confidence times its share; `und` without sentences."""
    best = languages(documents, records).groupBy("document_id").agg(F.max_by(F.struct("language", "confidence", "letters"), F.struct("letters", "language")).alias("b"), F.sum("letters").alias("all"))
    per = best.select("document_id", F.col("b.language").alias("language"), F.round(F.col("b.confidence") * F.col("b.letters") / F.col("all"), 6).alias("confidence"))
    return documents.select("document_id").where("document_id is not null").distinct().join(per, "document_id", "left").select("document_id", F.coalesce("language", F.lit("und")).alias("language"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))


def found(documents: DataFrame, records: DataFrame, normalized: DataFrame) -> DataFrame:
    """(document_id, language): the languages of documents with a missing or wrong label, or with more than one language."""
    lang = languages(documents, records).groupBy("document_id").agg(F.collect_set("language").alias("langs"))
    given = newest_labels(records).union(normalized.where("document_id is not null").select("document_id", "language"))
    said = given.groupBy("document_id").agg(F.collect_set(F.coalesce(code_of(F.col("label")), F.lit("missing"))).alias("said"))
    case = (F.size("langs") > 1) | F.coalesce(F.exists("said", lambda s: s != F.col("langs")[0]), F.lit(False))
    return lang.join(said, "document_id", "left").where(case).select("document_id", F.explode("langs").alias("language"))
