"""Problem 6: text decoded with a wrong character encoding.

Method: a multinomial classifier over hashed byte bigrams (of the UTF-8 bytes, those with a high byte) predicts the exact
encoding chain of each stretch of text: clean, or one of CHAINS. It is trained on a bounded sample of the archive's own
records, garbled synthetically by every chain; records that the first model finds garbled leave the sample before the
second fit. A predicted chain is inverted and kept only if it decodes strictly and the result reads as clean text.

Stretches are sentences and lines; where a stretch mixes clean and garbled words, its words are decided one by one.
Bytes lost to U+FFFD are put back where the surrounding letters tell them; otherwise the record is reported with
recovered = false.

Defined cases: null, empty and ASCII texts are clean; repeated rows give one result; of several record versions the newest
title counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values: (true encoding, encoding it was read with, times). These are the chains that can be told.
CHAINS = (
    ("utf-8", "latin-1", 1),
    ("utf-8", "cp1252", 1),
    ("utf-8", "cp1252", 2),
    ("utf-8", "cp1251", 1),
    ("utf-8", "cp1251", 2),
    ("cp1251", "cp1252", 1),
    ("cp866", "cp1251", 1),
    ("koi8-u", "cp1251", 1),
    ("cp1251", "koi8-u", 1),
    ("cp1251", "koi8-r", 1),
    ("mac-roman", "cp1252", 1),
    ("cp1252", "mac-roman", 1),
    ("cp1252", "cp1251", 1),
    ("cp1252", "cp850", 1),
)
LOST = "�"
#: Bound of the training sample: records, and characters of each (longer ones are not drawn).
SAMPLE, SAMPLE_CHARS = 2500, 3000
#: Log-likelihood by which a chain must beat clean text, for a stretch and for a single word.
MARGIN, WORD_MARGIN = 4.0, 6.0
#: Priors against the chains that turn Cyrillic letters into others, and against capitals among them: short clean words look like them.
RARE, RARE_CAPITALS = 10.0, 16.0
BUCKETS = 1 << 15
#: Share of each class spread evenly over all buckets.
SMOOTH = 0.01
#: Bytes scored at once in a Python worker.
SLICE_BYTES = 2_000_000
_STRETCH = re.compile(r"(?<=[.:;!?|])(?=\s)|(?<=\n)")
_WORD = re.compile(r"[^ \t\n\r]+")
#: Signs that no clean text holds; a character that would become one was kept when the text was garbled.
_SIGN = re.compile("[─-▟√≈≤≥∙⌠⌡]")


def _forward(true: str, read: str, times: int) -> dict[int, str]:
    """What each character becomes: its bytes in the true encoding, read with the wrong one. Others stay as they are."""
    out = {}
    for code in [*range(0x80, 0x600), *range(0x2010, 0x2040), 0x20AC, 0x2116, 0x2122]:
        c = chr(code)
        try:
            for _ in range(times):
                c = c.encode(true).decode(read, "replace")
        except UnicodeEncodeError:
            continue
        if c != chr(code):
            out[code] = c
    return out


def invert(text: str, chain: tuple[str, str, int]) -> str | None:
    """The text before the chain, or None if it can't be decoded strictly."""
    true, read, times = chain
    try:
        for _ in range(times):
            if read == "cp1252" and true == "utf-8":  # C1 controls stand for the bytes cp1252 leaves undefined
                raw = b"".join(bytes([ord(c)]) if 0x80 <= ord(c) <= 0x9F else c.encode("cp1252") for c in text)
            else:
                raw = text.encode(read)
            done = raw.decode(true)
            if true != "utf-8":
                done = "".join(b if b == a or not _SIGN.match(b) else a for a, b in zip(text, done))
                if true == "cp866":  # it has no dash or quotes, so these were kept
                    done = "".join(a if a in "–—»„“”’" and (i == 0 or i == len(text) - 1 or " " in (text[i - 1], text[i + 1]) or a == "»") else b for i, (a, b) in enumerate(zip(text, done)))
            text = done
        return text
    except (UnicodeEncodeError, UnicodeDecodeError):
        return None


def _buckets(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the bigrams with a high byte, and their hashed buckets."""
    at = np.flatnonzero((raw[:-1] | raw[1:]) >= 128)
    code = (raw[at].astype(np.uint32) << 8) | raw[at + 1]
    return at, ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


_CYRILLIC = ("cp1251", "cp866", "koi8-u")


def _classes() -> list[tuple[int, bool, bool]]:
    """(chain, 0 for clean; Cyrillic; capitals): one multinomial each, so that scripts don't drown one another."""
    out = []
    for k in range(1 + len(CHAINS)):
        true = CHAINS[k - 1][0] if k else "utf-8"
        for cyrillic in (False, True):
            if true == "utf-8" or (true in _CYRILLIC) == cyrillic:
                out += [(k, cyrillic, False), (k, cyrillic, True)]
    return out


CLASSES = _classes()
_CHAIN_OF = np.array([k for k, _, _ in CLASSES])
_CLEAN = np.flatnonzero(_CHAIN_OF == 0)
_KOI8 = np.array([False] + ["koi8" in true + read for true, read, _ in CHAINS])
_SWAPPED = np.array([_KOI8[k] and capitals for k, _, capitals in CLASSES])
_PRIOR = np.where(_SWAPPED, RARE_CAPITALS, np.where(_KOI8[_CHAIN_OF], RARE, 0.0)).astype(np.float32)
_SCAN_PRIOR = np.concatenate([np.zeros(len(_CLEAN)), np.where(_KOI8[1:], RARE, 0.0), [RARE_CAPITALS]]).astype(np.float32)


_RUN = re.compile(r"[^\x00-\x7f]{2,}")
_INNER_CAPITAL = re.compile(r"[a-zа-яёіїєґ][A-ZА-ЯЁІЇЄҐ]")


def plausible(text: str) -> bool:
    """A coarse screen of training rows: False if the text surely isn't clean. What it lets through the fitted model sifts."""
    if LOST in text or _C1.search(text):
        return False
    for run in set(_RUN.findall(text)):
        for read in ("cp1252", "cp1251"):
            try:
                if run.encode(read).decode("utf-8") != run:
                    return False  # UTF-8 hardly ever arises by chance
            except UnicodeError:
                pass
    high = sum(not c.isascii() for c in _LETTER.findall(text))
    cyrillic, latin = len(_CYR.findall(text)), len(_LAT.findall(text))
    return (high - cyrillic) <= 0.15 * (latin + 1) + 0.02 * cyrillic and len(_INNER_CAPITAL.findall(text)) <= 1 + 0.01 * len(text)


class Decoder:
    """The fitted classifier with the letter statistics used to restore lost bytes."""

    def __init__(self, probabilities: np.ndarray, pairs: Counter):
        self.logp = np.log(probabilities).T.astype(np.float32)  # buckets x classes
        # for the scan of everything: the clean classes, and for each chain the best of its classes
        chains = [self.logp[:, (_CHAIN_OF == k) & ~_SWAPPED].max(1) for k in range(1, 1 + len(CHAINS))] + [self.logp[:, _SWAPPED].max(1)]
        self.scan = np.ascontiguousarray(np.column_stack([self.logp[:, _CLEAN], *chains]), dtype=np.float32)
        # no chain can gain more over a clean class than these add up to
        self.bound = np.ascontiguousarray(self.scan[:, len(_CLEAN) :].max(1)[:, None] - self.scan[:, : len(_CLEAN)])
        self.pairs = pairs
        # letter statistics: three in a row, backed by two
        two: Counter = Counter()
        for (a, b, c), n in pairs.items():
            two[(b, c)] += n
        self._logs = {p: float(np.log(n)) for p, n in pairs.items()} | {p: float(np.log(n)) - 5 for p, n in two.items()}
        self._scores: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"_scores": {}}

    @classmethod
    def fit(cls, texts: list[str], rounds: int = 2) -> "Decoder":
        clean = [t for t in texts if t and plausible(t)]
        model = cls._fit_once(clean)
        for _ in range(rounds - 1):
            clean = [t for t, r in zip(clean, model.repair(clean)) if r is None]
            model = cls._fit_once(clean)
        return model

    @classmethod
    def _fit_once(cls, clean: list[str]) -> "Decoder":
        by_script: dict[bool, list[str]] = {False: [" "], True: [" "]}
        for t in clean:
            for line in t.split("\n"):
                by_script[len(_CYR.findall(line)) > len(_LAT.findall(line))].append(line)
        joined = {c: "\n".join(lines) for c, lines in by_script.items()}
        rows = []
        for k, cyrillic, capitals in CLASSES:
            t = joined[cyrillic].upper() if capitals else joined[cyrillic]
            t = t.translate(_TABLES[CHAINS[k - 1]]) if k else t
            raw = np.frombuffer(f" {t} ".encode("utf-8", "replace"), np.uint8)
            c = np.bincount(_buckets(raw)[1], minlength=BUCKETS).astype(np.float64)
            rows.append((1 - SMOOTH) * c / max(1.0, c.sum()) + SMOOTH / BUCKETS)
        body = (joined[True] + "\n" + joined[False]).lower()
        return cls(np.array(rows), Counter(zip(body, body[1:], body[2:])))

    def suspicious(self, texts: list[str]) -> np.ndarray:
        """For each text, whether any of its words or stretches reads better as garbled than as clean text.

        Most texts are settled by the bound, which is never less than the gain; only the others are scored by chain."""
        out = np.zeros(len(texts), bool)
        todo = [i for i, t in enumerate(texts) if t and not t.isascii()]
        perhaps = self._scan(texts, todo, self.bound, lambda word, line: (word.min(1) > WORD_MARGIN, line.min(1) > MARGIN))
        clean = len(_CLEAN)

        def exceed(word: np.ndarray, line: np.ndarray):
            word, line = word - _SCAN_PRIOR, line - _SCAN_PRIOR
            return word[:, clean:].max(1) - word[:, :clean].max(1) > WORD_MARGIN, line[:, clean:].max(1) - line[:, :clean].max(1) > MARGIN

        out[perhaps] = True
        out[perhaps] = self._scan(texts, perhaps, self.scan, exceed, flags=True)
        return out

    def _scan(self, texts: list[str], todo, columns: np.ndarray, exceed, flags: bool = False):
        """The texts of todo in which a word or a stretch exceeds; as numbers, or as flags in the order of todo."""
        out = np.zeros(len(texts), bool)
        todo = list(todo)
        k = 0
        while k < len(todo):
            part, size = [], 0
            while k < len(todo) and (not part or size < SLICE_BYTES):
                part.append(todo[k])
                size += len(texts[todo[k]])
                k += 1
            raws = [texts[i].encode("utf-8", "replace").replace(_NOT_SIGN, b"--\n") for i in part]
            raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
            ends = np.cumsum([len(r) + 1 for r in raws])
            part = np.asarray(part)
            for lo, hi in self._spans(raw):
                piece = raw[lo:hi]
                at, h = _buckets(piece)
                if not len(at):
                    continue
                words = np.cumsum((piece == 32) | (piece == 10), dtype=np.int32)[at]
                starts = np.flatnonzero(np.diff(words, prepend=-1))
                sums = np.add.reduceat(np.take(columns, h, axis=0), starts, axis=0)
                line = np.cumsum(_END[piece], dtype=np.int32)[at[starts]]
                first = np.flatnonzero(np.diff(line, prepend=-1))
                # one chain, and one kind of clean text, for a whole stretch
                by_word, lines = exceed(sums, np.add.reduceat(sums, first, axis=0))
                bad = np.concatenate([starts[by_word], starts[first[lines]]])
                out[part[np.searchsorted(ends, at[bad] + 1 + lo, side="right")]] = True
            for i in part:
                out[i] |= LOST in texts[i]
        return out[todo] if flags else np.flatnonzero(out)

    @staticmethod
    def _spans(raw: np.ndarray) -> Iterator[tuple[int, int]]:
        """Slices of bounded size, so that one huge text costs no more memory; cut after a line or space where possible."""
        lo = 0
        while lo < len(raw):
            hi = min(len(raw), lo + SLICE_BYTES)
            if hi < len(raw):
                gaps = np.flatnonzero((raw[lo:hi] == 10) | (raw[lo:hi] == 32))
                hi = lo + int(gaps[-1]) + 1 if len(gaps) else hi
            yield lo, hi
            lo = hi

    def score(self, text: str) -> np.ndarray:
        """The gain in log-likelihood of a text as each chain, by chain number, over clean text (0); last, that of clean text."""
        kept = self._scores.get(text)
        if kept is None:
            raw = np.frombuffer(f" {text} ".encode("utf-8", "replace"), np.uint8)
            each = self.logp[_buckets(raw)[1]].sum(0) - _PRIOR
            kept = np.full(1 + len(CHAINS), -np.inf)
            np.maximum.at(kept, _CHAIN_OF, each)
            kept = np.append(kept - kept[0], kept[0])
            if len(text) < 40:
                if len(self._scores) > 50_000:
                    self._scores.clear()
                self._scores[text] = kept
        return kept

    def repair(self, texts: list[str]) -> list[tuple[str, list[str], bool] | None]:
        """For each text None if clean, else (text as far as restored, chains found, wholly restored)."""
        flags = self.suspicious(texts)
        return [self.repair_one(t) if f else None for t, f in zip(texts, flags)]

    def repair_one(self, text: str) -> tuple[str, list[str], bool] | None:
        names: dict[str, None] = {}
        if LOST not in text and (done := self._undo(text, self.score(text), MARGIN, names)) is not None:
            if LOST not in done and not self.suspicious([done])[0]:
                return done, list(names), True
            names.clear()  # only a part of the text is garbled
        parts = _STRETCH.split(text)
        done = "".join(self._stretch(part, names) if bad else part for part, bad in zip(parts, self.suspicious(parts)))
        if LOST in done:
            names["lost"] = None
        return (done, list(names), LOST not in done) if names else None

    def _stretch(self, part: str, names: dict[str, None]) -> str:
        """The stretch under its likeliest chain, else with its words decided one by one."""
        if LOST not in part:
            done = self._undo(part, self.score(part), MARGIN, names)
            if done is not None:
                return done
        prior = self.score(part)[:-1]
        prior = np.where(np.isfinite(prior), np.clip(prior, -20, 20), -20)

        def one(m: re.Match) -> str:
            word = m[0]
            if word.isascii():
                return word
            if word[-1] == "¬":  # a hyphen at the end of a scanned line
                return _WORD.sub(one, word[:-1]) + "¬"
            score = self.score(word)
            gain = np.where(score[:-1] == 0, 0, score[:-1] + 0.4 * prior)
            done = self._undo(word, np.append(gain, score[-1]), WORD_MARGIN, names)
            return word if done is None else done

        return _WORD.sub(one, part)

    def _undo(self, text: str, gain: np.ndarray, margin: float, names: dict[str, None]) -> str | None:
        """The text before the likeliest chain that beats clean text by the margin, decodes strictly and then reads clean."""
        for k in np.argsort(-gain[:-1]):
            if k == 0 or gain[k] <= margin:
                break
            done = self._restore(text, CHAINS[k - 1]) if LOST in text else invert(text, CHAINS[k - 1])
            if done is None or done == text:
                continue
            after = self.score(done)
            if done.isascii() or LOST in done or (after[1:-1].max() <= margin and after[-1] > gain[-1] + margin):
                names[_name(CHAINS[k - 1])] = None
                return done
        return None

    def _restore(self, word: str, chain: tuple[str, str, int]) -> str | None:
        """A UTF-8 word with the bytes that its wrong encoding can't show put back: of the strict readings the likeliest."""
        true, read, times = chain
        if true != "utf-8" or read == "latin-1" or 2 * word.count(LOST) > len(word):
            return None
        missing = b"\x81\x8d\x8f\x90\x9d" if read == "cp1252" else b"\x98"
        if times == 2:
            inner = self._restore(word, (true, read, 1))
            return None if inner is None else (self._restore(inner, (true, read, 1)) if LOST in inner else invert(inner, (true, read, 1)))
        try:
            raw = [missing if c == LOST else (bytes([ord(c)]) if 0x80 <= ord(c) <= 0x9F else c.encode(read)) for c in word]
        except UnicodeEncodeError:
            return None
        # readings letter by letter: (likelihood, text so far, bytes of an unfinished letter)
        beams: list[tuple[float, str, bytes]] = [(0.0, " ", b"")]
        for options in raw:
            grown = []
            for total, done, open_ in beams:
                for byte in [options[i : i + 1] for i in range(len(options))] if options is missing else [options]:
                    held = open_ + byte
                    try:
                        c = held.decode("utf-8")
                    except UnicodeDecodeError as e:
                        if e.reason == "unexpected end of data" and len(held) < 4:
                            grown.append((total, done, held))
                        continue
                    low = c.lower()
                    a, b = done[-2:-1].lower(), done[-1].lower()
                    grown.append((total + (self._logs.get((a, b, low[0])) or self._logs.get((b, low[0]), _UNSEEN)), done + c, b""))
            beams = sorted(grown, key=lambda x: (-x[0], x[1]))[:8]
        return next((done[1:] for _, done, open_ in beams if not open_), None)


_UNSEEN = float(np.log(0.1)) - 5
_NOT_SIGN = "¬\n".encode()
_END = np.zeros(256, bool)
_END[np.frombuffer(b"\n.:;!?|", np.uint8)] = True
_C1, _LETTER = re.compile("[\x80-\x9f]"), re.compile(r"[^\W\d_]")
_CYR, _LAT = re.compile("[а-яё-їґА-ЯЁ-ЇҐ]"), re.compile("[a-zA-Zäöüß]")
_TABLES = {c: _forward(*c) for c in CHAINS}


def _name(chain: tuple[str, str, int]) -> str:
    return f"{chain[0]} read as {chain[1]}" + (" twice" if chain[2] == 2 else "")


def sample_texts(df: DataFrame, key: str, text: str, limit: int = SAMPLE, chars: int = SAMPLE_CHARS) -> list[str]:
    """A bounded sample spread evenly by the hash of the key: the training rows, about limit and never more than twice that.

    A row is drawn by its own hash against limit / rows, so no task ranks or sends more than its share."""
    n = df.count()
    if not n:
        return []
    share = min(1.0, limit / n)
    drawn = F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)
    rows = df.where(drawn & F.length(text).between(1, chars)).select(F.xxhash64(key).alias("h"), F.col(text).alias("t")).limit(2 * limit).collect()
    return [r.t for r in sorted(rows)]


def records(chunks: DataFrame, document_records: DataFrame) -> DataFrame:
    """(record_kind, record_id, text) of all chunks and of the newest title of each document."""
    c = chunks.select(F.lit("chunk").alias("record_kind"), F.col("chunk_id").alias("record_id"), "text")
    newest = document_records.where("document_id is not null").groupBy("document_id").agg(F.max(F.struct("loaded_at", "title")).alias("r"))
    t = newest.select(F.lit("title").alias("record_kind"), F.col("document_id").alias("record_id"), F.col("r.title").alias("text"))
    return c.unionByName(t).where("record_id is not null and length(text) > 0")


def fit(chunks: DataFrame, document_records: DataFrame, limit: int = SAMPLE) -> Decoder:
    """The classifier, trained on a bounded sample of chunks and titles."""
    return Decoder.fit(sample_texts(chunks, "chunk_id", "text", limit) + sample_texts(document_records, "document_id", "title", limit))


_OUT = "record_kind string, record_id string, text string, chains string, recovered boolean"


def _suspects(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 1000):
                part = pdf.iloc[lo : lo + 1000]
                yield part[shared.value.suspicious(part["text"].tolist())]

    return run


def _repair(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for pdf in batches:
            rows = []
            for kind, key, text in zip(pdf["record_kind"], pdf["record_id"], pdf["text"]):
                done = model.repair_one(text)
                if done is not None:
                    rows.append((kind, key, done[0], "; ".join(done[1]), done[2]))
            yield pd.DataFrame(rows, columns=["record_kind", "record_id", "text", "chains", "recovered"])

    return run


def repaired(chunks: DataFrame, document_records: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """(record_kind, record_id, text, chains, recovered): the affected records with their text as far as it comes back.

    All texts are scanned where they are read; only suspects move, spread evenly, since one document may hold most of them."""
    spark = chunks.sparkSession
    shared = spark.sparkContext.broadcast(fit(chunks, document_records, limit))  # BUCKETS x classes numbers and letter pairs: a few MB
    suspects = records(chunks, document_records).mapInPandas(_suspects(shared), "record_kind string, record_id string, text string")
    spread = suspects.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "record_kind", "record_id")
    return spread.mapInPandas(_repair(shared), _OUT).dropDuplicates(["record_kind", "record_id"])


def found(chunks: DataFrame, document_records: DataFrame) -> DataFrame:
    """(record_kind, record_id) of the affected records."""
    return repaired(chunks, document_records).select("record_kind", "record_id")
