"""Text views with reversible offsets, and the tokenizers that work on them.

Views are built by Arrow-batched UDFs, one regular-expression pass per text; everything that Spark's own functions can express
(offset lookups, tokens, shingles, trigrams) is a Column expression.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VIEW = "text string, runs array<struct<ss: int, se: int, ts: int, te: int>>"


def _class(*ranges: tuple[int, int]) -> str:
    """The inside of a character class of code-point ranges."""
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges)


#: Combining marks; line separators beside CR and LF; space separators; control, format and private characters.
_COMBINING = _class((0x300, 0x36F), (0x483, 0x487))
_LINES = _class((0x0B, 0x0C), (0x1C, 0x1E), (0x85, 0x85), (0x2028, 0x2029))
_SPACES = _class((0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
_DROPPED = _class((0, 8), (0x0E, 0x1B), (0x1F, 0x1F), (0x7F, 0x84), (0x86, 0x9F), (0xAD, 0xAD), (0x600, 0x605), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xD800, 0xF8FF), (0xFEFF, 0xFEFF), (0xFFF9, 0xFFFB))
_SPECIAL = re.compile(f"(?P<line>\r\n?|[{_LINES}])|(?P<space>[{_SPACES}])|(?P<drop>[{_DROPPED}])|(?P<cluster>[^{_COMBINING}][{_COMBINING}]+)")


class _Runs:
    """Pieces of a view with their runs; neighbouring one-to-one runs are one."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.runs: list[list[int]] = []
        self.size = 0

    def add(self, ss: int, se: int, piece: str) -> None:
        if not piece:
            return
        te = self.size + len(piece)
        last = self.runs[-1] if self.runs else None
        if last and se - ss == len(piece) and last[1] - last[0] == last[3] - last[2] and last[1] == ss:
            last[1], last[3] = se, te
        else:
            self.runs.append([ss, se, self.size, te])
        self.text.append(piece)
        self.size = te

    def done(self) -> tuple[str, list[tuple[int, int, int, int]]]:
        return "".join(self.text), [tuple(r) for r in self.runs]


def canonical_text(text: str) -> tuple[str, list[tuple[int, int, int, int]]]:
    """Line ends to LF, space separators to a space, controls dropped, clusters composed (NFC); and the offset runs."""
    out, at = _Runs(), 0
    for m in _SPECIAL.finditer(text):
        if m.start() > at:
            out.add(at, m.start(), text[at : m.start()])
        piece = {"line": "\n", "space": " ", "drop": ""}.get(m.lastgroup)
        out.add(m.start(), m.end(), unicodedata.normalize("NFC", m[0]) if piece is None else piece)
        at = m.end()
    if at < len(text):
        out.add(at, len(text), text[at:])
    return out.done()


_FOLD = re.compile(r"\s+|[^\s\x00-\x7f]|[A-Z]+")


def search_text(text: str) -> tuple[str, list[tuple[int, int, int, int]]]:
    """White space runs to one space, none at the ends, case folded, ё as е; and the offset runs."""
    out, at = _Runs(), 0
    for m in _FOLD.finditer(text):
        if m.start() > at:
            out.add(at, m.start(), text[at : m.start()])
        piece = m[0]
        if piece.isspace():
            piece = " " if out.size and m.end() < len(text) else ""
        else:
            piece = {"ё": "е", "Ё": "е"}.get(piece) or piece.casefold()
        out.add(m.start(), m.end(), piece)
        at = m.end()
    if at < len(text):
        out.add(at, len(text), text[at:])
    return out.done()


def _views(make):
    @F.pandas_udf(VIEW)
    def view(texts: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if t is None else make(t) for t in texts]
        return pd.DataFrame([(t, None if r is None else [dict(zip(("ss", "se", "ts", "te"), x)) for x in r]) for t, r in rows], columns=["text", "runs"])

    return view


def canonical_view(column: str | Column) -> Column:
    """struct<text, runs>; null for a null text."""
    return _views(canonical_text)(column)


def search_view(column: str | Column) -> Column:
    """struct<text, runs> of an already canonical text; null for a null text."""
    return _views(search_text)(column)


def to_source(runs: str | Column, position: str | Column) -> Column:
    """Where a position of the view lies in its source: exact in one-to-one runs, else the run's start; past the end, its end."""
    runs, position = (F.col(x) if isinstance(x, str) else x for x in (runs, position))
    before = F.filter(runs, lambda r: r["ts"] <= position)
    last = F.try_element_at(before, F.lit(-1))
    inside = last["ss"] + F.when(last["se"] - last["ss"] == last["te"] - last["ts"], position - last["ts"]).otherwise(F.lit(0))
    return F.when(position >= last["te"], last["se"]).otherwise(inside)


def normalize_for_scoring(column: str | Column) -> Column:
    """NFKC, punctuation and symbols to spaces, controls dropped, small letters, single spaces."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    spaced = F.regexp_replace(run(column), r"[\p{P}\p{S}]", " ")
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(spaced, r"\p{C}", "")), r"(?U)\s+", " "))


def ascii_slug(column: str | Column, max_bytes: int = 60) -> Column:
    """ASCII letters and digits joined by hyphens, cut at a word boundary."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            if t is None:
                return None
            s = re.sub(r"[^a-z0-9]+", "-", unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()).strip("-")
            return s if len(s) <= max_bytes else (s[: max_bytes + 1].rsplit("-", 1)[0] if "-" in s[: max_bytes + 1] else s[:max_bytes]).strip("-")

        return texts.map(one)

    return run(column)


def encode_token(text: str) -> str:
    """A path-safe token: letters, digits, dot and hyphen stay, every other byte becomes _hh."""
    return "".join(c if c.isascii() and (c.isalnum() or c in ".-") else "".join(f"_{b:02x}" for b in c.encode()) for c in text)


def decode_token(token: str) -> str:
    """The text of encode_token."""
    return re.sub(r"(?:_[0-9a-f]{2})+", lambda m: bytes.fromhex(m[0].replace("_", "")).decode(), token)


def tokens(column: str | Column, limit: int | None = None) -> Column:
    """Pieces between single spaces: the limit counts before empty pieces are dropped."""
    pieces = F.split(column, " ")
    pieces = F.slice(pieces, 1, limit) if limit else pieces
    return F.filter(pieces, lambda t: t != "")


def words(column: str | Column) -> Column:
    """Runs of letters and digits of any script, in small letters."""
    return F.regexp_extract_all(F.lower(column), F.lit(r"(?U)[\p{L}\p{N}]+"), F.lit(0))


def shingles(words_column: Column, size: int = 5) -> Column:
    """Contiguous word n-grams as strings; a shorter text is one shingle of all its words, an empty one has none; null stays null."""

    def grams(w: Column) -> Column:
        n = F.size(w)
        runs = F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.array_join(F.slice(w, i, size), " "))
        return F.when(n >= size, runs).when(n > 0, F.array(F.array_join(w, " "))).when(n == 0, F.array().cast("array<string>"))

    # bound by a lambda, the words are computed once and not for every n-gram
    return F.transform(F.array(words_column), grams)[0]


def char_trigrams(token: Column) -> Column:
    """Character trigrams of a token padded by ^ and $."""
    padded = F.concat(F.lit("^"), token, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))


_END = re.compile(r"[.!?…]+[\"')\]}»”’]*(?=(\s+)(.))", re.S)


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Sentences without a lost character: a stop ends one if space follows, then a capital, digit or opener, and the word
    before has two letters or digits at least."""
    spans, opened = [], 0
    for m in _END.finditer(text):
        head = re.search(r"[^\W_]*$", text[: m.start()][-80:])
        if len(head[0]) >= 2 and (m[2].isupper() or m[2].isdigit() or m[2] in "\"'([{«“‘"):
            gap = m.end() + len(m[1])
            spans.append((opened, gap))
            opened = gap
    if opened < len(text):
        spans.append((opened, len(text)))
    return spans


#: Words too common to tell texts apart.
STOP_WORDS = ("and", "the", "of", "und", "der", "и", "в", "на")


def word_spans(column: str | Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """array<struct<word, start, end>>: words of letters and digits, case folded, with their places in the text, without stop words."""

    @F.pandas_udf("array<struct<word: string, start: int, end: int>>")
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list | None:
            if t is None:
                return None
            return [{"word": w, "start": m.start(), "end": m.end()} for m in re.finditer(r"[^\W_]+", t) if (w := m[0].casefold()) not in stop]

        return texts.map(one)

    return run(column)


def redact_text(column: str | Column, secrets: tuple[str, ...] = ()) -> Column:
    """A text with values of secret-looking assignments, tokens of shards and stated secrets blotted out."""
    out = F.regexp_replace(F.col(column) if isinstance(column, str) else column, r"(?i)\b(password|secret|token|api_?key|credential)(\s*[=:]\s*)\S+", "$1$2<redacted>")
    out = F.regexp_replace(out, r"\bshard-[0-9a-f]{8,}\b", "shard-<redacted>")
    for s in secrets:
        out = F.replace(out, F.lit(s), F.lit("<redacted>")) if s else out
    return out
