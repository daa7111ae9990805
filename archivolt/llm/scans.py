"""Problem 7: traces of the page in text from scanned documents.

Method: words outside the vocabulary meet every vocabulary word within reach of a Levenshtein automaton, found by running
the automaton over a trie of the vocabulary: up to three shape confusions of scanning, or one edit of any kind.
Candidates are ranked by cost, then by context (does the same text hold the word elsewhere?) and frequency. An edit outside
CONFUSIONS needs more: known words on both sides, which together with the word make no known word (else it is a piece of a
broken one), and an edit that scanning makes. That is learned: edits are counted in chunks that bear other traces of the page
and in those that don't, and edits at home in the latter, such as typists' doubled letters, are left alone.
Then page furniture (page numbers, running headers) is removed, broken words are joined and lines reflowed. A header is a
line with a document's kind and code, or one that recurs in the chunks of its document but for its digits.

The vocabulary is counted over all chunks. It holds words of at least MIN_SHARE of all tokens, so it can't exceed
1 / MIN_SHARE words however large the archive, and only it is broadcast; frequent misreadings leave it again.
Only chunks that may bear a trace are carried beyond the scan, to meet the recurring lines of their documents.

Defined cases: null and empty texts are clean; tables, lists and headings keep their lines; a hyphen is a break unless
both parts are words of their own and the joined word is none; equal chunks are judged alike; a first word in
small letters and a last one without a stop, which the chunker may have cut, are judged only if they hold a digit.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.session import cut

#: A vocabulary word makes up at least this share of all tokens, and occurs at least so often.
MIN_SHARE, MIN_COUNT = 1.5e-6, 5
#: A word so many times rarer than the one it is confused with is a misreading.
RATIO = 25
#: Shapes confused in scanning, read -> meant.
CONFUSIONS = {
    "0": ("o", "о"), "1": ("l", "i", "і"), "3": ("з", "e"), "4": ("ч",), "5": ("s",), "6": ("b", "б"), "8": ("b", "в"), "9": ("g",),
    "c": ("e", "е", "с"), "e": ("е",), "f": ("t",), "l": ("i", "1"), "i": ("l",), "o": ("о",), "a": ("а",), "p": ("р",),
    "ii": ("u",), "li": ("h",), "rn": ("m", "м"), "vv": ("w",), "cl": ("d",),
    "г": ("т",), "л": ("п",), "п": ("л",), "н": ("и",), "и": ("н",),
}
#: Words that label a page number, and their forms around the number.
_PAGE = r"(?:-\s?\d{1,5}\s?-|\[\d{1,5}\]|(?:page|seite|стр\.|стор\.)\s?\d{1,5}(?:\s(?:of|von|из|з)\s\d{1,5})?|(?:p\.|s\.|blatt|лист|аркуш)\s?\d{1,5})"
_PAGE_LINE = re.compile(_PAGE, re.I)
_BARE_NUMBER = re.compile(r"\d{1,4}")
_CODE = r"[A-ZА-Я]{2}[-‐]\d{1,6}(?:/\d{1,3})?"
_HEADER_LINE = re.compile(rf"(?P<before>.*?)\b{_CODE}(?:\s{{2,}}(?:{_PAGE}|\d{{1,5}}))?", re.I)
_BREAK = re.compile(r"([^\W\d_]+)([-¬­])[ \t]*\n[ \t]*([^\W\d_]+)")
_SIGN_AT_END = re.compile(r"[-¬­][ \t]*\n")
_OPEN_BREAK = re.compile(r"([^\W\d_]{2,})([-¬­])$")
_TOKEN = re.compile(r"(?<!\w)[^\W_]++(?!_)")
#: Words joined by a hanging hyphen, as in "pre- and post-audit".
_HANGING = {"and", "or", "und", "oder", "bzw", "sowie", "и", "или", "та", "і", "й", "або"}
_FLUSH = 200_000
#: A line that recurs in so many chunks of its document is a header; least letters of a word judged by any edit.
RECURS, ANY_EDIT = 3, 6
#: An edit seen so often is judged by its record: it must be so many times as frequent in chunks with other traces as elsewhere.
SEEN, ODDS = 3, 2.0


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, line, n): words of all texts, and lines that may be headers as hashes with their document."""
    seen: Counter = Counter()
    lines: Counter = Counter()

    def out():
        yield pd.DataFrame({"word": list(seen), "line": None, "n": list(seen.values())}).astype({"line": "Int64"})
        yield pd.DataFrame({"word": None, "line": list(lines), "n": list(lines.values())}).astype({"word": object, "line": "Int64"})
        seen.clear()
        lines.clear()

    for pdf in batches:
        for document, t in zip(pdf["document_id"], pdf["text"]):
            seen.update(_TOKEN.findall(t.lower()))
            lines.update({line_key(document, x) for _, x, inside in header_like(t) if inside})
            if len(seen) + len(lines) > _FLUSH:
                yield from out()
    yield from out()


_LAYOUT = re.compile(r"\d|\S {2,}\S")
_SENTENCE_END = re.compile(r"[.!?…:;,]['\"»”)]*$")


def header_like(text: str) -> list[tuple[int, str, bool]]:
    """(number, line, whether it interrupts a sentence) of lines that may be running headers: mostly capitalised words, with
    digits, a gap or capitals only."""
    if "\n" not in text:
        return []
    out = []
    filled = [(k, s) for k, line in enumerate(text.split("\n")) if (s := line.strip())]
    for n, (k, s) in enumerate(filled):
        if s[0] == "#" or s[0].islower() or "|" in s or "\t" in s or _SENTENCE_END.search(s) or not (_LAYOUT.search(s) or s.isupper()):
            continue
        words = _TOKEN.findall(s)
        if sum(c.isalpha() for c in s) < 3 or 3 * sum(w[0].islower() for w in words) > len(words):
            continue
        inside = 0 < n < len(filled) - 1 and not _SENTENCE_END.search(filled[n - 1][1]) and filled[n + 1][1][0].islower()
        out.append((k, s, inside))
    return out


def line_key(document: str | None, line: str) -> int:
    """A hash of a line of a document, its digits left out."""
    body = f"{document}\x1f{re.sub(r'[0-9]+', '#', line)}"
    return int.from_bytes(hashlib.blake2b(body.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def counts(chunks: DataFrame) -> DataFrame:
    """(word, line, n) over all texts, summed in each partition before the shuffle."""
    rows = chunks.where("length(text) > 0").select("document_id", "text").mapInPandas(_counts, "word string, line long, n long")
    return rows.groupBy("word", "line").agg(F.sum("n").alias("n"))


def edit_of(read: str, meant: str) -> str:
    """The edit between two words as a class: what was read, an arrow, what was meant; any doubled letter is one class."""
    i = len(os.path.commonprefix([read, meant]))
    j = len(os.path.commonprefix([read[i:][::-1], meant[i:][::-1]]))
    a, b = read[i : len(read) - j], meant[i : len(meant) - j]
    return "doubled" if len(a) == 1 and not b and a in (read[i - 1 : i], read[i + 1 : i + 2]) else f"{a}→{b}"


class Lexicon:
    """The vocabulary as a trie, walked by the automaton of one read word."""

    def __init__(self, counts: dict[str, int], floor: int):
        self.counts, self.floor = counts, floor
        self.trie: dict = {}
        for word in counts:
            node = self.trie
            for c in word:
                node = node.setdefault(c, {})
            node[""] = word
        self._judged: dict[str, list] = {}
        self._any: dict[str, list] = {}
        letters: Counter = Counter()
        for word, n in counts.items():
            for c in set(word):
                letters[c] += n
        # letters of a script that hardly any word has come from wrong decoding
        self.letters = {c for c, n in letters.items() if n >= 0.002 * max(1, max(m for d, m in letters.items() if _script(d) == _script(c)))}

    def __getstate__(self):
        return self.__dict__ | {"_judged": {}, "_any": {}}

    def candidates(self, word: str, confusions: int = 3) -> list[tuple[float, str]]:
        """(cost, vocabulary word): all within one edit of the word or up to so many shape confusions; cheapest first.

        A confusion costs 1, any other edit 10. States are (position in word, edits used, cost) at a node of the trie."""
        best: dict[str, float] = {}
        n = len(word)
        stack = [(self.trie, 0, 0.0, 0, False)]
        seen: dict = {}
        while stack:
            node, i, cost, used, free = stack.pop()
            key = (id(node), i, free)
            if seen.get(key, 999.0) <= cost:
                continue
            seen[key] = cost
            if i == n and "" in node:
                w = node[""]
                best[w] = min(best.get(w, 999.0), cost)
            if i < n:
                c = word[i]
                nxt = node.get(c)
                if nxt is not None:
                    stack.append((nxt, i + 1, cost, used, free))
                if used < confusions and not free:
                    for width in (1, 2):
                        for meant in CONFUSIONS.get(word[i : i + width], ()) if i + width <= n else ():
                            nxt = node.get(meant)
                            if nxt is not None:
                                stack.append((nxt, i + width, cost + 1, used + 1, False))
                if used == 0 and not free:  # the one edit of any kind
                    stack.append((node, i + 1, cost + 10, 1, True))
                    stack.extend((child, i + 1, cost + 10, 1, True) for k, child in node.items() if k and k != c)
            if used == 0 and not free:
                stack.extend((child, i, cost + 10, 1, True) for k, child in node.items() if k)
        best.pop(word, None)
        return sorted((c, w) for w, c in best.items())

    def readings(self, word: str) -> list[tuple[float, str]]:
        """What a read word may have meant, by shape confusions alone; empty if the word is right or beyond repair."""
        kept = self._judged.get(word)
        if kept is None:
            own = self.counts.get(word, 0)
            digit = not word.isalpha()
            kept = []
            if 2 + (not digit) <= len(word) and not word.isdigit():
                kept = [(c, w) for c, w in self.candidates(word) if c <= (3 if len(word) > 6 else 2) - (len(w) < 4 and not digit) and self.counts[w] >= RATIO * own and (digit or self.counts[w] >= 4 * self.floor)]
            if len(self._judged) > 200_000:
                self._judged.clear()
            self._judged[word] = kept
        return kept

    def one_edit(self, word: str) -> list[str]:
        """Vocabulary words one edit of any kind away, for an unknown word of common letters; the most frequent first."""
        kept = self._any.get(word)
        if kept is None:
            kept = []
            if len(word) >= ANY_EDIT and word.isalpha() and set(word) <= self.letters and len({_script(c) for c in word}) == 1:
                kept = [w for c, w in self.candidates(word, 0) if c <= 10 and w.isalpha() and self.counts[w] >= max(RATIO * self.counts.get(word, 0), 4 * self.floor)]
                kept.sort(key=lambda w: (-self.counts[w], w))
            if len(self._any) > 200_000:
                self._any.clear()
            self._any[word] = kept
        return kept

    def without_misreadings(self) -> "Lexicon":
        """The vocabulary without frequent words that are rarer misreadings of others, or mix letters and digits."""
        return Lexicon({w: n for w, n in self.counts.items() if not self.readings(w)}, self.floor)


def _script(c: str) -> str:
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "latin" if c < "ɏ" else "other"


def lexicon(counted: DataFrame) -> Lexicon:
    """The vocabulary of the whole archive, of a size bounded by 1 / MIN_SHARE."""
    words = counted.where("word is not null")
    total = words.agg(F.sum("n")).first()[0] or 0
    floor = max(MIN_COUNT, int(total * MIN_SHARE))
    rows = words.where((F.col("n") >= floor) & F.col("word").rlike(r"\p{L}")).collect()
    return Lexicon({r.word: r.n for r in rows}, floor).without_misreadings()


def header_words(records: DataFrame, share: float = 0.002) -> list[str]:
    """Kinds of document as titles begin (before their code), each of a share of all titles: at most 1 / share of them."""
    kind = F.lower(F.trim(F.regexp_extract("title", rf"^([\p{{L}} ]{{2,40}}?)\s+{_CODE}", 1)))
    counts = records.select(kind.alias("kind")).where("kind <> ''").groupBy("kind").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return sorted(r.kind for r in counts.where(F.col("count") >= max(2, share * total)).collect())


class Cleaner:
    """Finds and repairs what scanning left in one text."""

    def __init__(self, lex: Lexicon, headers: list[str], edits: dict[str, tuple[int, int]] | None = None, chunks: tuple[int, int] = (0, 0)):
        """edits: how many chunks with and without other traces hold each edit; chunks: how many of them there are."""
        self.lex, self.headers = lex, set(headers)
        self.edits, self.chunks = edits or {}, chunks

    def scanned(self, edit: str) -> bool:
        """Whether an edit comes from scanning, as far as its record tells; an edit hardly seen may."""
        traced, clean = self.edits.get(edit, (0, 0))
        if traced + clean < SEEN:
            return edit != "doubled"
        return traced / max(1, self.chunks[0]) >= ODDS * clean / max(1, self.chunks[1])

    def _furniture(self, lines: list[str]) -> list[bool]:
        out = []
        for k, line in enumerate(lines):
            s = line.strip()
            hit = False
            if s and "|" not in s and "\t" not in s:
                if _PAGE_LINE.fullmatch(s):
                    hit = True
                elif _BARE_NUMBER.fullmatch(s):
                    hit = self._prose(lines, k, -1) and self._prose(lines, k, 1) and not (self._edge(lines, k, -1) and self._edge(lines, k, 1))
                else:
                    m = _HEADER_LINE.fullmatch(s)
                    hit = bool(m) and self._kind(m["before"])
            out.append(hit)
        return out

    def _kind(self, before: str) -> bool:
        """The text before a header's code: a kind of document, with or without the name of an office before it."""
        before = before.strip().lower()
        if before in self.headers:
            return True
        parts = re.split(r"\s{2,}", before)
        return len(parts) == 2 and parts[1] in self.headers and len(parts[0].split()) <= 3

    @staticmethod
    def _prose(lines: list[str], k: int, step: int) -> bool:
        """Whether the next filled line in that direction is running text (or there is none)."""
        j = k + step
        while 0 <= j < len(lines) and not lines[j].strip():
            j += step
        if not 0 <= j < len(lines):
            return True
        s = lines[j]
        if "|" in s or "\t" in s:
            return False
        letters = sum(c.isalpha() for c in s)
        return letters >= 3 and (len(s) >= 30 or letters > 0.4 * len(s))

    @staticmethod
    def _edge(lines: list[str], k: int, step: int) -> bool:
        j = k + step
        while 0 <= j < len(lines) and not lines[j].strip():
            j += step
        return not 0 <= j < len(lines)

    def _broken(self, left: str, sign: str, right: str) -> bool:
        """Whether a sign at a line end breaks a word, rather than being its own hyphen."""
        if sign != "-":
            return True
        a, b = left.lower(), right.lower()
        if b in _HANGING:
            return False
        if a + b in self.lex.counts:
            return True
        return not (a in self.lex.counts and b in self.lex.counts)

    def inspect(self, text: str, recurring: set[int] = frozenset(), guess: bool = False) -> tuple[list[str], str, list[str]] | None:
        """(what was found, the text as continuous paragraphs, edits outside CONFUSIONS), or None if the text bears no trace of a page.

        recurring are numbers of lines that recur in the document. With guess the edits are named, not judged by their record."""
        found: list[str] = []
        work = text
        if "\n" in text:
            lines = text.split("\n")
            furniture = [hit or k in recurring for k, hit in enumerate(self._furniture(lines))]
            if any(furniture):
                found.append("furniture")
                work = self._drop(lines, furniture)
        if "\n" in work or work[-1:] in "-¬­ \n":
            hits = 0

            def join(m: re.Match) -> str:
                nonlocal hits
                if not self._broken(m[1], m[2], m[3]):
                    return m[1] + "-" + ("" if m[3].lower() not in _HANGING else " ") + m[3]
                hits += 1
                return m[1] + m[3]

            if _SIGN_AT_END.search(work):
                work = _BREAK.sub(join, work)
            tail = _OPEN_BREAK.search((work.rsplit(None, 1) or [""])[-1].rstrip())
            if tail and (tail[2] != "-" or tail[1].lower() not in self.lex.counts) and "\n" in text:
                hits += 1
            if hits:
                found.append("broken words")
        words = _TOKEN.findall(work.lower())
        odd = set(words) - self.lex.counts.keys()
        edits: list[str] = []
        if odd:
            held = set(words)
            fixes = {}
            # the chunker may have cut these
            ends = ({words[0]} if work[:1].islower() else set()) | ({words[-1]} if work[-1:].isalnum() else set())
            for w in odd:
                if w.isdigit() or (w in ends and w.isalpha()):
                    continue
                readings = self.lex.readings(w)
                if readings:
                    cost = readings[0][0]
                    fixes[w] = min(readings, key=lambda r: (r[0] - 0.5 * (r[1] in held), -self.lex.counts[r[1]], r[1]))[1] if cost else w
                elif (guess := self._digits(w)) is not None:
                    fixes[w] = guess
            fixes = {w: f for w, f in fixes.items() if self._lower_case_somewhere(w, work)}
            for w, meant in self._any_edit(words, odd - fixes.keys(), held):
                if guess:
                    edits.append(edit_of(w, meant))
                elif self.scanned(edit_of(w, meant)):
                    fixes[w] = meant
            if fixes:
                found.append("misread characters")
                work = _TOKEN.sub(lambda m: _cased(fixes[m[0].lower()], m[0]) if m[0].lower() in fixes else m[0], work)
        return (found, reflow(work) if not guess else text, edits) if found or edits else None

    def _any_edit(self, words: list[str], odd: set[str], held: set[str]) -> Iterator[tuple[str, str]]:
        """(word, meant) of unknown words one edit from a known one, between known words with which they make none."""
        known = self.lex.counts
        done = set()
        for k in range(1, len(words) - 1):
            w, before, after = words[k], words[k - 1], words[k + 1]
            if w in odd and w not in done and (options := self.lex.one_edit(w)):
                done.add(w)
                plain = max(len(before), len(after)) > 1 and all(x in known or x.isdigit() for x in (before, after)) and not {before + w, w + after, before + w + after} & known.keys()
                if plain:
                    yield w, min(options, key=lambda x: (edit_of(w, x) != "doubled", x not in held, -known[x], x))

    @staticmethod
    def _digits(w: str) -> str | None:
        """An unknown word with one or two digits among many letters: the digits read as the letters they look like."""
        digits = sum(c.isdigit() for c in w)
        if not 0 < digits <= 2 or len(w) - digits < 4 or not all(c.isalpha() or c in CONFUSIONS for c in w) or w[0].isdigit() and w[1:2].isdigit():
            return None
        cyrillic = any("а" <= c <= "ї" for c in w)
        return "".join(next((m for m in CONFUSIONS[c] if ("а" <= m <= "ї") == cyrillic), CONFUSIONS[c][0]) if c.isdigit() else c for c in w)

    @staticmethod
    def _lower_case_somewhere(w: str, text: str) -> bool:
        """Codes such as H2SO4 or KB4 are no words: a word with digits counts only if it isn't part of a code."""
        if w.isalpha():
            return True
        for m in re.finditer(re.escape(w), text, re.I):
            before, after = text[max(0, m.start() - 1) : m.start()], text[m.end() : m.end() + 1]
            if before not in ("_", "/") and after not in ("_", "/"):
                return True
        return False

    @staticmethod
    def _drop(lines: list[str], furniture: list[bool]) -> str:
        """The lines without furniture; a paragraph that a page break cut in two is one again."""
        kept: list[str] = []
        k = 0
        while k < len(lines):
            if not furniture[k]:
                kept.append(lines[k])
                k += 1
                continue
            while k < len(lines) and (furniture[k] or not lines[k].strip()):
                k += 1
            while kept and not kept[-1].strip():
                kept.pop()
            if kept and k < len(lines) and re.search(r"[.!?…:]['\"»”)]*\s*$", kept[-1]):
                kept.append("")
        return "\n".join(kept)


def _cased(word: str, like: str) -> str:
    letters = [c for c in like if c.isalpha()]
    if letters and all(c.isupper() for c in letters) and len(letters) > 1:
        return word.upper()
    return word[:1].upper() + word[1:] if like[:1].isupper() else word


def reflow(text: str) -> str:
    """Lines of a paragraph become one; tables, lists and headings keep theirs."""
    out = []
    for block in re.split(r"\n[ \t]*\n\s*", text):
        lines = [x.strip() for x in block.split("\n")]
        keep = any("|" in x or "\t" in x for x in lines) or all(re.match(r"[\d\s;,.]+$", x) for x in lines if x)
        if keep or (lines and lines[0].startswith("#")):
            out.append("\n".join(lines))
        else:
            out.append(re.sub(r"\s+", " ", " ".join(lines)).strip())
    return "\n\n".join(out)


_OUT = "chunk_id string, text string, traces string"
_SUSPECT = "chunk_id string, text string, sure boolean, edits array<string>, lines array<struct<at: int, key: long>>"


def _suspects(shared):
    """Chunks with traces, with edits that may be traces, or with lines that may be headers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cleaner = shared.value
        for pdf in batches:
            rows = []
            for chunk_id, document, text in zip(pdf["chunk_id"], pdf["document_id"], pdf["text"]):
                seen = cleaner.inspect(text, guess=True)
                lines = [{"at": k, "key": line_key(document, x)} for k, x, _ in header_like(text)]
                if seen is not None or lines:
                    rows.append((chunk_id, text, bool(seen and seen[0]), seen[2] if seen else [], lines))
            yield pd.DataFrame(rows, columns=["chunk_id", "text", "sure", "edits", "lines"])

    return run


def _clean(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cleaner = shared.value
        for pdf in batches:
            rows = []
            for chunk_id, text, recurring in zip(pdf["chunk_id"], pdf["text"], pdf["recurring"]):
                seen = cleaner.inspect(text, set() if recurring is None else set(recurring))
                if seen is not None and seen[0]:
                    rows.append((chunk_id, seen[1], "; ".join(seen[0])))
            yield pd.DataFrame(rows, columns=["chunk_id", "text", "traces"])

    return run


def repaired(chunks: DataFrame, records: DataFrame) -> DataFrame:
    """(chunk_id, text, traces): the chunks that bear traces of the page, with their text in continuous paragraphs."""
    sc = chunks.sparkSession.sparkContext
    counted = cut(counts(chunks))
    lex, kinds = lexicon(counted), header_words(records)
    first = sc.broadcast(Cleaner(lex, kinds))
    texts = chunks.where("chunk_id is not null and length(text) > 0").select("chunk_id", "document_id", "text")
    suspects = cut(texts.mapInPandas(_suspects(first), _SUSPECT))
    kind = suspects.select("sure", F.explode(F.array_distinct("edits")).alias("edit")).groupBy("edit").agg(F.count_if("sure").alias("traced"), F.count_if(~F.col("sure")).alias("clean"))
    edits = {r.edit: (r.traced, r.clean) for r in kind.where(F.col("traced") + F.col("clean") >= SEEN).collect()}  # at most pairs of letters
    traced = suspects.where("sure").count()
    judge = sc.broadcast(Cleaner(lex, kinds, edits, (traced, texts.count() - traced)))
    recurs = counted.where(F.col("line").isNotNull() & (F.col("n") >= RECURS)).select(F.col("line").alias("key"))
    lines = suspects.select("chunk_id", F.explode("lines").alias("l")).select("chunk_id", F.col("l.at").alias("at"), F.col("l.key").alias("key"))
    headers = lines.join(recurs, "key").groupBy("chunk_id").agg(F.collect_set("at").alias("recurring"))  # lines of one chunk
    return suspects.select("chunk_id", "text").join(headers, "chunk_id", "left").mapInPandas(_clean(judge), _OUT)


def found(chunks: DataFrame, records: DataFrame) -> DataFrame:
    """(chunk_id) of the affected chunks."""
    return repaired(chunks, records).select("chunk_id").distinct()
