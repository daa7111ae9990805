"""Problem 10: the subject areas of each document.

Method: latent Dirichlet allocation, fitted over all documents without any label. Paragraphs and tables are the bags of words.
Topics start from clusters of a bounded sample of paragraphs; online variational EM follows: the documents are dealt to BATCHES,
in each round every partition infers the proportions of its paragraphs of one batch under the current topics and returns
expected word counts, which move the topics. Every document takes part in every epoch.
Only then labels are looked at: each topic is mapped to a subject through its top terms, whose shares among labelled texts vote;
a topic whose terms point nowhere stays unmapped. Topics of one subject are merged, which a few rounds over all documents settle.
A document gets the subjects that its paragraphs are devoted to by their topic proportions; a stray term in another subject's
paragraph is none.

Bounds: the vocabulary holds words of at least MIN_SHARE of all documents, counted over all of them, so that its size can't
grow with the archive (it is at most the words of an average document over MIN_SHARE); words of more than STOP_SHARE of the
documents are stop words (stop_share; to be raised for an archive of one or two subjects). Subjects are a fixed table; more than MAX_SUBJECTS of them are refused.

Defined cases: rows without a doc_id are left out; null and empty texts have no subject; unknown labels and labels of missing documents are ignored; without any
label nothing is assigned; repeated documents are judged alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivolt.functions import codepoints, wordhash
from archivolt.session import broadcast_if_small, cut

#: Least share and number of documents of a vocabulary word, and the greatest share.
MIN_SHARE, MIN_DOCUMENTS, STOP_SHARE = 3e-4, 3, 0.04
#: Topics; paragraphs from which they start (a bounded sample); batches of an epoch; epochs; rounds after merging; steps inside.
TOPICS, SAMPLE, BATCHES, EPOCHS, ROUNDS, STEPS = 96, 6000, 12, 2, 3, 3
#: Unmapped topics that remain beside the subjects after merging.
BACKGROUND = 8
#: Dirichlet priors of a paragraph's proportions and of a topic's words; how fast later batches count less.
ALPHA, ETA, DECAY = 0.05, 0.01, 0.6
#: A topic belongs to a subject if the vote of so many of its top terms is.
TOP_TERMS, VOTE = 25, 0.4
#: Expected words of its subject that a paragraph needs, and their share among all subject words of it.
LEAST_WORDS, LEAST_SHARE = 0.9, 0.5
#: So few words are a stray term where their subject makes up less than this share of the document's subject words.
STRAY_WORDS, STRAY_SHARE = 2.5, 0.1
SEED = 3
MAX_SUBJECTS = 10_000
_IS = codepoints.lookup(digit="0123456789_", line="\n\0", space=" \t\r ")
#: The same as one table: 1 part of a code, 2 line end, 4 something other than space.
_KIND = (_IS["digit"] + 2 * _IS["line"] + 4 * ~(_IS["line"] | _IS["space"])).astype(np.uint8)
#: Characters tokenised at once, and words inferred at once: as many as stay in a core's cache.
CHARACTERS, WORDS = 200_000, 2000


def _bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, paragraph) of every word of letters; paragraphs, numbered through, end at blank lines."""
    h, owner, start, end = wordhash.words(texts)
    cp, begin = codepoints.join(texts)
    # a word with a digit or beside an underscore is part of a code
    kind = _KIND[cp]
    digits = np.zeros(len(cp) + 1, np.int32)
    np.cumsum(kind & 1, out=digits[1:])
    a, b = begin[owner] + start, begin[owner] + end
    plain = digits[np.minimum(b + 1, len(cp))] == digits[np.maximum(a - 1, 0)]
    # blank: a line end followed by another with nothing but space between
    ends = np.flatnonzero(kind & 2)
    seen = np.zeros(len(cp) + 1, np.int32)
    np.cumsum(kind >> 2, out=seen[1:])
    empty = np.append(False, seen[ends[1:]] == seen[ends[:-1]]) if len(ends) else np.zeros(0, bool)
    blank = np.zeros(len(cp) + 1, np.int32)
    blank[ends[empty | (cp[ends] == 0)]] = 1
    paragraph = np.cumsum(blank)[a]
    # two letters are an abbreviation, except in scripts that write words with one or two
    keep = plain & ((b - a > 2) | (cp[a] >= 0x2E80))
    return h[keep], owner[keep], paragraph[keep]


def _sums(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word, count) of each word once, its counts added."""
    w = np.concatenate(words)
    order = np.argsort(w, kind="stable")
    w = w[order]
    first = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.zeros(0, np.int64)
    return w[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(w) else np.zeros(0, np.int64)


def _df(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words, counts, size, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0, 0
    for pdf in batches:
        texts = pdf["text"].tolist()
        for lo, hi in codepoints.slices(texts, CHARACTERS):
            h, owner, _ = _bags(texts[lo:hi])
            n += hi - lo
            u, at = np.unique(h, return_inverse=True)
            # every word once a text
            pair = np.sort(at * (hi - lo) + owner)
            pair = pair[np.append(True, pair[1:] != pair[:-1])] if len(pair) else pair
            words.append(u)
            counts.append(np.bincount(pair // (hi - lo), minlength=len(u)))
            size += len(u)
            if size > 1_000_000:
                w, c = _sums(words, counts)
                if len(w) > 500_000:
                    yield pd.DataFrame({"word": w.view(np.int64), "n": c})
                    w, c = w[:0], c[:0]
                words, counts, size = [w], [c], len(w)
    w, c = _sums(words, counts)
    yield pd.DataFrame({"word": np.append(w.view(np.int64), 0), "n": np.append(c, n)})


def vocabulary(documents: DataFrame, stop_share: float = STOP_SHARE) -> tuple[np.ndarray, np.ndarray, int]:
    """(sorted hashes of the vocabulary without stop words, their document frequencies, number of documents), over all documents."""
    counts = cut(documents.where("length(text) > 0").select("text").mapInPandas(_df, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    n = next((r.n for r in counts.where("word = 0").collect()), 0)
    floor = max(MIN_DOCUMENTS, int(MIN_SHARE * n))
    rows = counts.where((F.col("n") >= floor) & (F.col("n") <= max(floor, stop_share * n)) & (F.col("word") != 0)).collect()
    words, df = np.array([r.word for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows], np.int64)
    order = np.argsort(words)
    return words[order], df[order], n


def _index(vocab: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of each hash in the vocabulary, -1 if none."""
    if not len(vocab):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
    return np.where(vocab[at] == h, at, -1)


def labelled(labels: DataFrame, classes: list[str]) -> DataFrame:
    """(doc_id, class_id) of documents with a single known label."""
    known = labels.where(F.col("class_id").isin(classes)).groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count_distinct("class_id").alias("k"))
    return known.where("k = 1").select("doc_id", "class_id")


def _label_counts(place: dict[str, int]):
    """(class, word, n) of labelled bags, summed in each partition; each text weighs by the root of its counts, so that no long
    one decides alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], float] = {}
        for pdf in batches:
            for raw, c in zip(pdf["words"], pdf["class_id"]):
                word, n = np.unique(np.frombuffer(raw, np.int32), return_counts=True)
                for x, y in zip(word.tolist(), np.sqrt(n).tolist()):
                    total[place[c], x] = total.get((place[c], x), 0.0) + y
        yield pd.DataFrame([(*k, v) for k, v in total.items()], columns=["class", "word", "n"]).astype({"class": "int32", "word": "int32", "n": "float64"})

    return run


def label_counts(bags: DataFrame, labels: DataFrame, items: DataFrame, vocab: np.ndarray, classes: list[str]) -> np.ndarray:
    """Classes x words: how much of each word stands in texts of each class. Bags meet labels by id; no text moves."""
    sc = bags.sparkSession.sparkContext
    held = items.where(F.col("label").isin(classes) & (F.length("query_text") > 0)).select(F.lit(0).cast("long").alias("doc_id"), F.col("query_text").alias("text"), F.col("label").alias("class_id"))
    held = held.mapInPandas(_tokens(sc.broadcast(vocab), "class_id"), "doc_id long, batch int, words binary, paragraphs binary, class_id string")
    docs = bags.join(broadcast_if_small(labelled(labels, classes)), "doc_id").select("class_id", "words")
    rows = docs.unionByName(held.select("class_id", "words")).mapInPandas(_label_counts({c: k for k, c in enumerate(classes)}), "class int, word int, n double")
    out = np.zeros((len(classes), len(vocab)), np.float32)
    for r in rows.groupBy("class", "word").agg(F.sum("n").alias("n")).toLocalIterator():  # at most classes x vocabulary
        out[r["class"], r.word] = r.n
    return out


def _tokens(shared, label: str | None = None):
    """(doc_id, batch, words, paragraphs): vocabulary words of every text; blocks of rows are dealt to the batches in turn."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        vocab = shared.value
        context = TaskContext.get()
        turn = context.partitionId() if context else 0
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy()
            for lo, hi in codepoints.slices(texts, CHARACTERS):
                turn += 1
                h, owner, paragraph = _bags(texts[lo:hi])
                i = _index(vocab, h)
                keep = i >= 0
                i, owner, paragraph = i[keep].astype(np.int32), owner[keep], paragraph[keep].astype(np.int32)
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                ends = np.append(first, len(i))
                paragraph = paragraph - np.repeat(paragraph[first], np.diff(ends))
                w, p, cuts = i.tobytes(), paragraph.tobytes(), (4 * ends).tolist()
                parts = list(zip(cuts, cuts[1:]))
                out = pd.DataFrame({"doc_id": ids[lo + owner[first]], "batch": turn % BATCHES, "words": [w[a:b] for a, b in parts], "paragraphs": [p[a:b] for a, b in parts]})
                yield out.assign(**{label: pdf[label].to_numpy()[lo + owner[first]]}) if label else out

    return run


def _unpack(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, paragraph numbered through, row) of a batch of documents."""
    word, par = (np.frombuffer(b"".join(pdf[c]), np.int32) for c in ("words", "paragraphs"))
    row = np.repeat(np.arange(len(pdf)), [len(x) // 4 for x in pdf["words"]])
    new = (np.diff(row, prepend=-1) != 0) | (np.diff(par, prepend=-1) != 0)
    return word, np.cumsum(new) - 1, row


def _proportions(word: np.ndarray, first: np.ndarray, phi: np.ndarray, alpha: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(theta, expected words of each topic, both bags x topics; weight of each word) by mean-field steps on each bag's proportions.

    A word's shares in the topics are phi * theta / weight. They are nowhere formed: bags of one length are multiplied together,
    about WORDS words at a time, so that their rows of phi are read from the cache in every step."""
    size = np.diff(np.append(first, len(word)))
    theta, expected = np.empty((len(first), len(alpha)), phi.dtype), np.empty((len(first), len(alpha)), phi.dtype)
    weight = np.empty(len(word), phi.dtype)
    order = np.argsort(size, kind="stable")
    lengths, begin = np.unique(size[order], return_index=True)
    for n, lo, hi in zip(lengths.tolist(), begin.tolist(), [*begin[1:].tolist(), len(order)]):
        step = max(1, WORDS // n)
        for k in range(lo, hi, step):
            bags = order[k : min(hi, k + step)]
            at = first[bags][:, None] + np.arange(n)
            likely = phi[word[at]]
            t = np.broadcast_to(alpha, (len(bags), len(alpha)))
            for _ in range(steps):
                w = likely @ t[:, :, None]
                t = t * ((1 / w).transpose(0, 2, 1) @ likely)[:, 0] + alpha
            w = likely @ t[:, :, None]
            theta[bags], weight[at] = t, w[:, :, 0]
            expected[bags] = t * ((1 / w).transpose(0, 2, 1) @ likely)[:, 0]
    return theta, expected, weight


def infer(word: np.ndarray, bag: np.ndarray, phi: np.ndarray, alpha: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Each word's share in each topic, by mean-field steps on its paragraph's proportions. Bags are runs of equal numbers."""
    new = np.diff(bag, prepend=-1) != 0
    theta, _, weight = _proportions(word, np.flatnonzero(new), phi, alpha, steps)
    return phi[word] * theta[np.cumsum(new) - 1] / weight[:, None]


def _expect(shared):
    """Expected word counts of each topic over one partition's documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        phi, alpha = shared.value
        # the sum of theta / weight over each word's places; times phi it is the word's count
        out = np.zeros(phi.shape, np.float32)
        some = False
        for pdf in batches:
            for lo in range(0, len(pdf), 5000):
                some = True
                word, bag, _ = _unpack(pdf.iloc[lo : lo + 5000])
                theta, _, weight = _proportions(word, np.flatnonzero(np.diff(bag, prepend=-1)), phi, alpha)
                order = np.argsort(word, kind="stable")
                word, bag, weight = word[order], bag[order], 1 / weight[order, None]
                for k in range(0, len(word), WORDS):
                    w = word[k : k + WORDS]
                    first = np.flatnonzero(np.diff(w, prepend=-1))
                    out[w[first]] += np.add.reduceat(theta[bag[k : k + WORDS]] * weight[k : k + WORDS], first, axis=0)
        if some:
            yield pd.DataFrame({"z": [(out * phi).tobytes()]})

    return run


#: Tasks that add up the partitions' matrices before the driver sees them.
SUMS = 4


def _add(shape: tuple[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(shape, np.float32)
        for pdf in batches:
            for z in pdf["z"]:
                out += np.frombuffer(z, np.float32).reshape(shape)
        yield pd.DataFrame({"z": [out.tobytes()]})

    return run


def _counts(bags: DataFrame, phi: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Expected counts over all bags: SUMS tasks add up the partitions' matrices, so what reaches the driver doesn't grow."""
    shared = bags.sparkSession.sparkContext.broadcast((phi, alpha))
    out = np.zeros(phi.shape, np.float64)
    for r in bags.mapInPandas(_expect(shared), "z binary").repartition(SUMS).mapInPandas(_add(phi.shape), "z binary").collect():
        out += np.frombuffer(r.z, np.float32).reshape(phi.shape)
    shared.unpersist()
    return out


class Topics:
    """Fitted topics, with the subject each was mapped to (or none)."""

    def __init__(self, vocab, phi, alpha, subject, classes, raw):
        self.vocab, self.phi, self.alpha, self.subject, self.classes, self.raw = vocab, phi, alpha, subject, classes, raw


def start(sample: list[tuple[np.ndarray, np.ndarray]], df: np.ndarray, n: int, topics: int) -> np.ndarray:
    """Topics to start from, words x topics: spherical k-means over the TF-IDF vectors of sampled paragraphs, projected at random."""
    rng = np.random.default_rng(SEED)
    idf = np.log((n + 1) / (df + 0.5))
    bags = [w[p == k] for w, p in sample for k in np.unique(p)]
    bags = [b for b in bags if len(b) >= 4] or [b for b in bags if len(b)]
    bags = [bags[k] for k in rng.permutation(len(bags))[:SAMPLE]]
    topics = max(1, min(topics, len(bags) // 3))
    flat = np.concatenate(bags) if bags else np.zeros(0, np.int64)
    if not len(flat):
        return np.full((len(df), 1), 1.0)
    turn = rng.normal(size=(len(df), 256)).astype(np.float32)
    x = np.stack([(np.sqrt(c)[:, None] * idf[u][:, None] * turn[u]).sum(0) for u, c in (np.unique(b, return_counts=True) for b in bags)])
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    centre = [x[0]]
    far = 1 - x @ centre[0]
    for _ in range(topics - 1):
        q = np.maximum(far, 0) ** 2 + 1e-12
        centre.append(x[rng.choice(len(x), p=q / q.sum())])
        far = np.minimum(far, 1 - x @ centre[-1])
    centre = np.stack(centre)
    for _ in range(10):
        near = (x @ centre.T).argmax(1)
        for k in range(topics):
            if (near == k).any():
                centre[k] = x[near == k].sum(0)
                centre[k] /= np.linalg.norm(centre[k]) + 1e-9
    out = np.zeros((len(df), topics))
    np.add.at(out, (flat, np.repeat(near, [len(b) for b in bags])), 1.0)
    even = np.bincount(flat, minlength=len(df)) + 0.1
    return 0.9 * out / np.maximum(out.sum(0), 1e-9) + 0.1 * (even / even.sum())[:, None]


def topics(documents: DataFrame, epochs: float = EPOCHS, stop_share: float = STOP_SHARE) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """(vocabulary, expected counts words x topics, bags): the topic model, fitted without labels."""
    sc = documents.sparkSession.sparkContext
    vocab, df, n = vocabulary(documents, stop_share)
    texts = documents.where("doc_id is not null and length(text) > 0").select("doc_id", "text")
    bags = cut(texts.mapInPandas(_tokens(sc.broadcast(vocab)), "doc_id long, batch int, words binary, paragraphs binary"))
    if not len(vocab):
        return vocab, np.zeros((0, 1)), bags
    # bags are a small part of the texts; fewer partitions return fewer matrices
    bags = bags.coalesce(max(1, 2 * sc.defaultParallelism))
    total = bags.count()
    share = min(1.0, SAMPLE / max(1, total))
    drawn = bags.where(F.pmod(F.xxhash64("doc_id", "words"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)).select("words", "paragraphs")
    # a few paragraphs of each drawn document: the first ones of long texts, which only start the topics
    rows = drawn.select(F.expr("substring(words, 1, 4000)").alias("words"), F.expr("substring(paragraphs, 1, 4000)").alias("paragraphs")).collect()
    sample = sorted(((np.frombuffer(r.words, np.int32), np.frombuffer(r.paragraphs, np.int32)) for r in rows), key=lambda x: (len(x[0]), x[0].tobytes()))
    mass = start(sample, df, n, TOPICS) * max(1, total)
    alpha = np.full(mass.shape[1], ALPHA, np.float32)
    for k in range(round(epochs * BATCHES)):
        found = _counts(bags.where(F.col("batch") == k % BATCHES), _shares(mass), alpha) * BATCHES
        weight = 1.0 if k == 0 else (k + 1) ** -DECAY
        mass = (1 - weight) * mass + weight * found if found.any() else mass
    return vocab, mass, bags


def _shares(mass: np.ndarray) -> np.ndarray:
    return ((mass + ETA) / (mass + ETA).sum(0)).astype(np.float32)


def fit(documents: DataFrame, labels: DataFrame, items: DataFrame, subjects: DataFrame, **options) -> tuple[Topics, DataFrame]:
    """The topic model mapped to subjects, and the documents as bags of vocabulary words."""
    classes = [r.class_id for r in subjects.where("class_id is not null").select("class_id").distinct().orderBy("class_id").limit(MAX_SUBJECTS + 1).collect()]
    if len(classes) > MAX_SUBJECTS:
        raise ValueError(f"more than {MAX_SUBJECTS} subjects")
    vocab, mass, bags = topics(documents, **options)
    if not len(vocab):
        return Topics(vocab, mass, np.zeros(1), [-1], classes, (mass, [-1])), bags
    counts = label_counts(bags, labels, items, vocab, classes)
    subject = np.array(mapped(_shares(mass), counts))
    loose = np.flatnonzero(subject < 0)
    owned = [c for c in range(len(classes)) if (subject == c).any()]
    groups = [np.flatnonzero(subject == c) for c in owned] + [loose[k::BACKGROUND] for k in range(BACKGROUND) if len(loose[k::BACKGROUND])]
    raw = (_shares(mass), subject.tolist())
    mass = np.stack([mass[:, g].sum(1) for g in groups], 1)
    alpha = np.full(len(groups), ALPHA, np.float32)
    for _ in range(ROUNDS):
        mass = _counts(bags, _shares(mass), alpha)
    return Topics(vocab, _shares(mass), alpha, [*owned, *[-1] * (len(groups) - len(owned))], classes, raw), bags


def mapped(phi: np.ndarray, counts: np.ndarray) -> list[int]:
    """The subject of each topic: its top terms vote with their shares among labelled texts; -1 if they point nowhere.

    Top terms are frequent in the topic and more so than elsewhere."""
    share = (counts + 1 / max(1, len(counts))) / (counts.sum(0) + 1)
    all_topics = phi.mean(1)
    out = []
    for t in range(phi.shape[1]):
        terms = np.argsort(-phi[:, t] * np.log(np.maximum(phi[:, t] / (all_topics + 1e-12), 1e-3)))[:TOP_TERMS]
        vote = share[:, terms] @ (phi[terms, t] / phi[terms, t].sum())
        best = int(vote.argmax()) if len(vote) else 0
        out.append(best if len(vote) and vote[best] >= VOTE and counts[:, terms].any() else -1)
    return out


def _assign(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        phi, alpha, subject, classes = shared.value
        sub = np.array(subject)
        gather = np.zeros((phi.shape[1], len(classes)), np.float32)
        gather[np.flatnonzero(sub >= 0), sub[sub >= 0]] = 1
        for pdf in batches:
            for lo in range(0, len(pdf), 2000):
                part = pdf.iloc[lo : lo + 2000]
                word, bag, row = _unpack(part)
                first = np.flatnonzero(np.diff(bag, prepend=-1))
                words = _proportions(word, first, phi, alpha)[1] @ gather  # paragraphs x subjects
                doc = row[first]
                whole = np.zeros((len(part), len(classes)), np.float32)
                np.add.at(whole, doc, words)
                # of nearly equal subjects in a paragraph, the document's own prevails
                lead = words + 0.3 * (whole / np.maximum(whole.sum(1, keepdims=True), 1e-9))[doc]
                best = lead.argmax(1)
                own = np.take_along_axis(words, best[:, None], 1)[:, 0]
                part_of_all = (whole / np.maximum(whole.sum(1, keepdims=True), 1e-9))[doc, best]
                devoted = (own >= LEAST_WORDS) & (own >= LEAST_SHARE * words.sum(1)) & ((own >= STRAY_WORDS) | (part_of_all >= STRAY_SHARE))
                key = pd.DataFrame({"d": doc[devoted], "c": best[devoted], "n": own[devoted]}).groupby(["d", "c"])["n"].agg(["size", "sum"]).reset_index()
                amount = whole[key["d"], key["c"]] / np.maximum(whole.sum(1)[key["d"]], 1e-9)
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy()[key["d"]], "class_id": np.array(classes, object)[key["c"]], "paragraphs": key["size"].astype("int32"), "share": np.round(amount.astype(float), 6)})

    return run


def subjects(documents: DataFrame, labels: DataFrame, items: DataFrame, taxonomy: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, paragraphs, share): the subjects of each document, the paragraphs devoted to them, their share of its subject words."""
    model, bags = fit(documents, labels, items, taxonomy, **options)
    if not len(model.vocab) or not any(s >= 0 for s in model.subject):
        return documents.sparkSession.createDataFrame([], "doc_id long, class_id string, paragraphs int, share double")
    shared = documents.sparkSession.sparkContext.broadcast((model.phi, model.alpha, model.subject, model.classes))
    return bags.mapInPandas(_assign(shared), "doc_id long, class_id string, paragraphs int, share double")


def _spelt(wanted: np.ndarray):
    """(hash, term, n): how the wanted words are written, counted in each partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            texts = pdf["text"].tolist()
            for lo, hi in codepoints.slices(texts):
                part = texts[lo:hi]
                h, owner, a, b = wordhash.words(part)
                at = np.flatnonzero(_index(wanted, h) >= 0)
                seen.update((int(h[k]), part[owner[k]][a[k] : b[k]].lower()) for k in at)
        yield pd.DataFrame({"h": np.array([h for h, _ in seen], np.uint64).view(np.int64), "term": [w for _, w in seen], "n": list(seen.values())})

    return run


def top_terms(documents: DataFrame, labels: DataFrame, items: DataFrame, taxonomy: DataFrame, top: int = 20) -> DataFrame:
    """(topic, class_id, rank, term, weight): the top terms of each topic, fitted without labels, and the subject they map it to."""
    model, _ = fit(documents, labels, items, taxonomy)
    phi, subject = model.raw
    wanted = np.unique(model.vocab[np.argsort(-phi, axis=0)[:top]])
    spelt = documents.where("length(text) > 0").select("text").mapInPandas(_spelt(wanted), "h long, term string, n long").groupBy("h", "term").agg(F.sum("n").alias("n"))
    best = spelt.groupBy("h").agg(F.min_by("term", F.struct(-F.col("n"), F.col("term"))).alias("term")).collect()  # topics times top at most
    name = {int(np.int64(r.h).view(np.uint64)): r.term for r in best}
    rows = []
    for t in range(phi.shape[1] if len(phi) else 0):
        for rank, w in enumerate(np.argsort(-phi[:, t])[:top], 1):
            rows.append((t, model.classes[subject[t]] if subject[t] >= 0 else None, rank, name.get(int(model.vocab[w])), round(float(phi[w, t]), 6)))
    return documents.sparkSession.createDataFrame(rows, "topic int, class_id string, rank int, term string, weight double")


def held_out(documents: DataFrame, labels: DataFrame, items: DataFrame, taxonomy: DataFrame, share: float = 0.3) -> DataFrame:
    """(documents, labels, found, both, precision, recall): the subjects of documents whose labels, drawn by hash, were kept from
    the mapping, against those labels. Reviewers erred now and then, so neither can reach 1."""
    kept = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1000)) < int(1000 * share)
    test = labels.where(kept & F.col("class_id").isNotNull()).select("doc_id", "class_id").distinct()
    got = found(documents, labels.where(~kept), items.where("false"), taxonomy).join(test.select("doc_id").distinct(), "doc_id", "left_semi")
    both = got.join(test, ["doc_id", "class_id"], "left_semi")
    one = test.agg(F.count_distinct("doc_id").alias("documents"), F.count("*").alias("labels")).withColumn("k", F.lit(1))
    one = one.join(got.agg(F.count("*").alias("found")).withColumn("k", F.lit(1)), "k").join(both.agg(F.count("*").alias("both")).withColumn("k", F.lit(1)), "k")
    return one.select("documents", "labels", "found", "both", F.round(F.try_divide("both", "found"), 6).alias("precision"), F.round(F.try_divide("both", "labels"), 6).alias("recall"))


def composition(documents: DataFrame, labels: DataFrame, items: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(class_id, documents): the corpus by subject."""
    return subjects(documents, labels, items, taxonomy).groupBy("class_id").agg(F.count_distinct("doc_id").alias("documents"))


def found(documents: DataFrame, labels: DataFrame, items: DataFrame, taxonomy: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id) of the assigned subjects."""
    return subjects(documents, labels, items, taxonomy, **options).select("doc_id", "class_id").distinct()
