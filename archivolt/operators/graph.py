"""Graph operators over edge tables (src, dst): walks, reachability, cycles, ranks and communities."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivolt.session import cut

#: Rounds after which an iteration that should have ended raises.
GUARD = 500
#: Edges with whole numbers as ends that a task holds at once; of other kinds an eighth.
BLOCK = 4_000_000


def one_hop(edges: DataFrame, start) -> DataFrame:
    """Outgoing edges of a vertex."""
    return edges.where(F.col("src") == F.lit(start))


def bounded_walk(edges: DataFrame, start, depth: int) -> DataFrame:
    """(depth, src, dst): every edge step of every walk from start up to the depth, repeats kept.

    Each step joins the walks' ends, counted per vertex, to the edges; so walks that meet are carried once with their number."""
    e = edges.select("src", "dst").dropna()
    at = e.where(F.col("src") == F.lit(start)).groupBy("src", "dst").agg(F.count("*").alias("n"))
    out = None
    for k in range(1, int(depth) + 1):
        at = cut(at)
        step = at.select(F.lit(k).alias("depth"), "src", "dst", "n")
        out = step if out is None else out.union(step)
        if k < depth:
            ends = at.groupBy("dst").agg(F.sum("n").alias("n")).withColumnRenamed("dst", "src")
            at = e.join(ends, "src").groupBy("src", "dst").agg(F.sum("n").alias("n"))
    if out is None:
        return e.where("false").select(F.lit(1).alias("depth"), "src", "dst")
    return out.select("depth", "src", "dst", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("_")).drop("_")


def _expand(key: tuple, edges: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
    """(id, done): vertices of one block reached from its open ones, done, and ends of its edges in other blocks, not done."""
    codes, names = pd.factorize(np.concatenate([edges["src"].to_numpy(), edges["dst"].to_numpy()]))
    src, dst, n = codes[: len(edges)], codes[len(edges) :].astype(np.int32), len(names)
    order = np.argsort(src, kind="stable")
    first, ends = memoryview(np.searchsorted(src[order], np.arange(n + 1))), memoryview(dst[order])
    far = np.zeros(n, np.uint8)
    far[dst] = edges["far"].to_numpy()
    held = pd.Index(names).get_indexer(state["id"])
    seen, abroad = bytearray(n), far.tobytes()
    for v in held[held >= 0].tolist():
        seen[v] = 1
    new, stack = [], held[(held >= 0) & state["open"].to_numpy()].tolist()
    while stack:
        v = stack.pop()
        for k in range(first[v], first[v + 1]):
            w = ends[k]
            if not seen[w]:
                seen[w] = 1
                new.append(w)
                if not abroad[w]:
                    stack.append(w)
    at = np.array(new, np.int64)
    return pd.DataFrame({"id": names[at], "done": far[at] == 0})


def reachable(edges: DataFrame, starts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id): all vertices reachable from the starts (column `id`), they included; cycles are no matter.

    Edges are dealt to blocks by their source. A round follows all paths inside every block to their ends, and what they reach in
    other blocks is open in the next one; so a graph of one block takes a single round, however long its paths. Rounds are checkpointed."""
    e = cut(edges.select("src", "dst").dropna().distinct())
    kind = e.select("src").union(e.select("dst")).union(starts.select("id")).dtypes[0][1]
    blocks = max(1, -(-e.count() // (block if kind in ("tinyint", "smallint", "int", "bigint") else block // 8)))

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast(kind)), F.lit(blocks)).cast("int")

    dealt = e.select(place("src").alias("block"), F.col("src").cast(kind).alias("src"), F.col("dst").cast(kind).alias("dst"), (place("src") != place("dst")).alias("far"))
    dealt = cut(dealt) if blocks > 1 else dealt
    state = cut(starts.select(F.col("id").cast(kind).alias("id")).dropna().distinct().select("id", place("id").alias("block"), F.lit(True).alias("open")))
    while True:
        busy = [r.block for r in state.where("open").select("block").distinct().collect()]  # at most as many as blocks
        if not busy:
            return state.select("id")
        here = F.col("block").isin(busy)
        met = dealt.where(here).groupBy("block").cogroup(state.where(here).groupBy("block")).applyInPandas(_expand, f"id {kind}, done boolean")
        new = met.groupBy("id").agg(F.max("done").alias("done")).join(state.select("id"), "id", "left_anti").select("id", place("id").alias("block"), (~F.col("done")).alias("open"))
        state = cut(state.withColumn("open", F.lit(False)).union(new).repartition(max(blocks, 8), "id"))


def cycle_core(edges: DataFrame) -> DataFrame:
    """(src, dst): edges left when vertices without incoming or outgoing edges are peeled off; empty if and only if there is no cycle."""
    e = cut(edges.select("src", "dst").dropna().distinct())
    n = e.count()
    while True:
        e = cut(e.join(e.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(e.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst"))
        left = e.count()
        if left == n or not left:
            break
        n = left
    return e


def pagerank(edges: DataFrame, rounds: int | None = None, damping: float = 0.85, tolerance: float = 1e-9) -> DataFrame:
    """(id, rank): weighted by edge count; ranks sum to 1, dangling rank is spread evenly.

    Rounds end when the ranks move by less than the tolerance in all, or after a stated number of rounds."""
    e = edges.select("src", "dst").dropna().groupBy("src", "dst").agg(F.count("*").alias("w"))
    e = cut(e.join(e.groupBy("src").agg(F.sum("w").alias("total")), "src").select("src", "dst", (F.col("w") / F.col("total")).alias("share")))
    v = cut(e.select(F.col("src").alias("id")).union(e.select("dst")).distinct())
    n = v.count()
    if not n:
        return v.withColumn("rank", F.lit(0.0))
    rank = v.withColumn("rank", F.lit(1.0 / n))
    for k in range(1, GUARD if rounds is None else rounds + 1):
        flow = e.join(rank, F.col("src") == F.col("id")).groupBy("dst").agg(F.sum(F.col("rank") * F.col("share")).alias("in"))
        nxt = cut(rank.join(flow, F.col("id") == F.col("dst"), "left").select("id", F.col("rank").alias("old"), F.coalesce("in", F.lit(0.0)).alias("in")))
        kept = nxt.agg(F.sum("in")).first()[0] or 0.0
        rank = nxt.select("id", "old", (F.lit((1 - damping) / n + damping * (1 - kept) / n) + damping * F.col("in")).alias("rank"))
        moved = rank.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
        rank = rank.drop("old")
        if moved < tolerance or k == rounds:
            return rank
    raise RuntimeError(f"no end after {GUARD} rounds")


def label_communities(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, community): label propagation on the undirected graph until no label moves; ties go to the smallest label.

    A vertex keeps its label while that is among the most frequent around it. In each round about half of those
    that want to move do, by a hash of vertex and round, so that neighbours can't swap labels for ever. A stated number of rounds
    ends it before."""
    both = edges.select("src", "dst").dropna().where("src <> dst")
    both = cut(both.union(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    label = both.select(F.col("src").alias("id")).distinct().withColumn("community", F.col("id"))
    for k in range(GUARD if rounds is None else rounds):
        votes = both.join(label, F.col("dst") == F.col("id")).groupBy("src", "community").agg(F.count("*").alias("n"))
        best = votes.groupBy("src").agg(F.min_by(F.struct("community", "n"), F.struct(-F.col("n"), F.col("community"))).alias("b"))
        own = votes.select(F.col("src").alias("id"), "community", F.col("n").alias("mine"))
        j = label.join(best, F.col("id") == F.col("src")).join(own, ["id", "community"], "left")
        wants = F.coalesce("mine", F.lit(0)) < F.col("b.n")
        turn = F.pmod(F.xxhash64("id", F.lit(k)), F.lit(2)) == 0
        label = cut(j.select("id", F.when(wants & turn, F.col("b.community")).otherwise(F.col("community")).alias("community"), wants.alias("wants")))
        if label.where("wants").isEmpty():
            return label.drop("wants")
        label = label.drop("wants")
    if rounds is not None:
        return label
    raise RuntimeError(f"no end after {GUARD} rounds")


def agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """(n, ari, nmi): how far two assignments (id, community) of the same vertices agree, from one table of counts.

    Both are 1 for equal partitions, whatever the names; the adjusted Rand index is about 0 for chance."""
    cell = cut(a.select("id", F.col("community").alias("a")).join(b.select("id", F.col("community").alias("b")), "id").groupBy("a", "b").agg(F.count("*").alias("n")))
    two = lambda x: x.cast("double") * (x - 1) / 2
    total = cell.agg(F.sum("n").alias("all"), F.sum(two(F.col("n"))).alias("pairs"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("h")).withColumn("k", F.lit(1))
    for side in ("a", "b"):
        one = cell.groupBy(side).agg(F.sum("n").alias("n")).agg(F.sum(two(F.col("n"))).alias(f"pairs_{side}"), F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias(f"h_{side}")).withColumn("k", F.lit(1))
        total = total.join(one, "k")
    n = F.col("all").cast("double")
    chance = F.col("pairs_a") * F.col("pairs_b") / (n * (n - 1) / 2)
    ari = F.try_divide(F.col("pairs") - chance, (F.col("pairs_a") + F.col("pairs_b")) / 2 - chance)
    ha, hb = (F.log(n) - F.col(f"h_{s}") / n for s in ("a", "b"))
    mutual = F.log(n) + (F.col("h") - F.col("h_a") - F.col("h_b")) / n
    return total.select(F.col("all").alias("n"), F.round(F.coalesce(ari, F.lit(1.0)), 6).alias("ari"), F.round(F.coalesce(F.try_divide(2 * mutual, ha + hb), F.lit(1.0)), 6).alias("nmi"))


def class_closure(parents: DataFrame, depth: int = 64) -> DataFrame:
    """(class_id, ancestor): the reflexive transitive closure of (class_id, parent_id); classes form shallow trees."""
    known = cut(parents.select("class_id", F.col("class_id").alias("ancestor")).union(parents.select(F.col("parent_id").alias("class_id"), F.col("parent_id").alias("ancestor")).dropna()).distinct())
    step = parents.select(F.col("class_id").alias("ancestor"), F.col("parent_id").alias("up")).dropna()
    frontier = known
    for _ in range(depth):
        frontier = cut(frontier.join(step, "ancestor").select("class_id", F.col("up").alias("ancestor")).join(known, ["class_id", "ancestor"], "left_anti").distinct())
        if frontier.isEmpty():
            return known
        known = cut(known.union(frontier))
    raise ValueError(f"classes nest deeper than {depth}, or in a cycle")


def code_ancestors(df: DataFrame, code: str = "code") -> DataFrame:
    """Each dotted code with its ancestors, outermost first, and its depth; no recursion needed."""
    parts = F.split(code, r"\.")
    return df.withColumn("ancestors", F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "."))).withColumn("depth", F.size(parts))


def exports(edges: DataFrame, style: str = "turtle", base: str = "urn:archive:") -> DataFrame:
    """(value): one line an edge as Turtle, JSON-LD or GraphML elements, for write.text."""
    s, d = F.col("src").cast("string"), F.col("dst").cast("string")

    def iri(x):  # signs that an IRI can't hold, percent-encoded
        return F.regexp_replace(F.regexp_replace(F.url_encode(x), r"\+", "%20"), "%3A", ":")

    def xml(x):
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            x = F.replace(x, F.lit(sign), F.lit(name))
        return x

    line = {
        "turtle": lambda: F.concat(F.lit(f"<{base}"), iri(s), F.lit(f"> <{base}linked> <{base}"), iri(d), F.lit("> .")),
        "jsonld": lambda: F.to_json(F.struct(F.concat(F.lit(base), iri(s)).alias("@id"), F.struct(F.concat(F.lit(base), iri(d)).alias("@id")).alias(f"{base}linked"))),
        "graphml": lambda: F.concat(F.lit('<edge source="'), xml(s), F.lit('" target="'), xml(d), F.lit('"/>')),
    }[style]()
    return edges.dropna(subset=["src", "dst"]).select(line.alias("value"))
