"""Taxonomy classification of texts by weighted prototype overlap, its scheme checks, and leakage-free splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivolt.functions.text import words

#: Weights of where a word stands, and the decision's thresholds.
WEIGHTS = {"path": 5, "title": 4, "text": 3}
PRIMARY, MARGIN, ALTERNATE, ALTERNATES, MATCHED = 0.45, 0.08, 0.35, 3, 2


def scheme_findings(classes: DataFrame) -> DataFrame:
    """(finding, class_id): duplicate ids, orphans and missing captions of (class_id, parent_class_id, caption)."""
    dup = classes.groupBy("class_id").count().where("count > 1").select(F.lit("duplicate").alias("finding"), "class_id")
    ids = classes.select(F.col("class_id").alias("parent_class_id")).distinct()
    orphan = classes.where("parent_class_id is not null").join(ids, "parent_class_id", "left_anti").select(F.lit("orphan").alias("finding"), "class_id")
    blank = classes.where(F.coalesce(F.trim("caption"), F.lit("")) == "").select(F.lit("no-caption").alias("finding"), "class_id")
    return dup.unionByName(orphan).unionByName(blank)


def validate(classes: DataFrame, namespaces: list[str], licences: list[str]) -> DataFrame:
    """(finding, class_id): all checks of a scheme of (class_id, namespace, parent_class_id, caption, licence): those of
    scheme_findings, unknown namespaces, cycles, ids that meet under one path token or don't survive it, licences not allowed."""
    from archivolt.operators.graph import cycle_core

    def say(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("finding"), "class_id").distinct()

    core = cycle_core(classes.select(F.col("class_id").alias("src"), F.col("parent_class_id").alias("dst"))).select(F.col("src").alias("class_id"))
    token = class_token(F.col("class_id"))
    shared = classes.select("class_id", token.alias("t")).distinct()
    many = shared.groupBy("t").agg(F.count("*").alias("n")).where("n > 1").select("t")
    parts = [
        scheme_findings(classes),
        say("unknown-namespace", classes.where(~F.coalesce(F.col("namespace").isin(*namespaces), F.lit(False)))),
        say("cycle", core),
        say("token-collision", shared.join(many, "t", "left_semi")),
        say("token-lossy", classes.where(F.col("class_id").isNotNull() & ~F.col("class_id").rlike(r"^[A-Za-z0-9._:/ -]+$"))),
        say("licence", classes.where(~F.coalesce(F.col("licence").isin(*licences), F.lit(False)))),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def class_token(class_id: Column) -> Column:
    """A path-safe token of a class id: small letters, digits, dots; every other run of signs is one hyphen."""
    return F.regexp_replace(F.lower(class_id), r"[^a-z0-9.]+", "-")


def build_scheme(classes: DataFrame, extensions: DataFrame, outcomes: list[str]) -> tuple[str, DataFrame]:
    """(scheme_id, rows): a taxonomy with its extensions and the outcomes that stand beside classes; the id hashes the rows."""
    from archivolt.functions.hashing import set_checksum

    kinds = classes.sparkSession.createDataFrame([(o, None, o) for o in outcomes], "class_id string, parent_class_id string, caption string")
    columns = ("class_id", "parent_class_id", "caption")
    rows = classes.select(*columns, F.lit("class").alias("kind")).unionByName(extensions.select(*columns, F.lit("extension").alias("kind"))).unionByName(kinds.select(*columns, F.lit("outcome").alias("kind"))).distinct()
    c = rows.agg(set_checksum(F.concat_ws("|", *[F.coalesce(x, F.lit("")) for x in (*columns, "kind")])).alias("c")).first().c
    import hashlib

    scheme = "subjects-" + hashlib.sha256(f"{c.n}:{c.xored}:{c.summed}".encode()).hexdigest()[:12]
    return scheme, rows.withColumn("scheme_id", F.lit(scheme))


def crosswalk_coverage(classes: DataFrame, sources: DataFrame) -> DataFrame:
    """(finding, code): source codes (code) that no class maps, that several map, and mapped codes no source knows; classes has
    (class_id, crosswalk: array of codes)."""
    m = classes.select("class_id", F.explode("crosswalk").alias("code")).distinct()
    per = m.groupBy("code").agg(F.count("*").alias("n"))
    known = sources.select("code").dropna().distinct()
    parts = [("missing", known.join(per, "code", "left_anti")), ("duplicate", per.where("n > 1")), ("unknown", per.join(known, "code", "left_anti"))]
    out = None
    for name, rows in parts:
        one = rows.select(F.lit(name).alias("finding"), "code")
        out = one if out is None else out.unionByName(one)
    return out


def balance(classes: DataFrame, closure: DataFrame) -> DataFrame:
    """(leaves, least_depth, greatest_depth, greatest_fan_out): the shape of a tree, by its closure (class_id, ancestor)."""
    depth = closure.groupBy("class_id").agg(F.count("*").alias("depth"))
    fan = classes.where("parent_class_id is not null").groupBy(F.col("parent_class_id").alias("class_id")).agg(F.count("*").alias("fan"))
    j = depth.join(fan, "class_id", "left")
    leaf = F.col("fan").isNull()
    return j.agg(F.count_if(leaf).alias("leaves"), F.min(F.when(leaf, F.col("depth"))).alias("least_depth"), F.max(F.when(leaf, F.col("depth"))).alias("greatest_depth"), F.max("fan").alias("greatest_fan_out"))


def with_ancestors(classes: DataFrame, closure: DataFrame, caption: str) -> DataFrame:
    """(class_id, caption): each class's caption followed by those of its ancestors, which give it context."""
    names = classes.select(F.col("class_id").alias("ancestor"), F.col(caption).alias("name"))
    far = closure.where("class_id <> ancestor").join(names, "ancestor").groupBy("class_id").agg(F.concat_ws(" ", F.sort_array(F.collect_list("name"))).alias("above"))
    return classes.join(far, "class_id", "left").select("class_id", F.concat_ws(" ", caption, "above").alias("caption"))


def features(token_list: Column) -> Column:
    """Features of tokens: w:token of two letters or more, and the padded trigrams c: of those of five or more."""
    w = F.transform(F.filter(token_list, lambda t: F.length(t) > 1), lambda t: F.concat(F.lit("w:"), t))
    long = F.filter(token_list, lambda t: F.length(t) >= 5)
    grams = F.flatten(F.transform(long, lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.lit("c:"), F.substring(F.concat(F.lit("^"), t, F.lit("$")), i, F.lit(3))))))
    return F.concat(w, grams)


def file_features(files: DataFrame, identity: str = "file_id") -> DataFrame:
    """(id, term, weight, first_field, first_place): terms of a file's path, title and text, each weighed by where it stands."""
    out = None
    for rank, (part, weight) in enumerate(WEIGHTS.items()):
        one = files.where(F.col(part).isNotNull()).select(identity, F.posexplode(words(F.col(part))).alias("place", "term")).groupBy(identity, "term").agg((F.count("*") * weight).alias("weight"), F.min(F.struct(F.lit(rank).alias("rank"), "place")).alias("first"))
        out = one if out is None else out.unionByName(one)
    total = out.groupBy(identity, "term").agg(F.sum("weight").alias("weight"), F.min("first").alias("first"))
    return total.select(identity, "term", "weight", F.array(*[F.lit(p) for p in WEIGHTS])[F.col("first.rank")].alias("first_field"), F.col("first.place").alias("first_place"))


def physical_files(occurrences: DataFrame, documents: DataFrame, failures: DataFrame, budget: int = 120_000) -> DataFrame:
    """(silo, path, status, title, text, documents, truncated): one row a physical file with its documents' texts within a shared
    budget of characters, in the order of their ids; files without a document are failed or empty.

    occurrences has (silo, path, document_id), documents (document_id, title, text), failures (silo, path, reason)."""
    before = F.coalesce(F.sum(F.length("text")).over(Window.partitionBy("silo", "path").orderBy("document_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    j = occurrences.dropDuplicates(["silo", "path", "document_id"]).join(documents.select("document_id", "title", "text"), "document_id", "left")
    # lengths decide first; text beyond the budget is cut before it moves any further
    j = j.withColumn("keep", F.greatest(F.lit(0), F.lit(budget) - before)).withColumn("cut", F.coalesce(F.length("text") > F.col("keep"), F.lit(False))).withColumn("text", F.substring("text", F.lit(1), F.col("keep")))
    part = F.struct("document_id", "title", "text")
    per = j.groupBy("silo", "path").agg(F.sort_array(F.collect_list(F.when(F.col("keep") > 0, part))).alias("d"), F.count("text").alias("documents"), F.max("cut").alias("truncated"))
    bad = failures.groupBy("silo", "path").agg(F.min("reason").alias("reason"))
    status = F.when(F.col("reason").isNotNull(), "failed").when(F.col("documents") > 0, "read").otherwise("empty")
    return per.join(bad, ["silo", "path"], "full_outer").select("silo", "path", status.alias("status"), F.col("d")[0]["title"].alias("title"), F.array_join(F.transform("d", lambda x: x["text"]), "\n").alias("text"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("truncated", F.lit(False)).alias("truncated"))


def accounting(rows: DataFrame, inventory: DataFrame, keys: list[str]) -> DataFrame:
    """(inventory_rows, rows, missing, extra, repeated, equal): whether a result has exactly one row for each inventory row."""
    n = inventory.select(*keys).distinct()
    per = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    a = n.withColumn("i", F.lit(1)).join(per, keys, "full_outer")
    out = a.agg(F.count("i").alias("inventory_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("i").isNull()).alias("extra"), F.count_if(F.col("n") > 1).alias("repeated"))
    return out.withColumn("equal", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("repeated") == 0))


def review_packets(decisions: DataFrame, stratum: str, score: str, identity: str, size: int = 20, seed: str = "review") -> DataFrame:
    """A bounded seeded sample of each stratum for reviewers, with its place in the packet: sampling is the feature."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(identity).cast("string")), 256)
    w = Window.partitionBy(stratum).orderBy(order, identity)
    return decisions.withColumn("place", F.row_number().over(w)).where(F.col("place") <= size).select(stratum, "place", identity, score)


def prototypes(classes: DataFrame, captions: list[str]) -> DataFrame:
    """(class_id, variant, term, w, idf, norm): caption words of each language variant with their IDF over all variants."""
    v = classes.select("class_id", F.posexplode(F.array(*captions)).alias("variant", "caption")).where("caption is not null")
    t = v.select("class_id", "variant", F.explode(words(F.col("caption"))).alias("term")).groupBy("class_id", "variant", "term").agg(F.count("*").alias("w"))
    n = v.count()
    t = t.join(t.groupBy("term").agg((F.log((F.lit(n) + 1) / (F.count("*") + 1)) + 1).alias("idf")), "term")
    return t.join(t.groupBy("class_id", "variant").agg(F.sum(F.col("w") * F.col("idf")).alias("norm")), ["class_id", "variant"])


def class_scores(docs: DataFrame, proto: DataFrame, identity: str = "doc_id") -> DataFrame:
    """(id, class_id, score, matched): the best variant of each class, sum of min(document, prototype) * idf over its norm.

    docs has (id, term, weight). Prototypes are a taxonomy's captions, so broadcasting them is checked by size."""
    from archivolt.session import broadcast_if_small

    j = docs.join(broadcast_if_small(proto), "term")
    per = j.groupBy(identity, "class_id", "variant").agg(F.sum(F.least("weight", "w") * F.col("idf")).alias("s"), F.first("norm").alias("norm"), F.count_distinct("term").alias("matched"))
    best = F.max(F.struct(F.least(F.lit(1.0), F.col("s") / F.greatest(F.col("norm"), F.lit(1.0))).alias("score"), "matched"))
    return per.groupBy(identity, "class_id").agg(best.alias("b")).select(identity, "class_id", "b.score", "b.matched")


def decide(scores: DataFrame, tree: DataFrame, identity: str = "doc_id") -> DataFrame:
    """(id, primary_class_id, confidence, alternates): the best class if it passes the thresholds, else unclassified with 1 - score.

    tree has (class_id, depth) or (class_id, path), path being the ancestors from the root down to the class. Deeper classes win
    ties, then smaller ids. The competitor of the margin and the alternates are off the best class's branch: neither above nor
    below it."""
    if "path" not in tree.columns:
        tree = tree.select("class_id", "depth", F.array("class_id").alias("path"))
    elif "depth" not in tree.columns:
        tree = tree.withColumn("depth", F.size("path"))
    ranked = scores.join(F.broadcast(tree.select("class_id", "depth", "path")), "class_id")  # a fixed taxonomy
    # as many rows of an id as classes it scored for
    per = ranked.groupBy(identity).agg(F.array_sort(F.collect_list(F.struct((-F.round("score", 9)).alias("s"), (-F.col("depth")).alias("d"), "class_id", "matched", "path"))).alias("t"))
    per = per.withColumn("best", F.col("t")[0])
    off = F.filter("t", lambda x: ~F.array_contains(x["path"], F.col("best.class_id")) & ~F.array_contains(F.col("best.path"), x["class_id"]))
    per = per.withColumn("off", off)
    best, rival = F.col("best"), F.try_element_at("off", F.lit(1))
    ok = (-best["s"] >= PRIMARY) & (best["matched"] >= MATCHED) & (rival.isNull() | (rival["s"] - best["s"] >= MARGIN))
    others = F.transform(F.slice(F.filter("off", lambda x: -x["s"] >= ALTERNATE), 1, ALTERNATES), lambda x: x["class_id"])
    return per.select(identity, F.when(ok, best["class_id"]).otherwise("unclassified").alias("primary_class_id"), F.round(F.when(ok, -best["s"]).otherwise(1 + best["s"]), 6).alias("confidence"), others.alias("alternates"))


def split_groups(df: DataFrame, key: str, stratum: str, group: str, seed: str = "split") -> DataFrame:
    """df with its split, rows of a group in the same one: the group's smallest key stands for it, in its own stratum; rows
    without a group are groups of their own. Positions come from counts of hash ranges, so no stratum is sorted in one task."""
    unit = F.coalesce(F.concat(F.lit("g:"), F.col(group).cast("string")), F.concat(F.lit("k:"), F.col(key).cast("string")))
    tagged = df.withColumn("_unit", unit)
    units = tagged.groupBy("_unit").agg(F.min(F.struct(F.col(key).alias("k"), F.col(stratum).alias("s"))).alias("m")).select("_unit", F.col("m.k").alias("_key"), F.col("m.s").alias("_stratum"))
    return tagged.join(stratified_split(units, "_key", "_stratum", seed).select("_unit", "split"), "_unit").drop("_unit")


def stratified_split(df: DataFrame, key: str, stratum: str, seed: str = "split", shares: tuple[tuple[str, float], ...] = (("train", 0.6), ("dev", 0.2), ("test", 0.2))) -> DataFrame:
    """df with its split: rows of a stratum in the order of sha256(seed:key), cut at (position + 0.5) / n."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    keyed = df.withColumn("_digest", digest).withColumn("_range", F.substring("_digest", 1, 3))
    # rows before a hash range are counted, those inside one numbered: a stratum never stands in one task
    per = keyed.groupBy(stratum, "_range").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(stratum).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(stratum).alias("_s"), F.col("_range").alias("_r"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("_before"), F.sum("n").over(Window.partitionBy(stratum)).alias("_all"))
    j = keyed.join(per, keyed[stratum].eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    pos = (F.row_number().over(Window.partitionBy(stratum, "_range").orderBy("_digest", key)) + F.col("_before") - 0.5) / F.col("_all")
    out, edge = F.lit(shares[-1][0]), 1.0
    for name, share in reversed(shares[:-1]):
        edge = sum(s for n, s in shares[: [x for x, _ in shares].index(name) + 1])
        out = F.when(F.col("_pos") < edge, name).otherwise(out)
    return j.withColumn("_pos", pos).select(*df.columns, out.alias("split"))
