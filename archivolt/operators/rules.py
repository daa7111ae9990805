"""Ontology and domain rules whose violations are rows: (rule_id, subject, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finding(df: DataFrame, rule: str, subject: Column | str, detail: Column | str) -> DataFrame:
    """Rows as findings."""
    s, d = (F.col(x) if isinstance(x, str) else x for x in (subject, detail))
    return df.select(F.lit(rule).alias("rule_id"), s.cast("string").alias("subject"), d.cast("string").alias("detail"))


def unknown_predicates(facts: DataFrame, predicates: DataFrame) -> DataFrame:
    """Facts whose predicate is unknown or not active."""
    active = predicates.where("status = 'active'").select("predicate_id").distinct()
    return finding(facts.join(active, "predicate_id", "left_anti"), "unknown-predicate", "fact_id", "predicate_id")


def functional_violations(facts: DataFrame, predicates: DataFrame | None = None) -> DataFrame:
    """Subjects with more than one value of a functional predicate."""
    f = facts if predicates is None else facts.join(predicates.where("functional").select("predicate_id").distinct(), "predicate_id", "left_semi")
    many = f.groupBy("subject", "predicate_id").agg(F.count_distinct("value").alias("n")).where("n > 1")
    return finding(many, "functional", "subject", F.concat("predicate_id", F.lit(":"), "n"))


def domain_range(facts: DataFrame, types: DataFrame, predicates: DataFrame, closure: DataFrame) -> DataFrame:
    """Facts whose subject or object has no type under the predicate's domain or range; xsd ranges are exempt."""
    typed = types.join(closure, "class_id").select("object_id", "ancestor").distinct()
    f = facts.join(predicates.select("predicate_id", "domain", "range"), "predicate_id")
    out = None
    for side, want, rule in (("subject", "domain", "domain"), ("object", "range", "range")):
        g = f.where(F.col(want).isNotNull() & ~F.col(want).startswith("xsd:") & F.col(side).isNotNull())
        ok = typed.select(F.col("object_id").alias(side), F.col("ancestor").alias(want))
        bad = finding(g.join(ok, [side, want], "left_anti"), rule, "fact_id", side)
        out = bad if out is None else out.unionByName(bad)
    return out


def disjoint_types(types: DataFrame, closure: DataFrame, disjoint: DataFrame) -> DataFrame:
    """Objects whose types fall under two disjoint classes (a, b)."""
    t = types.join(closure, "class_id").select("object_id", "ancestor").distinct()
    a = t.join(disjoint, t["ancestor"] == disjoint["a"]).select("object_id", "b")
    both = a.join(t.withColumnRenamed("ancestor", "b"), ["object_id", "b"]).select("object_id").distinct()
    return finding(both, "disjoint", "object_id", F.lit("disjoint types"))


def object_xor_literal(facts: DataFrame) -> DataFrame:
    """Facts with both or neither of an object and a literal."""
    return finding(facts.where(F.col("object").isNull() == F.col("literal").isNull()), "object-xor-literal", "fact_id", F.coalesce("object", F.lit("none")))


def confidence_range(facts: DataFrame, column: str = "confidence") -> DataFrame:
    """Facts whose confidence is no number from 0 to 1; nulls pass."""
    n = F.expr(f"try_cast({column} AS DOUBLE)")
    return finding(facts.where(F.col(column).isNotNull() & (n.isNull() | F.isnan(n) | ~n.between(0, 1))), "confidence", "fact_id", column)


def conflicting_pairs(facts: DataFrame, one: str, other: str) -> DataFrame:
    """(subject, object) pairs joined by two predicates that exclude each other."""
    def pairs(p: str) -> DataFrame:
        return facts.where(F.col("predicate_id") == p).select("subject", "object")

    return finding(pairs(one).intersect(pairs(other)), f"conflict {one}/{other}", "subject", "object")


def allocation_findings(rows: DataFrame) -> DataFrame:
    """Rows (row_id, amount, allocated, currency, counter_currency, match_state): allocations over the amount, in another currency, or
    of an unknown state; with a column predicate also similarity taken for a match."""
    over = finding(rows.where("allocated > amount"), "over-allocated", "row_id", "allocated")
    money = finding(rows.where("currency <> counter_currency"), "currency", "row_id", "counter_currency")
    alike = finding(rows.where("match_state = 'matched'").where(F.col("predicate").contains("similar")), "similarity-matched", "row_id", "predicate") if "predicate" in rows.columns else None
    state = finding(rows.where("match_state is null or match_state not in ('matched', 'partial', 'unmatched', 'candidate')"), "match-state", "row_id", F.coalesce("match_state", F.lit("none")))
    out = over.unionByName(money).unionByName(state)
    return out if alike is None else out.unionByName(alike)


def alternative_sums(lines: DataFrame) -> DataFrame:
    """Alternative groups with more than one mandatory line, all with a quantity: they must not be summed."""
    g = lines.where("alternative_group_id is not null").groupBy("alternative_group_id").agg(F.count_if(F.col("is_mandatory")).alias("m"), F.every(F.col("quantity").isNotNull()).alias("q"))
    return finding(g.where("m > 1 and q"), "alternative-group", "alternative_group_id", "m")


def cohort_anomalies(df: DataFrame, cohort: str, identity: str, value: str, cutoff: float = 3.5, least: int = 8) -> DataFrame:
    """(id, cohort, score, status): robust z-scores by median and median absolute deviation; small cohorts give no evidence."""
    med = df.groupBy(cohort).agg(F.expr(f"percentile({value}, 0.5)").alias("m"), F.count(value).alias("n"))
    dev = df.join(med, cohort).withColumn("dev", F.abs(F.col(value) - F.col("m")))
    mad = dev.groupBy(cohort).agg(F.expr("percentile(dev, 0.5)").alias("mad"))
    score = F.round(F.coalesce(F.try_divide(0.6745 * F.col("dev"), F.col("mad")), F.lit(0.0)), 6)
    s = dev.join(mad, cohort).withColumn("score", score)
    status = F.when(F.col("n") < least, "insufficient-evidence").when(F.col("score") > cutoff, "anomaly").otherwise("normal")
    return s.select(F.col(identity), F.col(cohort), "score", status.alias("status"))


#: Pairs of predicates that exclude each other between the same two things.
EXCLUSIVE = (("part-of", "references"), ("owns-explicit", "owns-candidate"), ("allocates", "similar-to"), ("same-name", "alias-of"))


def exclusive_findings(facts: DataFrame, pairs: tuple[tuple[str, str], ...] = EXCLUSIVE) -> DataFrame:
    """Conflicts of every stated pair of predicates, in one pass: a subject and object joined by both."""
    side = F.array(*[F.struct(F.lit(f"conflict {a}/{b}").alias("rule"), F.array(F.lit(a), F.lit(b)).alias("p")) for a, b in pairs])
    hit = facts.select("subject", "object", "predicate_id", F.explode(F.filter(side, lambda x: F.array_contains(x["p"], F.col("predicate_id")))).alias("x"))
    both = hit.groupBy("subject", "object", "x.rule").agg(F.count_distinct("predicate_id").alias("n")).where("n > 1")
    return both.select(F.col("rule").alias("rule_id"), F.col("subject").cast("string"), F.col("object").cast("string").alias("detail"))


def kind_findings(facts: DataFrame, predicates: DataFrame) -> DataFrame:
    """Facts whose value is of another kind than their predicate's, or a literal of another datatype; no datatype means xsd:string.

    facts has (fact_id, predicate_id, object, literal, literal_datatype), predicates (predicate_id, kind: object or literal, datatype)."""
    j = facts.join(predicates.select("predicate_id", "kind", "datatype"), "predicate_id")
    wrong = finding(j.where(((F.col("kind") == "object") & F.col("literal").isNotNull()) | ((F.col("kind") == "literal") & F.col("object").isNotNull())), "kind-mismatch", "fact_id", "kind")
    has = F.coalesce("literal_datatype", F.lit("xsd:string"))
    return wrong.unionByName(finding(j.where((F.col("kind") == "literal") & F.col("literal").isNotNull() & (has != F.coalesce("datatype", F.lit("xsd:string")))), "datatype", "fact_id", has))


def registry_findings(rows: DataFrame) -> DataFrame:
    """Registry rows (row_id, status, reason): a failed one needs a reason, an empty one must not have any."""
    blank = F.coalesce(F.trim("reason"), F.lit("")) == ""
    return finding(rows.where((F.col("status") == "failed") & blank), "failed-without-reason", "row_id", "status").unionByName(finding(rows.where((F.col("status") == "empty") & ~blank), "empty-with-reason", "row_id", "reason"))


def stage_findings(rows: DataFrame, delivered: tuple[str, ...] = ("delivered", "accepted")) -> DataFrame:
    """Supply rows (row_id, stage, claims_delivery): a delivery may be claimed only in a stage that follows it."""
    return finding(rows.where(F.col("claims_delivery") & ~F.coalesce(F.col("stage").isin(*delivered), F.lit(False))), "delivery-claim", "row_id", F.coalesce("stage", F.lit("none")))


def anchor_findings(rows: DataFrame, kinds: dict[str, tuple[str, ...]], directions: tuple[str, ...] = ("in", "out", "both")) -> DataFrame:
    """Anchored rows (row_id, predicate_id, anchor_kind, direction): the kind must be one of the predicate's, the direction known."""
    allowed = F.create_map(*[x for k, v in kinds.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    fits = F.coalesce(F.array_contains(allowed[F.col("predicate_id")], F.col("anchor_kind")), F.lit(False))
    bad = finding(rows.where(F.col("predicate_id").isin(*kinds) & ~fits), "anchor-kind", "row_id", F.coalesce("anchor_kind", F.lit("none")))
    return bad.unionByName(finding(rows.where(~F.coalesce(F.col("direction").isin(*directions), F.lit(False))), "direction", "row_id", F.coalesce("direction", F.lit("none"))))


def predicate_key(name: Column) -> Column:
    """A camel-case local name as pred. and its words joined by hyphens."""
    return F.concat(F.lit("pred."), F.lower(F.regexp_replace(name, r"(?<!^)([A-Z])", "-$1")))


def evolution(old: dict, new: dict) -> tuple[str, list[str]]:
    """(identical, additive or breaking; what changed) of two vocabularies: name -> {kind, parent, domain, range, functional}."""
    gone = [f"removed {n}" for n in sorted(old.keys() - new.keys())]
    changed = [f"changed {n}.{k}" for n in sorted(old.keys() & new.keys()) for k in sorted(old[n].keys() | new[n].keys()) if old[n].get(k) != new[n].get(k)]
    added = [f"added {n}" for n in sorted(new.keys() - old.keys())]
    return "breaking" if gone or changed else "additive" if added else "identical", gone + changed + added


def load_vocabulary(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(classes, predicates) of a JSON-lines vocabulary: {"id", "kind": "class", "parent"} and {"id", "kind": "predicate",
    "domain", "range", "functional", "status"}; other kinds are refused."""
    rows = spark.read.schema("id string, kind string, parent string, domain string, range string, functional boolean, status string").json(path)
    bad = [r.kind for r in rows.where("kind is null or kind not in ('class', 'predicate')").select("kind").distinct().limit(5).collect()]
    if bad:
        raise ValueError(f"unknown kinds: {bad}")
    classes = rows.where("kind = 'class'").select(F.col("id").alias("class_id"), F.col("parent").alias("parent_id"))
    return classes, rows.where("kind = 'predicate'").select(F.col("id").alias("predicate_id"), "domain", "range", F.coalesce("functional", F.lit(False)).alias("functional"), F.coalesce("status", F.lit("active")).alias("status"))
