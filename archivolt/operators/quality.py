"""Data-quality rules compiled to as few passes as possible.

All row rules of a dataset run in one aggregate; uniqueness and references take one more job each. A check that did not run can't
pass, so a dataset is publishable only if every required check ran and passed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """kind: not_null, max_length, accepted, companion (column set demands another), pattern, between."""

    rule_id: str
    kind: str
    column: str
    value: object = None
    required: bool = True

    def failed(self) -> Column:
        """True for a failing row; nulls pass all rules but not_null."""
        c = F.col(self.column)
        bad = {
            "not_null": lambda: c.isNull(),
            "max_length": lambda: F.length(c.cast("string")) > self.value,
            "accepted": lambda: ~c.isin(*self.value),
            "companion": lambda: c.isNotNull() & F.col(self.value).isNull(),
            "pattern": lambda: ~c.cast("string").rlike(self.value),
            "between": lambda: ~c.between(*self.value),
        }[self.kind]()
        return F.coalesce(bad, F.lit(False))


def row_checks(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule_id, checked, failed, status): every row rule in a single pass over the data."""
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(r.failed()).alias(f"f{k}") for k, r in enumerate(rules)])
    entry = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.col("n").alias("checked"), F.col(f"f{k}").alias("failed")) for k, r in enumerate(rules)])
    status = F.when(F.col("checked") == 0, "not-applicable").when(F.col("failed") > 0, "fail").otherwise("pass")
    return counts.select(F.explode(entry).alias("e")).select("e.*").withColumn("status", status)


def snapshot_unique(df: DataFrame, keys: list[str], rule_id: str = "unique") -> DataFrame:
    """(rule_id, checked, failed, status): failed counts duplicated key values; null keys form a group like any other."""
    per = df.groupBy(*keys).count()
    out = per.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("checked"), F.count_if(F.col("count") > 1).alias("failed"))
    return out.select(F.lit(rule_id).alias("rule_id"), "checked", "failed", F.when(F.col("checked") == 0, "not-applicable").when(F.col("failed") > 0, "fail").otherwise("pass").alias("status"))


def batch_unique(df: DataFrame, batch: str, keys: list[str], rule_id: str = "batch_unique") -> DataFrame:
    """(rule_id, checked, failed, status): failed counts the rows whose key repeats inside their batch."""
    per = df.groupBy(batch, *keys).count()
    out = per.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("checked"), F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0)).alias("failed"))
    return out.select(F.lit(rule_id).alias("rule_id"), "checked", "failed", F.when(F.col("failed") > 0, "fail").otherwise("pass").alias("status"))


def relationship(child: DataFrame, key: str, parent: DataFrame | None, parent_key: str, rule_id: str = "relationship") -> DataFrame:
    """(rule_id, checked, failed, status): child rows without a parent; null keys aren't checked; without a parent table not-run."""
    if parent is None:
        return child.limit(0).agg(F.count("*").alias("checked")).select(F.lit(rule_id).alias("rule_id"), "checked", F.lit(0).cast("long").alias("failed"), F.lit("not-run").alias("status"))
    # keys are counted before they meet, so a hot key is one row
    keys = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    known = parent.where(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias("k"), F.lit(True).alias("known")).distinct()
    out = keys.join(known, "k", "left").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("checked"), F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("failed"))
    return out.select(F.lit(rule_id).alias("rule_id"), "checked", "failed", F.when(F.col("checked") == 0, "not-applicable").when(F.col("failed") > 0, "fail").otherwise("pass").alias("status"))


def publishable(report: DataFrame, required: list[str]) -> DataFrame:
    """(publishable, failing, missing): true only if every required rule is in the report and passed or had nothing to check."""
    ok = report.where(F.col("status").isin("pass", "not-applicable")).agg(F.collect_set("rule_id").alias("ok"), F.lit(0).alias("z"))
    want = F.array(*[F.lit(r) for r in required])
    return ok.select((F.size(F.array_except(want, F.col("ok"))) == 0).alias("publishable"), F.size(F.array_except(want, F.col("ok"))).alias("failing"))


SECRET = r"(?i)(password|secret|token|api_?key|credential)"


def failure_sample(df: DataFrame, rule: Rule, columns: list[str], rows: int = 5, width: int = 64) -> DataFrame:
    """A few failing rows, values cut short and secret-looking columns redacted: a bounded sample is the feature."""
    shown = [F.lit("<redacted>").alias(c) if re.search(SECRET, c) else F.substring(F.col(c).cast("string"), 1, width).alias(c) for c in columns]
    return df.where(rule.failed()).orderBy(*columns).limit(rows).select(*shown)


def conforms(df: DataFrame, schema) -> list[str]:
    """Differences between a frame's schema and a contract's: missing, extra and mistyped columns; decimals of any width agree."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
    out = [f"missing {c}" for c in want if c not in have] + [f"extra {c}" for c in have if c not in want]
    for c in want.keys() & have.keys():
        a, b = have[c].simpleString(), want[c].simpleString()
        if a != b and not (a.startswith("decimal") and b.startswith("decimal")):
            out.append(f"{c} is {a}, not {b}")
    return sorted(out)


def compile_rules(contract) -> tuple[list[Rule], list[dict]]:
    """(row rules, whole-table rules) of a contract: nullability, lengths, accepted values and units as rows; types, uniqueness
    of primary keys and references as {rule_id, kind, column, ...}. Fields may carry accepted and unit in the contract's bindings
    as "accepted:name" (values parted by |) and "unit:name" (the column that holds the unit)."""
    rows, tables = [], []
    for f in contract.fields:
        at = f"{contract.name}.{f.name}"
        tables.append({"rule_id": f"{at}.type", "kind": "decimal" if f.data_type().simpleString().startswith("decimal") else "type", "column": f.name, "type": f.data_type().simpleString(), "required": True})
        if f.required or f.primary:
            rows.append(Rule(f"{at}.not_null", "not_null", f.name))
        if f.max_length is not None:
            rows.append(Rule(f"{at}.max_length", "max_length", f.name, f.max_length))
        if accepted := contract.bindings.get(f"accepted:{f.name}"):
            rows.append(Rule(f"{at}.accepted", "accepted", f.name, accepted.split("|")))
        if unit := contract.bindings.get(f"unit:{f.name}"):
            rows.append(Rule(f"{at}.unit", "companion", f.name, unit))
        if f.references:
            tables.append({"rule_id": f"{at}.reference", "kind": "relationship", "column": f.name, "parent": f.references[0], "parent_key": f.references[1], "required": True})
    if keys := [f.name for f in contract.fields if f.primary]:
        tables.append({"rule_id": f"{contract.name}.unique", "kind": "unique", "columns": keys, "required": True})
    return rows, tables


def run_contract(df: DataFrame, contract, parents: dict[str, DataFrame] | None = None, min_rows: int = 0) -> DataFrame:
    """(rule_id, checked, failed, status): every rule of a contract over one dataset. Row rules take one pass; a missing parent is
    not-run; fewer rows than min_rows fail; extra columns are a warning."""
    spark = df.sparkSession
    rows, tables = compile_rules(contract)
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    out = row_checks(df, [r for r in rows if r.column in have and (r.kind != "companion" or r.value in have)])
    said: list[tuple] = [(r.rule_id, 0, 0, "not-run") for r in rows if r.column not in have or r.kind == "companion" and r.value not in have]
    for t in tables:
        if t["kind"] in ("type", "decimal"):
            got, want = have.get(t["column"], "missing"), t["type"]
            fine = got == want or t["kind"] == "decimal" and got.startswith("decimal")
            said.append((t["rule_id"], 1, int(not fine), "pass" if fine else "fail"))
        elif t["kind"] == "unique":
            out = out.unionByName(snapshot_unique(df, t["columns"], t["rule_id"]))
        else:
            out = out.unionByName(relationship(df, t["column"], (parents or {}).get(t["parent"]), t["parent_key"], t["rule_id"]))
    extra = [c for c in have if c not in contract.schema().names]
    said.append((f"{contract.name}.extra_columns", len(have), len(extra), "warning" if extra else "pass"))
    size = df.agg(F.count("*").alias("checked")).select(F.lit(f"{contract.name}.min_rows").alias("rule_id"), "checked", (F.col("checked") < min_rows).cast("long").alias("failed"), F.when(F.col("checked") < min_rows, "fail").otherwise("pass").alias("status"))
    columns = ("rule_id", "checked", "failed", "status")
    return out.select(*columns).unionByName(size.select(*columns)).unionByName(spark.createDataFrame(said, "rule_id string, checked long, failed long, status string"))


#: Statuses, worst first: of several results of a rule the worst holds.
STATUSES = ("fail", "not-run", "warning", "pass", "not-applicable")


def merge_results(results: DataFrame, samples: int = 5) -> DataFrame:
    """(rule_id, checked, failed, status, samples): results of batches (rule_id, batch, checked, failed, status, samples: array)
    merged by rule: sums, the worst status, and the first few samples in the order of the batches."""
    rank = F.array_position(F.array(*[F.lit(x) for x in STATUSES]), F.col("status"))
    first = F.filter(F.collect_list(F.when(F.size("samples") > 0, F.struct("batch", F.slice("samples", 1, samples).alias("s")))), lambda x: x.isNotNull())
    per = results.groupBy("rule_id").agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"), F.min_by("status", rank).alias("status"), F.slice(F.flatten(F.transform(F.sort_array(first), lambda x: x["s"])), 1, samples).alias("samples"))
    return per.select("rule_id", "checked", "failed", "status", "samples")


def overall(report: DataFrame, required: list[str]) -> DataFrame:
    """(status, failed, warnings, missing): fail if a rule failed or a required one is missing or did not run; warning if one warns."""
    want = F.array(*[F.lit(x) for x in required]) if required else F.array().cast("array<string>")
    c = report.agg(F.count_if(F.col("status") == "fail").alias("failed"), F.count_if(F.col("status") == "warning").alias("warnings"), F.collect_set(F.when(F.col("status") != "not-run", F.col("rule_id"))).alias("ran"))
    missing = F.size(F.array_except(want, F.col("ran")))
    return c.select(F.when((F.col("failed") > 0) | (missing > 0), "fail").when(F.col("warnings") > 0, "warning").otherwise("pass").alias("status"), "failed", "warnings", missing.alias("missing"))


def findings_as_results(findings: DataFrame, rules: list[str], not_run: tuple[str, ...] = ()) -> DataFrame:
    """(rule_id, checked, failed, status) of semantic findings (rule_id, subject, detail): a rule without any passes; rules that no
    producer here can run are not-run."""
    spark = findings.sparkSession
    every = spark.createDataFrame([(r, False) for r in rules] + [(r, True) for r in not_run], "rule_id string, off boolean")
    n = findings.groupBy("rule_id").agg(F.count("*").alias("failed"))
    j = every.join(n, "rule_id", "left").na.fill({"failed": 0})
    return j.select("rule_id", F.col("failed").alias("checked"), "failed", F.when(F.col("off"), "not-run").when(F.col("failed") > 0, "fail").otherwise("pass").alias("status"))


def provenance(df: DataFrame) -> DataFrame:
    """(rule_id, checked, failed, status) of an inventory (content_hash, status, reason, relative_path): hashes are 64 hex digits,
    refused files have a reason, paths stay inside their root."""
    return row_checks(
        df.withColumn("_refused", F.when(F.col("status") != "file", F.col("status"))).withColumn("_outside", F.when(F.array_contains(F.split("relative_path", "/"), "..") | F.col("relative_path").startswith("/"), F.lit("outside"))),
        [Rule("hash", "pattern", "content_hash", "^[0-9a-f]{64}$"), Rule("reason", "companion", "_refused", "reason"), Rule("inside", "accepted", "_outside", [""])],
    )
