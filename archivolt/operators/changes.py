"""Incremental change: manifest diffs, tombstones, upserts, retractions and active views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def manifest_diff(old: DataFrame, new: DataFrame, comparable: DataFrame | None = None) -> DataFrame:
    """(kind, silo, path, previous_path, content_hash): add, content-change, path-rename, remove, or withheld.

    Both have (silo, path, content_hash). A removed and an added path of one silo with equal content pair up, in order of their
    paths, as renames. comparable lists the silos (column `silo`) whose scans are complete; removals elsewhere are withheld."""
    o = old.select("silo", "path", F.col("content_hash").alias("old_hash"))
    n = new.select("silo", "path", F.col("content_hash").alias("new_hash"))
    both = o.join(n, ["silo", "path"], "full_outer")
    changed = both.where(F.col("old_hash") != F.col("new_hash")).select(F.lit("content-change").alias("kind"), "silo", "path", F.lit(None).cast("string").alias("previous_path"), F.col("new_hash").alias("content_hash"))
    gone = both.where("new_hash is null and old_hash is not null").select("silo", F.col("path").alias("previous_path"), F.col("old_hash").alias("content_hash"))
    come = both.where("old_hash is null and new_hash is not null").select("silo", "path", F.col("new_hash").alias("content_hash"))
    gone = gone.withColumn("turn", F.row_number().over(Window.partitionBy("silo", "content_hash").orderBy("previous_path")))
    come = come.withColumn("turn", F.row_number().over(Window.partitionBy("silo", "content_hash").orderBy("path")))
    pair = come.join(gone, ["silo", "content_hash", "turn"], "full_outer")
    kind = F.when(F.col("path").isNull(), "remove").when(F.col("previous_path").isNull(), "add").otherwise("path-rename")
    moved = pair.select(kind.alias("kind"), "silo", F.coalesce("path", "previous_path").alias("path"), F.when(F.col("path").isNotNull(), F.col("previous_path")).alias("previous_path"), "content_hash")
    out = changed.unionByName(moved)
    if comparable is not None:
        sure = comparable.select("silo").distinct().withColumn("sure", F.lit(True))
        out = out.join(sure, "silo", "left").withColumn("kind", F.when((F.col("kind") == "remove") & F.col("sure").isNull(), "withheld").otherwise(F.col("kind"))).drop("sure")
    return out.select("kind", "silo", "path", "previous_path", "content_hash")


def tombstones(removed: DataFrame, current: DataFrame) -> DataFrame:
    """Removed rows with content_remains and last_occurrence, by the hashes of the current manifest over all silos."""
    left = current.select("content_hash").distinct().withColumn("remains", F.lit(True))
    t = removed.join(left, "content_hash", "left")
    return t.select(*removed.columns, F.coalesce("remains", F.lit(False)).alias("content_remains"), F.col("remains").isNull().alias("last_occurrence"))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the order columns; a partial-aggregated max, no sort."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*df.columns)


def upsert(base: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """base with new rows inserted or replacing those of equal keys; within new, the last by order wins."""
    fresh = latest(new, keys, order) if order else new.dropDuplicates(keys)
    return base.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def retract_absent(base: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of base whose key is in the complete snapshot; an empty snapshot clears all."""
    return base.join(snapshot.select(*keys).distinct(), keys, "left_semi")


def not_in(df: DataFrame, column: str, excluded: DataFrame, key: str) -> DataFrame:
    """SQL's NOT IN: a null among the excluded removes every row, and rows with a null never survive."""
    keys = excluded.select(F.col(key).alias("_key"))
    if not keys.where("_key is null").isEmpty():
        return df.where("false")
    # an ordinary anti join; SQL's own NOT IN would broadcast all excluded keys
    left = df.join(keys.distinct(), df[column] == F.col("_key"), "left_anti")
    return left if keys.isEmpty() else left.where(F.col(column).isNotNull())


def active_view(derived: DataFrame, occurrences: DataFrame, removed: DataFrame) -> DataFrame:
    """Derived rows by content hash with their remaining paths. Rows with a path left, bound by a review, or shared with other
    contents that have one (column shared_with, where there is one) stay; others go with their last path."""
    gone = removed.select("silo", "path").distinct()
    paths = occurrences.join(gone, ["silo", "path"], "left_anti").groupBy("content_hash").agg(F.count("*").alias("paths"))
    keep = F.col("paths").isNotNull() | F.coalesce(F.col("review_state").isin("review", "merged", "split"), F.lit(False))
    j = derived.join(paths, "content_hash", "left")
    if "shared_with" in derived.columns:
        row = F.monotonically_increasing_id()
        from archivolt.session import cut

        j = cut(j.withColumn("_row", row))
        alive = paths.select(F.col("content_hash").alias("_other"))
        shared = j.select("_row", F.explode("shared_with").alias("_other")).join(alive, "_other", "left_semi").select("_row").distinct().withColumn("_shared", F.lit(True))
        j = j.join(shared, "_row", "left").drop("_row")
        keep = keep | F.col("_shared").isNotNull()
    return j.where(keep).select(*derived.columns, F.coalesce("paths", F.lit(0)).alias("paths"))


#: What keeps a generation from being pruned.
PROTECTIONS = ("active", "pinned", "reviewed", "rollback", "ledger", "backup", "sole-recovery")


def prune_plan(generations: DataFrame, protected: DataFrame | list[str]) -> DataFrame:
    """Stale or superseded generations that nothing protects, oldest first. protected is a list of ids or rows (generation_id, reason)
    with a reason of PROTECTIONS; an unknown reason protects as well."""
    if isinstance(protected, list):
        protected = generations.sparkSession.createDataFrame([(p,) for p in protected], "generation_id string")
    old = generations.where(F.col("state").isin("stale", "superseded"))
    return old.join(protected.select("generation_id").dropna().distinct(), "generation_id", "left_anti").select(*generations.columns).orderBy("created_at", "generation_id")


def plan_fingerprint(plan: DataFrame) -> str:
    """Identity of a prune plan; applying it is refused if the plan drawn anew has another."""
    from archivolt.functions.hashing import set_checksum

    c = plan.agg(set_checksum(F.col("generation_id")).alias("c")).first().c
    return f"{c.n}:{c.xored}:{c.summed}"


def supersede(attempts: DataFrame, replacement: DataFrame) -> DataFrame:
    """attempts (stage, attempt_id, state) after replacements: earlier published attempts of their stages are superseded."""
    new = replacement.select("stage", F.col("attempt_id").alias("_new")).groupBy("stage").agg(F.collect_set("_new").alias("_new"))
    j = attempts.join(new, "stage", "left")
    old = F.col("_new").isNotNull() & ~F.coalesce(F.array_contains("_new", F.col("attempt_id")), F.lit(False)) & (F.col("state") == "published")
    kept = j.select("stage", "attempt_id", F.when(old, "superseded").otherwise(F.col("state")).alias("state"))
    fresh = replacement.join(attempts.select("attempt_id"), "attempt_id", "left_anti").select("stage", "attempt_id", F.lit("published").alias("state"))
    return kept.unionByName(fresh)


def invalidation(affected: DataFrame, depends: DataFrame) -> DataFrame:
    """(id): everything that depends, near or far, on affected contents (content_hash); depends has (src: what is used, dst: by what)."""
    from archivolt.operators.graph import reachable

    return reachable(depends, affected.select(F.col("content_hash").alias("id")).distinct())


def path_overlay(events: DataFrame) -> DataFrame:
    """(occurrence_id, document_id, relative_path, events, consistent): each occurrence's path after folding its ordered events.

    A rename applies only if its previous path is the current one; otherwise the occurrence is inconsistent. Repeated events count
    once; rows without an occurrence are left out. The fold runs in the JVM over each occurrence's own short list."""
    e = events.where("occurrence_id is not null").dropDuplicates(["event_id"])
    per = e.groupBy("occurrence_id").agg(F.min("document_id").alias("document_id"), F.array_sort(F.collect_list(F.struct("event_time", "event_id", "kind", "relative_path", "previous_relative_path"))).alias("log"))
    start = F.struct(F.lit(None).cast("string").alias("path"), F.lit(True).alias("ok"))

    def step(state, x):
        rename = x["kind"] == "rename"
        fits = state["path"].isNull() | ~rename | x["previous_relative_path"].eqNullSafe(state["path"])
        moves = rename & fits | ((x["kind"] != "rename") & state["path"].isNull())
        return F.struct(F.when(moves, x["relative_path"]).otherwise(state["path"]).alias("path"), (state["ok"] & fits).alias("ok"))

    done = F.aggregate("log", start, step)
    return per.select("occurrence_id", "document_id", done["path"].alias("relative_path"), F.size("log").alias("events"), done["ok"].alias("consistent"))


def merge_review(derived: DataFrame, decisions: DataFrame) -> DataFrame:
    """derived (object_id, ...) under review decisions (object_id, action, target_id): merged objects point to their target, split ones are marked.

    Decisions are overlays: nothing is deleted, and the last decision of an object counts."""
    last = latest(decisions.select("object_id", "action", "target_id", "decided_at"), ["object_id"], ["decided_at", "action", "target_id"])
    j = derived.join(last, "object_id", "left")
    state = F.when(F.col("action") == "merge", "merged").when(F.col("action") == "split", "split").otherwise(F.col("review_state"))
    return j.select(*[state.alias(c) if c == "review_state" else F.col(c) for c in derived.columns], F.when(F.col("action") == "merge", F.col("target_id")).otherwise(F.col("object_id")).alias("effective_id"))


def affected_hashes(diff: DataFrame) -> DataFrame:
    """(content_hash, reason): contents to process anew after a manifest diff: added and changed ones, and those only renamed."""
    reason = F.when(F.col("kind") == "path-rename", "renamed").when(F.col("kind").isin("add", "content-change"), "affected")
    return diff.select("content_hash", reason.alias("reason")).where("reason is not null").groupBy("content_hash").agg(F.min("reason").alias("reason"))
