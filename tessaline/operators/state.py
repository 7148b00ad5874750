"""Snapshot operators: what to fetch, what changed, what to keep, what may be removed.

A state has a row for each key: key, sha256, and change tokens. Keys are output paths, so no two outputs share one.
All are equi-joins on the key and partial aggregates; a gate is one row of counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADDED, UPDATED, UNCHANGED, REMOVED, PRESERVED, FAILED = "added", "updated", "unchanged", "removed", "preserved", "failed"


def classify(old: DataFrame, new: DataFrame, key: str = "key", sha: str = "sha256", exists: str | None = None) -> DataFrame:
    """(key, old_sha, new_sha, status) by full outer join. A row whose output is missing (exists false) is added again."""
    left = old.select(F.col(key).alias("__old"), F.col(sha).alias("old_sha"), *([F.col(exists).alias("__exists")] if exists else [F.lit(True).alias("__exists")]))
    right = new.select(F.col(key).alias("__new"), F.col(sha).alias("new_sha"))
    status = (F.when(F.col("__old").isNull(), ADDED).when(F.col("__new").isNull(), REMOVED).when(~F.coalesce(F.col("__exists"), F.lit(False)), ADDED)
              .when(F.col("old_sha").eqNullSafe(F.col("new_sha")), UNCHANGED).otherwise(UPDATED))
    return left.join(right, F.col("__old") == F.col("__new"), "full_outer").select(F.coalesce("__new", "__old").alias(key), "old_sha", "new_sha", status.alias("status"))


def status_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("status").agg(F.count("*").alias("n"))


def removals(old: DataFrame, new: DataFrame, key: str = "key", special: Column | None = None) -> DataFrame:
    """Old rows whose key is no longer planned; special rows (of sources, say) are never among them."""
    rows = old if special is None else old.filter(~special)
    return rows.join(new.select(F.col(key).alias("__planned")).distinct(), F.col(key) == F.col("__planned"), "left_anti")


def gated_removals(old: DataFrame, new: DataFrame, gate: DataFrame, scope: str, key: str = "key") -> DataFrame:
    """Removals within scopes whose gate is open: gate has (scope, open), false where discovery was incomplete, filtered or failed.

    Scopes without a gate row are closed.
    """
    opened = gate.filter("open").select(F.col(scope).alias("__scope")).distinct()
    return removals(old, new, key).join(opened, F.col(scope) == F.col("__scope"), "left_semi")


def scope_gates(planned: DataFrame, declared: DataFrame, filtered: bool = False, scope: str = "scope") -> DataFrame:
    """(scope, complete, rows, least_rows, open): the gate of each scope, as a relation.

    declared has (scope, complete) and maybe least_rows, several rows for a scope if several discoveries feed it: all must be
    complete. A scope is open if it is complete, has as many rows as it must (one, where nothing is said; none, for a scope
    that is known to be gone) and nothing was filtered. Scopes that are planned but not declared are closed, and so are those
    of which neither says anything: they have no row.
    """
    least = F.max("least_rows") if "least_rows" in declared.columns else F.lit(1)
    told = declared.groupBy(F.col(scope).alias("__d")).agg(F.bool_and(F.coalesce("complete", F.lit(False))).alias("complete"), F.coalesce(least, F.lit(1)).cast("bigint").alias("least_rows"))
    counted = planned.groupBy(F.col(scope).alias("__p")).agg(F.count("*").alias("rows"))
    both = told.join(counted, F.col("__d") == F.col("__p"), "full_outer").select(
        F.coalesce("__d", "__p").alias(scope), F.coalesce("complete", F.lit(False)).alias("complete"), F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("least_rows", F.lit(1)).alias("least_rows"))
    return both.withColumn("open", F.col("complete") & (F.col("rows") >= F.col("least_rows")) & ~F.lit(filtered))


def settled_tokens(outcomes: DataFrame, tokens: DataFrame, scope: str = "scope", status: str = "status") -> DataFrame:
    """(scope, token) of those scopes of tokens of which no outcome failed: a scope's token counts only after full success."""
    bad = outcomes.filter(F.col(status).isin(PRESERVED, FAILED)).select(F.col(scope).alias("__bad")).distinct()
    return tokens.join(bad, F.col(scope) == F.col("__bad"), "left_anti")


def plan_changes(manifest: DataFrame, state: DataFrame, key: str = "key", token: str = "token", exists: str | None = None, force: bool = False) -> DataFrame:
    """manifest with reason: 'new', 'changed', 'missing output', 'forced', or null where nothing has to be fetched."""
    known = state.select(F.col(key).alias("__key"), F.col(token).alias("__token"), *([F.col(exists).alias("__exists")] if exists else [F.lit(True).alias("__exists")]))
    reason = (F.when(F.col("__key").isNull(), "new").when(F.lit(force), "forced").when(~F.coalesce(F.col("__exists"), F.lit(False)), "missing output")
              .when(~F.col(token).eqNullSafe(F.col("__token")), "changed"))
    return manifest.join(known, F.col(key) == F.col("__key"), "left").withColumn("reason", reason).drop("__key", "__token", "__exists")


def preserve(planned: DataFrame, fetched: DataFrame, old: DataFrame, key: str = "key", columns: tuple[str, ...] = ("sha256",)) -> DataFrame:
    """(key, columns, status): what was fetched; else the old row, preserved; else failed. fetched rows with null sha failed."""
    f = fetched.select(F.col(key).alias("__f"), *[F.col(c).alias(f"__f_{c}") for c in columns])
    o = old.select(F.col(key).alias("__o"), *[F.col(c).alias(f"__o_{c}") for c in columns])
    got, had = F.col(f"__f_{columns[0]}").isNotNull(), F.col("__o").isNotNull()
    joined = planned.select(key).join(f, F.col(key) == F.col("__f"), "left").join(o, F.col(key) == F.col("__o"), "left")
    return joined.select(key, *[F.when(got, F.col(f"__f_{c}")).otherwise(F.col(f"__o_{c}")).alias(c) for c in columns], F.when(got, "fetched").when(had, PRESERVED).otherwise(FAILED).alias("status"))


def fast_path(sources: DataFrame, outputs: DataFrame, source: str = "source", fingerprint: str = "fingerprint", new_fingerprint: str = "new_fingerprint") -> DataFrame:
    """(source, skip): whether the fingerprint is as before, there are outputs, and all of them exist (outputs: source, exists)."""
    whole = outputs.groupBy(F.col(source).alias("__s")).agg(F.bool_and("exists").alias("whole"), F.count("*").alias("n"))
    skip = F.col(fingerprint).eqNullSafe(F.col(new_fingerprint)) & F.col(fingerprint).isNotNull() & F.coalesce(F.col("whole") & (F.col("n") > 0), F.lit(False))
    return sources.join(whole, F.col(source) == F.col("__s"), "left").select(source, skip.alias("skip"))


@dataclass(frozen=True)
class Gate:
    """Whether a destructive step may run: complete discovery, no failures, no ad-hoc filter or limit, enough rows."""

    complete: bool = True
    failures: int = 0
    filtered: bool = False
    rows: int = 0
    least_rows: int = 0

    @property
    def open(self) -> bool:
        return self.complete and not self.failures and not self.filtered and self.rows >= self.least_rows

    def require_rows(self) -> None:
        """Abort before any change where a source yields less than it must."""
        if self.rows < self.least_rows:
            raise RuntimeError(f"only {self.rows} rows were discovered; {self.least_rows} at least are expected; nothing was changed")
