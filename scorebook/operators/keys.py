"""Key-set operators for incremental ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorebook.functions.columns import cast_to_schema


def new_keys(landed: DataFrame, processed: DataFrame, key: str = "match_id") -> DataFrame:
    """Keys landed but not yet processed (anti join, nulls never match)."""
    return landed.select(key).join(processed.select(key), on=key, how="left_anti")


def seen_keys(landed: DataFrame, processed: DataFrame, key: str = "match_id") -> DataFrame:
    """Landed keys that were already processed (reported, then skipped)."""
    return landed.select(key).join(processed.select(key), on=key, how="left_semi")


def any_seen(new: DataFrame, existing: DataFrame, key: str = "match_id") -> bool:
    """I4/A3: does any new key already exist? Semi join + limit 1: stops at the first hit."""
    return not seen_keys(new, existing, key).limit(1).isEmpty()


def duplicate_guard(new: DataFrame, existing: DataFrame, key: str = "match_id") -> None:
    """I4: raise if any new key is already loaded (always run, unlike the reference)."""
    if any_seen(new, existing, key):
        raise ValueError(f"new {key} values already exist in the target table")


def delta_count(df: DataFrame) -> int:
    """Number of fully non-null rows."""
    return df.dropna(how="any").count()


def merge_append(old: DataFrame, new: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Cast both sides to one schema (when given) and union by name."""
    if schema is not None:
        old, new = cast_to_schema(old, schema), cast_to_schema(new, schema)
    return old.unionByName(new)


def key_setops(landed: DataFrame, processed: DataFrame, key: str = "match_id") -> DataFrame:
    """Set difference and intersection of key sets, tagged."""
    a, b = landed.select(key), processed.select(key)
    return (a.subtract(b).withColumn("side", F.lit("only_landed"))
            .unionByName(a.intersect(b).withColumn("side", F.lit("both"))))


def version_decisions(held: DataFrame, batch: DataFrame, key: str = "match_id", version: str = "drop",
                      digest: str = "digest") -> DataFrame:
    """I1/I2 for documents that come again: `batch` (one row per key) with `decision`.

    new: the key is not held; same: its content is (equal digests, whatever the versions; two nulls are equal); replace: other
    content of a greater version; late: other content of the held or a smaller version, or of a null one. `held` has one row
    per key; null keys match nothing. A null held version is replaced by any other.
    """
    old = held.select(F.col(key), F.col(version).alias("__sb_version"), F.col(digest).alias("__sb_digest"),
                      F.lit(True).alias("__sb_held"))
    newer = F.col(version).isNotNull() & (F.col("__sb_version").isNull() | (F.col(version) > F.col("__sb_version")))
    decision = (F.when(F.col("__sb_held").isNull(), "new")
                .when(F.col(digest).eqNullSafe(F.col("__sb_digest")), "same")
                .when(newer, "replace").otherwise("late"))
    return batch.join(old, key, "left").select(*[batch[c] for c in batch.columns], decision.alias("decision"))
