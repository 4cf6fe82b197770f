"""Lookups, membership flags and key filters.

Keys compare null-safe (``<=>``), which Spark still plans as an equi-join. Lookups
carry no broadcast hint: their size belongs to the caller, so Spark's own size check
(``spark.sql.autoBroadcastJoinThreshold``, and the adaptive one on measured sizes)
decides, and a lookup beyond it becomes a shuffled join whose hot keys adaptive
execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str | tuple[str, str]]


def _pairs(keys: Keys) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Keys, how: str = "left") -> DataFrame:
    """Join on null-safe keys, keeping the left key columns and the right payload."""
    pairs = _pairs(keys)
    right_keys = {r for _, r in pairs}
    aliases = {r: f"__key_{i}" for i, (_, r) in enumerate(pairs)}
    other = right.select(
        *[F.col(f"`{r}`").alias(a) for r, a in aliases.items()],
        *[f"`{c}`" for c in right.columns if c not in right_keys],
    )
    condition = reduce(
        lambda a, b: a & b, [left[f"`{l}`"].eqNullSafe(other[aliases[r]]) for l, r in pairs]
    )
    joined = left.join(other, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*aliases.values())


def semi(df: DataFrame, keys_df: DataFrame, keys: Keys) -> DataFrame:
    return null_safe_join(df, keys_df, keys, "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, keys: Keys) -> DataFrame:
    return null_safe_join(df, keys_df, keys, "left_anti")


def flag_membership(df: DataFrame, keys_df: DataFrame, keys: Keys, flag: str) -> DataFrame:
    """Boolean column: is the row's key in the key list? Never NULL."""
    right = [r for _, r in _pairs(keys)]
    marked = keys_df.select(*right).distinct().withColumn("__hit", F.lit(True))
    return null_safe_join(df, marked, keys).withColumn(flag, F.coalesce("__hit", F.lit(False))).drop("__hit")


def flag_expression_membership(df: DataFrame, value: Column, keys_df: DataFrame, key: str, flag: str) -> DataFrame:
    """As ``flag_membership`` with a computed left key."""
    return flag_membership(df.withColumn("__value", value), keys_df, [("__value", key)], flag).drop("__value")


def require_unique(lookup: DataFrame, *keys: str) -> None:
    """Raise if a lookup holds a key twice. Reads the lookup only."""
    twice = lookup.groupBy(*keys).count().filter("count > 1").limit(1)
    if twice.count():
        raise ValueError(f"lookup keys are not unique: {list(keys)}")


def correct_by_lookup(
    df: DataFrame,
    columns: Sequence[str],
    lookup: DataFrame,
    wrong: str,
    right: str,
    on_duplicates: str = "fan_out",
) -> DataFrame:
    """Replace names that have a correction, in each of several columns.

    A lookup that holds a name twice doubles the record; ``on_duplicates="error"`` refuses it.
    """
    if on_duplicates == "error":
        require_unique(lookup, wrong)
    corrections = lookup.select(F.col(wrong).alias("__wrong"), F.col(right).alias("__right"))
    for column in columns:
        df = (
            null_safe_join(df, corrections, [(column, "__wrong")])
            .withColumn(column, F.coalesce("__right", column))
            .drop("__right")
        )
    return df


def recode_by_lookup(df: DataFrame, column: str, lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Value from a lookup, the original where there is none."""
    return correct_by_lookup(df, [column], lookup, key, value)


def two_level_lookup(
    first: DataFrame, second: DataFrame, key: str, middle: str, value: str, default_rows: DataFrame | None = None
) -> DataFrame:
    """key → middle → value as one (key, value) lookup, with literal default rows appended."""
    joined = null_safe_join(first.select(key, middle), second.select(middle, value), [middle]).select(key, value)
    return joined if default_rows is None else joined.unionByName(default_rows.select(key, value))


def override_by_membership(df: DataFrame, rules: Sequence[tuple[Column, str, str]]) -> DataFrame:
    """Ordered (condition, column, value) overrides; an unknown condition changes nothing."""
    for condition, column, value in rules:
        df = df.withColumn(column, F.when(condition, F.lit(value)).otherwise(F.col(column)))
    return df


def full_outer_merge(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer natural join of aggregates over the same keys.

    Written as one union and one aggregation: a single shuffle for any number of
    tables instead of one per join. Every table must be unique by the keys: a key that a table
    holds twice fails the job that computes it. Columns of one name in two tables are refused.
    """
    payload = [c for t in tables for c in t.columns if c not in keys]
    if len(set(payload)) < len(payload):
        raise ValueError(f"a column is in two tables: {sorted({c for c in payload if payload.count(c) > 1})}")
    marked = [t.withColumn("__from", F.lit(i)) for i, t in enumerate(tables)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    most = F.greatest(F.lit(0), *[F.count_if(F.col("__from") == i) for i in range(len(tables))])
    refused = F.raise_error(F.lit(f"a table of the merge is not unique by {list(keys)}")).cast("boolean")
    merged = stacked.groupBy(*keys).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in payload], most.alias("__most")
    )
    return merged.filter(F.when(F.col("__most") > 1, refused).otherwise(F.lit(True))).drop("__most")


def attach_counts(dimension: DataFrame, counts: DataFrame, keys: Keys) -> DataFrame:
    """Dimension with its counts; a dimension row without facts keeps NULL."""
    return null_safe_join(dimension, counts, keys)


def keep_groups(df: DataFrame, keys: Sequence[str], row_ok: Column, clean: bool = True) -> DataFrame:
    """Rows of groups in which every judged row is fine, or rows of the other groups.

    A row whose test is NULL is not judged. The verdict is aggregated first (partial
    sums before the shuffle), so a hot group is one small row when it meets the facts.
    """
    verdict = df.groupBy(*keys).agg(F.count_if(~row_ok).alias("__bad"))
    chosen = verdict.filter(F.col("__bad") == 0 if clean else F.col("__bad") > 0).select(*keys)
    return semi(df, chosen, list(keys))
