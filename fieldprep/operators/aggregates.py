"""Grouped aggregation. Everything combines before the shuffle; no group is gathered."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.operators.joins import anti, null_safe_join, semi
from fieldprep.session import stored


def total(col: Column | str) -> Column:
    """Sum that is 0, not NULL, when nothing is known."""
    return F.coalesce(F.sum(col), F.lit(0))


def none_as_null(count: Column) -> Column:
    return F.nullif(count, F.lit(0).cast("bigint"))


def conditional_counts(
    df: DataFrame, keys: Sequence[str], counts: Mapping[str, Column | None], zero_as_null: bool = False
) -> DataFrame:
    """Several filtered counts per key in one pass; ``None`` counts every row."""
    shape = none_as_null if zero_as_null else (lambda c: c)
    return df.groupBy(*keys).agg(
        *[shape(F.count(F.lit(1)) if c is None else F.count_if(c)).alias(a) for a, c in counts.items()]
    )


def group_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str], count: str = "n") -> DataFrame:
    """Row count and sums; flags count as 0/1."""
    kinds = dict(df.dtypes)
    as_number = lambda m: F.col(m).cast("int") if kinds[m] == "boolean" else F.col(m)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count), *[total(as_number(m)).alias(m) for m in measures]
    )


def resum(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum finished counts to a coarser key."""
    return df.groupBy(*keys).agg(*[total(F.col(m)).alias(m) for m in measures])


def pivot_counts(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], prefix: str = "", where: Column | None = None
) -> DataFrame:
    """Count per listed value, one column each, 0 where none. The values are given, never discovered."""
    hit = F.lit(True) if where is None else where
    return df.groupBy(*keys).agg(*[F.count_if(hit & (F.col(column) == v)).alias(f"{prefix}{v}") for v in values])


def dimension_year_summary(
    dimension: DataFrame,
    facts: DataFrame,
    key: str,
    year: str,
    counts: Mapping[str, Column | None],
    distinct_of: Column,
    distinct_alias: str,
) -> DataFrame:
    """Per dimension member and year: counts (0 where none) and the number of distinct known values.

    A member without facts keeps one row with a NULL year. The distinct count is NULL, not 0,
    where no value is known.
    """
    summary = facts.groupBy(key, year).agg(
        *[(F.count(F.lit(1)) if c is None else F.count_if(c)).alias(a) for a, c in counts.items()],
        none_as_null(F.count_distinct(distinct_of)).alias(distinct_alias),
    )
    joined = null_safe_join(dimension, summary, [key])
    return joined.withColumns({a: F.coalesce(a, F.lit(0)) for a in counts})


def inside_outside_counts(df: DataFrame, keys: Sequence[str], inside: Column) -> DataFrame:
    """Rows inside and outside an interval per group, and their total."""
    return (
        df.groupBy(*keys)
        .agg(F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside"))
        .withColumn("total", F.col("inside") + F.col("outside"))
    )


def class_lookup(lookup: DataFrame, key: str, value: str, classes: Sequence[str]) -> DataFrame:
    """One row per key: how often it has each class, any class, and how often it is listed."""
    of = [F.count_if(F.col(value) == c).alias(f"__n{i}") for i, c in enumerate(classes)]
    return lookup.groupBy(key).agg(*of, F.count(value).alias("__any"), F.count(F.lit(1)).alias("__fan"))


def classify_multi_value(
    df: DataFrame,
    id_column: str,
    column: str,
    lookup: DataFrame,
    key: str,
    value: str,
    classes: Mapping[str, str],
    slots: int = 3,
    missing: str = "Unknown",
    also_missing: Sequence[str] = ("other",),
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Class counts of a comma-separated cell, pooled over all rows with the same id.

    ``classes`` maps each class to its output column. The first ``slots`` parts are looked up,
    untrimmed; a missing first part counts as ``missing``. A row none of whose parts has a class
    vanishes; a row shows 0 for classes it does not hold itself. Rows that are identical once
    ``prepare`` (narrow rules on other columns) has run collapse.

    An id that occurs once pools nothing and has no twin. Repeated ids are found first by a narrow
    aggregation and stored, so that their true size decides the joins: with a short list the wide
    rows are neither shuffled nor compared. The joins against that list come before ``prepare``, so
    every row is prepared once.
    """
    own = {cls: f"__own{i}" for i, cls in enumerate(classes)}
    # Every slot of every branch reads it: stored, it is made once and its size is known.
    counts = stored(class_lookup(lookup, key, value, list(own)))
    classed = lambda rows: _with_own_counts(rows, column, counts, key, own, slots, missing, also_missing)
    narrow = df.select(F.col(id_column).alias("__id"), column)
    repeated = stored(
        classed(narrow)
        .groupBy("__id")
        .agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(a).alias(f"{a}_all") for a in own.values()])
        .filter(F.col("__rows") > 1)
        .drop("__rows")
    )
    held = [(id_column, "__id")]
    rest = df.drop(*classes.values())

    def finished(rows: DataFrame, suffix: str) -> DataFrame:
        counted = {
            out: F.when(F.col(own[c]) > 0, F.col(own[c] + suffix)).otherwise(0).cast("double") for c, out in classes.items()
        }
        helpers = [c for c in rows.columns if c.startswith(("__own", "__part"))]
        return rows.withColumns(counted).drop(*helpers)

    single = finished(classed(anti(rest, repeated, held)).drop(column), "")
    twins = prepare(classed(semi(rest, repeated, held)).drop(column)).distinct()
    several = finished(null_safe_join(twins, repeated, held, "inner"), "_all")
    return prepare(single).unionByName(several)


def class_parts(
    df: DataFrame,
    id_column: str,
    column: str,
    lookup: DataFrame,
    key: str,
    value: str,
    classes: Mapping[str, str],
    slots: int = 3,
    missing: str = "Unknown",
    also_missing: Sequence[str] = ("other",),
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """One arriving table's share of ``classify_multi_value``: its rows, and what it adds per id.

    The rows hold their own counts (``__own0`` and so on); twins, which agree in all columns and so
    come in one table, collapsed. The second table has one narrow row per id, with the number of rows and
    the sums of their counts; those of several tables add up. ``pool_parts`` puts both together.
    """
    own = {cls: f"__own{i}" for i, cls in enumerate(classes)}
    # Every slot of every branch reads it: stored, it is made once and its size is known.
    counts = stored(class_lookup(lookup, key, value, list(own)))
    classed = lambda rows: _with_own_counts(rows, column, counts, key, own, slots, missing, also_missing)
    narrow = classed(df.select(F.col(id_column).alias("__id"), column))
    adds = narrow.groupBy("__id").agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(a).alias(f"{a}_all") for a in own.values()])
    repeated = stored(adds.filter(F.col("__rows") > 1).select("__id"))
    held, rest = [(id_column, "__id")], df.drop(*classes.values())

    def bare(rows: DataFrame) -> DataFrame:
        rows = rows.drop(column, *[c for c in rows.columns if c.startswith("__part")])
        return prepare(rows)

    single, twins = bare(classed(anti(rest, repeated, held))), bare(classed(semi(rest, repeated, held))).distinct()
    return single.unionByName(twins), adds


def pool_parts(rows: DataFrame, adds: DataFrame, id_column: str, classes: Mapping[str, str]) -> DataFrame:
    """The classes' counts of all rows, pooled over the ids of all tables that ``adds`` has sums of.

    Rows without own counts keep what they have. Only ids of several rows pool anything; they are
    stored first, so that their true size decides the join.
    """
    own = {out: f"__own{i}" for i, out in enumerate(classes.values())}
    sums = adds.groupBy("__id").agg(F.sum("__rows").alias("__rows"), *[F.sum(f"{a}_all").alias(f"{a}_all") for a in own.values()])
    repeated = stored(sums.filter(F.col("__rows") > 1).drop("__rows"))
    joined = null_safe_join(rows, repeated, [(id_column, "__id")])

    def counter(out: str, a: str) -> Column:
        pooled = F.when(F.col(a) > 0, F.coalesce(f"{a}_all", a)).otherwise(0).cast("double")
        return F.when(F.col(a).isNull(), F.col(out)).otherwise(pooled) if out in rows.columns else F.when(F.col(a).isNotNull(), pooled)

    return joined.withColumns({out: counter(out, a) for out, a in own.items()}).drop(*own.values(), *[f"{a}_all" for a in own.values()])


def _with_own_counts(
    df: DataFrame,
    column: str,
    counts: DataFrame,
    key: str,
    own: Mapping[str, str],
    slots: int,
    missing: str,
    also_missing: Sequence[str],
) -> DataFrame:
    """The parts of a cell and how often a row holds each class; rows without any class dropped.

    Each part meets the lookup (``class_lookup``) once as a row of counts, so nothing is exploded or gathered and the
    row never has to be put together again; a key listed k times weighs the other parts k-fold,
    as a row-multiplying join would.
    """
    columns = [c for c in counts.columns if c != key]
    parts = F.split(F.col(column), ",", -1)
    work = df.withColumns({f"__part{i}": F.get(parts, F.lit(i)) for i in range(slots)})
    first = F.coalesce("__part0", F.lit(missing))
    work = work.withColumn("__part0", F.when(first.isin(list(also_missing)), F.lit(missing)).otherwise(first))
    for i in range(slots):
        slot = counts.select(key, *[F.col(c).alias(f"{c}_{i}") for c in columns])
        work = null_safe_join(work, slot, [(f"__part{i}", key)])
    fan = lambda i: F.coalesce(F.col(f"__fan_{i}"), F.lit(1))

    def held(number: int) -> Column:
        out = F.lit(0).cast("bigint")
        for i in range(slots):
            here = F.coalesce(F.col(f"__n{number}_{i}"), F.lit(0))
            for j in range(slots):
                if j != i:
                    here = here * fan(j)
            out = out + here
        return out

    known = F.lit(0)
    for i in range(slots):
        known = known + F.coalesce(F.col(f"__any_{i}"), F.lit(0))
    helpers = [f"{c}_{i}" for c in columns for i in range(slots)]
    return work.filter(known > 0).withColumns({a: held(n) for n, a in enumerate(own.values())}).drop(*helpers)
