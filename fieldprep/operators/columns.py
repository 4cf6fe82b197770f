"""Column naming and projection."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Two province headers that older tables spell differently.
PROVINCE_HEADER = "State_Province_of_Destination_Waterbody"
PROVINCE_HEADER_VARIANTS = ("Destination_Province_State", "Province_State_of_Destination_Waterbody")


def clean_name(name: str) -> str:
    """Blanks and slashes to underscores, ``?`` and ``#`` dropped, province headers unified."""
    tidy = re.sub(r"[?#]", "", re.sub(r"[ /]", "_", name))
    for variant in PROVINCE_HEADER_VARIANTS:
        tidy = tidy.replace(variant, PROVINCE_HEADER, 1)
    return tidy


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def snake_name(name: str) -> str:
    parts = re.findall(r"[A-Z]+(?![a-z])|[A-Z][a-z]*|[a-z]+|[0-9]+", name)
    return "_".join(p.lower() for p in parts)


def snake_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def repair_duplicate_names(names: Sequence[str]) -> list[str]:
    """Repeated or empty headers get a ``...<position>`` suffix, counting from 1."""
    seen = Counter(names)
    return [n if n and seen[n] == 1 else f"{n}...{i}" for i, n in enumerate(names, 1)]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def project(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Exactly the given columns, in order; what is not listed is dropped."""
    return df.select(*[expr.alias(name) for name, expr in rules.items()])


def derive_in_order(df: DataFrame, steps: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Add columns step by step, so that a later step can use the columns of an earlier one."""
    for step in steps:
        df = df.withColumns(dict(step))
    return df


def select_once(df: DataFrame, names: Sequence[str], missing_as_null: bool = False) -> DataFrame:
    """Select a fixed list; a name listed twice is kept once."""
    wanted = list(dict.fromkeys(names))
    if not missing_as_null:
        require_columns(df, wanted)
    have = set(df.columns)
    return df.select(*[F.col(f"`{n}`") if n in have else F.lit(None).cast("string").alias(n) for n in wanted])


def move_first(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names, *[f"`{c}`" for c in df.columns if c not in names])


def keep_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.select(*[f"`{c}`" for c in other.columns])


def apply_to_columns(
    df: DataFrame,
    change: Callable[[Column], Column],
    names: Iterable[str] = (),
    suffix: str | None = None,
    containing: str | None = None,
) -> DataFrame:
    """One expression over named columns and over columns matched by a suffix or a part.

    Matching ignores case.
    """
    listed = set(names)
    hit = [
        c
        for c in df.columns
        if c in listed
        or (suffix is not None and c.lower().endswith(suffix.lower()))
        or (containing is not None and containing.lower() in c.lower())
    ]
    return df.withColumns({c: change(F.col(f"`{c}`")) for c in hit})
