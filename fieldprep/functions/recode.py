"""Conditional recoding. Rules are data; each helper folds them into one expression."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUE_TEXT, FALSE_TEXT = "true", "false"


def holds(condition: Column) -> Column:
    """TRUE where the condition is TRUE; FALSE where it is FALSE or NULL."""
    return F.coalesce(condition, F.lit(False))


def in_set(col: Column, values: Iterable) -> Column:
    """Membership that is never NULL: NULL is a member only if NULL is listed."""
    listed = list(values)
    known = [v for v in listed if v is not None]
    member = holds(col.isin(known)) if known else F.lit(False)
    return (member | col.isNull()) if len(known) < len(listed) else member


def fold_rules(rules: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """First rule that holds decides."""
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return otherwise if out is None else out.otherwise(otherwise)


def recode_first_match(col: Column, rules: Sequence[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """Ordered (pattern, value) rules; the first pattern found in the text wins.

    A pattern without special characters is a plain search, which needs no regex engine.
    """
    test = lambda p: col.contains(p) if p == re.escape(p).replace("\\ ", " ").replace("\\-", "-") else col.rlike(p)
    return fold_rules([(test(p), F.lit(v)) for p, v in rules], col if otherwise is None else otherwise)


def recode_contains(col: Column, rules: Sequence[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """As ``recode_first_match`` for plain words, without the regex engine."""
    return fold_rules([(col.contains(p), F.lit(v)) for p, v in rules], col if otherwise is None else otherwise)


def recode_exact(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the rest: one lookup in a constant map."""
    constant = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(F.try_element_at(constant, col), col)


def normalise_flag_text(col: Column) -> Column:
    """NULL and "FALSE" → "false", "TRUE" → "true", anything else as it is."""
    return F.coalesce(recode_exact(col, {"TRUE": TRUE_TEXT, "FALSE": FALSE_TEXT}), F.lit(FALSE_TEXT))


def flag_text_to_boolean(col: Column) -> Column:
    """TRUE for "TRUE" or "true", FALSE for other text, NULL for NULL."""
    return F.array_contains(F.array(F.lit("TRUE"), F.lit(TRUE_TEXT)), col)


def yes_no(col: Column) -> Column:
    """yes/no to flag text; other answers are unknown (NULL)."""
    return F.when(col == "yes", F.lit(TRUE_TEXT)).when(col == "no", F.lit(FALSE_TEXT))


def flag_text(condition: Column) -> Column:
    """Flag text of a condition; an unknown condition counts as not met."""
    return F.when(condition, F.lit(TRUE_TEXT)).otherwise(F.lit(FALSE_TEXT))


def other_to_text(col: Column, free_text: Column, always_text: bool = False) -> Column:
    """"Other" gives the free text, a named choice gives itself, NULL stays NULL.

    ``always_text`` gives the free text for a named choice too.
    """
    return F.when(col == "Other", free_text).when(col != "Other", free_text if always_text else col)


def class_of(col: Column, members: Iterable[str], inside: str, outside: str) -> Column:
    return F.when(in_set(col, members), F.lit(inside)).otherwise(F.lit(outside))


def either_flag(*flags: Column) -> Column:
    """OR over flags given as text ("TRUE" or "true") or boolean, unknown counting as FALSE."""
    out = F.lit(False)
    for flag in flags:
        out = out | holds(flag_text_to_boolean(flag.cast("string")))
    return out


def all_missing(*cols: Column) -> Column:
    return F.coalesce(*[c.cast("string") for c in cols]).isNull()


def value_if(col: Column, label: str, amount: Column, otherwise: str = "0") -> Column:
    """The amount where the column carries the label, else a fixed text."""
    return F.when(col == label, amount).otherwise(F.lit(otherwise))


def null_if_false(col: Column) -> Column:
    return F.when(col, F.lit(True))


def replace_value(col: Column, old, new) -> Column:
    return F.when(col == old, F.lit(new)).otherwise(col)
