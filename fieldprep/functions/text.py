"""String expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word for title casing: letters, marks, digits and inner apostrophes or stops.
WORD = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"
WORD_OR_GAP = rf"{WORD}|[^\p{{L}}\p{{M}}\p{{N}}_]+"

# Text in which no capital is two letters and the mark below does not occur.
SIMPLE_LETTERS = "^[\\x02-\\x7FÀ-Þà-ÿ’]*$"
# A character that ends a word and is followed by another; inner apostrophes and stops do not.
WORD_BREAK = r"((?<![\p{L}\p{N}_])['’.]|[^\p{L}\p{N}_ '’.])(?=[\p{L}\p{N}_])"
MARK = "\x01 "


def replace_first(col: Column, pattern: str, replacement: str = "") -> Column:
    """Replace only the first match; ``$1``… in the replacement count the pattern's own groups."""
    shifted = re.sub(r"\$(\d+)", lambda m: f"${int(m[1]) + 1}", replacement)
    return F.regexp_replace(col, rf"^([\s\S]*?)(?:{pattern})", "$1" + shifted)


def remove_first(col: Column, pattern: str) -> Column:
    return replace_first(col, pattern, "")


def remove_all(col: Column, pattern: str) -> Column:
    return F.regexp_replace(col, pattern, "")


def extract(col: Column, pattern: str, may_be_empty: bool = False) -> Column:
    """First match of ``pattern``, NULL where there is none.

    Spark's ``regexp_substr`` also gives NULL for an empty match; where a pattern can match
    nothing, ``may_be_empty`` keeps the empty text.
    """
    if may_be_empty:
        return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, 0))
    return F.regexp_substr(col, F.lit(pattern))


def split_digits_from_letters(col: Column) -> Column:
    """``100mile House`` → ``100 mile House`` (first place only)."""
    return replace_first(col, "([0-9]+)([a-zA-Z]+)", "$1 $2")


def title_case(col: Column) -> Column:
    """Capitalise each word, also after brackets and hyphens (``initcap`` does neither)."""
    pieces = F.regexp_extract_all(F.lower(col), F.lit(WORD_OR_GAP), F.lit(0))

    def capital(word: Column) -> Column:
        # A letter whose capital is two letters keeps the second one small (ß → Ss).
        head = F.upper(F.substring(word, 1, 1))
        return F.concat(F.substring(head, 1, 1), F.lower(F.substr(head, F.lit(2))), F.substr(word, F.lit(2)))

    # The common case needs no word list: ``initcap`` starts words after blanks, so a marked
    # blank goes in wherever another character breaks a word, and comes out again.
    marked = F.regexp_replace(col, WORD_BREAK, "$1" + MARK)
    simple = F.replace(F.initcap(marked), F.lit(MARK), F.lit(""))
    slow = F.array_join(F.transform(pieces, capital), "")
    return F.when(col.rlike(SIMPLE_LETTERS), simple).when(col.isNotNull(), slow)


def between_commas(col: Column) -> Column:
    """Text after the first ", " up to the last ",": the region in ``City, Region, Country``.

    Text of one line is cut by position; with line breaks, the pattern finds the line.
    """
    start = F.locate(", ", col) + 2
    last = F.length(col) - F.locate(",", F.reverse(col)) + 1
    cut = F.when((start > 2) & (last >= start), F.substring(col, start, last - start))
    breaks = [col.contains(b) for b in ("\n", "\r", "\x85", "\u2028", "\u2029")]
    return F.when(reduce(lambda a, b: a | b, breaks), extract(col, "(?<=, ).*(?=,)", may_be_empty=True)).otherwise(cut)


def before_comma(col: Column) -> Column:
    return remove_all(col, ",.*")


def strip_year_prefix(col: Column, year: int) -> Column:
    return remove_first(col, f"{year}-")


def strip_country_prefix(col: Column) -> Column:
    """``CA.BC`` → ``BC``."""
    return remove_first(col, r"[A-Z]{2}\.")


def plain_placename(col: Column, fold_accents: bool = True) -> Column:
    """Placename as a join key: accented e folded, a bracketed remark dropped."""
    folded = F.regexp_replace(col, "(é|Ã©)", "e") if fold_accents else col
    return remove_all(folded, r" \(.*\)")


def query_placename(col: Column, fold_accents: bool = True) -> Column:
    """The same name in the form an address query takes (blanks as ``%20``)."""
    return F.regexp_replace(plain_placename(col, fold_accents), " ", "%20")


def leading_word(col: Column) -> Column:
    """Letters that stand before the first blank that follows letters or nothing."""
    return extract(col, "[A-Za-z]*(?= )", may_be_empty=True)


def province_code(col: Column) -> Column:
    return extract(col, "[A-Z]{2}")


def without_province(col: Column) -> Column:
    return remove_all(col, "[A-Z]{2}")


def pad_clock(col: Column) -> Column:
    """Complete a trailing `` 5:30`` or `` 05:30`` to `` 05:30:00``."""
    wide = F.regexp_replace(col, " ([0-9])(:[0-9]{2})$", " 0$1$2:00")
    return F.regexp_replace(wide, " ([0-9]{2})(:[0-9]{2})$", " $1$2:00")


def to_number(col: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    return col.try_cast("double")


def whole_number(col: Column) -> Column:
    return F.floor(to_number(col))


def with_deletions(c: Column, most: int) -> Column:
    """All different texts that are left when up to ``most`` characters are taken out."""
    one = lambda t: F.transform(
        F.sequence(F.lit(1), F.char_length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.char_length(t)))
    )
    less = lambda t: F.when(F.char_length(t) > 0, one(t)).otherwise(F.array().cast("array<string>"))
    reached, last = F.array(c), F.array(c)
    for _ in range(most):
        last = F.array_distinct(F.flatten(F.transform(last, less)))
        reached = F.concat(reached, last)
    return F.array_distinct(reached)
