"""Quality rules: surface counts, and divergence from what the language looks like.

Two histograms of a document, of its characters by class and of its language's common words, are
compared with the histograms of all documents of the language by the Jensen-Shannon distance, the
square root of the divergence in bits, between 0 and 1. A document is too short to be judged below
a number of characters or words, and so is a language.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldprep.llm.store import cut

#: Base rules: fewest words, and the largest percentage of words in repeated windows of three words.
LEAST_WORDS, REPEATED_PERCENT = 50, 50
#: Common words of a language.
COMMON = 12
#: Distances beyond which a document fails, and the sizes from which it is judged.
FAR_CHARS, FAR_WORDS = 0.32, 0.4
JUDGED_CHARS, JUDGED_WORDS = 200, 100
#: Languages up to which the short table of them is sent to every task, at about a kilobyte each.
LANGUAGES = 2000
#: Words of a language from which its reference counts.
REFERENCE_WORDS = 2000

BLANKS = r"[\x20\x09-\x0D]+"
#: Character classes apart from blanks and a-z, by what is not in them; what is in none is the last class.
CLASSES = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "symbol": "[^#*$%&|<>]+", "wide": r"[\x00-\x7F]+"}


def words_of(text: Column) -> Column:
    """The words of a text in order."""
    return F.array_remove(F.split(text, BLANKS), "")


def _base(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the words and the counts of every row."""
    rows = _base(docs).select(
        "*",
        words_of(F.col("text")).alias("words"),
        # Most of a text is a-z and blanks; the other classes are looked for in the rest.
        F.regexp_replace("text", r"[a-z\x20\x09-\x0D]+", "").alias("rest"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    )
    long = lambda c: c.cast("bigint")
    rows = rows.select(
        "doc_id",
        "lang",
        F.transform("words", F.lower).alias("lowered"),
        long(F.size("words")).alias("n_words"),
        long(F.length("text")).alias("n_chars"),
        long(F.length(F.array_join("words", ""))).alias("word_chars"),
        long(F.length("rest")).alias("n_rest"),
        *[long(F.length(F.regexp_replace("rest", drop, ""))).alias(f"n_{name}") for name, drop in CLASSES.items()],
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("words") >= 3, hashes).alias("hashes"),
    )
    rows = rows.withColumn("n_lower", F.col("word_chars") - F.col("n_rest")).drop("n_rest")
    # Only a text in which some window repeats is looked at window by window.
    placed = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("sorted", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(placed))).drop("hashes")
    # Windows whose neighbour in hash order has the same hash, then in text order.
    same = F.filter(
        "sorted", lambda x, j: (F.get("sorted", j - 1)["h"].eqNullSafe(x["h"])) | (F.get("sorted", j + 1)["h"].eqNullSafe(x["h"]))
    )
    rows = rows.withColumn("twice", F.sort_array(F.transform(same, lambda x: x["i"]))).drop("sorted")
    steps = F.transform("twice", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("twice", k + 1) - x, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("twice")


def _of_language(rows: DataFrame, known: DataFrame, how: str) -> DataFrame:
    """Rows with what is known of their language: without moving the rows, unless there are too many languages."""
    known = cut(known)
    return rows.join(F.broadcast(known) if known.count() <= LANGUAGES else known, "lang", how)


def common_words(docs: DataFrame) -> DataFrame:
    """lang and ``common``, the words that are most frequent in its documents, in order.

    Every word is counted, in partial sums before the shuffle; of equally frequent ones the first in
    code-point order leads. Each task hands on the best few of a language, so no task gets its vocabulary.
    """
    spoken = _base(docs).filter("lang IS NOT NULL").select("lang", F.explode(words_of(F.col("text"))).alias("word"))
    counts = spoken.select("lang", F.lower("word").alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    best = counts.withColumn("place", place).filter(F.col("place") <= COMMON)
    ordered = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("top"))
    return ordered.select("lang", F.transform("top", lambda x: x["word"]).alias("common"))


def _characters() -> Column:
    known = [F.col("n_lower"), *[F.col(f"n_{name}") for name in CLASSES]]
    blanks = F.col("n_chars") - F.col("word_chars")
    return F.array(*known, blanks, F.col("word_chars") - reduce(lambda a, b: a + b, known))


def _common_counts() -> Column:
    """How often each common word occurs, and how many other words there are."""
    hits = F.filter("lowered", lambda w: F.array_contains("common", w))
    return F.struct(hits.alias("hits"), (F.col("n_words") - F.size(hits)).alias("other"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; NULL if one has no counts."""
    total = [F.aggregate(x, F.lit(0.0), lambda a, v: a + v) for x in (p, q)]

    def part(x, y):
        a, b = x / total[0], y / total[1]
        m = (a + b) / 2
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0) + F.when(b > 0, b * F.log2(b / m)).otherwise(0.0)

    divergence = F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda s, v: s + v) / 2
    return F.when((total[0] > 0) & (total[1] > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: the counts, base_failed, kept, far_chars, far_words.

    The two distances are NULL where the document or its language is too short, or where ``lang`` is
    NULL; then only the base rules decide. A NULL text is the empty one, which fails them. Rows that
    repeat are each judged. An empty table gives an empty result. Other columns are not read.
    """
    rows = measured(docs)
    ready = _of_language(rows, common_words(docs), "left").withColumn("found", _common_counts())
    counts = F.transform("common", lambda w: F.size(F.filter("found.hits", lambda x: x == w)))
    ready = ready.withColumn("by_word", F.concat(counts.cast("array<double>"), F.array(F.col("found.other").cast("double"))))
    ready = cut(ready.withColumn("by_class", _characters().cast("array<double>")).drop("lowered", "found", "common"))
    sums = [F.sum(F.coalesce(F.get(name, i), F.lit(0.0))).alias(f"{name}_{i}") for name, n in (("by_class", len(CLASSES) + 3), ("by_word", COMMON + 1)) for i in range(n)]
    totals = ready.filter("lang IS NOT NULL").groupBy("lang").agg(F.sum("n_words").alias("lang_words"), F.max(F.size("by_word")).alias("bins"), *sums)
    references = totals.filter(F.col("lang_words") >= REFERENCE_WORDS).select(
        "lang",
        F.array(*[f"by_class_{i}" for i in range(len(CLASSES) + 3)]).alias("class_reference"),
        F.slice(F.array(*[f"by_word_{i}" for i in range(COMMON + 1)]), F.lit(1), F.col("bins")).alias("word_reference"),
    )
    compared = _of_language(ready, references, "left").select(
        "*",
        F.when(F.col("n_chars") >= JUDGED_CHARS, distance(F.col("by_class"), F.col("class_reference"))).alias("far_chars"),
        F.when(F.col("n_words") >= JUDGED_WORDS, distance(F.col("by_word"), F.col("word_reference"))).alias("far_words"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    near = F.coalesce(F.col("far_chars") <= FAR_CHARS, F.lit(True)) & F.coalesce(F.col("far_words") <= FAR_WORDS, F.lit(True))
    return compared.select(
        "doc_id", "n_words", "word_chars", F.col("n_symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & near).alias("kept"), "far_chars", "far_words",
    )
