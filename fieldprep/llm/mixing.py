"""Mixing sources to target weights by weighted random order within each source.

Every document gets an exponential key divided by its quality weight (Efraimidis and Spirakis): in
ascending order of the keys, better documents tend to come first. A source that is to give more
than its size gives all documents as many times as fit; what is left of its target is a prefix of
its order, up to the document that crosses the target, taken if that comes closer.

No source is sorted as a whole. The keys, brought to (0, 1), are summed in 1024 buckets, the bucket
that the target falls in again in 1024, and only the rows of that last bucket are put in order. The
result is one cut per source, and rows are compared with the cut of their source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldprep.llm.store import cut

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: How often a document may be taken at most.
REPEATS = 3
#: Buckets of keys at each of the two levels.
BUCKETS = 1024
#: Parts that the rows of a source are dealt to when they meet what is known of the source.
PARTS = 32

_LAST = 2**63 - 1


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def quality(size: Column, text: Column) -> Column:
    """Texts whose words have a plausible mean length weigh twice as much as others, wordless ones half."""
    chars = F.length(text)
    return F.when(size == 0, 0.5).when((chars >= 4 * size) & (chars <= 12 * size), 2.0).otherwise(1.0)


def _source(source: Column) -> Column:
    """A source as a key that orders by code point, NULL last, and joins NULL to NULL."""
    return F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"))


def _order(doc_id: Column, weight: Column) -> Column:
    """The exponential key brought to (0, 1): the number depends on nothing but the document's id and weight."""
    digits = F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(1 << 52)
    return 1.0 - F.pow(uniform, 1.0 / weight)


def measured(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, src, size, key of every row, and the columns carried along."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _source(F.col("source")).alias("src"), "text", *carried)
    rows = rows.withColumn("size", word_count(F.col("text")))
    return rows.withColumn("key", _order(F.col("doc_id"), quality(F.col("size"), F.coalesce("text", F.lit(""))))).drop("text")


def targets(rows: DataFrame) -> DataFrame:
    """src, source_size, target, epochs, rest: one row per source.

    The weights share the total size; a source of more than ``REPEATS`` times its size keeps that,
    and the excess goes to the others by weight. Sorted by the ratio of limit to weight, the sources
    that keep their limit come first, and the share of those after them is largest where they end.
    """
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    place = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weight).withColumn("most", REPEATS * F.col("source_size"))
    rising = Window.orderBy(F.col("most") / F.col("weight"), "src")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    shared = sizes.withColumn("left", total - F.coalesce(F.sum("most").over(before), F.lit(0))).withColumn("among", F.sum("weight").over(after))
    whole = Window.partitionBy(F.lit(0))
    best = F.max(F.struct((F.col("left") / F.col("among")).alias("each"), "left", "among")).over(whole)
    target = F.least(F.col("most").cast("double"), best["left"] * F.col("weight") / best["among"])
    found = shared.withColumn("target", target).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    )
    return found.select("src", "source_size", "target", "epochs", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"))


def _meet(rows: DataFrame, known: DataFrame, *more: str) -> DataFrame:
    """Rows with what is known of their source, a short table that is repeated for each part of the rows.

    So a source that holds a third of all rows is spread whatever the join.
    """
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("key", "doc_id"), F.lit(PARTS)).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    return dealt.join(known.withColumn("part", parts), ["src", "part", *more]).drop("part")


def _bucket(levels: int) -> Column:
    return F.floor(F.col("key") * BUCKETS**levels)


def _crossing(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """Of each source the bucket that its rest falls in, and what comes before it."""
    upto = F.sum("size").over(Window.partitionBy("src").orderBy("bucket"))
    found = sums.withColumn("upto", upto).join(limits, "src")
    start = F.col("before") + F.col("upto")
    return found.filter((start > F.col("rest")) & (start - F.col("size") <= F.col("rest"))).select("src", "rest", "bucket", (start - F.col("size")).alias("before"))


def cuts(rows: DataFrame) -> DataFrame:
    """``targets`` with the last key and doc_id that the fractional pass takes."""
    found = cut(targets(rows))
    limits = found.select("src", "rest", F.lit(0).cast("bigint").alias("before"))
    for level in (1, 2):
        inside = rows.withColumn("bucket", _bucket(level))
        if level == 2:
            inside = _meet(inside.withColumn("outer", _bucket(1)), limits.select("src", F.col("bucket").alias("outer")), "outer")
        sums = inside.groupBy("src", "bucket").agg(F.sum("size").alias("size"))
        limits = cut(_crossing(sums, limits.select("src", "rest", "before")))
    last = _meet(rows.withColumn("bucket", _bucket(2)), limits, "bucket")
    # About a millionth of a source's rows each.
    upto = F.sum("size").over(Window.partitionBy("src").orderBy("key", F.coalesce("doc_id", F.lit(_LAST))))
    taken = last.withColumn("upto", upto).filter(F.col("before") + F.col("upto") - F.col("size") / 2 <= F.col("rest"))
    ends = taken.groupBy("src").agg(F.max(F.struct("key", F.coalesce("doc_id", F.lit(_LAST)).alias("id"))).alias("end"))
    edge = F.struct((F.col("bucket") / BUCKETS**2).alias("key"), F.lit(-(2**63)).alias("id"))
    ends = limits.join(ends, "src", "left").select("src", F.coalesce("end", edge).alias("end"))
    return found.join(ends, "src", "left")


def passes(found: DataFrame) -> Column:
    """How often a row is taken: the epochs, and once more up to the cut of its source."""
    at = F.struct(F.col("key").alias("key"), F.coalesce("doc_id", F.lit(_LAST)).alias("id"))
    return (F.col("epochs") + F.coalesce(at <= F.col("end"), F.lit(False)).cast("int")).cast("int")


def mix(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    ``taken`` is the number of words that the mix takes of the row, whole documents only, so a source
    ends within half a document of its target. A NULL text has size 0 and is never missed. Rows
    without source form a source. Rows that repeat a doc_id within a source are taken together, as
    are rows without doc_id. An empty table gives an empty result. Other columns are not read.
    """
    rows = cut(measured(docs))
    found = _meet(rows, cuts(rows))
    return found.select("doc_id", "size", "source_size", "target", (passes(found) * F.col("size")).cast("bigint").alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    ends = cut(cuts(cut(measured(docs))))
    found = _meet(measured(docs, F.struct("*").alias("row")), ends)
    again = found.withColumn("again", F.explode(F.array_repeat(F.lit(0), passes(found))))
    return again.select("row.*")
