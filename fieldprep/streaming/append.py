"""Append newly arrived records to a stored table.

Files land in a folder; each micro-batch is cleaned by the same functions as a full
run and appended without the rows already stored, so replaying a batch, or the whole
folder with a fresh checkpoint, changes nothing. What is stored is known from a ledger
beside the table; the table itself is not read for that.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldprep.operators.joins import anti
from fieldprep.sources.versions import children
from fieldprep.streaming.ledger import Ledger, batch_name, digests


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the least by its other columns; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return least.select(*[c if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def _stored(spark: SparkSession, path: str, like: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Partition and key digests of the stored rows, from the table itself."""
    first, second = digests(keys)
    if not any(not n.startswith(("_", ".")) for n in children(spark, path)):
        return like.limit(0).select(partition, first.alias("__d1"), second.alias("__d2"))
    return spark.read.schema(like.schema).parquet(path).select(partition, first.alias("__d1"), second.alias("__d2"))


def append_new(batch: DataFrame, path: str, keys: Sequence[str], partition: str) -> bool:
    """Append the rows whose key is not stored yet; within a batch the least row of a key stays.

    Which row stays is decided by value, so a recomputed batch makes the same choice. What is stored
    is asked of the table's ledger (see ``ledger``): a batch applied before is known by its name, and
    keys are met with a filter of the partitions that the batch touches, then, where that cannot
    rule them out, with these partitions' digests. The partition has to be part of the key, which is
    checked. Returns whether the batch was applied now. One writer at a time.
    """
    if partition not in keys:
        raise ValueError(f"the partition column {partition} must be one of the keys {list(keys)}")
    spark = batch.sparkSession
    first, second = digests(keys)
    fresh = one_per_key(batch, keys).withColumns({"__d1": first, "__d2": second}).persist()
    try:
        sums = [F.count(F.lit(1)), F.bit_xor("__d1"), F.bit_xor("__d2"), F.sum(F.pmod("__d1", F.lit(2**31)))]
        # One row per touched partition (years, days): a handful by construction.
        summed = [tuple(row) for row in fresh.groupBy(partition).agg(*sums).collect()]
        touched, name = [row[0] for row in summed], batch_name(summed)
        if not summed:
            return False
        ledger = Ledger(spark, path, partition, dict(fresh.dtypes)[partition])
        rows = fresh.drop("__d1", "__d2")
        if ledger.interrupted() or not children(spark, ledger.base):
            ledger.recover(_stored(spark, path, rows, keys, partition))
        if ledger.applied(name):
            return False
        seen = ledger.seen(fresh, touched)
        new = fresh if seen is None else anti(fresh, seen, [partition, "__d1", "__d2"])
        # The ledger grows by what is new now; both writes must see the same rows.
        new = new.persist()
        try:
            ledger.begin(name, touched)
            new.drop("__d1", "__d2").write.mode("append").partitionBy(partition).parquet(path)
            ledger.enter(new, touched)
            ledger.finish(name)
        finally:
            new.unpersist()
        return True
    finally:
        fresh.unpersist()


def append_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    clean: Callable[[DataFrame], DataFrame],
    path: str,
    keys: Sequence[str],
    partition: str,
    checkpoint: str,
    fmt: str = "csv",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process everything that has arrived, then stop. Restarting continues where it ended."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        # A changed header is refused instead of being bound by position.
        reader = reader.option("header", True).option("enforceSchema", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def store(batch: DataFrame, _: int) -> None:
        append_new(clean(batch), path, keys, partition)

    return (
        reader.load(source)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
