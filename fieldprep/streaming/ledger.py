"""What an appended table knows of itself: batches applied, and digests of its keys per partition.

The ledger lies in a folder of the table that readers of the table skip. It holds

- a marker per applied batch, named by the digest of the batch's keys, so a replay is known by name;
- a marker per batch that is being applied, with the partitions it touches;
- per partition, two 64-bit digests of every stored key;
- per partition, a Bloom filter of these as rows: the number of a 64-bit word and its bits. A key sets
  a few bits of one word, so filters are made and merged by ``bit_or``, and asked by an equi-join.

A key that the filter has not seen is new, whatever is stored. Only keys that it may have seen are
met with the digests of their partition. The table itself is read only after an interruption: a
batch that was begun and not finished has its partitions entered anew from the stored rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldprep.operators.joins import null_safe_join, semi
from fieldprep.sources.versions import children, filesystem

FOLDER = "_ledger"
#: Filter bits per key, bits a key sets, and the least number of words as a power of two.
BITS_PER_KEY, BITS_SET, LEAST_SIZE = 16, 4, 6


def digests(keys: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit digests of a key; a missing part differs from every value and place."""
    told = [c for k in keys for c in (F.col(k).isNull(), F.col(k).cast("string"))]
    return F.xxhash64(*told), F.xxhash64(F.lit("second"), *told)


def _mask() -> Column:
    """The bits a key sets in its word."""
    out = F.lit(0).cast("bigint")
    for i in range(BITS_SET):
        place = F.shiftrightunsigned("__d2", 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return out


def _word() -> Column:
    """The word of a key in a filter of 2 ** __size words."""
    words = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__size"))
    return F.col("__d1").bitwiseAND(words - 1)


def _size(count: Column) -> Column:
    """The size, as a power of two words, of a filter for so many keys."""
    return F.greatest(F.lit(LEAST_SIZE), F.ceil(F.log2(count * BITS_PER_KEY / 64.0))).cast("int")


class Ledger:
    def __init__(self, spark: SparkSession, path: str, partition: str, kind: str):
        self.spark, self.table, self.partition, self.kind = spark, path.rstrip("/"), partition, kind
        self.base = f"{self.table}/{FOLDER}"

    # Batches

    def _marker(self, state: str, batch: str):
        return filesystem(self.spark, f"{self.base}/{state}/{batch}")

    def applied(self, batch: str) -> bool:
        where, files = self._marker("applied", batch)
        return files.exists(where)

    def begin(self, batch: str, touched: Sequence) -> None:
        where, files = self._marker("begun", batch)
        stream = files.create(where, True)
        stream.write(bytearray(json.dumps([None if t is None else str(t) for t in touched]).encode()))
        stream.close()

    def finish(self, batch: str) -> None:
        where, files = self._marker("applied", batch)
        files.create(where, True).close()
        where, files = self._marker("begun", batch)
        files.delete(where, False)

    def interrupted(self) -> dict[str, list[str | None]]:
        """Batches begun and not finished, each with its partitions; a torn marker was followed by nothing."""
        out = {}
        for batch in children(self.spark, f"{self.base}/begun"):
            if batch.startswith("."):
                continue
            where, files = self._marker("begun", batch)
            stream = files.open(where)
            text = bytes(stream.readAllBytes()).decode()
            stream.close()
            try:
                out[batch] = json.loads(text)
            except ValueError:
                out[batch] = []
        return out

    # Keys

    def _read(self, name: str, columns: str) -> DataFrame:
        path = f"{self.base}/{name}"
        schema = f"{columns}, `{self.partition}` {self.kind}"
        if not children(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _within(self, df: DataFrame, touched: Sequence) -> DataFrame:
        """Rows of the touched partitions; partitions are pruned by value."""
        some = F.col(self.partition).isin([t for t in touched if t is not None])
        return df.filter(some | F.col(self.partition).isNull() if None in touched else some)

    def keys(self, touched: Sequence) -> DataFrame:
        return self._within(self._read("keys", "__d1 bigint, __d2 bigint"), touched)

    def filter(self, touched: Sequence) -> DataFrame:
        """The filter's words, merged."""
        words = self._within(self._read("filter", "__size int, __word bigint, __bits bigint"), touched)
        return words.groupBy(self.partition, "__size", "__word").agg(F.bit_or("__bits").alias("__bits"))

    def _write(self, df: DataFrame, name: str, replace: bool) -> None:
        mode = "overwrite" if replace else "append"
        df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(f"{self.base}/{name}")

    def seen(self, fresh: DataFrame, touched: Sequence) -> DataFrame | None:
        """The rows of ``fresh`` (with __d1, __d2) whose key is stored; None if no key can be."""
        words = self.filter(touched)
        sizes = words.select(self.partition, "__size").distinct()
        asked = null_safe_join(fresh.select(self.partition, "__d1", "__d2"), sizes, [self.partition], "inner").withColumn("__word", _word())
        met = null_safe_join(asked, words, [self.partition, "__size", "__word"], "inner")
        may = met.filter(F.col("__bits").bitwiseAND(_mask()) == _mask()).select(self.partition, "__d1", "__d2")
        if may.isEmpty():
            return None
        return semi(may, self.keys(touched), [self.partition, "__d1", "__d2"])

    def _words(self, keyed: DataFrame, sizes: DataFrame) -> DataFrame:
        sized = null_safe_join(keyed, sizes, [self.partition], "inner")
        return sized.select(self.partition, "__size", _word().alias("__word"), _mask().alias("__bits")).groupBy(self.partition, "__size", "__word").agg(F.bit_or("__bits").alias("__bits"))

    def _enter(self, keyed: DataFrame, touched: Sequence, replace: bool) -> None:
        """Digests into the ledger; a filter that would get too full for its size is made anew from the digests."""
        keyed = keyed.select(self.partition, "__d1", "__d2")
        self._write(keyed, "keys", replace)
        held = self.keys(touched)
        needed = held.groupBy(self.partition).agg(_size(F.count(F.lit(1))).alias("__needed"))
        now = self.filter(touched).groupBy(self.partition).agg(F.max("__size").alias("__now"))
        # One row per touched partition.
        plan = null_safe_join(needed, now, [self.partition]).select(self.partition, "__needed", "__now").collect()
        kind = f"`{self.partition}` {self.kind}, __size int"
        grown = [(r[0], r[1]) for r in plan if replace or r[2] is None or r[1] > r[2]]
        fits = [(r[0], r[2]) for r in plan if not (replace or r[2] is None or r[1] > r[2])]
        if fits:
            self._write(self._words(keyed, self.spark.createDataFrame(fits, kind)), "filter", False)
        if grown:
            self._write(self._words(held, self.spark.createDataFrame(grown, kind)), "filter", True)

    def enter(self, keyed: DataFrame, touched: Sequence) -> None:
        self._enter(keyed, touched, replace=False)

    def recover(self, stored: DataFrame) -> None:
        """Enter the partitions of interrupted batches anew from the rows that are stored.

        A table that has rows but no ledger is entered whole.
        """
        if not children(self.spark, self.base):
            if stored.isEmpty():
                return
            everything = [r[0] for r in stored.select(self.partition).distinct().collect()]
            self._enter(stored, everything, replace=True)
            return
        for batch, touched in self.interrupted().items():
            if touched:
                text = F.col(self.partition).cast("string")
                some = text.isin([t for t in touched if t is not None])
                mine = stored.filter(some | text.isNull() if None in touched else some)
                values = [r[0] for r in mine.select(self.partition).distinct().collect()]
                if values:
                    self._enter(mine, values, replace=True)
            where, files = self._marker("begun", batch)
            files.delete(where, False)


def batch_name(rows: Sequence[tuple]) -> str:
    """A name from what a batch's keys sum up to, per partition."""
    return hashlib.sha256(json.dumps(sorted((str(r) for r in rows))).encode()).hexdigest()[:32]
