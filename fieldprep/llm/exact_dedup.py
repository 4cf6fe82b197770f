"""Exact deduplication against a minimal perfect hash of the distinct digests seen so far.

The digests of earlier documents are dealt to shards of bounded size. Each shard gets a minimal
perfect hash: at every level the digests that land alone in a bit array are placed, the others go
to the next level, and the slot of a digest is the number of set bits before its own. A slot holds
the full digest, the locator of the document that stays (its doc_id) and the number of copies.
Any digest is led to some slot, so a lookup compares all its bytes with those in the slot. Equal:
the arriving document repeats a stored one. Not equal: it is no member, and nonmembers are grouped
among themselves.

Copies never meet in one task: both sides are aggregated to distinct digests before they are dealt
to shards, and the verdict joins back to the rows by digest, a join that Spark splits when one
digest is hot.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.store import cut

#: Digests a shard holds on average; a shard of the index is a few hundred kilobytes.
KEYS_PER_SHARD = 4096
#: Bits per digest left in a level; more bits need fewer levels.
SPARE = 1.5

INDEX = "shard int, levels binary, slots binary, winners binary, copies binary"
GROUPS = "digest binary, keep_id bigint, group_size bigint, stored boolean"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: Column) -> Column:
    """Every run of blanks as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of the normalised text."""
    return docs.select(F.col("doc_id").cast("bigint"), F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))


def _bits(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each digest (rows of four 64-bit words) in a level."""
    h = words[:, 0] ^ (words[:, 1] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h = ((h ^ (h >> np.uint64(29))) + words[:, 2]) * _MIX
    return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(len(digests), 4)


def build_levels(words: np.ndarray) -> list[np.ndarray]:
    """Bit arrays in which every digest of ``words`` (all distinct) lands alone exactly once."""
    levels, left = [], words
    while len(left):
        size = max(8, math.ceil(len(left) * SPARE))
        at = _bits(left, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def slot_of(levels: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """The slot each digest is led to; -1 where no level has a bit set for it."""
    slots = np.full(len(words), -1, dtype=np.int64)
    open_, before = np.arange(len(words)), 0
    for number, level in enumerate(levels):
        rank = np.cumsum(level) - 1
        at = _bits(words[open_], number, len(level))
        hit = level[at]
        slots[open_[hit]] = before + rank[at[hit]]
        before += int(rank[-1]) + 1
        open_ = open_[~hit]
    return slots


def _pack(levels: list[np.ndarray]) -> bytes:
    sizes = np.array([len(levels), *(len(x) for x in levels)], dtype="<i8")
    return sizes.tobytes() + b"".join(np.packbits(x).tobytes() for x in levels)


def _unpack(blob: bytes) -> list[np.ndarray]:
    count = int(np.frombuffer(blob, "<i8", 1)[0])
    sizes, at, levels = np.frombuffer(blob, "<i8", count, 8), 8 * (count + 1), []
    for size in sizes.tolist():
        n = (size + 7) // 8
        levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, n, at), count=size).astype(bool))
        at += n
    return levels


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    digests = [bytes(x) for x in shard["digest"]]
    words = _words(digests)
    levels = build_levels(words)
    order = np.argsort(slot_of(levels, words))
    return pd.DataFrame(
        {
            "shard": [int(shard["shard"].iloc[0])],
            "levels": [_pack(levels)],
            "slots": [words[order].tobytes()],
            "winners": [shard["keep_id"].to_numpy("<i8")[order].tobytes()],
            "copies": [shard["group_size"].to_numpy("<i8")[order].tobytes()],
        }
    )


def _resolve(arrivals: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Both sides of one shard: stored groups with their new copies, and the groups of nonmembers."""
    digests = [bytes(x) for x in arrivals["digest"]]
    ids, sizes = arrivals["keep_id"].to_numpy(np.int64), arrivals["group_size"].to_numpy(np.int64)
    stored, keep, copies, member = b"", np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(digests), bool)
    if len(index):
        row = index.iloc[0]
        stored = bytes(row["slots"])
        keep = np.frombuffer(bytes(row["winners"]), "<i8").copy()
        copies = np.frombuffer(bytes(row["copies"]), "<i8").copy()
        if digests:
            words = _words(digests)
            slots = slot_of(_unpack(bytes(row["levels"])), words)
            member = (slots >= 0) & (np.frombuffer(stored, "<u8").reshape(-1, 4)[slots] == words).all(axis=1)
            hit = slots[member]
            keep[hit] = np.minimum(keep[hit], ids[member])
            copies[hit] += sizes[member]
    fresh = np.flatnonzero(~member)
    return pd.DataFrame(
        {
            "digest": [stored[i : i + 32] for i in range(0, len(stored), 32)] + [digests[i] for i in fresh],
            "keep_id": np.concatenate([keep, ids[fresh]]),
            "group_size": np.concatenate([copies, sizes[fresh]]),
            "stored": np.concatenate([np.ones(len(keep), bool), np.zeros(len(fresh), bool)]),
        }
    )


def _distinct(rows: DataFrame, shards: int) -> DataFrame:
    """One row per digest: the smallest doc_id, the number of rows, the shard.

    A digest of which every row lacks its doc_id has the largest bigint here.
    """
    lead = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("bigint")
    return (
        rows.groupBy("digest")
        .agg(F.coalesce(F.min("doc_id"), F.lit(2**63 - 1)).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .withColumn("shard", F.pmod(lead, F.lit(shards)).cast("int"))
    )


def shards_for(rows: int, keys_per_shard: int = KEYS_PER_SHARD) -> int:
    return max(1, math.ceil(rows / keys_per_shard))


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """The minimal perfect hash of the distinct digests of ``rows``, one row per shard."""
    return _distinct(rows, shards).groupBy("shard").applyInPandas(_build, INDEX)


def resolve(arrivals: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Every distinct digest of index and arrivals with the doc_id that stays and its number of rows."""
    return _distinct(arrivals, shards).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_resolve, GROUPS)


def exact_dedup(docs: DataFrame, historical: Column | None = None, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, stored.

    ``historical`` marks the rows that were there before, by default those whose doc_id lies in the
    lower half of the range: they make the index, the others arrive. The verdict is the same
    whichever rows are called historical. ``stored`` says whether the text was in the index.

    A NULL text equals the empty one. Texts that differ in blanks alone are equal. Rows that repeat
    a doc_id with one text count each in ``group_size`` and have one verdict. A row without doc_id
    arrives; where no row of a group has one, ``keep_id`` is NULL and the group is kept. Other
    columns are not read. An empty table gives an empty result.
    """
    rows = cut(digest_rows(docs))
    about = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    shards = shards_for(about[0], keys_per_shard)
    if historical is None:
        middle = None if about[1] is None else (about[1] + about[2]) // 2
        historical = F.col("doc_id") <= F.lit(middle).cast("bigint")
    old = F.coalesce(historical, F.lit(False))
    groups = resolve(rows.filter(~old), build_index(rows.filter(old), shards), shards)
    keep = F.nullif(F.col("keep_id"), F.lit(2**63 - 1))
    return rows.join(groups, "digest").select(
        "doc_id",
        keep.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "stored",
    )


def drop_copies(docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of equal texts the smallest doc_id.

    Of rows that repeat a doc_id with one text, one stays, and so does one row of a text that has no
    doc_id at all.
    """
    found = cut(exact_dedup(docs, keys_per_shard=keys_per_shard).filter("kept").select("doc_id", "text_sha256"))
    again = cut(found.groupBy("doc_id", "text_sha256").count().filter("count > 1 OR doc_id IS NULL").select("doc_id", "text_sha256"))
    # A doc_id may also stand for another text, so the digest is compared too.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.sha2(normalised(F.col("text")), 256).alias("digest"))

    def same(verdicts: DataFrame) -> DataFrame:
        return verdicts.select(F.col("doc_id").alias("id2"), F.col("text_sha256").alias("digest2"))

    met = F.col("id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("digest2"))
    if again.isEmpty():
        return rows.join(same(found), met, "left_semi").select("row.*")
    single = found.join(same(again), F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("text_sha256") == F.col("digest2")), "left_anti")
    named = rows.join(same(single), met, "left_semi").select("row.*")
    once = rows.join(same(again), met, "left_semi").dropDuplicates(["id", "digest"])
    return named.unionByName(once.select("row.*"))
