"""Near-duplicates by SimHash, linked by a self-join of binary tries over the fingerprints.

The trie of the distinct fingerprints is traversed against itself: a pair of nodes carries the
number of bits in which their paths differ, its four pairs of children add one where the bits
differ, and a pair over its budget is dropped with everything below it.

If two fingerprints differ in ``budget`` bits, one of their halves differs in half of that at most.
So two tries are traversed, one over each half first, and a pair may spend half the budget on the
first 32 bits and the whole of it only further down. That keeps the frontier small.

Spark deals the work by pairs of nodes at the top of the trie: a fingerprint goes to its own node
and to those within half the budget of it. The depth of these nodes follows from the counts, so
that the largest holds a bounded number of fingerprints.

A task looks for components, not for pairs. As links turn up, subtries that lie in one component
already are no longer compared with each other, so a large group of near copies costs a few passes
over its members, not the square. What leaves a task is one link per member of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.batches import steps, texts
from fieldprep.llm.components import components
from fieldprep.llm.store import cut

SHINGLE_WORDS = 4
SEED = 42
#: Differing bits up to which two fingerprints are linked.
BUDGET = 4
#: Fingerprints that a node dealt to a task holds at most, as long as its depth is below the deepest.
NODE_SIZE = 1 << 14
DEEPEST = 16
#: Node pairs that a traversal advances at once, and leaf pairs that end a descent.
FRONTIER, LEAF_PAIRS = 1 << 17, 4
_CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64 majority bits of the hashes of all word shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    whole, n = b" ".join(words), max(1, len(words) - SHINGLE_WORDS + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends - 1)[min(SHINGLE_WORDS, len(words)) - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        spans = zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK], strict=True)
        hashes = b"".join([xxhash.xxh64_digest(whole[a:b], SEED) for a, b in spans])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        found = np.fromiter((fingerprint(t) for t in texts(batch)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint as a signed 64-bit number."""
    whole = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    return whole.mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


class Groups:
    """Components of the members 0..n-1, and which ranges of them lie in one."""

    def __init__(self, n: int):
        self.of, self.steps, self.linked = np.arange(n), np.arange(n), False

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.of[i], self.of[j]
        while len(a):
            np.minimum.at(self.of, np.maximum(a, b), np.minimum(a, b))
            while (up := self.of[self.of]).tobytes() != self.of.tobytes():
                self.of = up
            a, b = self.of[a], self.of[b]
            a, b = a[apart := a != b], b[apart]
            self.linked = True
        self.steps = np.concatenate([[0], np.cumsum(self.of[1:] != self.of[:-1])])

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        """Whether two ranges lie in one and the same component."""
        even = (self.steps[alo] == self.steps[ahi - 1]) & (self.steps[blo] == self.steps[bhi - 1])
        return even & (self.of[alo] == self.of[blo])


def link_subtries(keys: np.ndarray, split: int, depth: int, spent: int, budget: int = BUDGET) -> np.ndarray:
    """The component of each key, from the links between two subtries or within one.

    ``keys`` are unsigned, distinct; those before ``split`` are one subtrie in order, the others the
    second; ``split`` 0 compares one subtrie with itself. All keys of a subtrie share ``depth`` bits,
    and the two differ in ``spent`` of them.
    """
    groups, n = Groups(len(keys)), len(keys)
    first = (0, split, split, n) if split else (0, n, 0, n)
    stack = [(depth, *(np.array([x]) for x in (*first, spent)))]
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        if groups.linked:
            keep = ~groups.joined(alo, ahi, blo, bhi)
            alo, ahi, blo, bhi, err = (x[keep] for x in (alo, ahi, blo, bhi, err))
        few = (ahi - alo) * (bhi - blo) <= LEAF_PAIRS if depth < 64 else np.ones(len(alo), bool)
        if few.any():
            across = bhi[few] - blo[few]
            pairs = (ahi[few] - alo[few]) * across
            which = np.repeat(np.arange(len(pairs)), pairs)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            i, j = alo[few][which] + nth // across[which], blo[few][which] + nth % across[which]
            near = (np.bitwise_count(keys[i] ^ keys[j]) <= budget) & (i != j)
            if near.any():
                groups.link(i[near], j[near])
            alo, ahi, blo, bhi, err = (x[~few] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            stack += [(depth, *(x[half:] for x in (alo, ahi, blo, bhi, err))), (depth, *(x[:half] for x in (alo, ahi, blo, bhi, err)))]
            continue
        bit = np.uint64(63 - depth)
        amid, bmid = (_middle(keys, lo, hi, bit, split) for lo, hi in ((alo, ahi), (blo, bhi)))
        same = alo == blo
        ways = [
            (alo, amid, blo, bmid, err, np.ones(len(alo), bool)),
            (amid, ahi, bmid, bhi, err, np.ones(len(alo), bool)),
            (alo, amid, bmid, bhi, err + 1, np.ones(len(alo), bool)),
            (amid, ahi, blo, bmid, err + 1, ~same),
        ]
        allowed = budget // 2 if depth + 1 <= 32 else budget
        kept = [ok & (a < b) & (c < d) & (e <= allowed) for a, b, c, d, e, ok in ways]
        stack.append((depth + 1, *(np.concatenate([w[k][ok] for w, ok in zip(ways, kept, strict=True)]) for k in range(5))))
    return groups.of


def _middle(keys, lo, hi, bit, split):
    """Where the keys of each range begin to have the bit set."""
    wanted = ((keys[lo] >> bit) | np.uint64(1)) << bit
    if not split:
        return np.clip(np.searchsorted(keys, wanted), lo, hi)
    left = lo < split
    at = np.where(left, np.searchsorted(keys[:split], wanted), split + np.searchsorted(keys[split:], wanted))
    return np.clip(at, lo, hi)


def _link_nodes(depth: int, budget: int):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        key, side = group["key"].to_numpy(np.int64).view(np.uint64), group["side"].to_numpy(np.int64)
        order = np.lexsort((key, side))
        keys, split = key[order], int((side == 0).sum()) if low != high else 0
        if low != high and split in (0, len(keys)):
            return pd.DataFrame({"u": np.empty(0, np.int64), "v": np.empty(0, np.int64)})
        of = link_subtries(keys, split, depth, (low ^ high).bit_count(), budget)
        u = np.flatnonzero(of != np.arange(len(of)))
        if int(group["turned"].iloc[0]):
            keys = (keys << np.uint64(32)) | (keys >> np.uint64(32))
        return pd.DataFrame({"u": keys[u].view(np.int64), "v": keys[of[u]].view(np.int64)})

    return link


def _depth(prints: DataFrame, node_size: int) -> int:
    """The least depth at which no node of either trie holds more than ``node_size`` fingerprints."""
    ends = F.array(F.shiftrightunsigned("fp", 64 - DEEPEST), F.shiftrightunsigned(F.col("fp").bitwiseAND(2**32 - 1), 32 - DEEPEST))
    # One count per node of the deepest level: 2 * 2**16 rows at most, whatever the table.
    counts = prints.select(F.posexplode(ends).alias("turned", "node")).groupBy("turned", "node").count().toPandas()
    deep = np.zeros((2, 1 << DEEPEST), np.int64)
    deep[counts["turned"], counts["node"]] = counts["count"]
    fits = (d for d in range(DEEPEST) if deep.reshape(2, 1 << d, -1).sum(axis=2).max() <= node_size)
    return next(fits, DEEPEST)


def link_prints(prints: DataFrame, budget: int = BUDGET, node_size: int = NODE_SIZE) -> DataFrame:
    """Links (u, v) that connect all fingerprints within ``budget`` bits; ``prints`` has distinct ``fp``."""
    depth = _depth(prints, node_size)
    masks = [m for m in range(1 << depth) if m.bit_count() <= budget // 2]
    turned = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    both = prints.select(F.posexplode(F.array("fp", turned)).alias("turned", "key"))
    node = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("bigint")
    met = both.withColumn("node", node).withColumn("mask", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])))
    other = F.col("node").bitwiseXOR(F.col("mask"))
    met = met.select(
        "turned", F.least("node", other).alias("low"), F.greatest("node", other).alias("high"), (F.col("node") > other).cast("int").alias("side"), "key"
    )
    return met.groupBy("turned", "low", "high").applyInPandas(_link_nodes(depth, budget), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, node_size: int = NODE_SIZE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, component.

    Two rows are linked if their fingerprints differ in at most ``budget`` bits; ``component_id`` is
    the smallest doc_id that a row reaches. A NULL, empty or blank text has fingerprint zero. A row
    without doc_id is linked like any other but names no component; a component without any doc_id
    has NULL. ``component`` is its smallest fingerprint, as a number. Rows that repeat a doc_id are
    each returned. Other columns are not read.
    """
    rows = cut(fingerprint_rows(docs))
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = components(link_prints(prints.select("fp"), budget, node_size))
    placed = prints.join(links.withColumnsRenamed({"u": "fp", "v": "top"}), "fp", "left").withColumn("top", F.coalesce("top", "fp"))
    named = placed.groupBy("top").agg(F.min("first").alias("component_id"))
    by_print = placed.join(named, "top").select("fp", "component_id", F.col("top").alias("component"))
    return rows.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component")


def drop_near_copies(docs: DataFrame, budget: int = BUDGET, node_size: int = NODE_SIZE) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are: of a component the smallest doc_id.

    Rows that repeat a doc_id in one component stay or go together. Of a component without any
    doc_id one row stays.
    """
    found = cut(near_duplicates(docs, budget, node_size))
    verdicts = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("some"), F.min(F.col("doc_id") == F.col("component_id")).alias("all"))
    verdicts = cut(verdicts.filter("some"))
    named = docs.join(verdicts.filter("all").select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    split = verdicts.filter("NOT all").select("doc_id")
    lonely = found.filter("doc_id IS NULL AND component_id IS NULL").groupBy("component").agg(F.min("fingerprint").alias("print"))
    schema = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.lit("").alias("print")).schema

    def attach(batches: Iterator) -> Iterator:
        for batch in steps(batches):
            prints = [f"{fingerprint(t):016x}" for t in texts(batch)]
            rows = pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([rows, ids, pa.array(prints)], names=["row", "id", "print"])

    if not split.isEmpty():
        # Other texts of the doc_id are in components that another doc_id stands for; the fingerprint tells them apart.
        right = found.filter("doc_id = component_id").select(F.col("doc_id").alias("id"), F.col("fingerprint").alias("print"))
        both = docs.join(split, "doc_id", "left_semi").select(docs.columns).mapInArrow(attach, schema)
        named = named.unionByName(both.join(right, ["id", "print"], "left_semi").select("row.*"))
    if lonely.isEmpty():
        return named
    with_print = docs.filter("doc_id IS NULL").mapInArrow(attach, schema).join(lonely.select("print"), "print")
    return named.unionByName(with_print.dropDuplicates(["print"]).select("row.*"))
