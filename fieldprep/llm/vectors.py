"""Near-duplicate embeddings by small-world graphs per shard.

Equal vectors of a label are one row from the start. The distinct ones of a label are dealt to
shards of bounded size by hash, and every shard gets a graph (``hnsw``), built once and stored.
A task then holds two shards of a label, or one: every vector of either is searched for in the
other's graph, and what the search finds is compared in double precision.

Before a task relies on a beam it audits it. For the vectors of smallest hash it computes all
similarities; the search must have found all their links, and the nearest vector of nearly all of
them. Otherwise the beam is doubled, up to a scan of the shard, which is the widest beam there is.

A pair leaves no task. What leaves is, per vector, the number of rows linked to it there and one
link to a smaller member of its component; Spark sums the numbers and joins the components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.components import components
from fieldprep.llm.hnsw import BLOCK, Graph, _mixed
from fieldprep.llm.store import cut, written

LEAST = 0.93
#: Numbers in the vectors of a shard: 8192 vectors of 64 dimensions.
ROOM = 1 << 19
BEAM = 32
#: Vectors audited per search of a shard, and the share of them whose nearest vector must be found.
AUDITED, NEAREST_FOUND = 256, 0.98
#: The search works in single precision, so it looks for a little less than the bound.
SLACK = 1e-5

SHARD = "family string, shards int, shard int, dims int, keys binary, copies binary, vectors binary, members array<binary>, links array<binary>"
FOUND = "u bigint, n bigint, v bigint, beam int"


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: it is there, holds finite numbers only, and not zeros only."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that no square overflows or vanishes; directions stay exactly."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0))[1][:, None])


def _unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _build(key: tuple, group: pa.Table) -> pa.Table:
    group = group.sort_by("key")
    family, shard = key[0].as_py(), key[1].as_py()
    dims, keys = group.column("dims")[0].as_py(), group.column("key").to_numpy()
    vectors = _scaled(group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
    graph = Graph.build(_unit(vectors), keys)
    row = {
        "family": family, "shards": group.column("shards")[0].as_py(), "shard": shard, "dims": dims,
        "keys": keys.astype("<i8").tobytes(), "copies": group.column("copies").to_numpy().astype("<i8").tobytes(), "vectors": vectors.astype("<f8").tobytes(),
        "members": [m.astype("<i4").tobytes() for m in graph.members], "links": [x.astype("<i4").tobytes() for x in graph.layers],
    }
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
    return pa.table({name: pa.array([value], kind) for (name, value), kind in zip(row.items(), kinds, strict=True)})


class Shard:
    """A stored shard: its graph, the vectors as they were given but for a power of two, keys and copies."""

    def __init__(self, row: dict):
        self.keys, self.copies = np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["copies"], "<i8")
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dims"])
        self.lengths = np.linalg.norm(self.vectors, axis=1)
        self.unit = _unit(self.vectors)
        members = [np.frombuffer(m, "<i4") for m in row["members"]]
        self.graph = Graph(self.unit, members, [np.frombuffer(x, "<i4").reshape(len(m), -1) for x, m in zip(row["links"], members, strict=True)])

    def audited(self) -> np.ndarray:
        return np.argsort(_mixed(self.keys), kind="stable")[:AUDITED]


def _passes(target: Shard, queries: np.ndarray, least: float, beam: int, own: bool) -> bool:
    """Whether a search with this beam finds what a scan does for the audited ``queries``."""
    true = queries @ target.unit.T
    best = 2 if own and true.shape[1] > 1 else 1  # among its own shard a vector is its own nearest
    nearest = target.graph.nearest(queries, best, beam)[:, best - 1]
    if (nearest >= np.partition(true, -best, axis=1)[:, -best] - 1e-6).mean() < NEAREST_FOUND:
        return False
    who, row = target.graph.within(queries, least, beam)
    missed = true >= least + SLACK  # at the bound itself single precision may differ
    missed[who, row] = False
    return not missed.any()


def search(target: Shard, asking: Shard, least: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows of ``asking`` and of ``target`` that may be linked, and the beam that passed its audit."""
    queries, own = asking.unit[asking.audited()], target is asking
    while beam < len(target.keys) and not _passes(target, queries, least - SLACK, beam, own):
        beam *= 2
    if beam < len(target.keys):
        return *target.graph.within(asking.unit, least - SLACK, beam), beam
    pairs = []
    for at in range(0, len(asking.unit), BLOCK):
        who, row = np.nonzero(asking.unit[at : at + BLOCK] @ target.unit.T >= least - SLACK)
        pairs.append((who + at, row))
    return *(np.concatenate(x) for x in zip(*pairs, strict=True)), len(target.keys)


def _verified(a: Shard, b: Shard, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Which pairs reach the bound in double precision."""
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        s, t = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        out[at : at + (1 << 16)] = np.einsum("ij,ij->i", a.vectors[s], b.vectors[t]) / (a.lengths[s] * b.lengths[t]) >= least
    return out


def linked(a: Shard, b: Shard, least: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, int]:
    """All verified pairs between two shards, or within one (then each once, smaller row first)."""
    i, j, used = search(b, a, least, beam)
    if a is not b:
        back_j, back_i, other = search(a, b, least, beam)
        i, j, used = np.concatenate([i, back_i]), np.concatenate([j, back_j]), max(used, other)
    else:
        i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
    # Either direction may find a pair; it counts once.
    i, j = np.divmod(np.unique(i * len(b.keys) + j), len(b.keys))
    true = _verified(a, b, i, j, least)
    return i[true], j[true], used


def _roots(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each vertex's component."""
    of = np.arange(size)
    while len(i):
        x, y = of[i], of[j]
        np.minimum.at(of, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := of[of], of):
            of = up
        apart = of[i] != of[j]
        i, j = i[apart], j[apart]
    return of


def _match(least: float, beam: int):
    def match(group: pa.Table) -> pa.Table:
        shards = [Shard(row) for row in group.sort_by("shard").to_pylist()]
        a, b = shards[0], shards[-1]
        i, j, used = linked(a, b, least, beam)
        keys = a.keys if a is b else np.concatenate([a.keys, b.keys])
        n, far = np.zeros(len(keys), np.int64), j if a is b else j + len(a.keys)
        np.add.at(n, i, b.copies[j])
        np.add.at(n, far, a.copies[i])
        order = np.argsort(keys, kind="stable")  # components in order of keys, so that links lead to smaller ones
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        of = keys[order][_roots(len(keys), place[i], place[far])][place]
        hit = n > 0
        return pa.table({"u": keys[hit], "n": n[hit], "v": of[hit], "beam": np.full(int(hit.sum()), used, np.int32)})

    return match


def near_vectors(rows: DataFrame, least: float = LEAST, room: int = ROOM, beam: int = BEAM) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Only vectors of equal, known label and equal length are compared. A vector that is NULL, zero or
    holds a NULL, NaN or infinite entry, or whose label is NULL, links with nothing. Rows that repeat
    a vector are linked with each other; rows that repeat a vec_id are each returned. A row without
    vec_id is linked like any other but names no component; where no row of one has an id,
    ``component_id`` is NULL and the rows are kept. Other columns are not read. An empty table gives
    an empty result.
    """
    vector = F.transform("embedding", lambda c: c.cast("double") + F.lit(0.0))  # -0.0 is 0.0
    whole = rows.select(F.col("vec_id").cast("bigint"), F.col("label").cast("string").alias("label"), vector.alias("vector"))
    family = F.when(F.col("label").isNotNull() & usable(F.col("vector")), F.concat_ws(":", F.size("vector").cast("string"), "label"))
    whole = cut(whole.select("vec_id", family.alias("family"), "vector"))
    distinct = whole.filter("family IS NOT NULL").groupBy("family", "vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    keyed = written(distinct.withColumn("key", F.monotonically_increasing_id()), "vectors")
    sizes = keyed.select("family", F.size("vector").alias("dims")).groupBy("family", "dims").count()
    sizes = sizes.select("family", "dims", F.ceil(F.col("count") * F.col("dims") / F.lit(room)).cast("int").alias("shards"))
    dealt = keyed.join(sizes, "family").withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int"))
    shards = written(dealt.groupBy("family", "shard").applyInArrow(_build, SHARD), "shards")
    # A shard meets itself and every other of its family.
    met = shards.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    met = met.withColumn("low", F.least("shard", "other")).withColumn("high", F.greatest("shard", "other"))
    found = cut(met.groupBy("family", "low", "high").applyInArrow(_match(least, beam), FOUND))
    top = components(found.filter("u <> v").select("u", "v")).withColumnsRenamed({"u": "key", "v": "top"})
    counts = found.groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("n"))
    placed = keyed.drop("vector", "family").join(counts, "key", "left").join(top, "key", "left").withColumn("top", F.coalesce("top", "key"))
    named = placed.groupBy("top").agg(F.min("first").alias("component_id"))
    verdicts = placed.join(named, "top").select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    verdicts = keyed.select("key", "family", "vector").join(verdicts, "key").drop("key").withColumn("met", F.lit(True))
    component = F.when(F.col("met"), F.col("component_id")).otherwise(F.col("vec_id"))
    out = whole.join(verdicts, ["family", "vector"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
