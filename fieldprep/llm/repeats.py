"""Removing every byte covered by a string of some length that also starts elsewhere.

Equal strings are found as by a suffix array cut off at that length: by prefix doubling, where Spark
sorts pairs of ranks at growing offsets and ranks anew until a position is unique or the length is
passed. Ranking every byte would shuffle the corpus many times over, so positions are thinned out
without loss: of all starts whose windows share the smallest hash of a short gram, the *anchor*,
one row is made, its *span* being the text of these windows together. Equal windows have equal
anchors at equal places, so the first rank of a span is that of its anchor gram, and

- a gram that no other span has: none of its windows repeats;
- a gram with one span of several copies: all its windows repeat;
- a gram with different spans: these are ranked further. Ranks of what follows the gram and of what
  precedes it are paired with the next piece, twice as long each round; a span whose pair is unique
  repeats no further on that side. Of the starts that are left, blocks are compared by the string
  that all their windows share and by the string of them all, and only where the first repeats and
  the second differs are single windows compared, by 128-bit names.

All comparisons are aggregations and joins on names, so a passage in very many documents is one
combined row per task. Texts are shuffled once to read off the spans in question, and those that
hold such a span a second time to remove what was found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.batches import steps
from fieldprep.llm.store import cut, written

LENGTH, GRAM = 400, 64
#: Windows in a block.
BLOCK = 16
#: Bytes of a text that are anchored at once; rows that a task holds before it hands them on.
PIECE, ROWS_OUT = 1 << 20, 1 << 14

_STEP = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 14)
        _POWERS["up"] = np.cumprod(np.full(size, _STEP, np.uint64))
        _POWERS["down"] = np.cumprod(np.full(size, pow(_STEP, -1, 2**64), np.uint64))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of each run of windows that share their smallest gram."""
    n = len(data)
    if n < length:
        return (np.empty(0, np.int64),) * 3
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    # The place in the low bits: of equal grams the first is smallest.
    key = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
    width = length - gram + 1
    table = np.concatenate([key, np.full(-len(key) % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = (np.minimum(behind[: len(key) - width + 1], ahead[width - 1 : len(key)]) & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(least, prepend=-1))
    return least[first], first, np.append(first[1:], len(least)) - 1


def _numbers(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def _pair(data: bytes) -> tuple[int, int]:
    """A 128-bit name as two signed numbers."""
    digest = xxhash.xxh3_128_digest(data)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _name(data: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(data), "big", signed=True)


def spans(data: bytes, length: int, gram: int) -> Iterator[tuple[int, int, int]]:
    """(first start, place of the anchor in the span, number of starts) of each span of a text."""
    for at in range(0, max(1, len(data) - length + 1), PIECE):
        a, s, e = anchors(data[at : at + PIECE + length - 1], length, gram)
        yield from zip((s + at).tolist(), (a - s).tolist(), (e - s + 1).tolist(), strict=True)


def levels(length: int, gram: int) -> list[int]:
    """Extents beyond the gram, each twice the one before, the last reaching the length."""
    return [-(-(length - gram) // 2**k) for k in (3, 2, 1, 0)]


def _documents(docs: DataFrame) -> DataFrame:
    """(id, rid, text): a row's name; rows with one name have one doc_id and one text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rid = F.xxhash64("doc_id", "text")
    return rows.select("doc_id", F.coalesce("doc_id", rid).alias("id"), rid.alias("rid"), "text")


def _anchor_rows(docs: DataFrame, length: int, gram: int, placed: bool) -> DataFrame:
    """A row per span: its name and gram, or its name and place."""
    schema = pa.schema([(n, pa.int64()) for n in (("p1", "p2", "id", "rid", "place") if placed else ("p1", "p2", "gram", "rid"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows: list[tuple] = []
            for id_, rid, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for s, off, n in spans(data, length, gram):
                    p = _pair(data[s : s + n - 1 + length])
                    rows.append((*p, id_, rid, s << 24 | off << 12 | n) if placed else (*p, _name(data[s + off : s + off + gram]), rid))
                if len(rows) > ROWS_OUT:
                    yield _numbers(rows, schema.names)
                    rows = []
            if rows:
                yield _numbers(rows, schema.names)

    return docs.select("id", "rid", "text").mapInArrow(run, ", ".join(f"{f.name} bigint" for f in schema))


def repeated_spans(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(p1, p2, gram, n, rep, open): the spans whose gram repeats; ``open`` where the gram has several spans."""
    rows = _anchor_rows(docs, length, gram, placed=False)
    named = rows.groupBy("p1", "p2").agg(F.first("gram").alias("gram"), F.count(F.lit(1)).alias("n"), F.min("rid").alias("rep"))
    named = cut(named)
    grams = named.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).filter("total > 1")
    return named.join(grams, "gram").select("p1", "p2", "gram", "n", "rep", (F.col("kinds") > 1).alias("open"))


_RUNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_NAMES = pa.list_(pa.int64())
#: What reading the texts yields; each kind of row fills its own columns.
_READ = pa.schema(
    [("kind", pa.string()), ("id", pa.int64()), ("rid", pa.int64()), ("doc_id", pa.int64())]
    + [(n, pa.int64()) for n in ("p1", "p2", "gram", "n", "start", "off", "starts")]
    + [("content", pa.binary()), ("left", _NAMES), ("right", _NAMES), ("spans", _RUNS)]
    + [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)
_DDL = (
    "kind string, id bigint, rid bigint, doc_id bigint, p1 bigint, p2 bigint, gram bigint, n bigint, start bigint, off bigint, starts bigint, "
    "content binary, left array<bigint>, right array<bigint>, spans array<struct<a:bigint,b:bigint>>, "
    "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
)


def join_spans(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs that some stretches cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _outcome(data: bytes, found: list[tuple[int, int]]) -> tuple:
    """spans, n_bytes, n_removed, n_spans, kept_sha256 of a text without some stretches."""
    found = join_spans(found)
    digest, at = hashlib.sha256(), 0
    for a, b in found:
        digest.update(data[at:a])
        at = b
    digest.update(data[at:])
    return found, len(data), sum(b - a for a, b in found), len(found), digest.hexdigest()


def _rows(kind: str, names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of one kind, whose other columns are NULL."""
    columns = dict(zip(names, zip(*rows, strict=True), strict=True)) | {"kind": [kind] * len(rows)}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(rows), f.type) for f in _READ], schema=_READ
    )


def _read_off(docs: DataFrame, lists: DataFrame, length: int, gram: int) -> DataFrame:
    """Three kinds of rows: documents that are done, open spans to compare, documents that wait for them."""
    extents = levels(length, gram)
    names = ["id", "rid", "doc_id"]
    columns = {
        "done": [*names, "spans", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "waits": [*names, "content", "spans"],
        "span": [*names, "p1", "p2", "gram", "n", "start", "off", "starts", "content", "left", "right"],
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = {kind: [] for kind in columns}
        held = 0
        for batch in steps(batches):
            found = batch.column(4)
            flat = found.flatten()
            fields = {f.name: flat.field(f.name).to_pylist() for f in flat.type}
            sizes = np.nan_to_num(found.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.cumsum(sizes).tolist()
            for at, (id_, rid, doc_id, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)):
                data, known, waits = text.encode("utf-8", "surrogatepass"), [], False
                for k in range(ends[at] - int(sizes[at]), ends[at]):
                    place, copies = fields["place"][k], fields["n"][k]
                    s, off, n = place >> 24, place >> 12 & 4095, place & 4095
                    end, a = s + n - 1 + length, s + off
                    if copies > 1:
                        known.append((s, end))
                    waits |= copies == 1
                    if fields["open"][k] and fields["rep"][k] == rid:
                        # Names of the pieces on both sides of the gram, cut where the span ends.
                        left = [_name(data[max(s, a - h) : a]) for h in extents]
                        right = [_name(data[a + gram : min(end, a + gram + h)]) for h in extents]
                        rows["span"].append((id_, rid, doc_id, fields["p1"][k], fields["p2"][k], fields["gram"][k], copies, s, off, n, data[s:end], left, right))
                        held += end - s
                if waits:
                    rows["waits"].append((id_, rid, doc_id, data, join_spans(known)))
                    held += len(data)
                else:
                    rows["done"].append((id_, rid, doc_id, *_outcome(data, known)))
                if held > 1 << 24:
                    yield from (_rows(kind, columns[kind], r) for kind, r in rows.items() if r)
                    rows, held = {kind: [] for kind in columns}, 0
        yield from (_rows(kind, columns[kind], r) for kind, r in rows.items() if r)

    return docs.join(lists, ["id", "rid"], "left").select("id", "rid", "doc_id", "text", "found").mapInArrow(run, _DDL)


def _reach(opened: DataFrame, rounds: int) -> DataFrame:
    """(p1, p2, left, right): the rounds that each side of a span went through without being unique."""
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("names")), F.struct(F.lit(1).alias("side"), F.col("right").alias("names"))))
    live = opened.select("p1", "p2", F.col("gram").alias("rank"), sides.alias("x")).select("p1", "p2", "rank", "x.side", "x.names")
    passed = []
    for k in range(rounds):
        # The new rank stands for the pair of the old rank and the name at the next offset.
        live = live.withColumn("rank", F.xxhash64("side", "rank", F.get("names", F.lit(k))))
        shared = live.groupBy("rank").count().filter("count > 1").select("rank")
        live = cut(live.join(shared, "rank", "left_semi"))
        passed.append(live.select("p1", "p2", "side", F.lit(k + 1).alias("k")))
    every = passed[0]
    for more in passed[1:]:
        every = every.unionByName(more)
    at = [F.max(F.when(F.col("side") == s, F.col("k"))) for s in (0, 1)]
    return every.groupBy("p1", "p2").agg(F.coalesce(at[0], F.lit(0)).alias("l"), F.coalesce(at[1], F.lit(0)).alias("r"))


def _blocks(opened: DataFrame, reach: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per block of starts that may repeat: the span, the block's number, its names and which starts it has."""
    reaches = [*levels(length, gram), length]
    names = ["p1", "p2", "n", "b", "core", "w1", "w2", "near", "far"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = []
            for p1, p2, n, off, starts, data, lower, upper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low = max(0, off - reaches[lower] + 1)
                high = min(starts - 1, off + gram + reaches[upper] - 1 - length)
                if high < low:
                    continue
                for b in range((off - high) // BLOCK, (off - low) // BLOCK + 1):
                    last = off - b * BLOCK  # the start with the smallest distance to the anchor
                    i, j = max(low, last - BLOCK + 1), min(high, last)
                    core = _name(data[last : last - BLOCK + 1 + length])
                    rows.append((p1, p2, n, b, core, *_pair(data[i : j + length]), last - j, last - i))
            if rows:
                yield _numbers(rows, names)

    ranged = opened.join(reach, ["p1", "p2"]).select("p1", "p2", "n", "off", "starts", "content", "l", "r")
    return ranged.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _windows(opened: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """A row per start of the blocks asked for: the block's name, the weight, the start's bit, the window's name."""

    names = ["w1", "w2", "near", "far", "weight", "d", "v1", "v2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = []
            for off, data, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for y in blocks:
                    for d in range(y["near"], y["far"] + 1):
                        i = off - y["b"] * BLOCK - d
                        rows.append((y["w1"], y["w2"], y["near"], y["far"], y["weight"], d, *_pair(data[i : i + length])))
                if len(rows) > ROWS_OUT:
                    yield _numbers(rows, names)
                    rows = []
            if rows:
                yield _numbers(rows, names)

    per_span = asked.groupBy("p1", "p2").agg(F.collect_list(F.struct("b", "w1", "w2", "near", "far", "weight")).alias("asked"))
    return opened.join(per_span, ["p1", "p2"]).select("off", "content", "asked").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _masks(opened: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """(w1, w2, near, far, mask): which starts of a block repeat."""
    key = ["w1", "w2", "near", "far"]
    wholes = cut(blocks.groupBy("core", *key).agg(F.sum("n").alias("weight"), F.min(F.struct("p1", "p2", "b")).alias("at")))
    cores = wholes.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.sum("weight").alias("total")).filter("total > 1")
    shared = cut(wholes.join(cores, "core").select(*key, "weight", "kinds", "at.p1", "at.p2", "at.b"))
    bit = lambda n: F.call_function("shiftleft", F.lit(1), n)
    every = shared.filter("weight > 1").select(*key, (bit(F.col("far") + 1) - bit(F.col("near"))).alias("mask"))
    windows = written(_windows(opened, shared.filter("kinds > 1"), length), "windows")
    twice = windows.groupBy("v1", "v2").agg(F.sum("weight").alias("total")).filter("total > 1").select("v1", "v2")
    some = windows.filter("weight = 1").join(twice, ["v1", "v2"], "left_semi")
    some = some.groupBy(*key).agg(F.bit_or(bit(F.col("d"))).alias("mask"))
    return every.unionByName(some)


def _runs(open_spans: DataFrame, blocks: DataFrame, masks: DataFrame, length: int) -> DataFrame:
    """(id, rid, more): what the single spans of a document have in stretches that repeat."""
    of_span = blocks.filter("n = 1").join(masks, ["w1", "w2", "near", "far"]).groupBy("p1", "p2").agg(F.collect_set(F.struct("b", "mask")).alias("bits"))
    placed = open_spans.filter("n = 1").select("p1", "p2", "id", "rid", "start", "off").distinct().join(of_span, ["p1", "p2"])

    def stretches(x):
        first = F.col("start") + F.col("off") - x["b"] * BLOCK
        bits = F.filter(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda d: F.call_function("shiftright", x["mask"], d).bitwiseAND(1) == 1)
        return F.transform(bits, lambda d: F.struct((first - d).cast("bigint").alias("a"), (first - d + length).cast("bigint").alias("b")))

    found = placed.select("id", "rid", F.explode(F.flatten(F.transform("bits", stretches))).alias("x"))
    return found.groupBy("id", "rid").agg(F.collect_list("x").alias("more"))


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    ``spans`` lists the maximal removed runs (a, b) in bytes of the UTF-8 text. A NULL text is the
    empty one; a text shorter than ``length`` loses nothing. Rows that repeat a doc_id and a text are
    copies of each other, so they lose all of it from ``length`` bytes on. Rows without doc_id count
    like any other. An empty table gives an empty result. Other columns are not read.
    """
    if not gram < length < gram + 4096 - BLOCK:
        raise ValueError("the length must exceed the gram, by less than 4,000 bytes")
    rows = _documents(docs)
    found = written(repeated_spans(rows, length, gram), "spans")
    lists = _anchor_rows(rows, length, gram, placed=True).join(found, ["p1", "p2"])
    lists = lists.groupBy("id", "rid").agg(F.collect_set(F.struct("p1", "p2", "place", "gram", "n", "rep", "open")).alias("found"))
    read = written(_read_off(rows, lists, length, gram), "texts")
    spans_ = read.filter("kind = 'span'")
    # A row stated twice gives its spans twice.
    opened = spans_.select("p1", "p2", "gram", "n", "off", "starts", "content", "left", "right")
    names = opened.select("p1", "p2", "gram", "left", "right").distinct()
    reach = cut(_reach(names, len(levels(length, gram))))
    blocks = written(_blocks(opened, reach, length, gram).distinct(), "blocks")
    one = opened.select("p1", "p2", "off", "content").dropDuplicates(["p1", "p2"])
    more = _runs(spans_, blocks, _masks(one, blocks, length), length)
    waiting = read.filter("kind = 'waits'").select("id", "rid", "doc_id", "content", "spans").join(more, ["id", "rid"], "left")

    names = ["spans", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            out = []
            for data, known, more in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                out.append(_outcome(data, [(y["a"], y["b"]) for part in (known, more) for y in part or ()]))
            columns = [pa.array(c, _READ.field(n).type) for n, c in zip(names, zip(*out, strict=True), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    schema = "doc_id bigint, spans array<struct<a:bigint,b:bigint>>, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    done = read.filter("kind = 'done'").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    ready = waiting.select("doc_id", "content", "spans", "more").mapInArrow(finish, schema)
    return done.unionByName(ready)
