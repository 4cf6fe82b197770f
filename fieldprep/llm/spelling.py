"""Spelling variants: words one edit apart, by composing the vocabulary's automaton with itself.

The vocabulary is an acceptor A, the one-edit transducer E replaces, inserts or deletes exactly one
symbol; the pairs of words one edit apart are what A o E o A accepts. A state of the composition is
a state of either acceptor and whether the edit is spent. Before it is spent both sides have read
the same prefix; at the first symbol that differs it is spent; from there both must accept the same
rest, so the composition runs on as an intersection, pruned wherever that is empty.

The work is split by initial states. Two words of at least ``least`` symbols one edit apart share
their first or their last ``(least - 1) // 2`` symbols. So every word goes to the initial state
that its first symbols lead to, and, read backwards, to the one of its last symbols; pairs that
share both are taken from the forward reading. Many small initial states make one task and one
minimal acceptor, and an initial state with more words than ``unit`` is dealt in blocks: a task
composes the acceptors of two blocks. So no task holds more than a few times ``unit`` words.

An acceptor counts the words behind each of its edges, so a word is known by its number in order and
no string is built while pairs are enumerated. Nothing here recurses: words may be of any length.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldprep.llm.store import cut, written

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: One run in so many, by hash, has lost a code point.
SLIP = 31
#: A variant's form occurs at least so many times as often.
RATIO = 10
#: Readings of words per task, forward and backward ones.
UNIT = 16_384

NEAR = "word string, near bigint, best_n bigint, best string"


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """word and its number of occurrences n, over all texts."""
    # Results of `least` code points come from runs of as many at least.
    runs = F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), 0)
    found = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    found = found.select("run", h.alias("h"), F.char_length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    word = F.when(F.col("h") % SLIP == 0, shorter).otherwise(F.col("run"))
    counted = found.select(word.alias("word")).filter(F.char_length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= count)


class Acceptor:
    """Minimal acyclic acceptors that share one set of states.

    ``edges[s]`` maps a symbol to the next state and the number of words of ``s`` before those that
    take this edge; ``final[s]``, ``count[s]`` words and the length ``shortest[s]`` of the shortest.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.edges: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []
        self.shortest: list[int] = []

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, *arcs)
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.edges)
            edges, total, shortest = {}, int(final), 0 if final else 1 << 60
            for symbol, state in arcs:
                edges[symbol] = (state, total)
                total += self.count[state]
                shortest = min(shortest, self.shortest[state] + 1)
            self.edges.append(edges)
            self.final.append(final)
            self.count.append(total)
            self.shortest.append(shortest)
        return at

    def accept(self, words: list[str]) -> int:
        """The initial state of the minimal acceptor of ``words``, sorted and distinct."""
        opened: list[list] = [[False, []]]  # from the start along the last word: final, finished edges
        last = ""
        for word in words:
            same, least = 0, min(len(word), len(last))
            while same < least and word[same] == last[same]:
                same += 1
            self._close(opened, last, same)
            opened += [[False, []] for _ in range(len(word) - same)]
            opened[-1][0] = True
            last = word
        self._close(opened, last, 0)
        return self._state(*opened[0])

    def _close(self, opened: list[list], last: str, keep: int) -> None:
        while len(opened) > keep + 1:
            final, arcs = opened.pop()
            opened[-1][1].append((last[len(opened) - 1], self._state(final, arcs)))

    def walk(self, state: int, prefix: str) -> tuple[int, int] | None:
        """The state after ``prefix`` and the number of the first word there."""
        base = 0
        for symbol in prefix:
            if symbol not in self.edges[state]:
                return None
            state, before = self.edges[state][symbol]
            base += before
        return state, base


class OneEdit:
    """The composition of two states of an acceptor with one edit between them."""

    def __init__(self, acceptor: Acceptor, rest: int | None = None):
        """``rest``: what both sides read after the edit has at most so many symbols."""
        self.a, self.rest = acceptor, 1 << 60 if rest is None else rest
        self.rests: dict[tuple, list] = {}
        self.edits: dict[tuple, list] = {}

    def common(self, p: int, q: int, left: int, without: str = "") -> list[tuple[int, int]]:
        """Numbers, within ``p`` and ``q``, of the words that both accept; ``q`` not by its edge ``without``."""
        a = self.a
        if p == q and not without and left >= 1 << 40:
            return [(i, i) for i in range(a.count[p])]
        if not without:
            if (known := self.rests.get((p, q, min(left, 64)))) is not None:
                return known
        out = [(0, 0)] if a.final[p] and a.final[q] else []
        if left:
            ways = self._ways(p, q, left, without)
            if ways:
                self._complete([w[:3] for w in ways])
                for x, y, rest, i, j in ways:
                    out += [(i + u, j + v) for u, v in self._known(x, y, rest)]
        if not without:
            self.rests[p, q, min(left, 64)] = out
        return out

    def _known(self, p: int, q: int, left: int) -> list[tuple[int, int]]:
        if p == q and left >= 1 << 40:
            return [(i, i) for i in range(self.a.count[p])]
        return self.rests[p, q, min(left, 64)]

    def _ways(self, p: int, q: int, left: int, without: str = "") -> list[tuple[int, int, int, int, int]]:
        a, here, there = self.a, self.a.edges[p], self.a.edges[q]
        if len(here) > len(there):
            shared = [s for s in there if s in here]
        else:
            shared = [s for s in here if s in there]
        ways = []
        for s in shared:
            if s != without:
                (x, i), (y, j) = here[s], there[s]
                if a.shortest[x] < left and a.shortest[y] < left:
                    ways.append((x, y, left - 1, i, j))
        return ways

    def _complete(self, todo: list[tuple[int, int, int]]) -> None:
        """Fill ``rests`` for the given pairs of states and all below them, deepest first."""
        a, stack = self.a, [(x, False) for x in todo]
        while stack:
            (p, q, left), ready = stack.pop()
            key = (p, q, min(left, 64))
            if key in self.rests or (p == q and left >= 1 << 40):
                continue
            ways = self._ways(p, q, left) if left else []
            if ways and not ready:
                stack.append(((p, q, left), True))
                stack += [(w[:3], False) for w in ways]
                continue
            out = [(0, 0)] if a.final[p] and a.final[q] else []
            for x, y, rest, i, j in ways:
                out += [(i + u, j + v) for u, v in self._known(x, y, rest)]
            self.rests[key] = out

    def at(self, p: int, q: int, same: bool) -> list[tuple[int, int]]:
        """Pairs of words of ``p`` and ``q`` whose very first symbols differ by the edit.

        ``same``: both sides are one acceptor, so ``p`` is ``q`` and each pair is given once.
        """
        if (known := self.edits.get((p, q))) is not None:
            return known
        a, rest, out = self.a, self.rest, []
        here, there = a.edges[p], a.edges[q]
        near = [(s, x, i) for s, (x, i) in here.items() if a.shortest[x] <= rest]
        far = near if same else [(s, y, j) for s, (y, j) in there.items() if a.shortest[y] <= rest]
        for (s, x, i), (z, y, j) in combinations(near, 2) if same else ((m, n) for m in near for n in far):
            if s != z and (a.final[x] and a.final[y] or x == y or not a.edges[x].keys().isdisjoint(a.edges[y])):
                out += [(i + u, j + v) for u, v in self.common(x, y, rest)]
        for s, x, i in near:  # the first side has one symbol more; the rest may not begin with it again
            if a.final[x] and a.final[q] or not a.edges[x].keys().isdisjoint(there):
                out += [(i + u, v) for u, v in self.common(x, q, rest, s)]
        if not same:
            for z, y, j in far:
                if a.final[y] and a.final[p] or not a.edges[y].keys().isdisjoint(here):
                    out += [(u, j + v) for v, u in self.common(y, p, rest, z)]
        self.edits[p, q] = out
        return out

    def pairs(self, p: int, q: int, first: int, second: int) -> list[tuple[int, int]]:
        """All pairs one edit apart; the words of ``p`` are numbered from ``first``, those of ``q`` from ``second``."""
        a, same, out, stack = self.a, p == q and first == second, [], [(p, q, first, second)]
        while stack:
            p, q, i, j = stack.pop()
            out += [(i + u, j + v) for u, v in self.at(p, q, same)]
            here, there = a.edges[p], a.edges[q]
            for s, (x, u) in here.items():
                if s in there and a.count[x] > same:
                    y, v = there[s]
                    stack.append((x, y, i + u, j + v))
        return out


def near_words(words: list[str], counts: np.ndarray, backward: np.ndarray, blocks: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the readings of one task: how many words are near, the largest count of one, which one it is (or -1).

    ``words`` are as written, ``backward`` says which readings are; readings of blocks 0 and 1 are
    compared with each other, where there is only block 0 among themselves.
    """
    read = [("<" + w[::-1]) if b else (">" + w) for w, b in zip(words, backward.tolist(), strict=True)]
    order = sorted(range(len(read)), key=read.__getitem__)
    across = bool(blocks.any())
    sides = [[i for i in order if blocks[i] == side] for side in ((0, 1) if across else (0,))]
    acceptor = Acceptor()
    starts = [acceptor.accept([read[i] for i in side]) for side in sides]
    compose = {"<": OneEdit(acceptor, depth - 1), ">": OneEdit(acceptor)}
    found: list[tuple[int, int]] = []
    for prefix in dict.fromkeys(read[i][: depth + 1] for i in sides[0]):
        ends = [acceptor.walk(start, prefix) for start in starts]
        if prefix[0] == "<" and not depth or None in ends:
            continue
        (p, i), (q, j) = ends[0], ends[-1]
        # Blocks that hold the same words after the prefix may share a state, so numbers tell them apart.
        found += compose[prefix[0]].pairs(p, q, i, j + (len(order) if across else 0))
    near, best_n, best = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), -1)
    if not found:
        return near, best_n, best
    number = np.concatenate([np.array(sides[0]), np.full(len(order) - len(sides[0]), -1)])
    if across:
        number = np.concatenate([number, np.array(sides[1], np.int64)])
    both = number[np.array(found, np.int64)]
    starts_alike = np.unique([w[:depth] for w in words], return_inverse=True)[1]
    both = both[~(backward[both[:, 0]] & (starts_alike[both[:, 0]] == starts_alike[both[:, 1]]))]
    u, v = np.concatenate([both[:, 0], both[:, 1]]), np.concatenate([both[:, 1], both[:, 0]])
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    near += np.bincount(u, minlength=len(words))
    ranked = np.lexsort((place[v], -counts[v], u))
    lead = ranked[np.concatenate([[True], np.diff(u[ranked]) > 0])] if len(u) else ranked
    best[u[lead]], best_n[u[lead]] = v[lead], counts[v[lead]]
    return near, best_n, best


def _near(depth: int):
    def measure(group: pa.Table) -> pa.Table:
        words = group.column("word").to_pylist()
        counts = group.column("n").to_numpy().astype(np.int64)
        near, best_n, best = near_words(words, counts, group.column("backward").to_numpy().astype(bool), group.column("side").to_numpy(), depth)
        hit = np.flatnonzero(near)
        return pa.table({"word": pa.array([words[i] for i in hit], pa.string()), "near": near[hit], "best_n": best_n[hit], "best": pa.array([words[i] for i in best[hit]], pa.string())})

    return measure


def nearest(words: DataFrame, least: int = LEAST_LENGTH, unit: int = UNIT) -> DataFrame:
    """word, near (how many words are one edit from it), best_n and best: the most frequent of them.

    ``words``: word (distinct, ``least`` code points or more) and n; a stored table, it is read several times.
    """
    depth = (least - 1) // 2
    read = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward"))
    start = F.substring(F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")), 1, depth)
    read = read.withColumn("start", start)
    total = words.count()
    buckets = max(1, math.ceil(2 * total / unit))
    many = read.groupBy("backward", "start").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > unit)
    many = many.select("backward", "start", F.ceil(F.col("size") / unit).cast("int").alias("blocks"))
    dealt = read.join(many, ["backward", "start"], "left")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("word", "n", "backward", "start", F.coalesce(own, F.lit(0)).alias("own"), F.col("blocks").isNotNull().alias("hot"), other.alias("other"))
    spread = F.when(F.col("hot"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("backward", "start"), F.lit(buckets)).cast("int"))
    dealt = dealt.select(
        "word", "n", "backward", (F.col("own") > F.col("other")).cast("int").alias("side"), spread.alias("bucket"),
        F.when(F.col("hot"), F.col("start")).alias("hot"), F.when(F.col("hot"), F.col("backward")).alias("turned"),
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
    )
    parts = dealt.groupBy("bucket", "hot", "turned", "low", "high").applyInArrow(_near(depth), NEAR)
    lead = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return parts.groupBy("word").agg(F.sum("near").alias("near"), lead.alias("lead")).select("word", "near", (-F.col("lead.m")).alias("best_n"), F.col("lead.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the end of the chain of ``forms`` (word, form) that begins at the word.

    Every round follows twice as many steps. A form is more frequent than its word by a factor, so
    chains are short and never close.
    """
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = cut(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = now.select("word", "root")
        if now.filter("moved").isEmpty():
            return at


def variants(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, ratio: int = RATIO, unit: int = UNIT) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, form, root, n, n_near, form_n.

    A NULL or empty text has no words. Rows without doc_id hash as if it were the empty text; rows
    that repeat a doc_id, or whole rows, count each. Of equally frequent near words the first in
    code-point order is the form. Other columns are not read. An empty table gives no rows.
    """
    words = written(vocabulary(docs.select("doc_id", "text"), least, count), "words")
    near = words.join(nearest(words, least, unit), "word", "left")
    good = F.col("best_n") >= ratio * F.col("n")
    found = cut(near.select("word", "n", F.coalesce("near", F.lit(0)).alias("n_near"), F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")))
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
