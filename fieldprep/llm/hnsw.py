"""A navigable small-world graph in layers over the vectors of one shard, in numpy.

Every vector stands in layer 0; one in ``DEGREE`` of those of a layer, by a hash, stands in the next.
A search goes down from the top layer, keeping a beam of the best vectors seen; the best ones not
yet looked at hand on their neighbours until none of them can improve the beam. All queries of a
block advance together, one array operation per step.

A layer is built in blocks of growing size: a block is searched for in what stands already and
compared within itself. A vector keeps neighbours that are nearer to it than to each other, and a
neighbour that gets too many links keeps those by the same rule.
"""

from __future__ import annotations

import numpy as np

DEGREE = 16
#: Beam while building; and queries or vectors that advance together.
BUILD_BEAM, BLOCK = 48, 512
#: Vectors of a beam looked at in one step.
WIDTH = 4


def _mixed(ids: np.ndarray) -> np.ndarray:
    """A number in (0, 1) per id, the same in every run."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53 + 2**-54


class Graph:
    """``unit`` are unit vectors (float32), one per row; ``layers`` neighbours per layer, -1 where there are fewer.

    ``members[l]`` are the rows that stand in layer l, in the order of their places there; links are places.
    """

    def __init__(self, unit: np.ndarray, members: list[np.ndarray], layers: list[np.ndarray]):
        self.unit, self.members, self.layers = unit, members, layers
        self.places = []
        for rows in members:
            place = np.full(len(unit), -1, np.int32)
            place[rows] = np.arange(len(rows), dtype=np.int32)
            self.places.append(place)

    @classmethod
    def build(cls, unit: np.ndarray, ids: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> Graph:
        """``ids`` decide by their hash who stands in the upper layers."""
        height = np.floor(-np.log(_mixed(ids)) / np.log(degree)).astype(int)
        order = np.lexsort((ids, -height))  # those of a layer come first in every layer below
        members = [order[height[order] >= layer].astype(np.int32) for layer in range(int(height.max(initial=0)) + 1)]
        layers = [np.full((len(rows), 2 * degree if layer == 0 else degree), -1, np.int32) for layer, rows in enumerate(members)]
        graph = cls(unit, members, layers)
        for layer in range(len(members) - 1, -1, -1):
            graph._fill(layer, degree, beam)
        return graph

    def _fill(self, layer: int, degree: int, beam: int) -> None:
        rows, links = self.members[layer], self.layers[layer]
        above = len(self.members[layer + 1]) if layer + 1 < len(self.members) else 0
        done = 0
        while done < len(rows):
            # Each block is at most as large as what stands already, so most neighbours are found there.
            size = min(len(rows) - done, max(above if not done else 0, 32, min(done, BLOCK)), BLOCK)
            block = np.arange(done, done + size)
            queries = self.unit[rows[block]]
            near, sims = self._within(queries, done, min(beam, size))
            if done:
                entry = self._enter(queries, layer, min(len(links), done))
                seen, seen_sims = self._beam(layer, queries, entry, beam, done)
                near, sims = np.concatenate([seen, near], axis=1), np.concatenate([seen_sims, sims], axis=1)
            chosen = self._select(rows, near, sims, degree)
            links[block, :degree] = chosen
            self._link_back(rows, links, block, chosen)
            done += size

    def _within(self, queries: np.ndarray, start: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """The best of a block for each of its own, as places."""
        sims = queries @ queries.T
        np.fill_diagonal(sims, -np.inf)
        best = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
        found = np.take_along_axis(sims, best, axis=1)
        return np.where(np.isfinite(found), best + start, -1).astype(np.int32), found

    def _select(self, rows: np.ndarray, near: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
        """Of each row's candidates (places, -1 for none) up to ``keep`` that are nearer to it than to one chosen before."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * keep]
        near, sims = np.take_along_axis(near, order, axis=1), np.take_along_axis(sims, order, axis=1)
        width = near.shape[1]
        out = np.full((len(near), keep), -1, np.int32)
        for at in range(0, len(near), BLOCK):
            part, own = near[at : at + BLOCK], sims[at : at + BLOCK]
            vectors = self.unit[rows[np.maximum(part, 0)]]
            between = vectors @ vectors.transpose(0, 2, 1)
            taken = np.zeros(part.shape, bool)
            closest = np.full(part.shape, -np.inf, np.float32)  # the largest similarity to one chosen
            left = np.full(len(part), keep)
            for k in range(width):
                ok = (part[:, k] >= 0) & (own[:, k] > closest[:, k]) & (left > 0)
                taken[:, k] = ok
                left -= ok
                np.maximum(closest, np.where(ok[:, None], between[:, k], -np.inf), out=closest)
            # What is left over fills free places, nearest first, so that groups of near copies stay linked.
            rank = np.argsort(~taken * 2 + (part < 0) * 4, axis=1, kind="stable")[:, :keep]
            picked = np.take_along_axis(part, rank, axis=1)
            out[at : at + BLOCK, : picked.shape[1]] = picked
        return out

    def _link_back(self, rows: np.ndarray, links: np.ndarray, block: np.ndarray, chosen: np.ndarray) -> None:
        source, target = np.repeat(block, chosen.shape[1]), chosen.ravel()
        some = target >= 0
        source, target = source[some], target[some]
        fresh = ~(links[target] == source[:, None]).any(axis=1)
        source, target = source[fresh], target[fresh]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        touched, first, many = np.unique(target, return_index=True, return_counts=True)
        if not len(touched):
            return
        nth = np.arange(len(target)) - np.repeat(first, many)
        which = np.repeat(np.arange(len(touched)), many)
        width = links.shape[1]
        for at in range(0, len(touched), BLOCK):
            mine = (which >= at) & (which < at + BLOCK)
            some = touched[at : at + BLOCK]
            added = np.full((len(some), int(many[at : at + BLOCK].max())), -1, np.int32)
            added[which[mine] - at, nth[mine]] = source[mine]
            near = np.concatenate([links[some], added], axis=1)
            sims = np.einsum("ijk,ik->ij", self.unit[rows[np.maximum(near, 0)]], self.unit[rows[some]])
            sims = np.where(near >= 0, sims, -np.inf)
            full = (near >= 0).sum(axis=1) > width
            if full.any():
                links[some[full]] = self._select(rows, near[full], sims[full], width)
            if not full.all():
                packed = np.argsort(near[~full] < 0, axis=1, kind="stable")[:, :width]
                links[some[~full]] = np.take_along_axis(near[~full], packed, axis=1)

    def _enter(self, queries: np.ndarray, layer: int, below: int) -> np.ndarray:
        """Where to enter ``layer``: the places there of the best found in the layers above."""
        entry = np.zeros((len(queries), 1), np.int32)
        for upper in range(len(self.members) - 1, layer, -1):
            found, _ = self._beam(upper, queries, entry, WIDTH, len(self.members[upper]))
            entry = self.places[upper - 1][self.members[upper][np.maximum(found, 0)]]
            entry = np.where(found >= 0, entry, -1)
        entry = np.where(entry < below, entry, -1)
        entry[(entry < 0).all(axis=1), 0] = 0  # those above stand at the front, but not all of them yet
        return entry

    def _beam(self, layer: int, queries: np.ndarray, entry: np.ndarray, beam: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` places per query that are reached from ``entry`` among the first ``size``; -1 for none."""
        rows, links, n = self.members[layer], self.layers[layer], len(queries)
        seen = np.zeros((n, size), bool)
        ids, sims = np.full((n, beam), -1, np.int32), np.full((n, beam), -np.inf, np.float32)
        closed = np.ones((n, beam), bool)
        who, where = np.nonzero(entry >= 0)
        fresh = self._fresh(seen, who, entry[who, where])
        ids, sims, closed = self._merge(rows, queries, ids, sims, closed, *fresh)
        while True:
            waiting = np.where(closed, -np.inf, sims)
            live = np.flatnonzero(np.isfinite(waiting).any(axis=1))
            if not len(live):
                return ids, sims
            next_ = np.argsort(-waiting[live], axis=1, kind="stable")[:, :WIDTH]
            who = np.repeat(live, next_.shape[1])
            where = next_.ravel()
            real = np.isfinite(waiting[who, where])
            who, where = who[real], where[real]
            closed[who, where] = True
            handed = links[ids[who, where]]
            who = np.repeat(who, handed.shape[1])
            handed = handed.ravel()
            real = (handed >= 0) & (handed < size)
            fresh = self._fresh(seen, who[real], handed[real])
            ids, sims, closed = self._merge(rows, queries, ids, sims, closed, *fresh)

    @staticmethod
    def _fresh(seen: np.ndarray, who: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs not seen before, each once; they are seen from now on."""
        new = ~seen[who, places]
        code = np.unique(who[new].astype(np.int64) * seen.shape[1] + places[new])
        who, places = np.divmod(code, seen.shape[1])
        seen[who, places] = True
        return who, places.astype(np.int32)

    def _merge(self, rows, queries, ids, sims, closed, who, places):
        """Beams with new pairs (ordered by query) taken in, best first."""
        if not len(who):
            return ids, sims, closed
        got = np.einsum("ij,ij->i", queries[who], self.unit[rows[places]])
        better = got > sims[who, -1]
        who, places, got = who[better], places[better], got[better]
        touched, first, many = np.unique(who, return_index=True, return_counts=True)
        if not len(touched):
            return ids, sims, closed
        nth = np.arange(len(who)) - np.repeat(first, many)
        which = np.repeat(np.arange(len(touched)), many)
        beam, most = ids.shape[1], int(many.max())
        more_ids, more_sims = np.full((len(touched), most), -1, np.int32), np.full((len(touched), most), -np.inf, np.float32)
        more_ids[which, nth], more_sims[which, nth] = places, got
        all_ids, all_sims = np.concatenate([ids[touched], more_ids], axis=1), np.concatenate([sims[touched], more_sims], axis=1)
        all_closed = np.concatenate([closed[touched], np.zeros(more_ids.shape, bool)], axis=1) | (all_ids < 0)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        ids[touched], sims[touched], closed[touched] = (np.take_along_axis(x, order, axis=1) for x in (all_ids, all_sims, all_closed))
        return ids, sims, closed

    def nearest(self, queries: np.ndarray, count: int, beam: int) -> np.ndarray:
        """The similarities of the best ``count`` that a search with this beam finds, best first."""
        size, out = len(self.members[0]), []
        for at in range(0, len(queries), BLOCK):
            part = queries[at : at + BLOCK]
            out.append(self._beam(0, part, self._enter(part, 0, size), min(beam, size), size)[1][:, :count])
        return np.concatenate(out)

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) of similarity ``least`` or more, in float32: the beam's, and all that these lead to.

        From every pair found the search goes on to the neighbours of its row, so a query with more
        partners than the beam holds still meets them.
        """
        rows, links, size = self.members[0], self.layers[0], len(self.members[0])
        found_who, found_row = [], []
        for at in range(0, len(queries), BLOCK):
            part = queries[at : at + BLOCK]
            ids, sims = self._beam(0, part, self._enter(part, 0, size), min(beam, size), size)
            who, where = np.nonzero(sims >= least)
            places = ids[who, where]
            seen = np.zeros((len(part), size), bool)
            seen[who, places] = True
            while len(who):
                found_who.append(who + at)
                found_row.append(rows[places])
                handed = links[places]
                who, handed = np.repeat(who, handed.shape[1]), handed.ravel()
                who, places = self._fresh(seen, who[handed >= 0], handed[handed >= 0])
                near = np.einsum("ij,ij->i", part[who], self.unit[rows[places]]) >= least
                who, places = who[near], places[near]
        if not found_who:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_who).astype(np.int64), np.concatenate(found_row).astype(np.int64)
