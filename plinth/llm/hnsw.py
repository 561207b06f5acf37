"""A hierarchical navigable small-world graph in numpy, built and searched for many vectors at once.

Every vector has a level drawn from the hash of its id, so a graph depends on the vectors alone. It is built in batches
of growing size: a batch looks for its neighbours in the graph so far and within itself, and links are pruned by the
usual rule (a neighbour is kept if it is nearer to the vector than to any kept one). Searches advance together: each
round expands the best open entry of every beam.
"""

from __future__ import annotations

import numpy as np

from plinth.llm.words import mix

M = 12
BUILD_BEAM = 48


class Graph:
    """vectors are unit length. links[level] has one row of at most ``2 * M`` (level 0) or ``M`` neighbours, -1 where none."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int) -> None:
        self.vectors, self.links, self.entry = vectors, links, entry

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, m: int = M, beam: int = BUILD_BEAM) -> Graph:
        n = len(ids)
        unit = (mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        level = np.minimum((-np.log(np.maximum(unit, 1e-300)) / np.log(m)).astype(np.int64), 12)
        order = np.argsort(-level, kind="stable")
        vectors, level = np.ascontiguousarray(vectors[order], np.float32), level[order]
        links = [np.full((int((level >= k).sum()), 2 * m if k == 0 else m), -1, np.int32) for k in range(int(level[0]) + 1 if n else 1)]
        graph = cls(vectors, links, 0)
        graph.order = order
        done = min(1, n)
        while done < n:
            batch = np.arange(done, min(n, done + max(1, min(done, 2048))))
            graph._insert(batch, level, m, beam)
            done = int(batch[-1]) + 1
        return graph

    def _insert(self, batch: np.ndarray, level: np.ndarray, m: int, beam: int) -> None:
        start = np.zeros(len(batch), np.int64)
        inner = self.vectors[batch] @ self.vectors[batch].T
        np.fill_diagonal(inner, -2)
        for k in range(len(self.links) - 1, -1, -1):
            here = level[batch] >= k
            if (~here).any():
                found, _ = self._search(self.vectors[batch[~here]], start[~here, None], 1, k)
                start[~here] = found[:, 0]
            if not here.any():
                continue
            own = batch[here]
            found, score = self._search(self.vectors[own], start[here, None], beam, k)
            start[here] = found[:, 0]
            local = inner[np.ix_(here, here)]
            width = min(beam, local.shape[1])
            near = np.argpartition(-local, width - 1, axis=1)[:, :width]
            found = np.concatenate([found, own[near]], axis=1)
            score = np.concatenate([score, np.take_along_axis(local, near, 1)], axis=1)
            found[score <= -2] = -1
            most = self.links[k].shape[1]
            self.links[k][own] = self._prune(own, found, score, m, most)
            self._link_back(own, k, m)

    def _prune(self, node: np.ndarray, found: np.ndarray, score: np.ndarray, m: int, width: int) -> np.ndarray:
        """The m most useful of each row's candidates, nearest first."""
        order = np.argsort(-score, axis=1, kind="stable")
        found, score = np.take_along_axis(found, order, 1), np.take_along_axis(score, order, 1)
        kept = np.full((len(node), width), -1, np.int32)
        count = np.zeros(len(node), np.int64)
        vectors = np.zeros((len(node), m, self.vectors.shape[1]), np.float32)
        at = np.arange(len(node))
        for c in range(found.shape[1]):
            other = found[:, c]
            live = (other >= 0) & (count < m) & (other != node)
            live &= ~(kept[:, :m] == other[:, None]).any(axis=1)
            if not live.any():
                continue
            rows = at[live]
            v = self.vectors[other[rows]]
            closest = np.einsum("rmd,rd->rm", vectors[rows], v)
            closest[np.arange(m) >= count[rows, None]] = -2
            # Copies of each other tie with the node itself; the first ones are kept so that groups stay joined.
            good = (closest.max(axis=1) <= score[rows, c] + 1e-6) | (count[rows] < 2)
            rows, v = rows[good], v[good]
            kept[rows, count[rows]] = other[rows]
            vectors[rows, count[rows]] = v
            count[rows] += 1
        return kept

    def _link_back(self, own: np.ndarray, k: int, m: int) -> None:
        links = self.links[k]
        source = np.repeat(own, links.shape[1])
        target = links[own].ravel()
        some = target >= 0
        source, target = source[some], target[some]
        order = np.lexsort((source, target))
        source, target = source[order], target[order]
        heads = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.zeros(0, np.int64)
        sizes = np.diff(np.concatenate([heads, [len(target)]]))
        width = links.shape[1]
        nodes = target[heads]
        free = (links[nodes] < 0).sum(axis=1)
        for node, a, size, room in zip(nodes.tolist(), heads.tolist(), sizes.tolist(), free.tolist(), strict=True):
            new = source[a : a + size]
            row = links[node]
            new = new[~np.isin(new, row)]
            if len(new) <= room:
                row[width - room : width - room + len(new)] = new
            else:
                cand = np.concatenate([row[: width - room], new])
                score = self.vectors[cand] @ self.vectors[node]
                row[:] = self._prune(np.array([node]), cand[None, :].astype(np.int64), score[None, :], width, width)[0]

    def _search(self, queries: np.ndarray, start: np.ndarray, beam: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, scores) of each query's beam, best first; -1 and -2 where it isn't full."""
        links, q = self.links[level], len(queries)
        nodes = np.full((q, beam), -1, np.int64)
        score = np.full((q, beam), -2.0, np.float32)
        nodes[:, : start.shape[1]] = start
        score[:, : start.shape[1]] = np.einsum("qsd,qd->qs", self.vectors[start], queries)
        opened = np.zeros((q, beam), bool)
        seen = np.zeros((q, (len(links) + 7) // 8), np.uint8)
        at = np.arange(q)
        for s in range(start.shape[1]):
            seen[at, start[:, s] >> 3] |= (1 << (start[:, s] & 7)).astype(np.uint8)
        live = at
        while live.size:
            choice = np.where(opened[live] | (nodes[live] < 0), -3.0, score[live])
            pick = choice.argmax(axis=1)
            go = choice[np.arange(len(live)), pick] > -3
            live, pick = live[go], pick[go]
            if not live.size:
                break
            opened[live, pick] = True
            near = links[nodes[live, pick]].astype(np.int64)
            safe = np.maximum(near, 0)
            fresh = (near >= 0) & ((seen[live[:, None], safe >> 3] >> (safe & 7).astype(np.uint8)) & 1 == 0)
            rows, cols = np.nonzero(fresh)
            who, what = live[rows], near[rows, cols]
            np.bitwise_or.at(seen, (who, what >> 3), (1 << (what & 7)).astype(np.uint8))
            value = np.einsum("nd,nd->n", self.vectors[what], queries[who])
            better = value > score[who, -1]
            extra = np.full(near.shape, -2.0, np.float32)
            extra[rows[better], cols[better]] = value[better]
            busy = (extra > -2).any(axis=1)
            live_b = live[busy]
            if live_b.size:
                both_score = np.concatenate([score[live_b], extra[busy]], axis=1)
                both_node = np.concatenate([nodes[live_b], near[busy]], axis=1)
                both_open = np.concatenate([opened[live_b], np.zeros(near[busy].shape, bool)], axis=1)
                top = np.argsort(-both_score, axis=1, kind="stable")[:, :beam]
                score[live_b] = np.take_along_axis(both_score, top, 1)
                nodes[live_b] = np.take_along_axis(both_node, top, 1)
                opened[live_b] = np.take_along_axis(both_open, top, 1)
                nodes[live_b] = np.where(score[live_b] > -2, nodes[live_b], -1)
        return nodes, score

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest nodes of each query by cosine, through all levels."""
        start = np.zeros((len(queries), 1), np.int64)
        for k in range(len(self.links) - 1, 0, -1):
            start = self._search(queries, start, 1, k)[0][:, :1]
        return self._search(queries, start, beam, 0)
