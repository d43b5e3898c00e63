"""Robust-pruned neighbour graphs in numpy: batches of inserts, greedy search from medoids, expansion within a range.

All vectors have length 1, so nearer means a larger dot product. Adjacency is a matrix of node numbers, -1 where a list ends.
"""

from __future__ import annotations

import numpy as np

from pulsefold.llm.texts import spread

NONE = -1


def medoid(units: np.ndarray) -> int:
    return int(np.argmax(units @ units.mean(0)))


def prune(units: np.ndarray, around: np.ndarray, candidates: np.ndarray, sims: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to `degree` neighbours for each of several nodes from their candidates (NONE where there is none): always the nearest
    one left, which then drops the candidates that are `alpha` times nearer to it than to the node."""
    order = np.argsort(-sims, axis=1, kind="stable")
    candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
    alive = (candidates != NONE) & (candidates != around[:, None])
    # The same candidate twice: only the first counts (equal ones need not be neighbours in the order, so compare numbers).
    by_number = np.argsort(candidates, axis=1, kind="stable")
    sorted_ = np.take_along_axis(candidates, by_number, 1)
    again = np.zeros_like(alive)
    np.put_along_axis(again, by_number[:, 1:], sorted_[:, 1:] == sorted_[:, :-1], 1)
    alive &= ~again
    vectors = units[np.maximum(candidates, 0)]
    between = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    to_node = 2 - 2 * sims
    out = np.full((len(around), degree), NONE, np.int64)
    rows = np.arange(len(around))
    for k in range(degree):
        pick = alive.argmax(1)
        some = alive[rows, pick]
        if not some.any():
            break
        out[some, k] = candidates[some, pick[some]]
        dropped = alpha * alpha * between[rows, pick] <= to_node
        dropped[rows, pick] = True
        alive &= ~(dropped & some[:, None])
    return out


def greedy(units: np.ndarray, adjacency: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int):
    """Best-first search for every query at once. Returns the beams (nodes, similarities), which nodes each query has met, and the
    pairs (query, node, similarity) of all of them in lists of arrays."""
    q, n = len(queries), len(units)
    seen = np.zeros((q, n), bool)
    seen[:, starts] = True
    sims = queries @ units[starts].T
    nodes = np.broadcast_to(starts, sims.shape)
    met = [(np.repeat(np.arange(q), len(starts)), nodes.ravel().copy(), sims.ravel().copy())]
    width = max(beam, 1)
    best, best_sims = np.full((q, width), NONE, np.int64), np.full((q, width), -np.inf, units.dtype)
    done = np.ones((q, width), bool)
    best, best_sims, done = _keep(best, best_sims, done, nodes, sims, np.zeros(sims.shape, bool), width)
    while True:
        waiting = np.where(done, -np.inf, best_sims)
        pick = waiting.argmax(1)
        live = np.flatnonzero(~done.all(1))
        if not len(live):
            return best, best_sims, seen, met
        pick = pick[live]
        done[live, pick] = True
        near = adjacency[best[live, pick]]
        new = (near != NONE) & ~seen[live[:, None], near]
        at, column = np.nonzero(new)
        who, node = live[at], near[at, column]
        seen[who, node] = True
        value = np.einsum("ij,ij->i", queries[who], units[node])
        met.append((who, node, value))
        if not len(who):
            continue
        sims_new = np.full(near.shape, -np.inf, units.dtype)
        sims_new[at, column] = value
        best[live], best_sims[live], done[live] = _keep(
            best[live], best_sims[live], done[live], np.where(new, near, NONE), sims_new, ~new, width)


def _keep(best, best_sims, done, nodes, sims, finished, width):
    nodes, values = np.concatenate([best, nodes], 1), np.concatenate([best_sims, sims], 1)
    done = np.concatenate([done, finished], 1)
    top = np.argpartition(-values, width - 1, axis=1)[:, :width]
    return np.take_along_axis(nodes, top, 1), np.take_along_axis(values, top, 1), np.take_along_axis(done, top, 1)


def build(units: np.ndarray, degree: int, beam: int, alpha: float, seed: int = 0) -> tuple[np.ndarray, int]:
    """Adjacency of a graph over `units` and its medoid. Nodes are inserted in growing batches: each looks for its neighbours in
    the graph so far, takes the pruned ones, and enters their lists, which are pruned again where they overflow."""
    n, start = len(units), medoid(units)
    adjacency = np.full((n, degree), NONE, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at = 1
    while at < n:
        batch = order[at:at + max(1, min(at, n // 16 + 1))]
        at += len(batch)
        nodes, sims, _, _ = greedy(units, adjacency, np.array([start]), units[batch], beam)
        adjacency[batch] = prune(units, batch, nodes, sims, degree, alpha)
        target, source = adjacency[batch].ravel(), np.repeat(batch, degree)
        target, source = target[target != NONE], source[target != NONE]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        hit, first, count = np.unique(target, return_index=True, return_counts=True)
        wide = np.full((len(hit), int(count.max())), NONE, np.int64)
        wide[np.repeat(np.arange(len(hit)), count), np.arange(len(target)) - np.repeat(first, count)] = source
        lists = np.concatenate([adjacency[hit], wide], 1)
        values = np.where(lists == NONE, -np.inf, np.einsum("ikj,ij->ik", units[np.maximum(lists, 0)], units[hit]))
        full = (lists != NONE).sum(1) > degree
        if (~full).any():
            ordered = np.take_along_axis(lists[~full], np.argsort(lists[~full] == NONE, axis=1, kind="stable"), 1)
            adjacency[hit[~full]] = ordered[:, :degree]
        if full.any():
            adjacency[hit[full]] = prune(units, hit[full], lists[full], values[full], degree, alpha)
    return adjacency, start


def both_ways(adjacency: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every edge in both directions: where each node's list begins (one more entry than nodes), and the lists end to end."""
    at, column = np.nonzero(adjacency != NONE)
    to, n = adjacency[at, column], len(adjacency)
    keys = np.unique(np.concatenate([at * n + to, to * n + at]))
    return np.searchsorted(keys, np.arange(n + 1) * n), keys % n


def within(units: np.ndarray, adjacency: np.ndarray, edges: tuple[np.ndarray, np.ndarray], starts: np.ndarray, queries: np.ndarray,
           beam: int, least: float, margin: float):
    """Pairs (query, node) of similarity `least` or more: greedy search from `starts`, then every node met within the range,
    widened by `margin`, is expanded along its edges in both directions (`both_ways`) until nothing new lies in it."""
    begin, lists = edges
    _, _, seen, met = greedy(units, adjacency, starts, queries, beam)
    who, node, value = (np.concatenate(x) for x in zip(*met, strict=True))
    n = len(units)
    found = [(who[value >= least], node[value >= least])]
    near = value >= least - margin
    who, node = who[near], node[near]
    while len(who):
        fresh_who, fresh_node = [], []
        for k in range(0, len(who), 4096):
            some = node[k:k + 4096]
            size = begin[some + 1] - begin[some]
            ahead, from_ = lists[spread(begin[some], size)], np.repeat(who[k:k + 4096], size)
            new = ~seen[from_, ahead]
            keys = np.unique(from_[new] * n + ahead[new])
            w, x = keys // n, keys % n
            seen[w, x] = True
            value = np.concatenate([np.einsum("ij,ij->i", queries[w[j:j + 50_000]], units[x[j:j + 50_000]]) for j in range(0, max(len(w), 1), 50_000)])
            found.append((w[value >= least], x[value >= least]))
            near = value >= least - margin
            fresh_who.append(w[near])
            fresh_node.append(x[near])
        who, node = np.concatenate(fresh_who), np.concatenate(fresh_node)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def k_means(points: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Centres of up to `k` cells, started from drawn points, so dense places get more of them."""
    draw = np.random.default_rng(seed)
    centres = points[draw.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        nearest = distances(points, centres).argmin(1)
        for j in range(len(centres)):
            own = points[nearest == j]
            if len(own):
                centres[j] = own.mean(0)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, taken around the mean of the centres, so that close vectors are told apart too."""
    middle = centres.mean(0)
    p, c = points - middle, centres - middle
    return (p * p).sum(1)[:, None] - 2 * p @ c.T + (c * c).sum(1)
