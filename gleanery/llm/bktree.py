"""BK-trees over 64-bit fingerprints in flat arrays, many trees at a time."""

from __future__ import annotations

import numpy as np


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def build(values: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """parent and edge of every value; tree names the tree it belongs to, equal ones adjacent.

    The first value of a tree is its root (parent -1). All others go down from the root: where
    the node has no child yet at their distance, the first of them becomes that child, and the
    rest go on from it. One round takes every value one level down, in all trees at once. A
    value equal to a node hangs below it by an edge of 0.
    """
    n = len(values)
    parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    first = np.concatenate([[True], tree[1:] != tree[:-1]]) if n else np.zeros(0, bool)
    at = np.flatnonzero(first)[np.cumsum(first) - 1] if n else np.zeros(0, np.int64)
    going = np.flatnonzero(~first)
    while len(going):
        node = at[going]
        d = distance(values[going], values[node])
        _, lead, group = np.unique(node * 65 + d, return_index=True, return_inverse=True)
        child = going[lead]  # the first of each group, in order
        parent[child], edge[child] = node[lead], d[lead]
        at[going] = child[group]
        going = going[at[going] != going]
    return parent, edge


def pairs_within(values: np.ndarray, tree: np.ndarray, radius: int, block: int = 1 << 20):
    """Yields arrays (query, node) with query > node, same tree, at most radius bits apart.

    All values query their own tree together. From a node at distance d only the edges from
    d - radius to d + radius are followed. The frontier is worked off in blocks.
    """
    parent, edge = build(values, tree)
    n = len(values)
    child = np.flatnonzero(parent >= 0)
    key = parent[child] * 65 + edge[child]
    order = np.argsort(key, kind="stable")
    child, key = child[order], key[order]
    roots = np.flatnonzero(parent < 0)
    root_of = roots[np.searchsorted(roots, np.arange(n), "right") - 1]
    stack = [(np.arange(n), root_of)]
    while stack:
        query, node = stack.pop()
        if len(query) > block:
            half = len(query) // 2
            stack += [(query[half:], node[half:]), (query[:half], node[:half])]
            continue
        d = distance(values[query], values[node])
        near = (d <= radius) & (query > node)
        if near.any():
            yield query[near], node[near]
        low = np.searchsorted(key, node * 65 + np.maximum(d - radius, 0), "left")
        high = np.searchsorted(key, node * 65 + np.minimum(d + radius, 64), "right")
        count = high - low
        total = int(count.sum())
        if total:
            source = np.repeat(np.arange(len(query)), count)
            place = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            stack.append((query[source], child[place]))


def components_within(values: np.ndarray, tree: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (value, smallest value of its component) for values linked in their tree."""
    n = len(values)
    root = np.arange(n)
    # in each tree the smallest value of a component stands for it: values in order, per tree
    order = np.lexsort((values, tree))
    values, tree = values[order], tree[order]
    for a, b in pairs_within(values, tree, radius):
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(root, up := root[root]):
                root = up
    linked = np.flatnonzero(root != np.arange(n))
    return values[linked], values[root[linked]]
