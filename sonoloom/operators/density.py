"""Density labels of one bounded block of vectors.

HDBSCAN as published (Campello, Moulavi, Sander 2013; McInnes, Healy 2017) on the cosine
distances of a block: mutual reachability, minimum spanning tree, condensed tree, and stable
(``eom``) or lowest (``leaf``) clusters.  Blocks are cut by row position, so their size is a
parameter and never grows with the table.
"""

from __future__ import annotations

import numpy as np


def _spanning_tree(distance: np.ndarray, min_samples: int) -> np.ndarray:
    """Rows (u, v, weight) of the mutual-reachability spanning tree by ascending weight."""
    size = len(distance)
    core = np.partition(distance, min(min_samples, size - 1), axis=1)[:, min(min_samples, size - 1)]
    best, source = np.full(size, np.inf), np.zeros(size, dtype=int)
    inside = np.zeros(size, dtype=bool)
    tree, at = [], 0
    for _ in range(size - 1):
        inside[at] = True
        reach = np.maximum(distance[at], np.maximum(core[at], core))
        closer = (reach < best) & ~inside
        best[closer], source[closer] = reach[closer], at
        at = int(np.argmin(np.where(inside, np.inf, best)))
        tree.append((source[at], at, best[at]))
    edges = np.array(tree)
    return edges[np.argsort(edges[:, 2], kind="stable")]


def _merge_tree(edges: np.ndarray, size: int) -> tuple[dict, np.ndarray]:
    """Binary merge tree: node -> (left, right, distance), and the leaves below each node."""
    top = np.arange(2 * size - 1)
    count = np.ones(2 * size - 1, dtype=int)

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    nodes = {}
    for step, (u, v, weight) in enumerate(edges):
        left, right, new = find(int(u)), find(int(v)), size + step
        nodes[new] = (left, right, weight)
        top[left] = top[right] = new
        count[new] = count[left] + count[right]
    return nodes, count


def _leaves(nodes: dict, start: int) -> list[int]:
    found, stack = [], [start]
    while stack:
        node = stack.pop()
        if node in nodes:
            stack.extend(nodes[node][:2])
        else:
            found.append(node)
    return found


def density_labels(vectors: np.ndarray, min_cluster_size: int, min_samples: int, method: str = "eom") -> np.ndarray:
    """Cluster number of each unit row, -1 for noise."""
    size = len(vectors)
    labels = np.full(size, -1)
    if size < max(2, min_cluster_size):
        return labels
    distance = np.clip(1.0 - vectors @ vectors.T, 0.0, None)
    np.fill_diagonal(distance, 0.0)
    nodes, count = _merge_tree(_spanning_tree(distance, min_samples), size)

    # Condensed tree: clusters with their birth, children and the (leaf, lambda) that fall out.
    root = 2 * size - 2
    born, children, fallen = {0: 0.0}, {0: []}, {0: []}
    stack, clusters = [(root, 0)], 1
    while stack:
        node, cluster = stack.pop()
        if node not in nodes:
            continue
        left, right, weight = nodes[node]
        rate = 1.0 / weight if weight > 0 else np.inf
        large = [c for c in (left, right) if count[c] >= min_cluster_size]
        for child in (left, right):
            if count[child] < min_cluster_size:
                fallen[cluster].extend((leaf, rate) for leaf in _leaves(nodes, child))
        if len(large) == 1:
            stack.append((large[0], cluster))
        elif len(large) == 2:
            for child in large:
                born[clusters], children[clusters], fallen[clusters] = rate, [], []
                children[cluster].append((clusters, rate, count[child]))
                stack.append((child, clusters))
                clusters += 1

    def excess(rate: float, birth: float) -> float:
        return 0.0 if rate == birth else rate - birth

    stability = {
        c: sum(excess(rate, born[c]) for _, rate in fallen[c]) + sum(n * excess(rate, born[c]) for _, rate, n in children[c])
        for c in born
    }
    chosen = set()
    for cluster in sorted(born, reverse=True):
        below = [child for child, _, _ in children[cluster]]
        if cluster == 0:
            break
        if method == "leaf":
            if not below:
                chosen.add(cluster)
            continue
        kept = sum(stability[b] for b in below)
        if below and kept > stability[cluster]:
            stability[cluster] = kept
        else:
            chosen.add(cluster)
            drop = list(below)
            while drop:
                child = drop.pop()
                chosen.discard(child)
                drop.extend(grand for grand, _, _ in children[child])

    for label, cluster in enumerate(sorted(chosen)):
        stack = [cluster]
        while stack:
            part = stack.pop()
            labels[[leaf for leaf, _ in fallen[part]]] = label
            stack.extend(child for child, _, _ in children[part])
    return labels
