"""Communities of weighted graphs, hierarchical clustering of centroids and density clustering of a fit sample."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa


def _summed(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights summed by pair, ordered by a, then b."""
    key = a * np.int64(n) + b
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return *np.divmod(key[first], max(n, 1)), np.add.reduceat(w[order], first) if len(key) else np.zeros(0)


AT_ONCE = 1_000_000  # edges of a graph that one array operation takes


class Graph:
    """Weighted edges in both directions, ordered by node and neighbour: node i has places first[i] to first[i + 1].

    Half the size of an edge list with both ends and a third of one of doubles; all work on it takes AT_ONCE edges at a time.
    """

    def __init__(self, first: np.ndarray, dst: np.ndarray, w: np.ndarray) -> None:
        self.first, self.dst, self.w, self.n = first, dst, w, len(first) - 1

    @staticmethod
    def of(n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> Graph:
        """From undirected edges between n nodes; repeated ones are summed, loops and weights that are not positive left out."""
        least = np.zeros(n + 1, np.int64)
        for end in (a, b):
            least[1:] += np.bincount(end, minlength=n)
        least = np.cumsum(least)
        cuts = np.unique(np.r_[0, np.searchsorted(least, np.arange(AT_ONCE, least[-1] + 1, AT_ONCE)), n])
        count, to, weight, at = np.zeros(n + 1, np.int64), np.empty(least[-1], np.int32), np.empty(least[-1]), 0
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            parts = []
            for x, y in ((a, b), (b, a)):
                ok = np.flatnonzero((x >= lo) & (x < hi))
                ok = ok[(x[ok] != y[ok]) & (w[ok] > 0)]
                parts.append((x[ok].astype(np.int64), y[ok].astype(np.int64), w[ok]))
            src, dst, sums = _summed(*(np.concatenate(c) for c in zip(*parts, strict=True)), n)
            count[lo + 1 : hi + 1] = np.bincount(src - lo, minlength=hi - lo)
            to[at : at + len(dst)], weight[at : at + len(dst)] = dst, sums
            at += len(dst)
        return Graph(np.cumsum(count), to[:at], weight[:at])

    def runs(self, nodes: np.ndarray | None = None):
        """All edges of the given nodes (or all nodes), some nodes at a time: nodes, number of edges of each, other ends, weights."""
        nodes = np.arange(self.n) if nodes is None else nodes
        size = self.first[nodes + 1] - self.first[nodes]
        ends = np.cumsum(size)
        cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(AT_ONCE, (ends[-1] if len(ends) else 0) + 1, AT_ONCE)), len(nodes)])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            v, each = nodes[lo:hi], size[lo:hi]
            if each.any():
                at = np.arange(each.sum()) + np.repeat(self.first[v] - np.cumsum(each) + each, each)
                yield v, each, self.dst[at], self.w[at]

    def degrees(self) -> np.ndarray:
        out = np.zeros(self.n)
        for v, each, _, w in self.runs():
            out[v] = np.bincount(np.repeat(np.arange(len(v)), each), w, minlength=len(v))
        return out

    def connected(self, group: np.ndarray) -> np.ndarray:
        """Number of each node's part that edges within a group connect."""
        root = np.arange(self.n)
        while True:
            moved = False
            for v, each, b, _ in self.runs():
                a = np.repeat(v, each)
                ok = (a > b) & (group[a] == group[b])
                x, y = root[a[ok]], root[b[ok]]
                apart = x != y
                if apart.any():
                    moved = True
                    np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
                    while (root[root] != root).any():
                        root = root[root]
            if not moved:
                return np.unique(root, return_inverse=True)[1]

    def summed(self, group: np.ndarray, k: int) -> tuple[Graph, np.ndarray]:
        """The graph of k groups, and the weight inside each, every edge once."""
        parts, loops = [], np.zeros(k)
        for v, each, to, w in self.runs():
            a, b = np.repeat(group[v], each), group[to]
            same = a == b
            loops += np.bincount(a[same], w[same] / 2, minlength=k)
            parts.append(_summed(a[~same], b[~same], w[~same], k))
            if sum(len(p[0]) for p in parts) > 4 * AT_ONCE:
                parts = [_summed(*(np.concatenate(c) for c in zip(*parts, strict=True)), k)]
        if not parts:
            return Graph(np.zeros(k + 1, np.int64), np.zeros(0, np.int32), np.zeros(0)), loops
        src, dst, w = parts[0] if len(parts) == 1 else _summed(*(np.concatenate(c) for c in zip(*parts, strict=True)), k)
        return Graph(np.searchsorted(src, np.arange(k + 1)), dst.astype(np.int32), w), loops


class Alike(Graph):
    """The graph of unit vectors with a cosine (to 12 places) of at least `least`, which weighs the edge.

    Up to `most` edges are held; more are computed anew whenever they are asked for, so that memory does not grow with them.
    """

    def __init__(self, x: np.ndarray, least: float) -> None:
        self.x, self.least, self.n = x, least, len(x)

    @staticmethod
    def of(x: np.ndarray, least: float, most: int = 4_000_000) -> Graph:
        n, parts, held = len(x), [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0))], 0
        for s in range(0, n, 1000):
            sim = x[s : s + 1000] @ x[s:].T
            i, j = np.nonzero((sim >= least) & (np.arange(sim.shape[1])[None] > np.arange(len(sim))[:, None]))
            held += len(i)
            if held > most:
                return Alike(x, least)
            parts.append(((i + s).astype(np.int32), (j + s).astype(np.int32), sim[i, j]))
        return Graph.of(n, *(np.concatenate(c) for c in zip(*parts, strict=True)))

    def runs(self, nodes: np.ndarray | None = None):
        nodes = np.arange(self.n) if nodes is None else nodes
        step = max(1, AT_ONCE // max(1, self.n))
        for s in range(0, len(nodes), step):
            v = nodes[s : s + step]
            sim = np.round(self.x[v] @ self.x.T, 12)
            sim[np.arange(len(v)), v] = -2
            i, j = np.nonzero(sim >= self.least)
            if len(i):
                yield v, np.bincount(i, minlength=len(v)), j, sim[i, j]


def _moved_together(graph: Graph, degree: np.ndarray, total: float, resolution: float, rng: np.random.Generator, start: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Communities after rounds in which a random quarter of the nodes moves at once, each to its best neighbour community.

    Only edges inside a group of `within` count. After the first round only nodes are looked at of which a neighbour has
    moved to another community.
    """
    n, own = graph.n, start.copy()
    mass, wake = np.bincount(own, degree, minlength=n), degree > 0
    for _ in range(40):
        turn, awake, changed = rng.integers(0, 4, n), wake, 0
        wake = np.zeros(n, bool)
        for g in range(4):
            moves = []
            for v, each, to, w in graph.runs(np.flatnonzero(awake & (turn == g))):
                row = np.repeat(np.arange(len(v)), each)
                ok = within[v][row] == within[to]
                row, to, w = row[ok], to[ok], w[ok]
                if not len(row):
                    continue
                row, comm, weight = _summed(row, own[to], w, n)
                here = comm == own[v][row]
                d = degree[v][row]
                gain = weight - resolution * d * (mass[comm] - here * d) / total
                stay = -resolution * degree[v] * (mass[own[v]] - degree[v]) / total
                stay[row[here]] = gain[here]
                begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                top = np.full(len(v), -np.inf)
                top[row[begin]] = np.maximum.reduceat(gain, begin)
                hit = np.flatnonzero(gain == top[row])[::-1]  # the smallest community among equals is written last
                best = own[v]
                best[row[hit]] = comm[hit]
                better = top > stay + 1e-12
                moves.append((v[better], best[better]))
            for v, to in moves:
                np.subtract.at(mass, own[v], degree[v])
                np.add.at(mass, to, degree[v])
                own[v] = to
                changed += len(v)
            for v, _ in moves:
                for x, each, near, _ in graph.runs(v):
                    wake[near[own[near] != np.repeat(own[x], each)]] = True
        if changed <= n // 1000:
            break
    return own


def _moved_singly(edges: Graph, degree: np.ndarray, total: float, resolution: float, rng: np.random.Generator, start: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Communities after moving nodes one by one until none gains; neighbours of a moved node are looked at again."""
    n = edges.n
    graph: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for v, each, to, w in edges.runs():
        src = np.repeat(v, each)
        inside = within[src] == within[to]
        for a, b, x in zip(src[inside].tolist(), to[inside].tolist(), w[inside].tolist(), strict=True):
            graph[a].append((b, x))
    own, mass, queue, waiting = start.tolist(), np.bincount(start, degree, minlength=n).tolist(), rng.permutation(n).tolist(), [True] * n
    while queue:
        later = []
        for v in queue:
            waiting[v] = False
            to: dict[int, float] = defaultdict(float)
            for u, x in graph[v]:
                to[own[u]] += x
            here, d = own[v], float(degree[v])
            mass[here] -= d
            best, gain = here, to.get(here, 0.0) - resolution * d * mass[here] / total
            for c in sorted(to):
                g = to[c] - resolution * d * mass[c] / total
                if g > gain + 1e-12:
                    best, gain = c, g
            mass[best] += d
            if best != here:
                own[v] = best
                for u, _ in graph[v]:
                    if own[u] != best and not waiting[u]:
                        waiting[u] = True
                        later.append(u)
        queue = later
    return np.array(own, np.int64)


def _connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of each node's connected part."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return np.unique(root, return_inverse=True)[1]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]


def _graph(n: int, edges: list[tuple[int, int, float]] | np.ndarray) -> Graph:
    e = np.asarray(edges, np.float64).reshape(-1, 3)
    return Graph.of(n, e[:, 0].astype(np.int64), e[:, 1].astype(np.int64), e[:, 2])


def modularity_communities(n: int, edges: list[tuple[int, int, float]] | np.ndarray | Graph, resolution: float = 1.0, seed: int = 42, rounds: int = 20, singly: int = 3_000) -> np.ndarray:
    """Communities of n nodes by local moving, refinement and aggregation, numbered by size, largest first.

    Maximises the weight inside communities less what their degrees predict, times `resolution`. After moving, each
    community is refined: its nodes start anew on their own and are merged only along edges inside the community, and
    the graph is summed up by these parts, which start the next round in their community. Communities are always
    connected; nodes without weight are alone. Graphs of at most `singly` nodes are moved node by node, larger ones by
    array operations, a quarter of the nodes at a time; 0 and a large number give one way at every size.
    """
    member, whole = np.arange(n), np.arange(n)
    graph = edges if isinstance(edges, Graph) else _graph(n, edges)
    loops, rng, start = np.zeros(n), np.random.default_rng(seed), np.arange(n)
    for _ in range(rounds):
        size = graph.n
        degree = graph.degrees() + 2 * loops
        total = float(degree.sum())
        if total <= 0:
            break
        move = _moved_singly if size <= singly else _moved_together
        own = move(graph, degree, total, resolution, rng, start, np.zeros(size, np.int8))
        part = graph.connected(own)
        whole = part[member]
        if int(part.max()) + 1 == size:
            break
        fine = graph.connected(move(graph, degree, total, resolution, rng, np.arange(size), own))
        if int(fine.max()) + 1 == size:
            fine = part
        k = int(fine.max()) + 1
        start = np.zeros(k, np.int64)
        start[fine] = part
        member = fine[member]
        loops = np.bincount(fine, loops, minlength=k)
        graph, inside = graph.summed(fine, k)
        loops += inside
    member = whole
    names, inverse, count = np.unique(member, return_inverse=True, return_counts=True)
    first = np.full(len(names), n)
    np.minimum.at(first, inverse, np.arange(n))
    place = np.empty(len(names), np.int64)
    place[np.lexsort((first, -count))] = np.arange(len(names))
    return place[inverse]


def communities_in_range(n: int, edges: list[tuple[int, int, float]] | np.ndarray | Graph, least: int, most: int, seed: int = 42, tries: int = 6) -> tuple[np.ndarray, float]:
    """Communities whose number lies within least and most if a try reaches it, and the resolution used.

    The resolution starts at 1, doubles with too few communities and shrinks to 0.55 of itself with too many.
    """
    resolution, labels = 1.0, np.zeros(n, np.int64)
    edges = edges if isinstance(edges, Graph) else _graph(n, edges)
    for attempt in range(tries):
        labels = modularity_communities(n, edges, resolution, seed)
        k = int(labels.max(initial=-1)) + 1
        if least <= k <= most or attempt == tries - 1:
            break
        resolution *= 2.0 if k < least else 0.55
    return labels, resolution


def quality(n: int, edges: list[tuple[int, int, float]], labels: np.ndarray, resolution: float = 1.0) -> float:
    """Modularity of a partition."""
    degree, inside, total = np.zeros(n), 0.0, 0.0
    for a, b, w in edges:
        degree[a] += w
        degree[b] += w
        total += 2 * w
        inside += 2 * w * (labels[a] == labels[b])
    if not total:
        return 0.0
    mass = np.bincount(labels, weights=degree)
    return float(inside / total - resolution * ((mass / total) ** 2).sum())


def ward(x: np.ndarray, k: int) -> np.ndarray:
    """k clusters of the rows by least growth of the squared error, numbered by their first row; for topic-sized data.

    Chains of nearest neighbours over group means: memory grows with the rows, never with their pairs.
    """
    n = len(x)
    c, size, alive = np.array(x, np.float64), np.ones(n), np.ones(n, bool)
    sq, merges, chain = (c * c).sum(axis=1), [], []
    while len(merges) < n - 1:
        if not chain:
            chain = [int(alive.argmax())]
        while True:
            i = chain[-1]
            d = np.maximum(sq + sq[i] - 2 * c @ c[i], 0) * (size * size[i] / (size + size[i]))
            d[~alive], d[i] = np.inf, np.inf
            j = int(d.argmin())
            if len(chain) > 1 and d[chain[-2]] <= d[j]:
                break
            chain.append(j)
        i, j = sorted((chain.pop(), chain.pop()))
        merges.append((float(d[j if d[i] == np.inf else i]), i, j))
        c[i] = (size[i] * c[i] + size[j] * c[j]) / (size[i] + size[j])
        sq[i] = c[i] @ c[i]
        size[i] += size[j]
        alive[j] = False
    merges.sort(key=lambda m: m[0])
    pairs = np.array([m[1:] for m in merges[: max(0, n - max(1, k))]], np.int64).reshape(-1, 2)
    return _connected(n, pairs[:, 0], pairs[:, 1])


def density_tree(x: np.ndarray, k: int) -> list[tuple[float, int, int]]:
    """Edges (length, a, b) of a minimum spanning tree of the rows over mutual reachability with k neighbours."""
    n = len(x)
    sq = (x * x).sum(axis=1)
    k = min(n - 1, k)
    core = np.concatenate([np.sqrt(np.maximum(np.partition(sq[s : s + 500, None] + sq[None] - 2 * x[s : s + 500] @ x.T, k, axis=1)[:, k], 0)) for s in range(0, n, 500)])
    near, at, left = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    v, tree = 0, []
    for _ in range(n - 1):
        left[v] = False
        d = np.maximum(np.maximum(np.sqrt(np.maximum(sq + sq[v] - 2 * x @ x[v], 0)), core), core[v])
        better = left & (d < near)
        near[better], at[better] = d[better], v
        v = int(np.where(left, near, np.inf).argmin())
        tree.append((float(near[v]), int(at[v]), v))
    return tree


def spread_density_tree(spark, x: np.ndarray, k: int, stored: int = 16) -> list[tuple[float, int, int]]:
    """As density_tree, with the comparisons of rows in tasks.

    Each row's nearest `stored` rows are kept. Parts of the tree grow by their shortest edge out, the largest part only
    as others reach it. Rows whose stored neighbours do not settle that edge are compared with all rows again.
    """
    n = len(x)
    k, m = min(n - 1, k), min(n - 1, stored)
    sc = spark.sparkContext
    parts = int(np.clip(n // 500, 1, 8 * sc.defaultParallelism))
    held = sc.broadcast(x)

    def lists(batches):
        x = held.value
        sq = (x * x).sum(axis=1)
        for b in batches:
            ids = b.column(0).to_numpy()
            for s in range(0, len(ids), 64):
                own = ids[s : s + 64]
                d = np.maximum(sq[own][:, None] + sq[None] - 2 * x[own] @ x.T, 0)
                d[np.arange(len(own)), own] = -1
                at = np.argpartition(d, max(k, m), axis=1)[:, : max(k, m) + 1]
                d = np.take_along_axis(d, at, 1)
                order = np.argsort(d, axis=1, kind="stable")
                at, d = np.take_along_axis(at, order, 1), np.sqrt(np.maximum(np.take_along_axis(d, order, 1), 0))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(d[:, k]), pa.array(list(at[:, 1 : m + 1].astype(np.int32))), pa.array(list(d[:, 1 : m + 1]))], names=["i", "core", "at", "d"])

    t = spark.range(0, n, 1, parts).mapInArrow(lists, "i long, core double, at array<int>, d array<double>").toArrow().sort_by("i")
    core = t["core"].to_numpy()
    at, d = (np.asarray(t[c].combine_chunks().flatten()).reshape(n, m) for c in ("at", "d"))
    reach = np.maximum(np.maximum(d, core[:, None]), core[at])
    bound = np.maximum(core, d[:, -1]) if m < n - 1 else np.full(n, np.inf)  # no row that is not stored is nearer
    del t, d

    def scan(todo: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sent = sc.broadcast((todo, part, core))

        def run(batches):
            x, (todo, part, core) = held.value, sent.value
            sq = (x * x).sum(axis=1)
            for b in batches:
                place = b.column(0).to_numpy()
                for s in range(0, len(place), 64):
                    own = todo[place[s : s + 64]]
                    w = np.sqrt(np.maximum(sq[own][:, None] + sq[None] - 2 * x[own] @ x.T, 0))
                    w = np.maximum(np.maximum(w, core[None]), core[own][:, None])
                    w[part[own][:, None] == part[None]] = np.inf
                    to = w.argmin(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(place[s : s + 64]), pa.array(to), pa.array(w[np.arange(len(own)), to])], names=["p", "to", "w"])

        t = spark.range(0, len(todo), 1, int(np.clip(len(todo) // 64, 1, parts))).mapInArrow(run, "p long, to long, w double").toArrow().sort_by("p")
        sent.destroy()
        return t["to"].to_numpy(), t["w"].to_numpy()

    a, b, tree = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    rows = np.arange(n)
    while len(tree) < n - 1:
        part = _connected(n, a, b)
        count = np.bincount(part)
        grows = np.ones(len(count), bool)
        grows[count.argmax()] = False
        out = np.where(part[at] != part[:, None], reach, np.inf)
        best = out.argmin(axis=1)
        w, to = out[rows, best], at[rows, best].astype(np.int64)
        least, floor = np.full(len(count), np.inf), np.full(len(count), np.inf)
        np.minimum.at(least, part, w)
        np.minimum.at(floor, part, bound)
        sure = grows & (least <= floor) & np.isfinite(least)
        if not sure.any():
            todo = np.flatnonzero(grows[part] & (bound < least[part]))
            to[todo], w[todo] = scan(todo, part)
            sure = grows
        order = np.lexsort((to, rows, w, part))
        first = order[np.r_[True, part[order][1:] != part[order][:-1]]]
        first = first[sure[part[first]]]
        root = list(range(len(count)))
        new = []
        for i in first[np.argsort(w[first], kind="stable")].tolist():
            p, q = int(part[i]), int(part[to[i]])
            while root[p] != p:
                root[p] = p = root[root[p]]
            while root[q] != q:
                root[q] = q = root[root[q]]
            if p != q:
                root[p] = q
                new.append((float(w[i]), i, int(to[i])))
        tree += new
        a, b = np.r_[a, [e[1] for e in new]].astype(np.int64), np.r_[b, [e[2] for e in new]].astype(np.int64)
    held.destroy()
    return tree


def density_clusters(x: np.ndarray, least: int, neighbours: int | None = None, tree: list[tuple[float, int, int]] | None = None) -> np.ndarray:
    """Clusters of the rows by persistence of density, -1 for noise; without a given tree, some ten thousand rows.

    The minimum spanning tree over mutual reachability is cut from the longest edge; a part of at least `least` rows is
    a cluster as long as it lasts, and the clusters with most excess of mass are kept.
    """
    n = len(x)
    if n < 2 or least < 2:
        return np.zeros(n, np.int64) if least < 2 else np.full(n, -1)
    tree = density_tree(x, neighbours or least) if tree is None else tree
    tree.sort()
    parent = list(range(2 * n - 1))
    child: dict[int, tuple[int, int, float]] = {}
    weight = [1] * n + [0] * (n - 1)

    def find(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i, (dist, a, b) in enumerate(tree):
        a, b, c = find(a), find(b), n + i
        child[c] = (a, b, dist)
        parent[a] = parent[b] = c
        weight[c] = weight[a] + weight[b]

    def leaves(node: int) -> list[int]:
        out, stack = [], [node]
        while stack:
            y = stack.pop()
            if y < n:
                out.append(y)
            else:
                stack += child[y][:2]
        return out

    root = 2 * n - 2
    score: dict[int, float] = {root: 0.0}
    kids: dict[int, list[int]] = defaultdict(list)
    top = {root: root}
    members: dict[int, int] = {root: root}
    stack = [(root, root, 0.0)]
    order = [root]
    while stack:
        node, cluster, birth = stack.pop()
        if node < n:
            continue
        a, b, dist = child[node]
        lam = 1 / max(dist, 1e-12)
        big = [c for c in (a, b) if weight[c] >= least]
        if len(big) == 2:
            score[cluster] += weight[node] * (lam - birth)
            for c in big:
                score[c] = 0.0
                kids[cluster].append(c)
                members[c] = c
                order.append(c)
                stack.append((c, c, lam))
        else:
            gone = weight[node] - sum(weight[c] for c in big)
            score[cluster] += gone * (lam - birth)
            stack += [(c, cluster, birth) for c in big]
    best: dict[int, float] = {}
    chosen: dict[int, bool] = {}
    for c in reversed(order):
        below = sum(best[x] for x in kids[c])
        chosen[c] = c != root and score[c] >= below if kids[c] else c != root
        best[c] = score[c] if chosen[c] else below
    labels, stack, found = np.full(n, -1), [root], []
    while stack:
        c = stack.pop()
        if chosen[c]:
            found.append(sorted(leaves(c)))
        else:
            stack += kids[c]
    for i, rows in enumerate(sorted(found, key=lambda r: (-len(r), r[0]))):
        labels[rows] = i
    return labels
