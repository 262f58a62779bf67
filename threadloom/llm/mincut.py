"""A two-label minimum cut over a small graph: Dinic's algorithm on residual
capacities, after each node's two terminal edges have been cancelled against
each other."""

from __future__ import annotations

from collections import deque


def source_side(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether the minimum cut leaves it with the source.

    ``score[i]`` is what labelling i as sink costs more than as source; an edge
    (i, j, w) costs w when its ends are labelled differently.  Ties (nothing
    left to push either way) go to the sink side unless the score is positive.
    """
    n = len(score)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def link(a: int, b: int, forth: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        cap.append(forth)
        head[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, x in enumerate(score):
        if x > 0:
            link(s, i, x, 0.0)
        elif x < 0:
            link(i, t, -x, 0.0)
    for i, j, w in edges:
        link(i, j, w, w)
    tiny = 1e-12
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in head[u]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        at = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                for k, e in enumerate(path):
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if cap[e] <= tiny)
                u = to[path[cut] ^ 1]
                del path[cut:]
            while at[u] < len(head[u]):
                e = head[u][at[u]]
                if cap[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                at[u] += 1
            else:
                if u == s:
                    break
                level[u] = -1
                u = to[path.pop() ^ 1]
                continue
            path.append(e)
            u = to[e]
