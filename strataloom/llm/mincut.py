"""Minimum cut of small graphs with two terminals, by Dinic's algorithm."""

from __future__ import annotations

from collections import deque


def min_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of a least-cost labelling: a node with gain g > 0 costs g where it is False, with g < 0 it costs -g where True.

    An edge (a, b, w) costs w where its ends differ. Ties go to False.
    """
    n = len(gain)
    if all(g > 0 for g in gain) or all(g <= 0 for g in gain):
        return [g > 0 for g in gain]
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            link(source, i, g, 0.0)
        elif g < 0:
            link(i, sink, -g, 0.0)
    for a, b, w in edges:
        if w > 0:
            link(a, b, w, w)

    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        place = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # Back to the first edge that is full.
                k = next(i for i, e in enumerate(path) if room[e] <= least)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while place[a] < len(out[a]):
                e = out[a][place[a]]
                if room[e] > least and level[to[e]] == level[a] + 1:
                    break
                place[a] += 1
            if place[a] < len(out[a]):
                path.append(out[a][place[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                a = to[path.pop() ^ 1]
                place[a] += 1
