"""Plain Python answers for small inputs."""

from collections import deque


def both_ways(edges):
    return [pair for a, b in edges for pair in ((a, b), (b, a))]


def levels(edges, root):
    near = {}
    for a, b in both_ways(edges):
        near.setdefault(a, []).append(b)
    found = {v: -1 for v in near}
    if root not in near:
        return found
    found[root] = 0
    queue = deque([root])
    while queue:
        v = queue.popleft()
        for w in near[v]:
            if found[w] == -1:
                found[w] = found[v] + 1
                queue.append(w)
    return found


def product(cells, vector):
    total = {}
    for row, col, value in cells:
        if col in vector:
            total[row] = total.get(row, 0) + value * vector[col]
    return total
