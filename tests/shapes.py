"""Brute-force answers for small polygon sets."""

PARTS = "parts array<array<array<array<double>>>>"


def box(x, y, w=1, h=1):
    x, y, w, h = map(float, (x, y, w, h))
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


def unit_cells(x, y, w, h):
    return {(i, j) for i in range(x, x + w) for j in range(y, y + h)}


def count_components(cells):
    left, found = set(cells), 0
    while left:
        found += 1
        stack = [left.pop()]
        while stack:
            i, j = stack.pop()
            for near in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                if near in left:
                    left.remove(near)
                    stack.append(near)
    return found


def edges_of(triangle):
    return [(triangle[i], triangle[(i + 1) % 3]) for i in range(3)]


def union_area(triangles):
    """Exact area of a union of triangles by vertical slabs between all corners and crossings."""
    edges = [e for t in triangles for e in edges_of(t)]
    xs = {p[0] for t in triangles for p in t}
    for i, (a, b) in enumerate(edges):
        for c, d in edges[:i]:
            den = (b[0] - a[0]) * (d[1] - c[1]) - (b[1] - a[1]) * (d[0] - c[0])
            if den:
                xs.add(a[0] + ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / den * (b[0] - a[0]))
    xs, area = sorted(xs), 0.0
    for left, right in zip(xs, xs[1:]):
        mid, spans = (left + right) / 2, []
        for t in triangles:
            ys = sorted(
                a[1] + (mid - a[0]) / (b[0] - a[0]) * (b[1] - a[1]) for a, b in edges_of(t) if (a[0] > mid) != (b[0] > mid)
            )
            if ys:
                spans.append(ys)
        covered, reach = 0.0, float("-inf")
        for low, high in sorted(spans):
            covered += max(0.0, high - max(low, reach))
            reach = max(reach, high)
        area += covered * (right - left)
    return area


def in_triangle(t, x, y):
    turns = [(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for a, b in edges_of(t)]
    return all(v > 0 for v in turns) or all(v < 0 for v in turns)
