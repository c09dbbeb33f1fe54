"""NumPy and plain Python geometry kernels for grouped functions."""

from __future__ import annotations

import math


def inside_ring(x: float, y: float, ring: list) -> bool:
    """Parity of crossings of a ray to the east."""
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[-1:] + ring[:-1], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            odd = not odd
    return odd


def ring_area(ring: list) -> float:
    return abs(sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True))) / 2


def clip_ring(ring: list, x0: float, y0: float, x1: float, y1: float) -> list:
    """Closed ring cut to a box, half-plane by half-plane; [] if nothing is left."""
    pts = ring[:-1] if ring and ring[0] == ring[-1] else list(ring)
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for k, p in enumerate(pts):
            q = pts[k - 1]
            dp, dq = (p[axis] - bound) * sign, (q[axis] - bound) * sign
            if (dp >= 0) != (dq >= 0):
                t = dq / (dq - dp)
                cut = [q[0] + (p[0] - q[0]) * t, q[1] + (p[1] - q[1]) * t]
                cut[axis] = bound
                out.append(tuple(cut))
            if dp >= 0:
                out.append(tuple(p))
        pts = out
        if not pts:
            return []
    clean = [p for k, p in enumerate(pts) if p != pts[k - 1]]
    return [*clean, clean[0]] if len(clean) >= 3 and ring_area(clean) > 0 else []


def clip_line(line: list, x0: float, y0: float, x1: float, y1: float) -> list[list]:
    """Parts of a line inside a box."""
    parts: list[list] = []
    for (ax, ay), (bx, by) in zip(line, line[1:], strict=False):
        t0, t1 = 0.0, 1.0
        for p, q in ((ax - bx, ax - x0), (bx - ax, x1 - ax), (ay - by, ay - y0), (by - ay, y1 - ay)):
            if p == 0:
                if q < 0:
                    t0 = 2.0
            elif p < 0:
                t0 = max(t0, q / p)
            else:
                t1 = min(t1, q / p)
        if t0 > t1:
            continue
        a = (ax, ay) if t0 == 0 else (ax + (bx - ax) * t0, ay + (by - ay) * t0)
        b = (bx, by) if t1 == 1 else (ax + (bx - ax) * t1, ay + (by - ay) * t1)
        if parts and parts[-1][-1] == a:
            parts[-1].append(b)
        elif a != b:
            parts.append([a, b])
    return parts


def simplify(line: list, tolerance: float) -> list:
    """Douglas-Peucker without recursion; both ends stay."""
    keep, todo = {0, len(line) - 1}, [(0, len(line) - 1)]
    while todo:
        a, b = todo.pop()
        (ax, ay), (bx, by) = line[a], line[b]
        dx, dy = bx - ax, by - ay
        far, at = tolerance, -1
        for i in range(a + 1, b):
            px, py = line[i][0] - ax, line[i][1] - ay
            n = dx * dx + dy * dy
            t = max(0.0, min(1.0, (px * dx + py * dy) / n)) if n else 0.0
            d = math.hypot(px - t * dx, py - t * dy)
            if d > far:
                far, at = d, i
        if at >= 0:
            keep.add(at)
            todo += [(a, at), (at, b)]
    return [line[i] for i in sorted(keep)]


def simplify_ring(ring: list, tolerance: float) -> list:
    """A closed ring simplified in two halves; the ring itself if it would collapse."""
    if len(ring) <= 5:
        return ring
    far = max(range(len(ring)), key=lambda i: (ring[i][0] - ring[0][0]) ** 2 + (ring[i][1] - ring[0][1]) ** 2)
    out = simplify(ring[: far + 1], tolerance)[:-1] + simplify(ring[far:], tolerance)
    return out if len(out) >= 4 and ring_area(out[:-1]) > 0 else ring


def buffer_line(line: list, half: float, arc: int = 4) -> list[list]:
    """Flat-capped buffer as overlapping rings: a quad a segment, a disc at each bend."""
    out = []
    for (ax, ay), (bx, by) in zip(line, line[1:], strict=False):
        n = math.hypot(bx - ax, by - ay)
        if n:
            ox, oy = -(by - ay) / n * half, (bx - ax) / n * half
            out.append([(ax + ox, ay + oy), (bx + ox, by + oy), (bx - ox, by - oy), (ax - ox, ay - oy), (ax + ox, ay + oy)])
    for x, y in line[1:-1]:
        turn = [(x + half * math.cos(k * math.pi / (2 * arc)), y + half * math.sin(k * math.pi / (2 * arc))) for k in range(4 * arc)]
        out.append([*turn, turn[0]])
    return out


def union_rectangles(boxes: list[tuple]) -> list[tuple]:
    """Disjoint rectangles that cover the same points as the given ones (x0, y0, x1, y1).

    A sweep over x: each slab between neighbouring borders holds the merged y
    intervals of the boxes over it; equal neighbours are joined again.
    """
    xs = sorted({v for b in boxes for v in (b[0], b[2])})
    open_now: dict[tuple, float] = {}
    out = []
    for left, right in zip(xs, xs[1:], strict=False):
        spans: list[list[float]] = []
        for lo, hi in sorted((b[1], b[3]) for b in boxes if b[0] <= left and b[2] >= right):
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], hi)
            else:
                spans.append([lo, hi])
        now = {tuple(s) for s in spans}
        for s in [s for s in open_now if s not in now]:
            out.append((open_now.pop(s), s[0], left, s[1]))
        for s in now:
            open_now.setdefault(s, left)
    last = xs[-1] if xs else 0
    return sorted([*out, *((x, s[0], last, s[1]) for s, x in open_now.items())])
