"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math


def components(nodes, linked):
    """{node: least node reachable}; ``linked`` is symmetric."""
    out = {}
    for start in sorted(nodes):
        if start in out:
            continue
        todo, seen = [start], {start}
        while todo:
            x = todo.pop()
            for y in nodes:
                if y not in seen and linked(x, y):
                    seen.add(y)
                    todo.append(y)
        out.update(dict.fromkeys(seen, min(seen)))
    return out


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def jaccard_linked(a, b, percent=80):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def cosine(a, b):
    if not a or not b or len(a) != len(b) or any(x is None or not math.isfinite(x) for x in (*a, *b)):
        return -2.0
    na, nb = math.sqrt(math.fsum(x * x for x in a)), math.sqrt(math.fsum(x * x for x in b))
    return math.fsum(x * y for x, y in zip(a, b)) / (na * nb) if na and nb else -2.0
