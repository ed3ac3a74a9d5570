"""Plain versions of the operators, over rows in memory."""

from __future__ import annotations

import collections
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower_ascii(word: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), word)


def shingles(text: str | None, k: int = 5) -> frozenset:
    words = [lower_ascii(w) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < k else [tuple(words[i : i + k]) for i in range(len(words) - k + 1)])


def components(sets: dict) -> dict:
    """Smallest key reachable over links of 0.75 or more, by comparing all pairs."""
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= 75 * (len(x) + len(y) - shared):
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
    return {d: find(d) for d in sets}


def targets(sizes: dict, cap: int = 3) -> dict:
    """Water-filling over sources ordered by name, null last, with weights 1, 2, 3 in turn."""
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    clamped: set = set()
    while True:
        free = [s for s in sizes if s not in clamped]
        rest = sum(sizes.values()) - sum(cap * sizes[s] for s in clamped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] >= cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in clamped else level * weight[s] for s in sizes}
        clamped |= over


RULES = (
    (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    return sorted((m.start(), k, m.end()) for k, (rule, counts) in enumerate(RULES) for m in rule.finditer(text or "") if counts(m))


def nearest(vectors: dict, query: int, k: int = 10) -> list[tuple[float, int]]:
    far = sorted((math.dist(vectors[query], v), i) for i, v in vectors.items() if i != query)
    return far[:k]


def grouped(texts: dict) -> dict:
    groups = collections.defaultdict(list)
    for d, t in texts.items():
        groups[t or ""].append(d)
    return groups
