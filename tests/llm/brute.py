"""Plain single-process versions of the operators, for small tables."""

import collections
import hashlib
import re

KINDS = ("email", "ip", "card", "phone")


def pii_spans(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def span_digest(spans):
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def gram_set(text, n):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def components(rows, n, p, q):
    """doc_id -> (set size, smallest id reachable)."""
    sets = {i: gram_set(t, n) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    index = collections.defaultdict(list)
    for i in sorted(sets):
        common = collections.Counter(j for g in sets[i] for j in index[g])
        for g in sets[i]:
            index[g].append(i)
        for j, k in common.items():
            if q * k >= p * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeated_words(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    count = collections.Counter(grams)
    return len({k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(8)})
