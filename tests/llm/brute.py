"""Plain Python versions of the operators, straight from their definitions, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = WORD.findall((text or "").translate(_LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near_groups(docs, k, percent):
    """id -> (set size, smallest id reachable)."""
    sets = {i: shingles(t, k) for i, t in docs}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def _luhn(digits):
    turned = [int(c) for c in reversed(digits)]
    return (sum(turned[::2]) + sum(sum(divmod(2 * d, 10)) for d in turned[1::2])) % 10 == 0


def personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m[0])) <= 19 and _luhn(digits(m[0])):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def secrets(text):
    assign = re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
    found = [(m.start(), "assign", m.end()) for m in assign if len(m[2]) >= 8]
    found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[0], order.index(s[1])))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{z}" for a, k, z in spans).encode()).hexdigest()


def without_repeats(docs, window):
    """(words, removed, digest) per row: every word in a window that starts anywhere else goes."""
    words = [WORD.findall(t or "") for _, t in docs]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((key, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out
