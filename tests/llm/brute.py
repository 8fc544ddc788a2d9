"""Plain-Python versions of the operators' results, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near_duplicate_rows(docs, k, percent=80):
    """{id: (set size, component)} of (id, text) pairs."""
    sets = {}
    for i, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    holders, up = defaultdict(list), {i: i for i in sets}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i in sorted(sets):
        both = Counter(j for s in sets[i] for j in holders[s])
        for s in sets[i]:
            holders[s].append(i)
        for j, n in both.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: (len(s), top(i)) for i, s in sets.items()}


def repeat_rows(docs, window=20):
    """{id: (words, words removed, digest of the rest)} of (id, text) pairs."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for j in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][j:j + window]), (i, j))
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] != (i, j):
                gone[j:j + window] = [True] * window
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)


def base_spans(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate((
            ("assign", ASSIGN, 2, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
            ("hex", re.compile("[0-9a-f]+"), 0, 32))):
        found += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def quality_counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if often[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leak_rows(docs, items, window=10):
    """{id: (words, words hit, item ids as texts)} of (id, text) pairs."""
    split = lambda t: ITEM_WORD.findall((t or "").translate(LOWER))
    holders = defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            holders[tuple(w[s:s + n])].add("" if i is None else str(i))
    sizes, out = {len(g) for g in holders}, {}
    for i, t in docs:
        w, hit, names = split(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in holders:
                    hit |= set(range(s, s + n))
                    names |= holders[tuple(w[s:s + n])]
        out[i] = (len(w), len(hit), sorted(names))
    return out


def word_runs(w, times=4, least=6):
    """(start, length, smallest period) of every maximal run, by start and period."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            start, n = i - q, j - i + q
            if n >= max(least, times * q) and not any(
                    all(w[k] == w[k - r] for k in range(start + r, start + n)) for r in range(1, q)):
                out.append((start, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def product_codes(rows, scale=256, parts=16, entries=64, rounds=2):
    """([(id, code, error)], codebooks) of (id, vector) pairs, in Python integers."""
    import math

    x = [(i, [math.floor(scale * c) for c in v]) for i, v in rows]
    width = len(x[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v in x]
    first = sorted(range(len(x)), key=lambda r: (x[r][0], x[r][1]))[:entries]
    books = [[cut[r][p] for r in first] for p in range(parts)]

    def nearest(p, v):
        d = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(p, c[p])[0]].append(c[p])
            books[p] = [[sum(col) // len(groups[e]) for col in zip(*groups[e])] if groups[e] else old
                        for e, old in enumerate(books[p])]
    out = []
    for (i, _), c in zip(x, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in best), sum(d for _, d in best)))
    return out, books
