"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def near_duplicates(docs):
    """docs: (id, text). Rows (id, shingles, component, kept)."""
    sets = {i: shingles(t) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    out = [(i, len(sets[i]), find(i), find(i) == i) for i, _ in docs if i is not None]
    return out + [(None, len(shingles(t)), None, True) for i, t in docs if i is None]


def without_repeats(docs):
    first = {}
    for i, t in sorted((i, t) for i, t in docs if i is not None):
        w = words(t)
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        for j in range(len(w) - 12 if i is not None else 0):
            if first[tuple(w[j : j + 13])] < i:
                gone |= set(range(j, j + 13))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def decontaminate(docs, benchmark):
    windows = defaultdict(set)
    for item, text in benchmark:
        w = letters(text)
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n and item is not None else 0):
            windows[tuple(w[j : j + n])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for i, t in docs:
        w, hit, items = letters(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    items |= windows[tuple(w[j : j + n])]
        out.append((i, len(w), len(hit), sorted(items)))
    return out


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Shares by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, left, out = set(names), float(sum(sizes.values())), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > epochs * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = float(epochs * sizes[s])
        left -= sum(out[s] for s in full)
        open_ -= set(full)
    return out


def mix(docs):
    """docs: (id, source, text). Rows (id, source, size, taken)."""
    sizes = defaultdict(int)
    for _, s, t in docs:
        sizes[s] += len(words(t))
    want, out = targets(sizes), []
    for s in sizes:
        key = lambda r: (hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:15], r[0] or 0, r[2] or "")
        budget, before = int(want[s] + 0.5), 0
        for i, _, t in sorted((r for r in docs if r[1] == s), key=key):
            n = len(words(t))
            whole, rest = divmod(budget, sizes[s]) if sizes[s] else (0, 0)
            out.append((i, s, n, whole * n + max(0, min(n, rest - before))))
            before += n
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    w = words(text)
    chars = sum(map(len, w))

    def inside(n):
        grams = [tuple(w[j : j + n]) for j in range(len(w) - n + 1)]
        count = Counter(grams)
        return {k for j, g in enumerate(grams) if count[g] > 1 for k in range(j, j + n)}

    seen, lines, line_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if words(line):
            if line in seen:
                lines, line_chars = lines + 1, line_chars + sum(map(len, words(line)))
            seen.add(line)
    symbols, triples = len(re.findall(r"[#*$%&|<>]", text or "")), len(inside(3))
    failed = len(w) < 50 or 100 * triples > 50 * len(w)
    bad = line_chars > 0.3 * chars or symbols > 0.1 * len(w)
    bad = bad or any(sum(len(w[k]) for k in inside(n)) > 0.4 * chars for n in range(5, 11))
    return len(w), chars, symbols, lines, triples, failed, not failed and not bad


def hits(text, benchmark):
    """Places of the words inside an occurrence of a window."""
    w, hit = letters(text), set()
    for item, t in benchmark:
        x = letters(t)
        n = min(10, len(x))
        windows = {tuple(x[j : j + n]) for j in range(len(x) - n + 1)} if n and item is not None else set()
        for j in range(len(w) - n + 1):
            if tuple(w[j : j + n]) in windows:
                hit |= set(range(j, j + n))
    return hit


def spelling(docs, slip=31):
    """docs: (id, text). Rows (word, form, root, n, n_near, form_n)."""
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    form, n_near = {}, {}
    for w in counts:
        around = [x for x in counts if near(w, x)]
        n_near[w] = len(around)
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 10 * counts[w]:
            form[w] = best
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], n_near[w], counts.get(form.get(w))))
    return out


def runs(w, least=24, times=3):
    """Longest stretches (start, length, smallest period), distance by distance."""
    out = []
    x = np.unique(np.array(w), return_inverse=True)[1] if len(w) else np.zeros(0)
    for p in range(1, len(w) // times + 1):
        same = np.concatenate([[False], x[:-p] == x[p:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in edges.reshape(-1, 2)[edges[1::2] - edges[::2] + p >= max(least, times * p)].tolist():
            part = w[start : end + p]
            if not any(part[r:] == part[:-r] for r in range(1, p)):
                out.append((start, len(part), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(docs):
    """docs: (id, text), with the contract's planted stretches. Rows (id, words, runs, collapsed text)."""
    out = []
    for i, t in docs:
        w = words(t)
        h = zlib.crc32(("" if i is None else str(i)).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[k if k < a else a + (k - a) % p] for k in range(n)]
        found = runs(w)
        gone = {k for s, length, p in found for k in range(s + p, s + length)}
        out.append((i, len(w), found, " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out
