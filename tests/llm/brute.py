"""Plain versions of the operators, for small tables held in memory."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

BLANK = r"[^\x20\x09-\x0D]+"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text, pattern):
    return re.findall(pattern, lower(text))


def key_order(key):
    return (key is None, key if key is not None else 0)


def exact(rows):
    """{row number: (keep_id, group_size, kept, sha)} of (doc_id, text) rows."""
    groups = defaultdict(list)
    for i, (k, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), key_order(k), i, k))
    out = {}
    for text, members in groups.items():
        best = min(members)
        for *_, i, k in members:
            out[i] = (best[3], len(members), i == best[2], hashlib.sha256(text.encode()).hexdigest())
    return out


def near(rows, width, percent=80):
    """{doc_id: (n_shingles, component_id)} for rows with distinct keys."""
    sets = {}
    for k, t in rows:
        w = words(t, BLANK)
        sets[k] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def leaks(rows, items, width=10):
    """{row number: (n_words, n_hit, items)}."""
    windows = defaultdict(set)
    for item, t in items:
        w = words(t, LETTERS)
        if w:
            for i in range(max(len(w) - width + 1, 1)):
                windows[tuple(w[i : i + width])].add(item)
    out = {}
    for i, (_, t) in enumerate(rows):
        w, hit, found = words(t, LETTERS), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (x := tuple(w[s : s + n])) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[x]
        out[i] = (len(w), len(hit), found)
    return out


def repeats(rows, length=50):
    """{doc_id: (n_bytes, n_removed, n_spans, sha)} for rows with distinct keys."""
    first, out = {}, {}
    for k, t in sorted(rows):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], k)
    for k, t in rows:
        b = (t or "").encode()
        mask = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < k:
                mask[i : i + length] = True
        kept = bytes(c for c, m in zip(b, mask) if not m)
        spans = int((mask[1:] & ~mask[:-1]).sum() + mask[0]) if len(b) else 0
        out[k] = (len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def chunked(rows, cuts, least):
    """{doc_id: (n_chunks, n_repeated, n_removed)} for rows with distinct keys."""
    pieces, first = {}, {}
    for k, t in sorted(rows):
        b = (t or "").encode()
        ends = cuts(np.frombuffer(b, np.uint8), np.array([0, len(b)])).tolist()
        pieces[k] = [b[s:e] for s, e in zip([0, *ends], ends)]
        for p in pieces[k]:
            first.setdefault(p, k)
    out = {}
    for k, found in pieces.items():
        run = removed = again = 0
        for p in [*found, None]:
            if p is not None and first[p] < k:
                run, again = run + len(p), again + 1
            else:
                removed, run = removed + (run if run >= least else 0), 0
        out[k] = (len(found), again, removed)
    return out


def phrases(text, wanted):
    w, at, labels = words(text, LETTERS), [], set()
    for p, label in wanted.items():
        q = p.split()
        for i in range(len(w) - len(q) + 1):
            if w[i : i + len(q)] == q:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def language_model(rows, mass):
    """{doc_id: (held_out, n_tokens, n_known, N, base, score)}."""
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows}
    tokens = {k: [*words(t, BLANK), "\0"] for k, t in rows}
    one, two = Counter(), Counter()
    for k, w in tokens.items():
        if not held[k]:
            one.update(w)
            two.update(zip(["^", *w], w))
    total, vocabulary = sum(one.values()), len(one)
    one["^"] = sum(not h for h in held.values())
    p = lambda x: (one[x] + 0.1) / (total + 0.1 * (vocabulary + 1))
    return {
        k: (held[k], len(w), sum(one[x] > 0 for x in w), total, sum(math.log10(p(x)) for x in w),
            sum(math.log10((two[v, x] + mass * p(x)) / (one[v] + mass)) for v, x in zip(["^", *w], w)))
        for k, w in tokens.items()
    }


def mixed(parts, length, period):
    """Source and unit of each slot: every unit a job of its own, earliest deadline
    first over periods, then over each period's slots."""
    whole = sum(parts.values())
    jobs = [
        (Fraction((i + 1) * whole, p), s, i, i * whole // p)
        for s, p in parts.items() for i in range(-(-p * length // whole) + 1)
    ]
    out = []
    for start in range(0, length, period):
        end = min(start + period, length)
        now = sorted(j for j in jobs if j[3] < end)[: end - start]
        jobs = sorted(set(jobs) - set(now))
        units = {}
        for _, s, i, _ in now:
            units.setdefault(s, []).append(i)
        n = end - start
        inner = [
            (-(-(j + 1) * n // len(u)), s, i, j * n // len(u))
            for s, u in units.items() for j, i in enumerate(sorted(u))
        ]
        for t in range(n):
            best = min(j for j in inner if j[3] <= t)
            inner.remove(best)
            out.append(best[1:3])
    return out


def hinge(x, y, cost, steps=20000):
    """min |w|^2/2 + sum cost * hinge over dense rows with a last column of ones,
    by projected gradient steps on the dual. The weights and the objective."""
    z = x * y[:, None]
    gram = z @ z.T
    alpha, rate = np.zeros(len(y)), 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(steps):
        alpha = np.clip(alpha + rate * (1 - gram @ alpha), 0, cost)
    w = z.T @ alpha
    return w, w @ w / 2 + (cost * np.maximum(0, 1 - z @ w)).sum()
