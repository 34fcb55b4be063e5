"""Plain statements of the contracts, row by row."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base_spans(text):
    found = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c.isascii() and c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and (not 16 <= len(digits) <= 19 or sum(
                    d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def repeat_words(words, window=8):
    at = defaultdict(list)
    for i in range(len(words) - window + 1):
        at[tuple(words[i:i + window])].append(i)
    return len({p for starts in at.values() if len(starts) > 1 for s in starts for p in range(s, s + window)})


def fingerprint(text):
    w = lower(text).encode().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    """(id, fingerprint) rows -> fingerprint -> smallest id that chains of links reach."""
    prints = sorted({f for _, f in rows})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    low = {}
    for i, f in rows:
        if i is not None:
            low[find(f)] = min(i, low.get(find(f), i))
    return {f: low.get(find(f)) for f in prints}


def targets(sizes, most=3):
    """source -> words  =>  source -> target."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


def contamination(text, items):
    """(words hit, item ids) of a document."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    w, hit, ids = split(text), set(), set()
    for item, t in items:
        b = split(t)
        span = min(10, len(b))
        windows = {tuple(b[i:i + span]) for i in range(len(b) - span + 1)} if b else set()
        for i in range(len(w) - span + 1 if b else 0):
            if tuple(w[i:i + span]) in windows:
                hit |= set(range(i, i + span))
                ids |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(ids)


def unigrams(rows):
    """(id, text) rows -> N, V, and per row (held out, tokens, known, base score)."""
    toks = [[*lower(t).encode().split(), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(w for t, h in zip(toks, held, strict=True) if not h for w in t)
    n, v = sum(count.values()), len(count)
    return n, v, [(h, len(t), sum(count[w] > 0 for w in t), sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t))
                  for t, h in zip(toks, held, strict=True)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
