"""Plain definitions of the operators' results, for small inputs."""

import collections
import hashlib
import re

import numpy as np
import xxhash

SPACE = r"[^\x20\x09-\x0D]+"


def words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall(SPACE, text)


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def simhash(text, n=4):
    w = words(text, lower=True)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows, radius=4):
    """[(doc_id, fingerprint, least doc_id of the group)] for (doc_id, text) rows."""
    prints = [simhash(t) for _, t in rows]
    distinct = sorted(set(prints))
    array, parent = np.array(distinct, np.uint64), list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(distinct)):
        for j in np.nonzero(np.bitwise_count(array ^ array[i]) <= radius)[0]:
            parent[find(int(j))] = find(i)
    place = {f: i for i, f in enumerate(distinct)}
    least = {}
    for (d, _), f in zip(rows, prints, strict=True):
        if d is not None:
            least[find(place[f])] = min(least.get(find(place[f]), d), d)
    return [(d, f"{f:016x}", least.get(find(place[f]))) for (d, _), f in zip(rows, prints, strict=True)]


def word_repeats(rows, k=50):
    """[(doc_id, n_words, n_removed, sha of what is kept)]"""
    split, first = [(d, words(t)) for d, t in rows], {}
    for d, w in split:
        for i in range(len(w) - k + 1) if d is not None else ():
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1) if d is not None else ():
            if first[tuple(w[i:i + k])] < d:
                gone[i:i + k] = [True] * k
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def byte_repeats(rows, k=100):
    """[(doc_id, n_bytes, n_removed, n_spans, sha of what is kept)]"""
    raw, first = [(d, (t or "").encode()) for d, t in rows], {}
    for d, w in raw:
        for i in range(len(w) - k + 1) if d is not None else ():
            seen = first.get(w[i:i + k])
            if seen is None or d < seen[0]:
                first[w[i:i + k]] = (d, {w: i})
            elif d == seen[0]:
                seen[1].setdefault(w, i)
    out = []
    for d, w in raw:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - k + 1) if d is not None else ():
            seen = first[w[i:i + k]]
            if seen[0] < d or seen[1].get(w, i) < i:
                gone[i:i + k] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((d, len(w), int(gone.sum()), spans, sha(np.frombuffer(w, np.uint8)[~gone].tobytes())))
    return out


def leaks(rows, items, threshold=0.8, n=5):
    """{(doc_id, item_id): (similarity, first word)}"""
    def shingles(w, g):
        return collections.Counter(tuple(w[i:i + g]) for i in range(len(w) - g + 1))

    out = {}
    items = [(i, words(t, True)) for i, t in items if i is not None and words(t, True)]
    items = [(i, len(w), min(n, len(w)), shingles(w, min(n, len(w)))) for i, w in items]
    for d, text in rows:
        w = words(text, True)
        grams = {g: set(shingles(w, g)) for g in range(1, n + 1)}
        for item, size, g, s in items:
            if not grams[g] & set(s):
                continue
            size = min(size, len(w))
            for at in range(len(w) - size + 1):
                c = shingles(w[at:at + size], g)
                common = sum((c & s).values())
                j = common / (sum(c.values()) + sum(s.values()) - common)
                if j >= threshold and j > out.get((d, item), (0, 0))[0]:
                    out[d, item] = (j, at)
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text, patterns):
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text or ""):
            value, digits = m.group(), re.sub("[^0-9]", "", m.group())
            keep = (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in value.split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 8 <= len(digits) <= 15)
            if keep:
                out.append((kind, m.start(), m.end()))
    return out
