"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash


def groups(n: int, linked) -> list[int]:
    """Smallest index reachable from each of n vertices."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def shingles(text, k):
    words = "".join(c.lower() if c.isascii() else c for c in (text or "")).encode().split()
    return [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []


def simhash(text, k=3):
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, k)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def jaccard(a, b, k=5):
    a, b = set(shingles(a, k)), set(shingles(b, k))
    return len(a & b) / len(a | b) if a | b else 1.0


def cut_bytes(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of what is left)."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            window = data[i:i + length]
            if window in seen:
                gone[i:i + length] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        out[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def cut_words(docs, width=13):
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        words = (text or "").encode().split()
        gone, own = [False] * len(words), set()
        for i in range(len(words) - width + 1):
            window = tuple(words[i:i + width])
            if window in seen:
                gone[i:i + width] = [True] * width
            own.add(window)
        seen |= own
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def leaks(docs, items, k=5, least=0.8):
    """Pairs (doc_id, item_id) with a window of the item's size that is similar enough."""
    out = set()
    for doc_id, text in docs:
        words = (text or "").lower().encode().split()
        for item_id, item in items:
            wanted = (item or "").lower().encode().split()
            if len(wanted) < k:
                n = len(wanted)
                if n and any(words[i:i + n] == wanted for i in range(len(words) - n + 1)):
                    out.add((doc_id, item_id))
                continue
            target = Counter(tuple(wanted[i:i + k]) for i in range(len(wanted) - k + 1))
            for s in range(max(1, len(words) - len(wanted) + 1)):
                window = words[s:s + len(wanted)]
                have = Counter(tuple(window[i:i + k]) for i in range(len(window) - k + 1))
                both = sum((have & target).values())
                if both and both / (sum(have.values()) + sum(target.values()) - both) >= least:
                    out.add((doc_id, item_id))
                    break
    return out


def search(docs, items, k=50):
    """(item_id, rank, doc_id, score) of every document scored for every item."""
    def found(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    counts = [(i, Counter(found(text))) for i, text in docs]
    n_docs, length = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted, out = {}, []
    for i, text in items:
        wanted.setdefault(i, set()).update(found(text))
    for i, terms in wanted.items():
        scores = []
        for doc_id, c in counts:
            score = 0
            for t in terms & c.keys():
                m = 100 - 50 + 50 * c.total() * n_docs // length
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(i, rank + 1, doc_id, -s) for rank, (s, _, doc_id) in enumerate(sorted(scores)[:k])]
    return out


def trie(rows, family=100, heads=6):
    """Set of nodes of (conv_id, turn, role, text), as the operator returns them."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(own)] for c, own in convs.items()}
    paths = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        paths[c] = tuple(convs.get(c - c % family, [])[:h] + own[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = set()
    for node, ids in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(ids) if paths[c] == node)
        out.add((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out
