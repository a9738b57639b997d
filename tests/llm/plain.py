"""Brute-force versions of the operators, on plain Python values."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash


def components(nodes, linked):
    """Smallest reachable node of each node; ``linked(a, b)`` says whether two nodes are linked."""
    nodes = sorted(nodes)
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def words(text):
    return (text or "").encode().split()


def fingerprint(text, k=4):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    h = np.array([xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))


def near_duplicates(docs):
    """doc_id -> (fingerprint, component) of (doc_id, text) rows with distinct ids."""
    fp = {i: fingerprint(t) for i, t in docs}
    root = components(set(fp.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for i, f in fp.items():
        first[root[f]] = min(first.get(root[f], i), i)
    return {i: (f"{f:016x}", first[root[f]]) for i, f in fp.items()}


def shingles(text, k=5):
    w = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())
    return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def contained(docs, items, threshold=0.8):
    out = []
    for d, text in docs:
        have = shingles(text)
        for i, item in items:
            want = shingles(item)
            if want and len(want & have) >= threshold * len(want) - 1e-9:
                out.append((d, i, len(want), len(want & have)))
    return sorted(out)


def mix_targets(sizes, share=1.5, limit=2.0, weights=(5, 2, 1)):
    """Target of each source from {source: size}; None sorts last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    wanted, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = wanted - sum(limit * sizes[s] for s in full)
        total = sum(weight[s] for s in rest)
        target = {s: left * weight[s] / total for s in rest} | {s: limit * sizes[s] for s in full}
        over = {s for s in rest if target[s] > limit * sizes[s]}
        if not over:
            return target
        full |= over


def ppm(docs, order):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base, score) of (doc_id, text)."""
    low = lambda t: (t or "").encode().lower()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    count, unigram = defaultdict(int), defaultdict(int)
    for i, t in docs:
        if held[i]:
            continue
        s = [*low(t), 256]
        for k in range(len(s)):
            count[tuple(s[max(0, k - order) : k + 1])] += 1
        for w in [*low(t).split(), None]:
            unigram[w] += 1
    for size in range(order + 1, 1, -1):
        for g in [g for g in count if len(g) == size]:
            count[g[1:]] += 1
    follow = defaultdict(dict)
    for g, n in count.items():
        follow[g[:-1]][g[-1]] = n
    total, kinds = sum(unigram.values()), len(unigram)

    def score(t):
        s, out = [*low(t), 256], 0.0
        for k, x in enumerate(s):
            excluded = set()
            for n in range(min(order, k), -1, -1):
                seen = {a: c for a, c in follow.get(tuple(s[k - n : k]), {}).items() if a not in excluded}
                if not seen:
                    continue
                if x in seen:
                    out += math.log10((seen[x] - 0.5) / sum(seen.values()))
                    break
                out += math.log10(len(seen) / 2 / sum(seen.values()))
                excluded |= set(seen)
            else:
                out -= math.log10(257 - len(excluded))
        return out

    out = {}
    for i, t in docs:
        tokens = [*low(t).split(), None]
        base = sum(math.log10((unigram.get(w, 0) + 1) / (total + kinds + 1)) for w in tokens)
        out[i] = (held[i], len(tokens), sum(unigram.get(w, 0) > 0 for w in tokens), total, base, score(t))
    return out


def warc(pages):
    """page_id -> (payload_bytes, payload_digest, record_type, refers_to) of (page_id, html)."""
    largest = {}
    for i, h in pages:
        largest[h or ""] = max(largest.get(h or "", i), i)
    out = {}
    for i, h in pages:
        body, first = (h or "").encode(), largest[h or ""]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out[i] = (len(body), digest, "response" if first == i else "revisit", None if first == i else first)
    return out


def url_parts(url):
    if "://" not in (url or ""):
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def url_rule(url, rules):
    host, path = url_parts(url)
    fits = [(len(h + p), v == "allow", h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits) if fits else None


def nearest(vectors, queries, k):
    """query -> [(id, score)] of {id: vector}."""
    out = {}
    for q in queries:
        scored = [(-float(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q]
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out
