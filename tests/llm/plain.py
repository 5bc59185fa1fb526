"""The operators once more, plainly and slowly, on lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def kept_words(docs, window):
    words = [WORD.findall(t or "") for _, t in docs]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def simhash(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs, n=3, distance=3):
    """(doc_id, fingerprint, smallest doc_id of the group or None) of each row."""
    prints = [simhash(t, n) for _, t in docs]
    nodes = sorted(set(prints))
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[find(b)] = find(a)
    least = {}
    for (doc_id, _), p in zip(docs, prints):
        r = find(p)
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    return [(d, f"{p:016x}", least.get(find(p))) for (d, _), p in zip(docs, prints)]


def edit_distance_within(pattern, text):
    """Least edit distance of a list to any run of another, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def shingles_of(text, n=5):
    """Hashes as Spark's xxhash64 chains them over the words of a shingle."""
    words = WORD.findall(text or "")
    parts = [words[i : i + n] for i in range(len(words) - n + 1)] or ([[" ".join(words)]] if words else [])
    out = set()
    for part in parts:
        h = 42
        for w in part:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return out


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


M64 = (1 << 64) - 1


def gram_buckets(text, multipliers=(0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)):
    """Buckets of all 1- to 3-grams of the letters of a text in lower case, with one space for whatever else."""
    spaced = " " + re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text)) + " "
    spaced = re.sub(" +", " ", spaced)
    out = []
    for size in (1, 2, 3):
        for i in range(len(spaced) - size + 1):
            h = size
            for j in range(size):
                h = (h + ord(spaced[i + j]) * multipliers[j]) & M64
            out.append(((h ^ h >> 29) * multipliers[0] & M64) >> 50)
    return out


def languages(rows, lower=str.lower):
    """(doc_id, language, probability) of (doc_id, text, lang) rows by naive Bayes with equal priors and half a count more."""
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 4 == 2
    counts = {}
    for doc_id, text, lang in rows:
        if lang is not None and doc_id is not None and not held(doc_id):
            counts.setdefault(lang, Counter()).update(gram_buckets(lower(text or "")))
    out = []
    for doc_id, text, _ in rows:
        text = lower(text or "")
        if not any(c.isalpha() for c in text) or not counts:
            out.append((doc_id, "und", 0.0))
            continue
        sums = {}
        for lang, own in counts.items():
            total = sum(own.values()) + 0.5 * (1 << 14)
            sums[lang] = sum(math.log((own[b] + 0.5) / total) for b in gram_buckets(text))
        best = max(sums.values())
        lang = min(x for x in sums if sums[x] == best)
        out.append((doc_id, lang, 1 / sum(math.exp(s - best) for s in sums.values())))
    return out


def text_statistics(text):
    """The statistics of a text, one by one, from its bytes and words."""
    data = (text or "").encode()
    symbols = b"#$%&*+/<=>@[\\]^_`{|}~"
    classes = [bytes(range(65, 91)), b"0123456789", b".,;:'\"()-", b"!?", b"|", symbols.replace(b"|", b"")]
    out = [math.sqrt(sum(b in c for b in data) / (len(data) + 100)) for c in classes]
    words = data.split()
    n = len(words)
    out.append(math.sqrt(sum(a == b for a, b in zip(words, words[1:])) / (n + 20)))
    out.append((n - len(set(words))) / (n + 20) / math.log(n + math.e))
    out.append(math.log((sum(map(len, words)) + 100) / (n + 20)))
    out.append(math.sqrt(sum(w[-1] in symbols + b"!?" for w in words) / (n + 20)))
    return [*out, math.log1p(n)]


def quality_scores(rows, labels):
    """(doc_id, probability of label 1) of (doc_id, text) rows by two shrunk normals."""
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    x = [np.array(text_statistics(t)) for _, t in rows]
    own = {y: np.array([v for (d, _), v in zip(rows, x) for i, q in labels if i == d and q == y and d is not None and not held(d)]) for y in (0, 1)}
    total = len(own[0]) + len(own[1])
    cov = {y: np.cov(v.T, bias=True) for y, v in own.items()}
    both = sum(len(own[y]) / total * cov[y] for y in own)
    density = {}
    for y, v in own.items():
        c = 0.99 * (0.9 * cov[y] + 0.1 * both) + 0.01 * np.diag(np.diag(both).clip(1e-12))
        d = np.array(x) - v.mean(axis=0)
        mahalanobis = np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d)
        density[y] = math.log(len(v) / total) - 0.5 * (np.linalg.slogdet(c)[1] + mahalanobis)
    return [(d, 1 / (1 + math.exp(min(700, b - a)))) for (d, _), a, b in zip(rows, density[1], density[0])]
