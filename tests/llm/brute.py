"""Plain versions of the operators, for small inputs only."""

import collections
import hashlib
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    words = WORD.findall(text or "")
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often, covered, seen, dup = collections.Counter(tri), set(), set(), 0
    for i, t in enumerate(tri):
        if often[t] > 1:
            covered |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered))


def fingerprint(text, k=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_components(values, max_bits=2):
    """value -> smallest value of its component; values: unsigned 64-bit integers."""
    f = np.array(sorted(set(values)), np.uint64)
    up = list(range(len(f)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1:]) <= max_bits) + i + 1:
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    return {int(x): int(f[find(i)]) for i, x in enumerate(f)}


def repeated_bytes(texts, length):
    """For each of the byte strings: mask of the bytes to remove."""
    count = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


def drop_later_lines(rows, min_lines=2, min_words=50):
    """rows: (doc_id, text) in order; the texts with later copies of line runs deleted."""
    seen, gone = set(), {}
    for d, text in rows:
        worded = [i for i, x in enumerate((text or "").split("\n")) if WORD.search(x)]
        lines = (text or "").split("\n")
        gone[d] = set()
        for k in range(len(worded)):
            for size in {min_lines, 1}:
                part = tuple(lines[i] for i in worded[k:k + size])
                if len(part) < size or size == 1 < min_lines and len(WORD.findall(part[0])) < min_words:
                    continue
                if part in seen:
                    gone[d] |= set(worded[k:k + size])
                seen.add(part)
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d])
            for d, t in rows}


def pieces(ids, capacity=2048):
    n = len(ids)
    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def sha(b):
    return hashlib.sha256(b).hexdigest()
