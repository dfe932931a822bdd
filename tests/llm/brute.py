"""Brute-force versions used by more than one test module."""

import re

import numpy as np
import xxhash


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, k):
    """rows: (doc_id, fingerprint); all pairs of distinct fingerprints."""
    fps = sorted({f for _, f in rows})
    arr = np.array(fps, np.uint64)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= k)[0]:
            parent[find(i)] = find(i + 1 + int(j))
    place, least = {f: i for i, f in enumerate(fps)}, {}
    for d, f in rows:
        r = find(place[f])
        least[r] = min(least.get(r, d), d)
    return {d: least[find(place[f])] for d, f in rows}
