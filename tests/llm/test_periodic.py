import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fareline.llm import periodic as pr


def brute_runs(words):
    """Every maximal stretch with smallest period q, by definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            stretch = words[s:s + length]
            if length >= max(6, 4 * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        old = list(words)
        for i in range(a, n):
            words[i] = old[a + (i - a) % p]
    number = {}
    runs = brute_runs([number.setdefault(w, len(number)) for w in words])
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


def values(r):
    return tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))


def periodic_text(rng, n):
    out = []
    while len(out) < n:
        if rng.random() < 0.5:
            out += [rng.choice("abcdefgh") for _ in range(rng.randint(1, 30))]
        else:
            unit = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.randint(1, rng.choice([3, 12, 40])))]
            k = rng.randint(2, 9)
            out += (unit * (k + 1))[:k * len(unit) + rng.randint(0, len(unit))]
    return out[:n]


def as_runs(found):
    return sorted(((s, e - s + q, q) for q, x in found.items() for s, e in x if e - s + q >= max(6, 4 * q)), key=lambda r: (r[0], r[2]))


def test_fragments_against_definition():
    rng = random.Random(1)
    for _ in range(250):
        ids = [ord(w) for w in periodic_text(rng, rng.randint(1, 300))]
        assert as_runs(pr.fragments(np.array(ids, np.int64))) == brute_runs(ids)
    fib = "a", "ab"
    while len(fib[1]) < 500:
        fib = fib[1], fib[1] + fib[0]
    thue = [bin(i).count("1") % 2 for i in range(512)]
    for ids in ([ord(x) for x in fib[1]], thue, [7] * 333, [1, 2] * 100 + [1, 2, 3] * 50 + [3] * 40):
        assert as_runs(pr.fragments(np.array(ids, np.int64))) == brute_runs(ids)


def test_whole_table_against_brute_force(spark, sf, docs):
    from fareline.llm.queries import op12_periodic_runs

    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: values(r) for r in op12_periodic_runs(spark, sf).collect()}
    assert len(got) == len(rows)
    short = [(d, t) for d, t in rows if len((t or "").split()) < 1500]
    assert len(short) > 0.9 * len(rows)
    for d, t in short:
        assert got[d] == brute_report(d, t), d


def test_tiles_give_what_one_piece_gives(spark):
    """Long documents in tiles of 64 words and up, stitched, against the definition; runs across many tiles too."""
    rng = random.Random(4)
    rows = [(i, " ".join(periodic_text(rng, 700))) for i in range(12)]
    rows += [(100, "a " * 900), (101, "a b c " * 300), (102, " ".join(map(str, range(200))) + " " + "x y " * 60), (103, ("%s " * 170 % tuple(range(170))) * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for tile in (64, 256, pr.TILE):
        got = {r["doc_id"]: values(r) for r in pr.runs_report(df, tile).collect()}
        assert got == {d: brute_report(d, t) for d, t in rows}, tile


def test_edge_rows(spark, table):
    long = "lorem ipsum dolor " * 30000
    free = next(i for i in range(6, 99) if zlib.crc32(str(i).encode()) % 10)        # a doc_id that is not edited
    df = table([(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (5, "a a a a a a"), (5, "b"), (None, "x y " * 8), (None, "z"), (free, long)],
               "doc_id long, text string, key string, n string, words string, period string, s int, e int, runs int, start string")
    rows = pr.runs_report(df).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(values(r))
    for d, t in ((1, None), (2, ""), (3, " \t\n"), (4, "a a a a a")):
        assert by[d] == [brute_report(d, t)] and by[d][0][0] == 0
    assert sorted(by[5], key=str) == sorted([brute_report(5, t) for t in ("a a a a a a", "a a a a a a", "b")], key=str)
    assert sorted(v[0] for v in by[None]) == [0, 1]
    assert by[free][0][:5] == (1, 0, 90000, 3, 1000 * 30000)
    assert pr.runs_report(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [65, 1000, 5000])
def test_tiles_cover(n):
    """Every octave that can hold a run has boundaries two octaves apart over the document, each with its windows inside its tile."""
    each = list(pr.tiles(n, 64))
    p = 1
    while 4 * p <= n:
        mine = [t for t in each if t[0] <= p <= t[1]]
        at = sorted(b + c for _, _, b, _, lo, hi, _ in mine for c in range(-(-lo // (2 * p)) * 2 * p, hi, 2 * p))
        assert at[0] == 0 and max(np.diff([*at, n])) <= 2 * p
        for _, _, b, e, lo, hi, _ in mine:
            assert b == 0 or lo >= 2 * p
            assert e == n or e - b - hi >= 4 * p
        p *= 2
