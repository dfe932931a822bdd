"""Periodic runs of words by scale-tiled boundary Z-functions.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)`` long, that no
neighbouring word extends with that period. Equivalently word i equals word i + q
over a maximal interval of i, at least ``max(6, 4 q) - q`` long, and no divisor of q does as well.

Periods go by octaves [P, 2P). An octave's boundaries lie 2P words apart, so every run of the octave
has one inside, whatever its place; around each, the interval of every period is read off two
Z-functions, of the words to the right and of those to the left in reverse. They look 2P words to
each side: a longer run leaves a fragment at each boundary inside it, and neighbouring
fragments touch. Work is linear in the words for each octave, and only boundaries
go on where the hashes of P words at the boundary and some period of the octave away agree, which every fragment
of a run has on one of its sides.

Distribution is tiled by scale: a document of up to ``tile`` words is one tile for all octaves; a longer one is exploded
into overlapping tiles, each with the octaves its size serves: tiles of the lowest octaves have
``tile`` words, those of octave P have 8P, plus 6P of overlap. Tiles are shuffled apart and solved independently;
their fragments are shuffled by (document, period) and touching ones stitched to intervals. Only the
highest octaves of a document have tiles of about its own length, as a period of a quarter of it asks for.
Documents without a fragment are finished in the first pass; only the others' texts go into the join with their runs.

Defined results: a null text has no words; equal rows get equal results; a null doc_id is treated as its own
document (and never edited); an empty table gives an empty table; other columns are not looked at. Texts are whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, written

LEAST, TIMES = 6, 4         # a run has at least LEAST words and TIMES periods (fixed values)
TILE = 1 << 15              # words; a power of two
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))

Edit = Callable[[int | None, list[bytes]], list[bytes]]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def z_function(s: list[int]) -> list[int]:
    """z[i]: how many items from i on equal those from the start on."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def prime_divisors(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] * (q > 1)


def grams(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(P, hashes of the P items from each place on) for P = 1, 2, 4 ..."""
    h, size = ids.astype(np.uint64), 1
    while len(h):
        yield size, h
        if len(h) <= size:
            return
        h = h[:-size] * _MIX[0] + h[size:]
        h ^= h >> np.uint64(29)
        h *= _MIX[1]
        h ^= h >> np.uint64(32)
        size *= 2


def candidates(h: np.ndarray, n: int, p: int) -> dict[int, list[int]]:
    """boundary -> periods of the octave where the p items after, or before, the boundary repeat that far on."""
    blocks = -(-n // (2 * p))
    pad = np.uint64(1 << 63) + np.arange(2 * blocks * p, dtype=np.uint64)       # agree with nothing
    after, before = pad.copy(), pad.copy()
    after[:len(h)] = h
    end = min(len(h), 2 * blocks * p - p)
    before[p:p + end] = h[:end]
    after, before = after.reshape(blocks, 2 * p), before.reshape(blocks, 2 * p)
    same = (after[:, p:] == after[:, :1]) | (before[:, p:] == before[:, :1])
    out: dict[int, list[int]] = {}
    for block, q in zip(*(x.tolist() for x in np.nonzero(same))):
        out.setdefault(2 * p * block, []).append(p + q)
    return out


def at_boundary(ids: list[int], c: int, p: int, periods: list[int], begin: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(period, first, last + 1) of the intervals around boundary c that can be part of a run. The document begins at
    ``begin`` and ends at ``end``: 0 and the number of items, or outside of them where it goes on."""
    n = len(ids)
    lo, hi, reach = max(0, c - 2 * p), min(n, c + 4 * p), min(n, c + 2 * p)
    right = z_function(ids[c:hi])
    head = ids[lo:c][::-1]
    left = z_function(head + [-1] + ids[lo:reach][::-1])[len(head) + 1:]
    for q in periods:
        if c + q >= hi or c + q > reach:
            continue
        r, l = right[q], left[reach - c - q]        # noqa: E741
        cut = c - l == lo != begin or c + q + r == hi != end
        if l + r < max(LEAST, TIMES * q) - q and not cut:
            continue
        # a smaller period of these words, at least 2q, would be a divisor of q
        if any(right[d] >= r + q - d and left[reach - c - d] >= l for d in (q // f for f in prime_divisors(q))):
            continue
        yield q, c - l, c + r


def fragments(ids: np.ndarray, least: int = 1, most: int | None = None, core: tuple[int, int] | None = None,
              begin: int = 0, end: int | None = None) -> dict[int, list[tuple[int, int]]]:
    """period -> intervals of the octaves ``least`` .. ``most`` around the boundaries in ``core``, touching ones as one."""
    n, found, items = len(ids), {}, ids.tolist()
    lo, hi = core or (0, n)
    most, end = n // TIMES if most is None else most, n if end is None else end
    for p, h in grams(ids):
        if p > most:
            break
        if p < least:
            continue
        for c, periods in candidates(h, n, p).items():
            if lo <= c < hi:
                for q, s, e in at_boundary(items, c, p, periods, begin, end):
                    have = found.setdefault(q, [])
                    if have and s <= have[-1][1]:
                        have[-1] = (min(s, have[-1][0]), max(e, have[-1][1]))
                    else:
                        have.append((s, e))
    return found


def tiles(n: int, tile: int) -> Iterator[tuple[int, ...]]:
    """(least octave, most, begin, end, core begin and end in the tile, n) that cover a document of n > tile words."""
    p, least = tile // 8, 1
    while least == 1 or TIMES * p <= n:
        for at in range(0, n, 8 * p):
            begin, end = max(0, at - 2 * p), min(n, at + 12 * p)
            yield least, p, begin, end, at - begin, min(n, at + 8 * p) - begin, n
        p *= 2
        least = p


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those after the first period of a run (start, length, period)."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


_FIRST = pa.schema([("key", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sha", pa.string()), ("words", pa.binary()),
                    ("tile", pa.list_(pa.int64())), ("period", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])
_FIRST_DDL = "key string, doc_id long, n long, sha string, words binary, tile array<long>, period long, s long, e long"
_FRAGMENT = pa.schema([("key", pa.string()), ("period", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])


def first_pass(docs: DataFrame, edit: Edit | None, tile: int) -> DataFrame:
    """One row per document (sha: digest of the words where no fragment was found, else words), one per
    fragment (period, s, e) and one per tile of a long document (tile, words)."""
    def run(batches):
        for batch in batches:
            rows, numbers, parts, at, owners = [], _Numbers(), [], [0], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = (text or b"").split()           # bytes: ASCII white space only
                if edit is not None:
                    words = edit(doc_id, words)
                line = b" ".join(words)
                key = hashlib.blake2b(b"%s|%s" % (str(doc_id).encode(), line), digest_size=16).hexdigest()
                doc = [key, doc_id, len(words), None, line, None, None, None, None]
                rows.append(doc)
                if len(words) > tile:
                    rows += [[key, None, None, None, b" ".join(words[t[2]:t[3]]), list(t), None, None, None] for t in tiles(len(words), tile)]
                elif words:
                    owners.append(doc)
                    parts.append(np.array([*map(numbers.__getitem__, words), -1 - len(owners)], np.int64))
                    at.append(at[-1] + len(words) + 1)      # the number after a document is met nowhere else
                else:
                    doc[3:5] = hashlib.sha256(b"").hexdigest(), None
            begin = np.array(at, np.int64)
            found = fragments(np.concatenate(parts)) if parts else {}
            have = set()
            for q, intervals in found.items():
                for (s, e), i in zip(intervals, np.searchsorted(begin, [s for s, _ in intervals], side="right").tolist()):
                    have.add(i - 1)
                    rows.append([owners[i - 1][0], None, None, None, None, None, q, s - at[i - 1], e - at[i - 1]])
            for i, doc in enumerate(owners):
                if i not in have:
                    doc[3:5] = hashlib.sha256(doc[4]).hexdigest(), None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FIRST.types)] if rows else
                                             [pa.array([], t) for t in _FIRST.types], schema=_FIRST)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _FIRST_DDL)


def solve_tiles(rows: DataFrame) -> DataFrame:
    """key, period, s, e: the fragments of the tiles in ``rows`` (key, tile, words), in words of the document."""
    def run(batches):
        for batch in batches:
            out = []
            for key, (least, most, begin, end, lo, hi, n), words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = np.array([*map(_Numbers().__getitem__, words.split())], np.int64)
                out += [(key, q, s + begin, e + begin) 
                        for q, x in fragments(ids, least, most, (lo, hi), 0 if begin == 0 else -1, len(ids) + (end < n)).items() for s, e in x]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(_FRAGMENT.types)], schema=_FRAGMENT)

    return (rows.select("key", "tile", "words").repartition("key", F.col("tile")[1], F.col("tile")[2])
            .mapInArrow(run, "key string, period long, s long, e long"))


def stitch(parts: DataFrame) -> DataFrame:
    """key, runs array<struct<start, period, length>> by start, then period; touching fragments of a (key, period) are one."""
    w = Window.partitionBy("key", "period").orderBy("s", "e")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("s") > F.col("before"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    whole = (parts.distinct().withColumn("before", before).withColumn("island", island)
             .groupBy("key", "period", "island").agg(F.min("s").alias("start"), (F.max("e") - F.min("s") + F.col("period")).alias("length"))
             .where(F.col("length") >= F.greatest(F.lit(LEAST), F.lit(TIMES) * F.col("period"))))
    return whole.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def collapsed_sha(words: Column, runs: Column) -> Column:
    @F.arrow_udf("string")
    def run(lines: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array([None if line is None else hashlib.sha256(
            collapse(line.split(), [(r["start"], r["length"], r["period"]) for r in found or ()])).hexdigest()
            for line, found in zip(lines.to_pylist(), lists.to_pylist())], pa.string())

    return run(words, runs)


def periodic_runs(docs: DataFrame, edit: Edit | None = None, tile: int = TILE) -> DataFrame:
    """doc_id, n_words, runs array<struct<start, period, length>> by start, then period, and the digest of the
    words left when every run is collapsed to its first period. ``edit`` may change a document's words first."""
    arrow_batches(docs.sparkSession)
    first = written(first_pass(docs, edit, tile), "runs-first")
    parts = first.where("period IS NOT NULL").select("key", "period", "s", "e")
    parts = parts.unionByName(solve_tiles(first.where("tile IS NOT NULL")))
    runs = stitch(parts).withColumnRenamed("key", "of")
    each = first.where("n IS NOT NULL")
    done = each.where("sha IS NOT NULL").select("doc_id", F.col("n").alias("n_words"), F.expr("cast(array() AS array<struct<start: bigint, period: bigint, length: bigint>>)").alias("runs"),
                                                F.col("sha").alias("collapsed_sha256"))
    rest = (each.where("sha IS NULL").join(runs, F.col("key") == F.col("of"), "left")
            .select("doc_id", F.col("n").alias("n_words"), F.coalesce("runs", F.expr("cast(array() AS array<struct<start: bigint, period: bigint, length: bigint>>)")).alias("runs"),
                    collapsed_sha(F.col("words"), F.col("runs")).alias("collapsed_sha256")))
    return done.unionByName(rest)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of a tenth of the documents, by a hash of the doc_id, the words from some place on repeat with some period."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def runs_report(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """The runs of every document after ``planted``: number, greatest run, digests of runs and collapsed words."""
    each, at = periodic_runs(docs, planted, tile), F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return (each.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-at["start"]).alias("start"), at["length"].alias("length"),
                    (-at["period"]).alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"), "collapsed_sha256"))
