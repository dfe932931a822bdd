"""Quality rules as a short-circuit cascade.

Every rule has a cost and a selectivity. Both are measured on a sample of the
table, the rules are ordered by rejections per second, and the verdict is one
``CASE`` whose branches are tried in that order: a document stops at the first
rule that rejects it, so dear rules see few documents. The order changes the
time, never the verdict (a document is kept when no rule rejects it).

Defined results: a null text counts as empty; an empty text has zero words and
fails the base; equal rows get equal results; an empty table gives an empty
table; other columns are not looked at. Texts are processed whole.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, whole_text, words, written

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SAMPLE_ROWS = 4000          # rows on which costs and selectivities are measured


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the text and the struct of base features."""

    name: str
    rejects: object

    def column(self, text: Column, base: Column) -> Column:
        return F.coalesce(self.rejects(text, base), F.lit(False))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


# Integer arithmetic throughout, so that any engine gives the same verdict.
RULES = (
    Rule("short_words", lambda t, b: b["word_chars"] < 2 * b["n_words"]),
    Rule("long_words", lambda t, b: b["word_chars"] > 15 * b["n_words"]),
    Rule("symbols", lambda t, b: 100 * b["n_symbols"] > 20 * b["n_words"]),
    Rule("dup_lines", lambda t, b: 100 * b["n_dup_lines"] > 60 * (1 + _count(t, "\\n"))),
    Rule("capitals", lambda t, b: 100 * _count(t, "\\p{Lu}{2,}") > 50 * b["n_words"]),
    Rule("exclamations", lambda t, b: 100 * _count(t, "!") > 50 * b["n_words"]),
    Rule("numerals", lambda t, b: 100 * _count(t, "[0-9]+") > 50 * b["n_words"]),
)


FEW = 24        # up to so many repeated windows are looked up one by one, more by a sort


def _repeated_words(ws: Column) -> Column:
    """Words inside a 3-word window that is found at least twice.

    Windows are compared by their 64-bit hash; a text without a repeated hash
    is done. Otherwise the sorted hashes show the repeated ones. A few are
    looked up at every position; many are found by a sort of (hash, position),
    whose equal neighbours they are. Each covered position counts once.
    """
    def cover(starts: Column) -> Column:
        at = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
        return F.size(F.array_distinct(at))

    def places(tri: Column, h: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(tri) - 1), lambda i: F.array_contains(h, F.get(tri, i)))

    def by_sort(tri: Column) -> Column:
        pairs = F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        same = let(F.sort_array(pairs), lambda s: F.filter(
            s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])))
        return F.transform(same, lambda x: x["i"])

    def resolve(tri: Column) -> Column:
        again = let(F.sort_array(tri), lambda s: F.filter(s, lambda x, j: F.get(s, j + 1) == x))
        return let(F.array_distinct(again), lambda h: cover(
            F.when(F.size(h) <= FEW, places(tri, h)).otherwise(by_sort(tri))))

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    return F.when(F.size(ws) < 3, F.lit(0)).otherwise(let(ws, lambda w: let(windows(w), lambda tri: F.when(
        F.size(F.array_distinct(tri)) == F.size(tri), F.lit(0)).otherwise(resolve(tri)))))


def base_features(text: Column) -> Column:
    """Struct n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long)."""
    def features(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _count(text, SYMBOLS).alias("n_symbols"),
            let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _repeated_words(w).cast("long").alias("n_repeat_words"))

    return let(words(text), features)


def base_failed(base: Column) -> Column:
    return (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PCT * base["n_words"])


def measure(sample: DataFrame, text: str, base: str, rules, clock=time.perf_counter) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of each rule on the written ``sample``."""
    t, b = F.col(text), F.col(base)

    def timed(*cols: Column) -> tuple[float, list]:
        best, row = None, []
        for _ in range(2):          # the first run also compiles
            t0 = clock()
            row = list(sample.agg(F.count(F.lit(1)), *cols).first())
            best = min(clock() - t0, best if best is not None else 1e9)
        return best, row

    idle, (n,) = timed()
    out = []
    for r in rules:
        sec, row = timed(F.count_if(r.column(t, b)))
        out.append((r, max(sec - idle, 1e-6), row[1] / n if n else 0.0))
    return out


def order(measured) -> list[Rule]:
    """Most rejections per second first; ties by name."""
    return [r for r, sec, share in sorted(measured, key=lambda m: (-m[2] / m[1], m[0].name))]


def cascade(text: Column, base: Column, rules) -> Column:
    """True where no rule rejects: branches of one CASE, tried in the given order."""
    if not rules:
        return F.lit(True)
    first, *rest = rules
    verdict = F.when(first.column(text, base), F.lit(False))
    for r in rest:
        verdict = verdict.when(r.column(text, base), F.lit(False))
    return verdict.otherwise(F.lit(True))


def verdict(text: Column, rules) -> Column:
    """Struct of the base features, base_failed and kept. One expression, with
    everything bound inside, so that a filter on it evaluates it just once."""
    def judged(t: Column, b: Column) -> Column:
        failed = base_failed(b)
        return F.struct(b.alias("base"), failed.alias("base_failed"),
                        F.when(failed, F.lit(False)).otherwise(cascade(t, b, rules)).alias("kept"))

    return let(whole_text(text), lambda t: let(base_features(t), lambda b: judged(t, b)))


def plan(docs: DataFrame, text: str = "text", rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order measured on about ``sample_rows`` rows of ``docs``
    that pass the base (the cascade sees no others)."""
    n = docs.count()
    sample = docs.select(whole_text(F.col(text)).alias("text")).sample(min(1.0, sample_rows / n) if n else 1.0, seed=7)
    sample = written(sample.withColumn("base", base_features(F.col("text"))), "quality-sample")
    return order(measure(sample.where(~base_failed(F.col("base"))), "text", "base", rules))


def quality_report(docs: DataFrame) -> DataFrame:
    v = docs.select("doc_id", verdict(F.col("text"), plan(docs)).alias("v"))
    return v.select("doc_id", "v.base.*", "v.base_failed", "v.kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """Filtering stage: the columns of ``docs``, rows with the verdict kept."""
    return docs.where(verdict(F.col("text"), plan(docs))["kept"])


_WORDS = "regexp_extract_all({t}, '[^\\x20\\x09-\\x0D]+')"
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), f AS (
  SELECT rid, doc_id, t, {_WORDS.format(t='t')} AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d
), p AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM f)
), r AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM p) WHERE n > 1
), c AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), b AS (
  SELECT f.rid, doc_id, t, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM f LEFT JOIN c ON c.rid = f.rid
), v AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
         len(regexp_extract_all(t, '\\p{{Lu}}{{2,}}')) AS caps, len(regexp_extract_all(t, '[0-9]+')) AS numerals,
         len(regexp_extract_all(t, '!')) AS bangs, len(regexp_extract_all(t, '\\n')) AS breaks
  FROM b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 60 * (1 + breaks)
            OR 100 * caps > 50 * n_words OR 100 * bangs > 50 * n_words
            OR 100 * numerals > 50 * n_words) AS kept
FROM v
"""
