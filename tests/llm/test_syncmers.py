import hashlib
import re

import pytest
from pyspark.sql import functions as F

from fareline.llm import syncmers

TEXTS = [(3, "one two three four five six seven eight nine ten"), (1, None), (2, ""), (7, "a b"), (9, "a b a b a b a b a b a b"), (9, "a b a b a b a b a b a b"),
         (None, "null id sorts first of all"), (12, "x"), (20, "word " * 30000), (21, "é漢字 😀 ü ß"), (25, "one two three four five six seven eight nine ten"), (26, " \t\n ")]


def pieces(t):
    c, v = "bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ", "aeiouyAEIOUY"
    return re.findall(f"[{c}]*[{v}]+|[{c}]+|[^\\x20\\x09-\\x0Da-zA-Z]", t)


def brute(spark, rows, k=syncmers.K, s=syncmers.S):
    """Everything but the hash in plain Python."""
    order = sorted(((d is not None, d or 0, t or "") for d, t in rows))
    out = []
    for i, (has, d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][2]
        m = len(t) // 2
        out.append([d if has else None, t, t[:len(t) - m] + nxt[:m], nxt])
    texts = {t for r in out for t in r[1:]}
    vocab = sorted({w for t in texts for w in pieces(t)})
    h = {r["w"]: r["h"] for r in spark.createDataFrame([(w,) for w in vocab], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    needed, plan = set(), {}
    for t in texts:
        hs = [h[w] for w in pieces(t)]
        hs = [2**63 - 1] * (k - 1) + hs + [2**63 - 1] * (k - 1) if hs else []
        plan[t] = [tuple(hs[i:i + k]) for i in range(len(hs) - k + 1) if min(hs[i:i + k]) in (hs[i], hs[i + k - 1])]
        needed |= set(plan[t])
    grams = sorted(needed)
    of = {}
    if grams:
        df = spark.createDataFrame(grams, ", ".join(f"c{i} long" for i in range(k)))
        of = {tuple(r)[:k]: r["h"] >> 32 & 0xFFFFFFFF for r in df.select("*", F.xxhash64(*df.columns).alias("h")).collect()}
    prints = {t: list(dict.fromkeys(of[c] for c in chosen)) for t, chosen in plan.items()}

    def like(a, b):
        if not a and not b:
            return 1.0
        x, y = [v for v in a if v in set(b)], [v for v in b if v in set(a)]
        steps = lambda z: set(zip(z, z[1:]))
        return (len(steps(x) & steps(y)) + bool(x)) / len(set(a) | set(b))

    return [(d, len(t), hashlib.sha256(e.encode()).hexdigest(), prints[t], prints[e], like(prints[t], prints[e]), like(prints[t], prints[n]))
            for d, t, e, n in out]


def compare(got, want):
    text = lambda p: "".join(f"{x:08x}" for x in p)
    key = lambda r: repr(tuple(r)[:3])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:3] == w[:3]
        for mine, p in ((g["fingerprint"], w[3]), (g["edited_fingerprint"], w[4])):
            assert mine == text(p) and (p or not g["n_chars"] or mine == "")
        assert abs(g["near_edited"] - w[5]) < 1e-12 and abs(g["near_next"] - w[6]) < 1e-12


@pytest.mark.parametrize("range_rows", [1, 3, 1000])
def test_small_table(spark, range_rows):
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in TEXTS], "doc_id long, text string, anchors string, n_chars int")
    compare(syncmers.fingerprint_report(df, range_rows).collect(), brute(spark, TEXTS))


def test_whole_table(spark, sf, docs):
    from fareline.llm.queries import op6_syncmers

    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    compare(op6_syncmers(spark, sf).collect(), brute(spark, rows))


def test_one_document_and_none(spark):
    df = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    r = syncmers.fingerprint_report(df).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0
    assert syncmers.fingerprint_report(df.limit(0)).count() == 0


def inside(spark, text):
    return set(spark.createDataFrame([(text,)], "t string").select(syncmers.anchors(F.col("t"), blanks=False)).first()[0])


def every(spark, text):
    return set(spark.createDataFrame([(text,)], "t string").select(syncmers.anchors(F.col("t"))).first()[0])


@pytest.mark.parametrize("passage", [
    " ".join(f"word{i} lies" for i in range(40)), "".join(f"a{i * i % 97}ble" for i in range(60)), "".join(chr(0x4E00 + (i * i * 31) % 3000) for i in range(120)),
    "a short passage with anchors in it", "一二三四五六七八九十"])
def test_a_passage_keeps_its_anchors(spark, passage):
    """Context-free: what a passage selects inside itself it selects alone, in a long run without spaces, and in any
    surroundings. Its first and last piece may join letters around it, so they are left out."""
    found = list(re.finditer(syncmers.PIECE, passage))
    own = inside(spark, passage[found[0].end():found[-1].start()])
    assert own
    for before, after in (("", ""), ("x y z " * 9, " q r s" * 5), ("前" * 47, "後"), ("e" * 60 + "o", "!" * 60), ("1" * 5000, "2" * 5000), (" ", "\n")):
        assert own <= every(spark, before + passage + after), (before[:5], after[:5])


def test_no_length_changes_the_rule(spark):
    """A run of 47 characters and one of 49, three words and five: the same pieces."""
    rows = [("bana" * n + "!" * m,) for n, m in ((11, 3), (12, 0), (12, 1))] + [("one two six",), ("one two six ten won",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(syncmers.tokens(F.col("t"))).collect()]
    assert got[0][:22] == got[1][:22] == got[2][:22] and got[4][:len(got[3])] == got[3]
    assert [len(g) for g in got] == [len(pieces(t)) for (t,) in rows]


def test_wider_inner_substrings(spark):
    rows = [(1, "the cat sat on the mat and the dog sat on the log while it rained all day"), (2, "a a a a a a"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    r = df.select(syncmers.anchors(F.col("text"), 5, 2).alias("a")).collect()
    assert 1 <= len(r[0]["a"]) <= 40 and len(r[1]["a"]) >= 1 and r[2]["a"] == []


def test_order_matters(spark):
    """Positional: the same sentences in another order are less alike than in the same order, more than others are."""
    said = [f"sentence number {i * 37} tells of {i * i} things" for i in range(12)]
    mixed = [said[i] for i in (7, 0, 9, 2, 11, 4, 1, 6, 3, 8, 5, 10)]
    (_, same), (_, moved), (_, other) = shares(spark, [(" ".join(said), " ".join(said)), (" ".join(said), " ".join(mixed)), (" ".join(said), "quite another text")])
    assert same == 1.0 and 0.4 < moved < 0.95 and other < 0.1


def shares(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    x, y = syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))
    return [(r["n"], r["like"]) for r in df.orderBy("i").select(F.size(x).alias("n"), syncmers.likeness(x, y).alias("like")).collect()]


def test_unspaced_texts(spark):
    """One changed character leaves most anchors of a long text without spaces; other texts share none."""
    import random

    rng = random.Random(5)
    make = lambda first, size, n: "".join(chr(first + rng.randrange(size)) for _ in range(n))
    texts = [make(0x4E00, 3000, 400), make(0x3041, 80, 400), make(0x0E01, 46, 400), make(0x21, 90, 400),
             "\n".join(make(0x4E00, 3000, 30) for _ in range(3)), "\n".join(make(0x4E00, 3000, 30) for _ in range(20)),
             " ".join("，".join(make(0x4E00, 3000, 5) for _ in range(4)) for _ in range(20)),
             "intro words before it " + make(0x61, 26, 300) + " and some after"]
    changed = [t[:len(t) // 2] + "_" + t[len(t) // 2 + 1:] for t in texts]
    for t, (n, like) in zip(texts, shares(spark, zip(texts, changed))):
        assert n > len(t) // 16 and like > 0.6, (t[:20], n, like)
    for n, like in shares(spark, zip(texts[:4], [make(0x4E00, 3000, 400), make(0x3041, 80, 400), make(0x0E01, 46, 400), make(0x21, 90, 400)])):
        assert like < 0.05


def test_edited_unspaced_documents(spark):
    docs = [(i, "".join(chr(0x4E00 + (j * j * (31 + i) + 7 * i) % 2999) for j in range(200))) for i in range(3)]
    rows = syncmers.fingerprint_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(0.2 < r["near_edited"] < 0.6 and r["near_next"] < 0.2 for r in rows)


def test_native(spark, docs):
    plan = syncmers.fingerprint_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
