import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.llm import toxicity


def test_held_out_accuracy(spark, sf, docs):
    from fareline.llm.queries import op7_toxicity

    rows = op7_toxicity(spark, sf).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert sum((s >= 0.5) == (y == 1) for s, y in held) >= 0.9 * len(held)
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum(a > b for a in pos for b in neg) >= 0.9 * len(pos) * len(neg)


def test_fit_finds_the_sentence_words():
    """Feature 0 is in one sentence of every toxic document, 1 and 2 anywhere."""
    rng, data = np.random.default_rng(0), []
    for d in range(300):
        bags = [[int(rng.integers(1, 3))] for _ in range(5)]
        if d % 2:
            bags[int(rng.integers(0, 5))].append(0)
        data.append((d % 2, 10, bags))
    bias, w = toxicity.fit(data, 3)
    assert bias < -3 and w[0] > 5 and abs(w[1]) < 2 and abs(w[2]) < 2


def test_gradient():
    """One step of the fit moves against the slope of the likelihood."""
    data = [(1, 2, [[0], [1, 1]]), (0, 1, [[1]]), (1, 0, [[0, 1]]), (0, 3, [])]

    def loss(x):
        total = 0.0
        for y, plain, bags in data:
            q = plain * np.logaddexp(0, x[-1]) + sum(np.logaddexp(0, x[-1] + sum(x[f] for f in b)) for b in bags)
            total += q if not y else -np.log(-np.expm1(-q))
        return total / len(data)

    start = np.array([0.0, 0.0, toxicity.BIAS])
    b, w = toxicity.fit(data, 2, steps=1)
    for i, moved in enumerate([*w, b]):
        e = np.zeros(3)
        e[i] = 1e-5
        slope = (loss(start + e) - loss(start - e)) / 2e-5
        assert np.sign(moved - start[i]) == -np.sign(slope)


def test_offending_sentences_are_located(spark):
    clean = ["The river runs by the old mill. ", "We ate bread in the sun.\n", "Nobody saw the train leave! "]
    bad = "You utter zorgblat fool. "
    rows = [(i, "".join(clean[(i + j) % 3] for j in range(4)) + (bad if i % 3 == 0 else "")) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.toxicity_report(docs, labels).collect()}
    for i, t in rows:
        assert out[i]["predicted"] == int(i % 3 == 0)
        assert [t[s["start"]:s["end"]].strip() for s in out[i]["offending"]] == (["You utter zorgblat fool"] if i % 3 == 0 else [])


def test_edge_rows(spark, table):
    rows = [(i, "you zorgblat" if i % 2 else "good day to all") for i in range(80)]
    rows += [(100, None), (101, ""), (102, "zorgblat. " * 50000), (None, "zorgblat"), (3, "you zorgblat"), (103, "!?\n.")]
    df = table(rows)
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(80)] + [(None, 1, 1), (5, None, 1), (7, 1, 1), (999, 1, 0)], "doc_id long, toxic int, text int")
    out = toxicity.toxicity_report(df, labels).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) and by[100]["score"] == by[101]["score"] == by[103]["score"] == 0
    assert by[102]["predicted"] == 1 and by[None]["predicted"] == 1 and by[2]["predicted"] == 0
    unlabelled = toxicity.toxicity_report(df, labels.limit(0)).collect()
    assert {r["predicted"] for r in unlabelled} == {0}
    assert toxicity.toxicity_report(df.limit(0), labels).count() == 0


def test_scores_are_the_noisy_or_in_plain_python(spark):
    """Every document's score and located sentences from the definition: sentences, words, their features, logistic, 1 - prod(1 - s)."""
    import math
    import random
    import re

    rng = random.Random(4)
    weights = {"vile": 7.5, "vile*": 1.0, "bad": 4.0, "hate*": 3.5, "hatef*": 2.0, "kind": -3.0, "é": 2.5}
    bias = -5.0
    said = ["vile", "viles", "bad", "Bad", "hateful", "hated", "kind", "plain", "é", "word", "x"]
    texts = [None, "", "...", "\n!\n"] + ["".join(rng.choice(said) + rng.choice([" ", " ", ", ", ". ", "!", "\n", "? "]) for _ in range(rng.randint(1, 60)))
                                          for _ in range(60)]

    def want(text):
        keep, found = 1.0, []
        for m in re.finditer(r"[^.!?\n]+", text or ""):
            z = bias
            for w in re.findall(r"[^\W\d_]+", m.group()):
                w = w.lower()
                z += sum(weights.get(f, 0.0) for f in [w] + [w[:n] + "*" for n in (4, 5) if len(w) > n])
            s = 1 / (1 + math.exp(-z))
            keep *= 1 - s
            if s >= 0.5:
                found.append((m.start(), m.end(), s))
        return 1 - keep, found

    model = spark.sparkContext.broadcast((bias, weights))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in df.select("i", toxicity.score(F.col("text"), model).alias("t")).collect():
        score, found = want(texts[r["i"]])
        assert r["t"]["score"] == pytest.approx(score, abs=1e-12)
        assert [(o["start"], o["end"]) for o in r["t"]["offending"]] == [f[:2] for f in found]
        assert [o["score"] for o in r["t"]["offending"]] == pytest.approx([f[2] for f in found])
