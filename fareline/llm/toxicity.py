"""Toxicity by multiple-instance learning.

Only documents have labels, sentences get the scores: a sentence's is the
logistic of a bias and the weights of its words, a document's the noisy-or of its sentences,
``1 - prod(1 - s)``. The weights are fitted to the document labels through the noisy-or, so
they find the sentences that make a document toxic; those with a score of at
least one half are located.

A word has up to three features: itself and its first 4 and 5 letters, in lower case. Spark counts
them per class over the training documents and keeps the ``FEATURES`` with the
largest chi-square; the weights are fitted on the driver, on sentences that are
then a few feature numbers each.

Learned from a bounded sample: ``SAMPLE`` labelled documents per class, by a hash of the doc_id. Scores read whole
texts of all documents. Defined results: a null or empty text has score 0, a text
without labels to learn from too; a null label, or a label without document, teaches nothing; equal texts get equal results;
an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, held, whole_text, written

SAMPLE = 3000           # training documents per class
FEATURES = 4096
LEAST_DOCS = 4          # training documents that a feature is in
STEPS, RATE, DECAY = 400, 0.08, 1e-4
BIAS = -6.0             # before fitting
MAX_WORDS = 300_000     # words whose weights a worker keeps
STEMS = (4, 5)

_SENTENCE = regex.compile(r"[^.!?\n]+")
_WORD = regex.compile(r"\p{L}+")


def features_of(word: str) -> tuple[str, ...]:
    w = word.lower()
    return (w, *(w[:n] + "*" for n in STEMS if len(w) > n))


def train_rows(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(text, toxic) of a bounded sample of the labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    u = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    part = F.when(F.col("toxic") == 1, F.lit(min(1.0, SAMPLE / n.get(1, 1)))).otherwise(F.lit(min(1.0, SAMPLE / n.get(0, 1))))
    chosen = written(known.where(u < part), "toxic-labels")     # about 2 * SAMPLE rows
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def select_features(rows: DataFrame) -> list[str]:
    """The features that tell the classes apart best, by chi-square over documents."""
    @F.arrow_udf("array<string>")
    def distinct(texts: pa.Array) -> pa.Array:
        return pa.array([sorted({f for w in set(_WORD.findall(t or "")) for f in features_of(w)})
                         for t in texts.to_pylist()], pa.list_(pa.string()))

    n = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not n[0] or not n[1]:
        return []
    used = (rows.select("toxic", F.explode(distinct(F.col("text"))).alias("f"))
            .groupBy("f").agg(F.sum("toxic").cast("double").alias("a"), F.count(F.lit(1)).cast("double").alias("n"))
            .where(F.col("n") >= LEAST_DOCS))
    share = n[0] / (n[0] + n[1])
    chi = F.pow(F.col("a") - F.col("n") * share, 2) / (F.col("n") * share * (1 - share))
    top = used.orderBy(F.desc(chi), "f").limit(FEATURES).collect()      # a top list of fixed length
    return sorted(r["f"] for r in top)


def bags(rows: DataFrame, features: list[str]) -> DataFrame:
    """toxic, plain (sentences without a feature), bags (feature numbers of the other sentences)."""
    listed = rows.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(features)})

    @F.arrow_udf("struct<plain int, bags array<array<int>>>")
    def run(texts: pa.Array) -> pa.Array:
        number, plain, out = listed.value, [], []
        for t in texts.to_pylist():
            mine, none = [], 0
            for s in _SENTENCE.findall(t or ""):
                bag = [number[f] for w in _WORD.findall(s) for f in features_of(w) if f in number]
                if bag:
                    mine.append(bag)
                else:
                    none += 1
            plain.append(none)
            out.append(mine)
        return pa.StructArray.from_arrays([pa.array(plain, pa.int32()), pa.array(out, pa.list_(pa.list_(pa.int32())))], ["plain", "bags"])

    return rows.select("toxic", run(F.col("text")).alias("b")).select("toxic", "b.plain", "b.bags")


def fit(labelled: list[tuple[int, int, list[list[int]]]], n_features: int, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """(bias, weights) by Adam on the likelihood of the document labels under the noisy-or."""
    y = np.array([t for t, _, _ in labelled], float)
    plain = np.array([p for _, p, _ in labelled], float)
    bags_, owner = [], []
    for d, (_, _, sentences) in enumerate(labelled):
        for s in sentences:
            bags_.append(s)
            owner.append(d)
    owner = np.array(owner, np.int64)
    row = np.repeat(np.arange(len(bags_)), [len(s) for s in bags_]).astype(np.int64)
    col = np.array([f for s in bags_ for f in s], np.int64)
    x = np.zeros(n_features + 1)
    x[-1] = BIAS
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        w, b = x[:-1], x[-1]
        z = b + np.bincount(row, w[col], len(bags_))
        soft, slope = np.logaddexp(0, z), 0.5 * (1 + np.tanh(z / 2))
        q = plain * np.logaddexp(0, b) + np.bincount(owner, soft, len(y))     # -log(1 - p)
        by_q = np.where(y > 0, -1 / np.expm1(np.clip(q, 1e-9, 50)), 1.0) / len(y)
        by_z = by_q[owner] * slope
        g = np.empty_like(x)
        g[:-1] = np.bincount(col, by_z[row], n_features) + DECAY * w
        g[-1] = by_z.sum() + (by_q * plain).sum() * 0.5 * (1 + np.tanh(b / 2))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return float(x[-1]), x[:-1]


class Scorer:
    """Sentence and document scores in one worker."""

    def __init__(self, bias: float, weights: dict[str, float]):
        self.bias, self.weights, self.known = bias, weights, {}

    def word(self, w: str) -> float:
        v = self.known.get(w)
        if v is None:
            if len(self.known) >= MAX_WORDS:
                self.known.clear()
            v = self.known[w] = sum(self.weights.get(f, 0.0) for f in features_of(w))
        return v

    def score(self, text: str) -> tuple[float, list[dict]]:
        """(document score, offending sentences as start, end, score in code points)."""
        q, found, word = 0.0, [], self.word
        base = float(np.logaddexp(0, self.bias))
        for s in _SENTENCE.finditer(text):
            gain = sum(map(word, _WORD.findall(s.group())))
            if gain == 0.0:
                q += base
                continue
            soft = float(np.logaddexp(0, self.bias + gain))
            q += soft
            if self.bias + gain >= 0:
                found.append({"start": s.start(), "end": s.end(), "score": -float(np.expm1(-soft))})
        return -float(np.expm1(-q)), found


def learn(docs: DataFrame, labels: DataFrame, held_out: Column) -> tuple[float, dict[str, float]]:
    rows = written(train_rows(docs, labels, held_out), "toxic-train")
    features = select_features(rows)
    if not features:
        return -100.0, {}
    data = [(r["toxic"], r["plain"], r["bags"]) for r in bags(rows, features).collect()]    # the bounded sample
    bias, w = fit(sorted(data), len(features))
    return bias, {f: float(x) for f, x in zip(features, w)}


def score(text: Column, model: Broadcast) -> Column:
    """struct(score, offending array<struct(start, end, score)>) of the whole text."""
    key = uuid.uuid4().hex

    @F.arrow_udf("struct<score double, offending array<struct<start int, end int, score double>>>")
    def run(texts: pa.Array) -> pa.Array:
        scorer = held(key, lambda: Scorer(*model.value))
        each = [scorer.score(t or "") for t in texts.to_pylist()]
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array([s for s, _ in each], pa.float64()), pa.array([f for _, f in each], span)],
                                          ["score", "offending"])

    return run(text)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, offending."""
    spark = docs.sparkSession
    arrow_batches(spark)
    model = spark.sparkContext.broadcast(learn(docs, labels, held_out(F.col("doc_id"))))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(whole_text(F.col("text")), model).alias("t"))
            .select("doc_id", "held_out", "t.score", (F.col("t.score") >= 0.5).cast("int").alias("predicted"), "t.offending"))
