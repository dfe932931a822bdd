"""Language identification with segmentation-marginalised unigrams.

The vocabulary is a public one and stays fixed; a language is a probability
for each of its pieces. A word's likelihood is the sum over all its
segmentations into pieces, by the forward algorithm; a text's is the product
over its words, and with equal priors the posterior of the best language is the score.

The probabilities are learned by expectation maximisation: words are counted
per language in Spark, tasks run forward-backward on the distinct words and
return expected counts per (language, piece), which is bounded by the vocabulary.

Learned from a bounded sample: ``SAMPLE_DOCS`` documents per language, by
a hash of the doc_id, of every language that has a label. Prediction reads whole texts of all documents.

Words are lower-cased runs of letters. Defined results: a null text, or one without a
letter, is ``und`` with score 0, and so is every text when nothing was learned; equal texts get equal results;
ties go to the first language by code point; an empty table gives an empty table; other columns are not
looked at.
"""

from __future__ import annotations

import math
import uuid
from os.path import commonprefix

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, fresh, held, written

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_DOCS = 800           # training documents per language
ROUNDS = 3                  # of expectation maximisation
SMOOTH = 0.05               # added to every expected count
MAX_WORDS = 500_000         # words whose likelihoods a worker keeps, while there are at most TABLE_LANGS languages
TABLE_LANGS = 16            # with more, a worker keeps as many fewer words, and scores fewer new ones at a time
TINY = 1e-200               # likelihoods below it are computed in logarithms
UNKNOWN = ""                # stands for a character that no piece covers
UND = "und"

_LETTERS = regex.compile(r"\p{L}+")


def vocabulary(path: str | None = None) -> list[str]:
    """The pieces without upper case, control and byte pieces; the last is UNKNOWN."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    keep = [sp.id_to_piece(i) for i in range(sp.vocab_size())
            if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return sorted({p for p in keep if p == p.lower() and _LETTERS.fullmatch(p.removeprefix("▁") or "a")}) + [UNKNOWN]


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


class Pieces:
    """The vocabulary for lookups from the left (``number``: piece -> number, other prefix of a
    piece -> -1) and from the right (``ending``, the same with suffixes)."""

    def __init__(self, pieces: list[str]):
        self.number = {p: i for i, p in enumerate(pieces)}
        self.ending = dict(self.number)
        for p in pieces:
            for i in range(1, len(p)):
                self.number.setdefault(p[:i], -1)
                self.ending.setdefault(p[i:], -1)
        self.unknown = self.number[UNKNOWN]

    def arcs(self, word: str) -> list[list[tuple[int, int]]]:
        """For each place in the marked word, the (end, piece) that start there."""
        s, get, out = "▁" + word, self.number.get, []
        for i in range(len(s)):
            here, j = [], i + 1
            while j <= len(s) and (n := get(s[i:j])) is not None:
                if n >= 0:
                    here.append((j, n))
                j += 1
            if not here or here[0][0] != i + 1:     # this character alone is no piece
                here.append((i + 1, self.unknown))
            out.append(here)
        return out


def forward(words: list[str], lookup: Pieces, logp: np.ndarray) -> np.ndarray:
    """Log likelihood [word, language]: for each word the sum over all segmentations.

    The forward variable of a place depends on the letters before it only, so words
    that begin alike share it: the sorted words are walked as a tree of prefixes.
    Python finds the pieces that end at each node; the sums go level by level over
    all nodes of the words, in logarithms (no underflow however long a word is).
    """
    get, unknown = lookup.ending.get, lookup.unknown
    depth, first, source, piece = [0], [0], [], []      # per node; arcs of a node lie together
    leaf, path, before = np.zeros(len(words), np.int64), [0], ""
    for w in sorted(range(len(words)), key=words.__getitem__):
        s = "▁" + words[w]
        same = len(commonprefix((s, before)))
        del path[same + 1:]
        for d in range(same + 1, len(s) + 1):
            first.append(len(source))
            depth.append(d)
            k, single = d - 1, False
            while k >= 0 and (n := get(s[k:d])) is not None:
                if n >= 0:
                    source.append(path[k])
                    piece.append(n)
                    single = single or k == d - 1
                k -= 1
            if not single:          # this character alone is no piece
                source.append(path[d - 1])
                piece.append(unknown)
            path.append(len(depth) - 1)
        leaf[w], before = path[len(s)], s
    depth, source, piece = np.array(depth), np.array(source, np.int64), np.array(piece, np.int64)
    start = np.array([*first, len(source)], np.int64)
    alpha = np.zeros((len(depth), logp.shape[1]))
    nodes = np.argsort(depth, kind="stable")
    for level in np.split(nodes, np.searchsorted(depth[nodes], np.arange(1, depth.max() + 1)))[1:]:
        size = start[level + 1] - start[level]
        cut = np.cumsum(size) - size
        arcs = np.repeat(start[level] - cut, size) + np.arange(size.sum())
        term = alpha[source[arcs]] + logp[piece[arcs]]
        top = np.maximum.reduceat(term, cut)
        alpha[level] = top + np.log(np.add.reduceat(np.exp(term - np.repeat(top, size, axis=0)), cut))
    return alpha[leaf]


def expected(arcs, prob: np.ndarray, weight: float, into: dict[int, float]) -> None:
    """Adds ``weight`` times the expected use of each piece in one word, for one language."""
    n = len(arcs)
    alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
    alpha[0] = beta[n] = 1.0
    for i, here in enumerate(arcs):
        for j, piece in here:
            alpha[j] += alpha[i] * prob[piece]
    if alpha[n] < TINY:     # a word too long for plain numbers
        _expected_scaled(arcs, prob, weight, into)
        return
    for i in range(n - 1, -1, -1):
        beta[i] = sum(prob[piece] * beta[j] for j, piece in arcs[i])
    for i, here in enumerate(arcs):
        for j, piece in here:
            into[piece] = into.get(piece, 0.0) + weight * alpha[i] * prob[piece] * beta[j] / alpha[n]


def _expected_scaled(arcs, prob: np.ndarray, weight: float, into: dict[int, float]) -> None:
    """``expected`` in logarithms, for words of any length."""
    n = len(arcs)
    logp = {piece: math.log(prob[piece]) for here in arcs for _, piece in here}
    ending: list[list[float]] = [[] for _ in range(n + 1)]
    alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
    for i, here in enumerate(arcs):
        if i:
            alpha[i] = _log_sum(ending[i])
        for j, piece in here:
            ending[j].append(alpha[i] + logp[piece])
    alpha[n] = _log_sum(ending[n])
    for i in range(n - 1, -1, -1):
        beta[i] = _log_sum([logp[piece] + beta[j] for j, piece in arcs[i]])
    for i, here in enumerate(arcs):
        for j, piece in here:
            into[piece] = into.get(piece, 0.0) + weight * math.exp(alpha[i] + logp[piece] + beta[j] - alpha[n])


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms))


def training_rows(docs: DataFrame, held_out: Column) -> DataFrame:
    """(lang, text) of a bounded sample of the labelled documents that are not held out."""
    labelled = docs.where(~held_out & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    rates = labelled.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(SAMPLE_DOCS)) / F.count(F.lit(1))).alias("rate"))
    u = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return labelled.join(F.broadcast(rates), "lang").where(u < F.col("rate")).select("lang", "text")


def learn(docs: DataFrame, held_out: Column, pieces: list[str], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, probabilities[piece, language])."""
    spark = docs.sparkSession

    @F.arrow_udf("array<string>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([words_of(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    counts = written(training_rows(docs, held_out).select("lang", F.explode(split(F.col("text"))).alias("word"))
                     .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "lang-words")
    langs = [r["lang"] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    place = {x: i for i, x in enumerate(langs)}
    probs = np.full((len(pieces), len(langs)), 1.0 / len(pieces))
    listed = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds if langs else 0):
        now = spark.sparkContext.broadcast(probs)

        def count(batches, now=now):
            lookup, sums = Pieces(listed.value), {}
            columns = {}        # of the languages met in the task
            for pdf in batches:
                for lang, word, n in zip(pdf["lang"], pdf["word"], pdf["n"]):
                    if lang not in columns:
                        columns[lang] = np.ascontiguousarray(now.value[:, place[lang]])
                    expected(lookup.arcs(word), columns[lang], float(n), sums.setdefault(lang, {}))
            yield pd.DataFrame([(x, p, v) for x, s in sums.items() for p, v in s.items()], columns=["lang", "piece", "v"])

        uses = (counts.mapInPandas(count, "lang string, piece int, v double")
                .groupBy("lang", "piece").agg(F.sum("v").alias("v"))).toArrow()     # only pairs that occur
        sums = np.full(probs.shape, SMOOTH)
        column = np.fromiter((place[x] for x in uses["lang"].to_pylist()), np.int64, len(uses))
        np.add.at(sums, (uses["piece"].to_numpy(), column), uses["v"].to_numpy())
        probs = sums / sums.sum(axis=0)
    return langs, probs


class Scorer:
    """Word likelihoods in one worker, kept for words met again."""

    def __init__(self, pieces: list[str], probs: np.ndarray):
        self.lookup, self.logp = Pieces(pieces), np.log(probs)
        self.most = max(1, MAX_WORDS * TABLE_LANGS // max(TABLE_LANGS, len(self.logp[0])))
        self.step = max(1, self.most // 10)
        self._clear()

    def _clear(self) -> None:
        self.known, self.table = {}, np.empty((1 << 12, self.logp.shape[1]))

    def likelihoods(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Per text the log likelihood by language; None without a letter."""
        words = [words_of(t) for t in texts]
        if len(self.known) > self.most:
            self._clear()
        known = self.known
        new = list(set().union(*words).difference(known))
        if new:
            n = len(known)
            while n + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.empty_like(self.table)])
            for i in range(0, len(new), self.step):
                part = new[i:i + self.step]
                self.table[n + i:n + i + len(part)] = forward(part, self.lookup, self.logp)
            known.update(zip(new, range(n, n + len(new))))
        return [self.table[np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))].sum(axis=0) if ws else None
                for ws in words]


def predict(text: Column, langs: list[str], pieces: Broadcast, probs: Broadcast) -> Column:
    """struct(lang_pred, score) of the whole text."""
    key = uuid.uuid4().hex      # a fit's name, so that a worker tells fits apart

    @F.arrow_udf("struct<lang_pred string, score double>")
    def run(texts: pa.Array) -> pa.Array:
        scorer = held(key, lambda: Scorer(pieces.value, probs.value)) if langs else None
        names, scores = [], []
        for ll in scorer.likelihoods(texts.to_pylist()) if langs else [None] * len(texts):
            best = int(np.argmax(ll)) if ll is not None else -1
            names.append(langs[best] if best >= 0 else UND)
            scores.append(float(1.0 / np.exp(ll - ll[best]).sum()) if best >= 0 else 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return run(text)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1


def fitted(docs: DataFrame, path: str | None = None) -> Column:
    """The prediction of column ``text``, learned from ``docs``."""
    spark = docs.sparkSession
    arrow_batches(spark)
    pieces = vocabulary(path)
    langs, probs = learn(docs, held_out(F.col("doc_id")), pieces)
    sc = spark.sparkContext
    return predict(F.col("text").cast("string"), langs, sc.broadcast(pieces), sc.broadcast(probs))


def lang_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), fitted(docs, path).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def keep_known(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """Filtering stage: the columns of ``docs``, rows with a language whose posterior is at least ``least_score``.
    The posterior is over the learned languages only and the whole text: in practice rows without a letter go, and letter
    noise or a text in no learned language stays."""
    c = fresh(docs, "language")[0]
    return (docs.withColumn(c, fitted(docs)).where((F.col(c)["lang_pred"] != UND) & (F.col(c)["score"] >= least_score))
            .select(*docs.columns))
