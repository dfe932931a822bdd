"""Token counts by whole-token shortcut.

A text is split as the vocabulary's pre-tokenizer does. Most pre-tokens are vocabulary
strings, but a vocabulary string need not be what merging its own bytes ends in. So before any text is
read, ``whole_tokens`` proves for each vocabulary string, by merging it, whether it encodes alone as one
token. A pre-token among the proven ones counts as one; only the rest is
merged, with a heap over its pairs (n log n for n bytes, however long a run without spaces is).
Counts of merged pre-tokens met again come from a table of bounded bytes.

Special strings of the vocabulary file (here ``<|endoftext|>``) inside a text are one token each
and split it, as in the tokenizer library's default. No begin or end token, no truncation.

Defined results: a null text counts as empty: no bytes, no tokens; equal rows get equal results;
an empty table gives an empty table; other columns are not looked at. Texts are counted whole.
"""

from __future__ import annotations

import heapq
import json
import uuid

import pyarrow as pa
import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, held, splitter, whole_text

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024                # tokens above which a document is over the limit
TABLE_BYTES = 64 << 20      # of a worker for counts of merged pre-tokens, about
LONG_PIECE = 64             # pre-tokens of more characters are rarely met again and not held


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabulary files write bytes: printable Latin-1 as it is, the others,
    in order, from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Byte-level merges: token numbers of bytes, and of pairs with their ranks."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        letters = byte_letters()
        self.of_byte = {b: vocabulary[c] for c, b in letters.items() if c in vocabulary}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault((vocabulary[left], vocabulary[right]), (rank, vocabulary[left + right]))

    def tokens(self, data: bytes) -> list[int]:
        """Merging by rank, the leftmost pair first among equal ones."""
        get, n = self.pairs.get, len(data)
        token = [self.of_byte[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*found, i, token[i], token[i + 1]) for i in range(n - 1) if (found := get((token[i], token[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, made, i, left, right = heapq.heappop(heap)
            j = after[i]
            if token[i] != left or j >= n or token[j] != right:
                continue        # one of the two has been merged meanwhile
            token[i], token[j], after[i] = made, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
                if found := get((made, token[after[j]])):
                    heapq.heappush(heap, (*found, i, made, token[after[j]]))
            if before[i] >= 0:
                k = before[i]
                if found := get((token[k], made)):
                    heapq.heappush(heap, (*found, k, token[k], made))
        return [t for t in token if t >= 0]


def read_model(path: str | None = None) -> dict:
    """Vocabulary, merges and special strings of a tokenizer file; ValueError unless it is plain byte-level BPE."""
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        file = json.load(f)
    model, split = file["model"], file["pre_tokenizer"]
    if (model["type"], split["type"]) != ("BPE", "ByteLevel") or split["add_prefix_space"] or not split["use_regex"] or file["normalizer"]:
        raise ValueError("a byte-level BPE file without normalizer and prefix space is expected")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in file["added_tokens"]):
        raise ValueError("added tokens that take in their surroundings are not supported")
    return {"vocabulary": model["vocab"], "merges": model["merges"], "special": [t["content"] for t in file["added_tokens"]]}


def whole_tokens(model: dict) -> list[str]:
    """The proof: the vocabulary strings that encode alone as one token, as text (those that are no text on
    their own, such as parts of a character, are never a pre-token)."""
    merges, letters, whole = Merges(model["vocabulary"], model["merges"]), byte_letters(), []
    for string, number in model["vocabulary"].items():
        if not all(c in letters for c in string):
            continue
        data = bytes(letters[c] for c in string)
        if merges.tokens(data) == [number]:
            try:
                whole.append(data.decode("utf-8"))
            except UnicodeDecodeError:
                pass
    return whole


class Counter(dict):
    """pre-token -> number of tokens. Proven whole tokens are always there; merged pre-tokens become the
    older half when half the bytes are taken, and those not asked for since then are dropped."""

    def __init__(self, model: dict, whole: list[str], pattern: str):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.older, self.taken = len(self), {}, 0
        self.merges = Merges(model["vocabulary"], model["merges"])
        self.split = splitter(pattern)
        special = sorted(model["special"], key=len, reverse=True)       # the longest of those that begin at a place
        self.special = regex.compile("|".join(map(regex.escape, special))).split if special else None

    def __missing__(self, piece: str) -> int:
        n = self.older.get(piece)
        if n is None:
            n = len(self.merges.tokens(piece.encode("utf-8")))
        if len(piece) <= LONG_PIECE:
            if 2 * self.taken > TABLE_BYTES:
                each = list(self.items())
                self.clear()
                self.update(each[:self.whole])      # the proven ones were there first
                self.older, self.taken = dict(each[self.whole:]), 0
            self[piece] = n
            self.taken += 150 + len(piece)
        return n

    def count(self, text: str) -> int:
        if self.special is None:
            return sum(map(self.__getitem__, self.split(text)))
        parts = self.special(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.split(p))) for p in parts)


def prepared(spark: SparkSession, path: str | None = None) -> Broadcast:
    """Model and proven whole tokens for the executors (a vocabulary: of a size that does not grow)."""
    model = read_model(path)
    return spark.sparkContext.broadcast((model, whole_tokens(model)))


def count_tokens(text: Column, table: Broadcast, pattern: str = public_tokenizers.PATTERN) -> Column:
    """long: the number of tokens of the whole text."""
    key = uuid.uuid4().hex      # a table's name, so that a worker tells tables apart

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        counter = held(key, lambda: Counter(*table.value, pattern))
        return pa.array([counter.count(t or "") for t in texts.to_pylist()], pa.int64())

    return run(text)


def token_report(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    spark = docs.sparkSession
    arrow_batches(spark)
    text = whole_text(F.col("text"))
    each = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), count_tokens(text, prepared(spark, path)).alias("n"))
    return each.select("doc_id", "n_bytes", F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))
