"""Document fingerprints from closed syncmers, with DataFrame expressions only.

One alphabet serves every text: outside of ASCII white space a piece is ASCII consonants with the vowels after them, consonants
that no vowel follows, or any other single character (so in scripts without spaces each character). Where a piece ends
depends on the two characters there alone, so no length of a word, run or text changes the rule. A k-mer is ``K``
consecutive pieces, its inner substrings are its ``S`` pieces long, ordered by a 64-bit hash; the k-mer is an
anchor when its least inner substring lies at its start or at its end. Whether it is one depends on its own
pieces alone, so the anchors of a shared passage are the same in every text that has
it, alone or within a longer run. Beyond both ends of a text come ``K - 1`` blanks that are greater than any piece, so that a text
of any length has anchors. A fingerprint is the distinct anchors (32-bit hashes) in text order, as hex.

Likeness is positional: the common anchors of two texts are put in the order of each; a common anchor counts when the one before it is the
same in both (the first one always), and the count is divided by the number of distinct anchors of both. Equal texts have 1; a passage
moved as a whole keeps its count but for its ends.

The edited texts need the next document by doc_id. Documents are dealt into
ranges of doc_id whose bounds come from a quantile sketch; the first document
of a range goes along as a sentinel at the end of the range before. So each text is
shuffled once (one more copy per range), a window within a range finds the next
text, and the order never meets in one task.

Defined results: a null text counts as empty; a text without pieces has no anchor and an empty fingerprint, alike (1) only
to another such; a null doc_id sorts first; rows with equal doc_id sort by text; the next document of the last is the first, of a single one
itself; an empty table gives an empty table; other columns are not looked at. Texts are read whole.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, let, whole_text

K = 6
S = 1
CONSONANTS = "bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ"
VOWELS = "aeiouyAEIOUY"
PIECE = f"[{CONSONANTS}]*[{VOWELS}]+|[{CONSONANTS}]+|[^{SPACE}A-Za-z]"
BLANK = (1 << 63) - 1
RANGE_ROWS = 500        # documents per range of doc_id, while there are at most MAX_RANGES
MAX_RANGES = 10_000
NULL_ID = -(1 << 63)


def _int32(h: Column) -> Column:
    """The upper half of a long as an int."""
    return F.shiftright(h, 32).cast("int")


def tokens(text: Column) -> Column:
    """array<long>: hashes of the pieces, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda w: F.xxhash64(w))


def anchors(text: Column, k: int = K, s: int = S, blanks: bool = True) -> Column:
    """array<int>: distinct closed syncmers of the text, in order; without ``blanks`` only those wholly inside it."""
    def least(p: Column, i: Column) -> Column:
        inner = [F.get(p, i + d) for d in range(k - s + 1)]

        def at(edge: int) -> Column:        # most comparisons end at the first or second
            return functools.reduce(operator.and_, [inner[edge] <= x for x in inner if x is not inner[edge]], F.lit(True))

        return at(0) | at(-1)

    def chosen(h: Column, p: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(h) - k), lambda i: least(p, i))
        return F.transform(at, lambda i: _int32(F.xxhash64(*(F.get(h, i + d) for d in range(k)))))

    def pick(h: Column) -> Column:
        pieces = h if s == 1 else F.transform(F.slice(h, F.lit(1), F.size(h) - s + 1),
                                              lambda x, i: F.xxhash64(*(F.get(h, i + d) for d in range(s))))
        return F.when(F.size(h) < k, F.array().cast("array<int>")).otherwise(let(pieces, lambda p: F.array_distinct(chosen(h, p))))

    def padded(h: Column) -> Column:
        ends = F.array_repeat(F.lit(BLANK), k - 1)
        return F.when(F.size(h) == 0, h).otherwise(F.concat(ends, h, ends))

    return let(tokens(text), lambda h: let(padded(h) if blanks else h, pick))


def as_string(a: Column) -> Column:
    """Eight hex digits per anchor."""
    return F.lower(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Common anchors that follow the same common anchor in both (and the first), over the distinct anchors of both; 1 when both are empty."""
    def steps(x: Column) -> Column:     # each anchor with the one before, as one long
        return F.transform(F.sequence(F.lit(1), F.size(x) - 1), lambda i: F.shiftleft(F.get(x, i - 1).cast("long"), 32)
                           .bitwiseOR(F.get(x, i).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))

    def of(x: Column) -> Column:        # the common anchors in the order of a, and of b
        kept = F.when(F.size(x["a"]) < 2, F.size(x["a"])).otherwise(
            F.size(F.array_intersect(steps(x["a"]), steps(x["b"]))) + 1)
        return kept / (F.size(a) + F.size(b) - F.size(x["a"]))

    both = F.struct(F.array_intersect(a, b).alias("a"), F.array_intersect(b, a).alias("b"))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(let(both, of))


def _bucket(at: Column, firsts: list[int]) -> Column:
    """Number of the range that holds ``at``: a binary search in the sorted bounds."""
    bounds = F.array(*map(F.lit, firsts))
    steps = max(1, len(firsts).bit_length())
    found = F.aggregate(
        F.array(*[F.lit(0)] * steps), F.struct(F.lit(0).alias("lo"), F.lit(len(firsts) - 1).alias("hi")),
        lambda acc, _: let(F.floor((acc["lo"] + acc["hi"] + 1) / 2).cast("int"), lambda mid: F.when(
            F.get(bounds, mid) <= at, F.struct(mid.alias("lo"), acc["hi"].alias("hi")))
            .otherwise(F.struct(acc["lo"].alias("lo"), F.greatest(mid - 1, acc["lo"]).alias("hi")))))
    return found["lo"]


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, anchors and those of the next document (next_text, next_anchors)."""
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    ids = docs.select(at.alias("at"))
    n, low = ids.agg(F.count(F.lit(1)), F.min("at")).first()
    ranges = min(MAX_RANGES, n // range_rows + 1)
    cuts = [] if ranges < 2 else ids.agg(F.percentile_approx(
        "at", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]
    firsts = sorted({low if low is not None else 0, *cuts})      # bounds are ids that occur
    last = len(firsts)
    base = (docs.select("doc_id", at.alias("at"), whole_text(F.col("text")).alias("text"))
            .withColumn("bucket", _bucket(F.col("at"), firsts)))
    opens = F.get(F.array(*map(F.lit, firsts)), F.col("bucket")) == F.col("at")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("sentinel"))
    before = F.struct(F.pmod(F.col("bucket") - 1, F.lit(last)).alias("bucket"), F.lit(1).alias("sentinel"))
    dealt = (base.select("doc_id", "at", "text", F.explode(F.when(opens, F.array(own, before)).otherwise(F.array(own))).alias("to"))
             .select("doc_id", "at", "text", "to.bucket", "to.sentinel").repartition("bucket")
             .withColumn("anchors", anchors(F.col("text"))))
    w = Window.partitionBy("bucket").orderBy("sentinel", "at", "text")
    return (dealt.withColumn("next_text", F.lead("text").over(w)).withColumn("next_anchors", F.lead("anchors").over(w))
            .where("sentinel = 0").select("doc_id", "text", "anchors", "next_text", "next_anchors"))


def fingerprint_report(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of the texts and of their edited texts, and likenesses."""
    n = F.col("n_chars")
    half = F.floor(n / 2).cast("int")
    df = (with_next(docs, range_rows).withColumn("n_chars", F.length("text"))
          .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
          .withColumn("edited_anchors", anchors(F.col("edited"))))
    return df.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                     as_string(F.col("anchors")).alias("fingerprint"), as_string(F.col("edited_anchors")).alias("edited_fingerprint"),
                     likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
                     likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))
