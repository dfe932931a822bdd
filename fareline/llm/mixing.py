"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a weight; together the sources share a budget of words. A
source's target is its share, at most ``MAX_EPOCHS`` times its size; what is
above is shared again by weight. A target of e whole epochs and a rest takes
every document e times, then documents in the order of exponential keys
(``-ln(u) / w``: u a hash of the document as a uniform number, w its quality weight) until
their sizes fill the rest. Documents are taken whole: the last one is
taken when that brings the sum nearer to the rest.

The order within a source is a range shuffle on (source, key), so a source with
a third of all rows is dealt over many tasks; sums by (partition, source) find
the partition in which a source's rest runs out, and only there a running sum
is needed. What results is one threshold key per source, and a document's
decision is a comparison with it. A mixture is a configuration with one entry
per source; that table alone goes to the driver, its size is checked.

Defined results: a null text has no words and is taken with size 0 (0 words); a null
source is a source of its own, last in order; rows equal in doc_id and text
share a key and a decision; equal keys go together; an empty table gives an
empty table; other columns are not looked at. Sizes count whole texts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, fresh, release, written

SOURCE_WEIGHTS = (5.0, 2.0, 1.0)    # repeating, by code point order of the sources
MAX_EPOCHS = 3
MAX_SOURCES = 1_000_000             # entries of a mixture's configuration
SEED = 17


def measure(text: Column) -> Column:
    """struct(size, junk): words (runs without ASCII white space) and symbol characters of the whole text."""
    @F.arrow_udf("struct<size long, junk long>")
    def run(texts: pa.Array) -> pa.Array:
        release()
        size, junk = [], []
        for t in texts.cast(pa.binary()).to_pylist():
            t = t or b""
            size.append(len(t.split()))
            junk.append(len(t) - len(t.translate(None, b"#*$%&|<>")))
        return pa.StructArray.from_arrays([pa.array(size, pa.int64()), pa.array(junk, pa.int64())], ["size", "junk"])

    return run(text)


def quality_weight(size: Column, junk: Column) -> Column:
    """In (0, 1]: less for texts with many symbols per word."""
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * junk / F.greatest(size, F.lit(1)))


def sample_key(doc_id: Column, text: Column, weight: Column, seed: int = SEED) -> Column:
    """Exponential key of rate ``weight``; the uniform number is a hash of the
    document, so it is the same on every run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, F.xxhash64(text)), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / weight


def measured(docs: DataFrame, seed: int = SEED) -> tuple[DataFrame, str, str]:
    """``docs`` with size and key, and the names of the two columns."""
    arrow_batches(docs.sparkSession)
    cm, cs, ck = fresh(docs, "measure", "size", "key")
    m = F.col(cm)
    df = docs.withColumn(cm, measure(F.col("text")))
    key = sample_key(F.col("doc_id"), F.col("text"), quality_weight(m["size"], m["junk"]), seed)
    return df.withColumn(cs, m["size"]).withColumn(ck, key).drop(cm), cs, ck


def share(sizes: list[int], weights: list[float], budget: float, cap: float = MAX_EPOCHS) -> list[float]:
    """Targets: the budget by weight, at most cap times the size, the excess
    shared again by weight until no target is above."""
    targets, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(budget)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
        left -= sum(targets[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def targets(narrow: DataFrame, weights=SOURCE_WEIGHTS) -> DataFrame:
    """source, source_size, target, epochs, rest: one row per source."""
    spark = narrow.sparkSession
    by_source = narrow.groupBy("source").agg(F.sum("size").alias("n"))
    rows = by_source.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"a mixture has at most {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))    # code point order
    sizes = [r["n"] for r in rows]
    goal = share(sizes, [weights[i % len(weights)] for i in range(len(rows))], sum(sizes))
    out = []
    for r, n, t in zip(rows, sizes, goal):
        epochs = int(t // n) if n else 0
        out.append((r["source"], n, t, epochs, t - epochs * n))
    return spark.createDataFrame(out, "source string, source_size long, target double, epochs int, rest double")


def thresholds(narrow: DataFrame, goals: DataFrame) -> DataFrame:
    """source, threshold: the largest key that is taken once more (null: none)."""
    ranged = (narrow.where("size > 0").repartitionByRange("source", "key")
              .select("source", "key", "size", F.spark_partition_id().alias("part")))
    ranged = written(ranged, "mix-ranged")
    sums = written(ranged.groupBy("source", "part").agg(F.sum("size").alias("n")), "mix-sums")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    at = (sums.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).alias("s")
          .join(F.broadcast(goals.alias("g")), same("s", "g"))
          .where("before < rest")
          .select("s.source", "part", "before", "n", "rest"))
    last = (at.groupBy("source").agg(F.max(F.struct("part", "before", "rest")).alias("x"))
            .select("source", "x.*"))
    run = Window.partitionBy("r.source").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    inside = (ranged.alias("r").join(F.broadcast(last.alias("l")), same("r", "l") & (F.col("r.part") == F.col("l.part")))
              .withColumn("upto", F.col("before") + F.sum("size").over(run))
              .select("r.source", "key", "upto", "rest",
                      (F.col("upto") - F.sum("size").over(Window.partitionBy("r.source", "key"))).alias("below")))
    # the last key is taken when that leaves less than leaving it out; without any
    # key taken in this partition the threshold lies before it
    taken = inside.where((F.col("upto") <= F.col("rest")) | (F.col("upto") - F.col("rest") < F.col("rest") - F.col("below")))
    here = taken.groupBy("source").agg(F.max("key").alias("here"))
    earlier = (ranged.alias("r").join(F.broadcast(last.alias("l")), same("r", "l") & (F.col("r.part") < F.col("l.part")))
               .groupBy("r.source").agg(F.max("key").alias("earlier")))
    out = last.alias("l").join(here.alias("h"), same("l", "h"), "left").join(earlier.alias("e"), same("l", "e"), "left")
    return out.select("l.source", F.coalesce("here", "earlier").alias("threshold"))


def mixture(narrow: DataFrame) -> DataFrame:
    """source, source_size, target, epochs, threshold: the whole mix, one row per source."""
    goals = targets(narrow)
    cut = thresholds(narrow, goals)
    return written(goals.alias("g").join(cut.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source")), "left")
                   .select("g.source", "source_size", "target", "epochs", "threshold"), "mix")


def times(size: Column, key: Column, epochs: Column, threshold: Column) -> Column:
    """How often a document is taken, by the epochs and threshold of its source."""
    return epochs + ((size > 0) & F.coalesce(key <= threshold, F.lit(False))).cast("int")


def mix_report(docs: DataFrame) -> DataFrame:
    df, cs, ck = measured(docs.select("doc_id", "text", "source"))
    narrow = written(df.select("doc_id", "source", F.col(cs).alias("size"), F.col(ck).alias("key")), "mix-narrow")
    plan = mixture(narrow).withColumnRenamed("source", "of")
    n = times(F.col("size"), F.col("key"), F.col("epochs"), F.col("threshold"))
    return (narrow.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * n).alias("taken")))


def mix(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the columns of ``docs``, each row as often as it is taken.

    The rows are measured once and written with size and key; the mix is made from the narrow
    columns, and only the table of sources is joined to the texts: no text is shuffled.
    """
    df, cs, ck = measured(docs)
    df = written(df, "mix-docs")
    narrow = df.select("doc_id", "source", F.col(cs).alias("size"), F.col(ck).alias("key"))
    plan = mixture(narrow)
    of, epochs, threshold, copy = fresh(df, "of", "epochs", "threshold", "copy")
    plan = plan.select(F.col("source").alias(of), F.col("epochs").alias(epochs), F.col("threshold").alias(threshold))
    n = times(F.col(cs), F.col(ck), F.col(epochs), F.col(threshold))
    return (df.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col(of))).where(n > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), n))).select(*docs.columns))
