"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit for each bit of its shingles' XXH64 values:
set when over half of them have it set. Two fingerprints link when they differ
in at most ``max_distance`` (0 to 2) bits.

Each distinct fingerprint is in two tables, under its upper and under its lower half. Of two fingerprints within two
bits, one half differs in at most one; so each fingerprint probes both tables with the Hamming ball of
radius one of its own half (33 values), fetches what lies there and verifies the complete distance.

Near copies can share a half by the thousand, and a bucket's pairs grow with its square. A bucket of more than ``MAX_BUCKET``
is therefore split by a second index on the other half: its members are entered under the radius-one ball of that half,
33 entries each. Members of one entry are within two bits of each other, so each links to the least of the entry; an entry is a
bit mask and a flag, combined on the map side, whatever the bucket's size. A probe that has spent one bit
asks the entry of its own other half, whose members are one bit from it at most. So no group makes all its pairs, and none is cut.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and links like any other; fewer words than a shingle are one
shingle; equal rows share a fingerprint and a component; a null doc_id never
names a component unless all are null; an empty table gives an empty table;
other columns are not looked at. Texts are hashed whole.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, by_merge, fresh, release, written
from .components import connected_components

SHINGLE = 3
MAX_DISTANCE = 2
SEED = 42
HALF = 32
MAX_BUCKET = 32         # members of a bucket that a probe fetches one by one
BROADCAST_ROWS = 10_000     # split buckets up to which they are broadcast
CHUNK = 1 << 16         # shingles whose hashes are held at once


def fingerprint_of(text: bytes, k: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole UTF-8 text."""
    words = text.lower().split()        # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    at = list(accumulate(map(len, words), lambda a, n: a + n + 1, initial=0))
    n = max(1, len(words) - k + 1)
    ends = at[k:] if len(words) >= k else at[-1:]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for i in range(0, n, CHUNK):
        raw = b"".join([digest(line[a:b - 1], SEED) for a, b in zip(at[i:i + CHUNK], ends[i:i + CHUNK])])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint(text: Column, k: int = SHINGLE) -> Column:
    """The fingerprint as a (signed) long."""
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        release()
        prints = np.array([fingerprint_of(t or b"", k) for t in texts.cast(pa.binary()).to_pylist()], np.uint64)
        return pa.array(prints.view(np.int64))

    return run(text)


def halves(fp: Column) -> Column:
    """Array of struct(seg, value, other): the upper and the lower half as keys, each with the other one."""
    upper, lower = F.shiftrightunsigned(fp, HALF), fp.bitwiseAND(F.lit((1 << HALF) - 1))
    def entry(seg: int, value: Column, other: Column) -> Column:
        return F.struct(F.lit(seg).alias("seg"), value.alias("value"), other.alias("other"))
    return F.array(entry(0, upper, lower), entry(1, lower, upper))


def whole(seg: Column, value: Column, other: Column) -> Column:
    """The fingerprint of which ``value`` is the half number ``seg``."""
    return F.when(seg == 0, F.shiftleft(value, HALF).bitwiseOR(other)).otherwise(F.shiftleft(other, HALF).bitwiseOR(value))


def ball(value: Column, radius: int) -> Column:
    """Array of struct(at, flip): the half itself (flip -1) and, for radius one, its 32 neighbours."""
    near = [F.struct(value.alias("at"), F.lit(-1).alias("flip"))]
    for bit in range(HALF if radius else 0):
        near.append(F.struct(value.bitwiseXOR(F.lit(1 << bit)).alias("at"), F.lit(bit).alias("flip")))
    return F.array(*near)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect exactly what
    links of at most ``max_distance`` bits connect."""
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance is 0, 1 or 2")
    entries = prints.select(F.inline(halves(F.col("fp"))))
    large = written(entries.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_bucket).select("seg", "value"), "sim-large")
    split = F.broadcast(large) if large.count() <= BROADCAST_ROWS else by_merge(large)
    # the half that differs less differs in no bit for distances 0 and 1, in one at most for 2
    probes = (entries.select("seg", "other", F.inline(ball(F.col("value"), max_distance // 2)))
              .withColumnRenamed("at", "value").withColumn("spent", (F.col("flip") >= 0).cast("int"))
              .withColumn("fp", whole(F.col("seg"), F.when(F.col("flip") < 0, F.col("value")).otherwise(
                  F.col("value").bitwiseXOR(F.expr("shiftleft(1L, greatest(flip, 0))"))), F.col("other"))))
    table = entries.join(split, ["seg", "value"], "left_anti").groupBy("seg", "value").agg(F.collect_list("other").alias("others"))
    fetched = (probes.select("seg", "value", "fp").join(by_merge(table), ["seg", "value"])      # 66 probes a fingerprint, sized as one
               .select("fp", F.explode(F.transform("others", lambda o: whole(F.col("seg"), F.col("value"), o))).alias("b")))
    found = fetched.where((F.col("b") < F.col("fp")) & (distance(F.col("fp"), F.col("b")) <= max_distance)).select(F.col("fp").alias("a"), "b")
    if large.isEmpty():
        return found
    return found.unionByName(split_links(entries.join(split, ["seg", "value"], "left_semi"), probes.join(split, ["seg", "value"], "left_semi"), max_distance))


def split_links(entries: DataFrame, probes: DataFrame, max_distance: int) -> DataFrame:
    """The edges that buckets with a second index give: ``entries`` are their members, ``probes`` what asks them."""
    own = F.col("flip") < 0
    index = (entries.select("seg", "value", F.inline(ball(F.col("other"), min(1, max_distance))))
             .groupBy("seg", "value", "at").agg(
                 F.bit_or(F.when(own, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, greatest(flip, 0))"))).alias("mask"),
                 F.bool_or(own).alias("own")))
    index = written(index.where((F.bit_count("mask") + F.col("own").cast("int")) >= (1 if max_distance == 2 else 2)), "sim-index")
    flipped = F.transform(F.filter(F.sequence(F.lit(0), F.lit(HALF - 1)), lambda i: F.getbit(F.col("mask"), i) == 1),
                          lambda i: F.col("at").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    members = F.when(F.col("own"), F.concat(F.array("at"), flipped)).otherwise(flipped)
    # for distance 1 only the entry's own fingerprint is near enough to every other member
    hub = F.col("at") if max_distance == 1 else F.array_min("members")
    full = index.where(F.col("own") | F.lit(max_distance == 2)).withColumn("members", members).withColumn("hub", whole(F.col("seg"), F.col("value"), hub))
    inside = full.select(F.col("hub").alias("b"), F.explode(F.transform("members", lambda m: whole(F.col("seg"), F.col("value"), m))).alias("a"))
    edges = inside.where((F.col("a") != F.col("b")) & (distance(F.col("a"), F.col("b")) <= max_distance))
    if max_distance < 2:
        return edges
    asked = (probes.where("spent = 1").join(by_merge(full.withColumnRenamed("at", "other")), ["seg", "value", "other"])
             .select(F.col("fp").alias("a"), F.col("hub").alias("b")))
    return edges.unionByName(asked.where(distance(F.col("a"), F.col("b")) <= max_distance))


def groups(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, component_id, first) per distinct fingerprint of ``prints`` (doc_id, fp):
    the smallest doc_id of the component, and struct(doc_id is null, doc_id, fp) of its first document."""
    per = written(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("first")), "sim-prints")
    comp = written(connected_components(links(per.select("fp"), max_distance)), "sim-comp")
    rooted = per.join(by_merge(comp), F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "sim-rooted")
    roots = written(rooted.groupBy("root").agg(F.min("first").alias("least")), "sim-roots")
    return written(rooted.join(by_merge(roots), "root").select("fp", F.col("least.doc_id").alias("component_id"), F.col("least").alias("first")), "sim-groups")


def simhash_report(docs: DataFrame, k: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    arrow_batches(docs.sparkSession)
    prints = written(docs.select("doc_id", fingerprint(F.col("text"), k).alias("fp")), "sim-docs")
    of = groups(prints, max_distance).select("fp", "component_id")
    return (prints.join(by_merge(of), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_first(docs: DataFrame, k: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Deduplicating stage: the columns of ``docs``, one document of each component
    (the smallest doc_id; of rows equal in it and in fingerprint any one).

    Texts are hashed once: the rows are written with their fingerprint and a number. Everything up to the
    numbers of the rows to keep works on the narrow columns; then the texts meet those numbers in one join."""
    arrow_batches(docs.sparkSession)
    cf, cr = fresh(docs, "fp", "row")
    marked = written(docs.withColumn(cf, fingerprint(F.col("text"), k)).withColumn(cr, F.monotonically_increasing_id()), "sim-docs")
    prints = marked.select("doc_id", F.col(cf).alias("fp"), F.col(cr).alias("row"))
    of = groups(prints.select("doc_id", "fp"), max_distance).select("fp", "component_id", "first")
    heads = of.groupBy("component_id", "first").agg(F.count(F.lit(1)).alias("n")).select("first.doc_id", "first.fp")
    rows = prints.groupBy("doc_id", "fp").agg(F.min("row").alias("keep_row"))       # repeated rows become one before the join
    keep = rows.alias("r").join(by_merge(heads.alias("h")), F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("r.fp") == F.col("h.fp")), "left_semi")
    keep = written(keep.select("keep_row"), "sim-keep")
    return marked.join(by_merge(keep), F.col(cr) == F.col("keep_row"), "left_semi").select(*docs.columns)
