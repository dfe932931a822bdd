"""Prefix trie of conversations, built as a burst trie.

A turn is an id of fixed width (digest of role and text, and the text's length), a
conversation the string of its turns' ids; conversations with the same turns are
one sequence with its members' number, least id and digest from the start, so copies cost nothing further on.

A container holds the suffixes of the sequences that share a trie head. It begins as the root's. A container of more than
``limit`` turns bursts: its head becomes a node of the upper trie and each next turn id gets a container of
its own. The sizes of 1, 2, 4 ... levels below are counted in one aggregate per round, so a
prefix shared by many takes as many rounds as the logarithm of its length. What is left, at most ``limit`` turns or one
sequence, is dealt to shards by head, sorted, and swept: neighbours' common prefix says which nodes
are open, and counts go from a node to its parent when it closes. Heads get theirs from the tops of their containers, added
up once per head and then along its path.

Defined results: rows order by turn (null first), then role, then turn id; repeated rows stay turns of
their own; null role or text is empty; rows without a conv_id belong to no conversation; an empty table has no nodes, not
even a root; other columns are not looked at. Texts are whole. A conversation's ids (40 bytes a turn), not its texts, meet in one row.
"""

from __future__ import annotations

import hashlib
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text, written

WIDTH = 40                  # characters of a turn id: 32 of the digest, 8 of the length, in hexadecimal
LIMIT = 200_000             # turns of a container
BLOCK_BITS = 12             # conv_ids that agree but for these bits are digested as one row
BROADCAST_ROWS = 10_000     # heads up to which they are broadcast
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    role, text = whole_text(role), whole_text(text)
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, WIDTH - 8), F.lpad(F.lower(F.hex(F.length(text))), 8, "0"))


def first_turns(path: Column, n: Column) -> Column:
    return F.substring(path, F.lit(1), n * WIDTH)


def n_turns(path: Column) -> Column:
    return F.length(path).cast("int") / F.lit(WIDTH)


def sequences(conv: DataFrame) -> DataFrame:
    """conv_id, path: the ids of its turns in order."""
    rows = (conv.where("conv_id IS NOT NULL")
            .select("conv_id", "turn", whole_text(F.col("role")).alias("role"), turn_id(F.col("role"), F.col("text")).alias("id")))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "id")))
    return rows.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t["id"]), "").alias("path"))


def rebuilt(conv: DataFrame) -> DataFrame:
    """conv_id, path of every conversation c after its first h turns became those of conversation c - c % 100."""
    own = written(sequences(conv), "trie-own")
    most = 5
    heads = (own.where(F.col("conv_id") % 100 == 0)
             .select(F.col("conv_id").alias("head_id"), first_turns(F.col("path"), F.lit(most)).alias("head")))
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string")) % (most + 1)).cast("int")
    path = F.concat(first_turns(F.coalesce("head", F.lit("")), h), F.substring(F.col("path"), h * WIDTH + 1, F.length("path")))
    return own.join(heads, c - c % 100 == F.col("head_id"), "left").select("conv_id", path.alias("path"))


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """path, turns, n, least, ends: each distinct sequence with its members' number, least id and the digest of their ids.

    Ids are gathered in blocks of neighbours first; a digest reads its blocks one after another, as SHA-256
    has to, and holds none of them."""
    blocks = (seqs.groupBy("path", F.shiftright("conv_id", BLOCK_BITS).alias("block"))
              .agg(F.sort_array(F.collect_set("conv_id")).alias("ids")))

    def digest(batches):
        now, state, n, least = None, None, 0, None
        for batch in batches:
            out = []
            for path, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != now:
                    if now is not None:
                        out.append((now, n, least, state.hexdigest()))
                    now, state, n, least = path, hashlib.sha256(), 0, ids[0]
                state.update(b"," * (n > 0) + ",".join(map(str, ids)).encode())
                n += len(ids)
            yield _batch(out, _SEQUENCE)
        if now is not None:
            yield _batch([(now, n, least, state.hexdigest())], _SEQUENCE)

    each = blocks.repartition("path").sortWithinPartitions("path", "block").select("path", "ids")
    return each.mapInArrow(digest, "path string, n long, least long, ends string").withColumn("turns", n_turns(F.col("path")).cast("int"))


_SEQUENCE = pa.schema([("path", pa.string()), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())])
_NODE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                   ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
                   ("head", pa.string())])
_NODE_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
             "ends_sha256 string, head string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _small(df: DataFrame) -> DataFrame:
    """A written table of heads, broadcast when it has been counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def burst(seqs: DataFrame, limit: int) -> DataFrame:
    """``seqs`` with ``top``, the depth of its container's top node; turns + 1 for a sequence that ends at a head."""
    todo, done, levels, deepest = seqs.withColumn("top", F.lit(0)), [], 1, F.col("deepest")
    while True:
        below = F.least(F.col("top") + F.lit(levels - 1), F.col("turns"))
        at = (todo.select("path", "turns", F.explode(F.sequence(F.col("top"), below)).alias("d"))
              .withColumn("prefix", first_turns(F.col("path"), F.col("d"))))
        large = written(at.groupBy("prefix").agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("turns").cast("long") + 1).alias("w"))
                        .where((F.col("c") > 1) & (F.col("w") > limit)).select("prefix"), "trie-large")
        if large.isEmpty():
            break
        # the heads on a sequence's path are the first of its prefixes, so the deepest says where its container is
        down = (at.join(_small(large), "prefix", "left_semi").groupBy("path").agg(F.max("d").alias("deepest"))
                .withColumnRenamed("path", "of"))
        moved = written(todo.join(down, F.col("path") == F.col("of"), "left")
                        .withColumn("more", F.coalesce((deepest == below) & (deepest < F.col("turns")), F.lit(False)))
                        .withColumn("top", F.coalesce(deepest + 1, F.col("top"))).drop("of", "deepest"), "trie-round")
        done.append(moved.where("NOT more").drop("more"))
        todo = moved.where("more").drop("more")
        levels *= 2
    out = todo
    for d in done:
        out = out.unionByName(d)
    return out


def sweep_container(rows: list[tuple[str, int, int, str]], top: int) -> list[tuple]:
    """The nodes from depth ``top`` on of sorted sequences (path, n, least, ends) that share the turns up to there."""
    depth, parent, n, least, ends, chars, open_, before = [], [], [], [], [], [], [], ""
    for path, members, first, digest in rows:
        del open_[max(0, len(commonprefix((before, path))) // WIDTH - top + 1):]
        for d in range(top + len(open_), len(path) // WIDTH + 1):
            parent.append(open_[-1] if open_ else -1)
            open_.append(len(depth))
            depth.append(d)
            chars.append(int(path[d * WIDTH - 8:d * WIDTH], 16) if d else 0)
            n.append(0)
            least.append(None)
            ends.append(EMPTY)
        here, before = open_[-1], path
        n[here], least[here], ends[here] = members, first, digest
    kids, leaves, saved = [0] * len(n), [0] * len(n), [0] * len(n)
    for i in range(len(n) - 1, -1, -1):         # children come after their parent
        leaves[i] = leaves[i] or 1
        saved[i] += (n[i] - 1) * chars[i]
        p = parent[i]
        if p >= 0:
            n[p] += n[i]
            least[p] = least[i] if least[p] is None else min(least[p], least[i])
            kids[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    head = rows[0][0][:(top - 1) * WIDTH] if top else None
    return [(least[i], depth[i], least[p] if (p := parent[i]) >= 0 else None, n[i], kids[i], leaves[i], saved[i], ends[i], head if p < 0 else None)
            for i in range(len(n))]


def sweep(containers: DataFrame) -> DataFrame:
    """The nodes of all containers; ``head`` is the path of the trie head above, on a container's top node only."""
    def run(batches):
        key, top, rows = None, 0, []
        for batch in batches:
            out = []
            for path, at, *rest in zip(*(batch.column(i).to_pylist() for i in range(5))):
                mine = path[:at * WIDTH]
                if mine != key:
                    if rows:
                        out += sweep_container(rows, top)
                    key, top, rows = mine, at, []
                rows.append((path, *rest))
            if out:
                yield _batch(out, _NODE)
        if rows:
            yield _batch(sweep_container(rows, top), _NODE)

    return (containers.select("path", "top", "n", "least", "ends").withColumn("shard", first_turns(F.col("path"), F.col("top")))
            .repartition("shard").sortWithinPartitions("path").drop("shard").mapInArrow(run, _NODE_DDL))


def heads_of(nodes: DataFrame, ended: DataFrame) -> DataFrame:
    """prefix and the columns of a node (but the parent) of every trie head, from the tops of its containers and the
    sequences that end at it."""
    tops = (nodes.where("head IS NOT NULL").groupBy("head")
            .agg(F.sum("n_convs").alias("n"), F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("kids"),
                 F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).withColumn("ends", F.lit(None).cast("string")))
    own = tops.unionByName(ended.select(F.col("path").alias("head"), "n", "least", *[F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")], "ends"))
    depth = n_turns(F.col("head")).cast("int")
    here = F.col("d") == F.col("depth")
    each = (own.withColumn("depth", depth).withColumn("d", F.explode(F.sequence(F.lit(0), F.col("depth"))))
            .groupBy(first_turns(F.col("head"), F.col("d")).alias("prefix"))
            .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.sum(F.when(here, F.col("kids")).otherwise(0)).alias("kids"),
                 F.sum("leaves").alias("leaves"), F.sum("saved").alias("below"), F.max(F.when(here, F.col("ends"))).alias("ends")))
    each = written(each.withColumn("depth", n_turns(F.col("prefix")).cast("int")), "trie-heads")
    chars = F.when(F.col("depth") > 0, F.conv(F.substring(F.col("prefix"), F.length("prefix") - 7, F.lit(8)), 16, 10).cast("long")).otherwise(0)
    mine = each.withColumn("own", (F.col("n") - 1) * chars)
    saved = (mine.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("depth"))))
             .groupBy(first_turns(F.col("prefix"), F.col("d")).alias("p")).agg(F.sum("own").alias("own")))
    kids = each.where("depth > 0").groupBy(first_turns(F.col("prefix"), F.col("depth") - 1).alias("q")).agg(F.count(F.lit(1)).alias("more"))
    up = each.select(F.col("prefix").alias("u"), F.col("least").alias("parent_conv_id"))
    out = (each.join(saved, F.col("prefix") == F.col("p")).join(kids, F.col("prefix") == F.col("q"), "left")
           .join(up, (F.col("depth") > 0) & (first_turns(F.col("prefix"), F.col("depth") - 1) == F.col("u")), "left"))
    return written(out.select("prefix", F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
                              (F.col("kids") + F.coalesce("more", F.lit(0))).alias("n_children"), F.col("leaves").alias("n_leaves"),
                              (F.col("below") + F.col("own")).alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256")), "trie-upper")


def prefix_trie(seqs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of ``seqs`` (conv_id, path): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    each = written(distinct_sequences(seqs), "trie-sequences")
    placed = burst(each, limit)
    nodes = written(sweep(placed.where("top <= turns")), "trie-nodes")
    columns = nodes.columns[:-1]
    upper = heads_of(nodes, placed.where("top > turns"))
    tops = (nodes.where("head IS NOT NULL").drop("parent_conv_id")
            .join(_small(upper.select(F.col("prefix").alias("head"), F.col("conv_id").alias("parent_conv_id"))), "head"))
    return nodes.where("head IS NULL").select(columns).unionByName(tops.select(columns)).unionByName(upper.select(columns))


def trie_report(conv: DataFrame, limit: int = LIMIT) -> DataFrame:
    return prefix_trie(rebuilt(conv), limit)


_STEP = "lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END"
_CRC = (f"xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), "
        f"lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), {_STEP}), 4294967295)")
SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''),
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (SELECT *, CAST({_CRC} % 6 AS BIGINT) AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS path
  FROM h c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), nodes AS (
  SELECT path[1:d] AS p, d AS depth, count(*) AS n, min(conv_id) AS least,
    CASE WHEN d > 0 THEN (count(*) - 1) * any_value(length(path[d].text)) ELSE 0 END AS own,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = d), '')) AS ends
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt) GROUP BY 1, 2
), kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_ AS (SELECT nodes.*, coalesce(kids.n, 0) AS kids FROM nodes LEFT JOIN kids USING (p)),
sums AS (
  SELECT p[1:d] AS p, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum(own) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_) GROUP BY 1
)
SELECT f.least AS conv_id, f.depth, u.least AS parent_conv_id, f.n AS n_convs, f.kids AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM full_ f JOIN sums s USING (p) LEFT JOIN nodes u ON f.depth > 0 AND u.p = f.p[1:f.depth - 1]
"""
