import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from fareline.llm import trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, role, digest[:32], len(text), text))
    own = {c: [(r, t) for _, _, r, _, _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - c % 100 if c >= 0 else c + (-c) % 100
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute_nodes(seqs):
    members = defaultdict(set)
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    ends = defaultdict(list)
    for c, turns in sorted(seqs.items()):
        ends[tuple(turns)].append(str(c))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(ends[p]).encode()).hexdigest()) for p, m in members.items()), key=str)


def values(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark, sf):
    from fareline.llm.queries import op11_prefix_trie

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert values(op11_prefix_trie(spark, sf)) == brute_nodes(brute_rebuilt(rows))


def conversations(seed, n, words, longest, copies=0):
    rng, rows = random.Random(seed), []
    stem = [("user", rng.choice(words)) for _ in range(longest)]
    for c in range(n):
        own = stem[:rng.randint(0, longest)] + [(rng.choice(["user", "assistant"]), rng.choice(words)) for _ in range(rng.randint(1, 4))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(own)]
    for c in range(n, n + copies):
        rows += [(c, i, r, t) for i, (r, t) in enumerate(stem)]
    return rows


@pytest.mark.parametrize("limit", [1, 7, 60, trie.LIMIT])
def test_bursting_gives_the_same(spark, limit):
    """Long shared beginnings, copies, sequences that end at heads; any container size."""
    rows = conversations(3, 60, ["a", "b", "", "words of the third"], 21, copies=25)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert values(trie.trie_report(df, limit)) == brute_nodes(brute_rebuilt(rows))


def test_heads_with_and_without_ends(spark):
    seqs = {1: "", 2: "", 3: "a", 4: "ab", 5: "ab", 6: "abc", 7: "abd", 8: "b", 9: "abce"}
    rows = [(c, "".join(f"{hashlib.md5(x.encode()).hexdigest()}{ord(x):08x}" for x in s)) for c, s in seqs.items()]
    want = brute_nodes({c: [("", x * ord(x)) for x in s] for c, s in seqs.items()})
    df = spark.createDataFrame(rows, "conv_id long, path string")
    for limit in (1, 3, 6, 100):
        assert values(trie.prefix_trie(df, limit)) == want


def test_digest_of_many_members(spark):
    """Copies over several blocks of ids, negative ones too: digested in the order of the numbers."""
    ids = list(range(-9000, 30001, 3))
    df = spark.createDataFrame([(c, "0" * trie.WIDTH) for c in ids], "conv_id long, path string")
    got = {r["depth"]: r for r in trie.prefix_trie(df).collect()}
    assert got[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert (got[1]["n_convs"], got[1]["conv_id"], got[0]["ends_sha256"]) == (len(ids), -9000, trie.EMPTY)


def test_edge_rows(spark):
    long = "word " * 50000
    rows = [(None, 1, "user", "lost"), (5, None, None, None), (5, 1, "user", long), (5, 1, "user", long), (5, 1, "assistant", "tie"),
            (100, 0, "user", None), (150, 0, "user", None), (-7, 2, None, "x"), (-100, 0, "user", "y"), (-107, 0, "user", "y"), (300, None, "", "")]
    wide = [(*r, "x", None, 1) for r in rows]
    df = spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, path string, head string, depth int")
    want = brute_nodes(brute_rebuilt(rows))
    assert values(trie.trie_report(df)) == want
    assert values(trie.trie_report(df, 2)) == want
    assert trie.trie_report(df.limit(0)).count() == 0
