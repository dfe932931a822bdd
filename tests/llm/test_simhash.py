import numpy as np
import pytest

from fareline.llm import components, simhash

from .brute import brute_components, brute_print


def test_whole_table_against_brute_force(spark, sf, docs):
    from fareline.llm.queries import op1_simhash

    got = {r["doc_id"]: r for r in op1_simhash(spark, sf).collect()}
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{f:016x}" for d, f in rows}
    assert {d: r["component_id"] for d, r in got.items()} == brute_components(rows, 2)


@pytest.mark.parametrize("k", [0, 1, 2])
def test_links_connect_what_all_pairs_connect(spark, k):
    rng = np.random.default_rng(k)
    centers = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = set(int(c) for c in centers)
    for c in centers:           # chains and clouds of flips, top bit included
        x = int(c)
        for _ in range(25):
            x ^= 1 << int(rng.integers(0, 64)) if rng.random() < 0.7 else (1 << int(rng.integers(0, 64))) | (1 << int(rng.integers(0, 64)))
            fps.add(x)
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    signed = [(i, f - (1 << 64) if f >= 1 << 63 else f) for i, f in rows]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    comp = {r["fp"] % (1 << 64): r["component_id"] for r in simhash.groups(df, k).collect()}
    want = brute_components(rows, k)
    assert {i: comp[f] for i, f in rows} == want


def test_bad_distance(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_edge_rows(spark, table):
    long = "word " * 70000
    df = table([(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (5, "one  TWO"), (None, "one two"), (9, long)])
    rows = simhash.simhash_report(df).collect()
    assert len(rows) == 8
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert {by[i][0]["fingerprint"] for i in (1, 2, 3)} == {"0" * 16}
    assert {by[i][0]["component_id"] for i in (1, 2, 3)} == {1}
    assert len(by[5]) == 2 and {r["component_id"] for i in (4, 5, None) for r in by[i]} == {4}
    assert by[9][0]["fingerprint"] == f"{brute_print(long):016x}"
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect())) == [1, 4, 9]
    assert simhash.simhash_report(df.limit(0)).count() == 0
    assert simhash.keep_first(df.limit(0)).count() == 0


@pytest.mark.parametrize("bucket", [1, 4, simhash.MAX_BUCKET])
@pytest.mark.parametrize("k", [1, 2])
def test_hot_buckets(spark, k, bucket):
    """Hundreds of fingerprints that share a half, and others one bit off that half: the same components as all
    pairs whether buckets are split or not, and edges that do not grow with a bucket's square."""
    rng = np.random.default_rng(7 * k + bucket)
    fps = set()
    for upper in (0xDEADBEEF, 0xDEADBEEF ^ 4, 0x12345678):
        lower = rng.integers(0, 1 << 32, 6, dtype=np.uint64)
        for _ in range(250):
            x = int(rng.choice(lower))
            for bit in rng.integers(0, 9, int(rng.integers(0, 4))):
                x ^= 1 << int(bit)
            fps.add(upper << 32 | x)
    fps |= {(f & 0xFFFFFFFF) << 32 | f >> 32 for f in list(fps)[:200]}
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    df = spark.createDataFrame([(f - (1 << 64) if f >= 1 << 63 else f,) for _, f in rows], "fp long")
    edges = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, k, bucket).collect()}
    assert all(1 <= (a ^ b).bit_count() <= k for a, b in edges)
    assert len(edges) <= 64 * len(fps)
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    number = {f: i for i, f in rows}
    assert {i: number[find(f)] for i, f in rows} == brute_components(rows, k)


@pytest.fixture
def plans(monkeypatch):
    """The plans of all tables that the operator writes."""
    seen = []
    for module in (simhash, components):
        known = module.written
        monkeypatch.setattr(module, "written", lambda df, name, known=known: seen.append(df._jdf.queryExecution().executedPlan().toString()) or known(df, name))
    return seen


@pytest.mark.parametrize("bucket", [1, 32])
def test_joins_of_the_documents_never_broadcast(spark, table, plans, monkeypatch, bucket):
    """Tables of the documents, small as they look, stay off the driver: a broadcast side is sized before its 66 probes a row."""
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", -1)      # the list of split buckets too is taken for a long one
    monkeypatch.setattr(simhash.links, "__defaults__", (simhash.MAX_DISTANCE, bucket))
    df = table([(i, f"one two three four {i % 7} five six seven {i % 3}") for i in range(60)])
    found = simhash.simhash_report(df)
    assert found.count() == 60
    kept = simhash.keep_first(df)       # the stage of the pipeline
    assert 0 < kept.count() < 60
    plans.append(kept._jdf.queryExecution().executedPlan().toString())
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 5
    assert not [p for p in plans if "Broadcast" in p]
