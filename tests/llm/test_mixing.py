import math
import re

from fareline.llm import mixing


def brute_targets(sizes):
    """Sources in order; water filling by bisection instead of rounds."""
    w, total = [(5, 2, 1)[i % 3] for i in range(len(sizes))], sum(sizes)
    lo, hi = 0.0, 3.0 * total + 1
    for _ in range(300):
        mid = (lo + hi) / 2
        if sum(min(mid * a, 3 * s) for a, s in zip(w, sizes)) < total:
            lo = mid
        else:
            hi = mid
    return [min(hi * a, 3 * s) for a, s in zip(w, sizes)]


def test_share():
    for sizes in ([10, 20, 30], [1000, 1, 1, 1], [0, 5, 0, 7], [1], [0], [], [10 ** 12, 3, 10 ** 6, 17, 0, 999]):
        got = mixing.share(sizes, [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))], sum(sizes))
        for a, b in zip(got, brute_targets(sizes)):
            assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


def check(rows, docs):
    """rows of the report against the texts: (doc_id, text, source)."""
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n(t) for _, t, x in docs if x == s) for s in order}
    target = dict(zip(order, brute_targets([size[s] for s in order])))
    of = {d: (n(t), s) for d, t, s in docs}
    taken = dict.fromkeys(order, 0)
    for r in rows:
        k, s = of[r["doc_id"]]
        assert r["size"] == k and r["source_size"] == size[s]
        assert math.isclose(r["target"], target[s], rel_tol=1e-9, abs_tol=1e-6)
        times = r["taken"] / k if k else 0
        epochs = math.floor(target[s] / size[s] + 1e-9) if size[s] else 0
        assert times in (epochs, epochs + 1) or k == 0
        assert r["taken"] <= 3 * k
        taken[s] += r["taken"]
    largest = {s: max([k for k, x in of.values() if x == s], default=0) for s in order}
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    return taken


def test_whole_table_and_reruns(spark, sf, docs):
    from fareline.llm.queries import op5_mixing

    rows = op5_mixing(spark, sf).collect()
    check(rows, [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    again = mixing.mix_report(docs.repartition(3)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_order_of_the_fraction_is_by_key(spark, docs):
    """Within a source no taken document has a larger key than one left out."""
    df, cs, ck = mixing.measured(docs)
    mix = mixing.mixture(df.select("doc_id", "source", df[cs].alias("size"), df[ck].alias("key")))
    cut = {r["source"]: r["threshold"] for r in mix.collect()}
    rows = mixing.mix_report(docs).collect()
    keys = {r["doc_id"]: (r["source"], r[ck], r[cs]) for r in df.collect()}
    epochs = {r["source"]: r["epochs"] for r in mix.collect()}
    for r in rows:
        s, key, size = keys[r["doc_id"]]
        assert r["taken"] == size * (epochs[s] + (cut[s] is not None and size > 0 and key <= cut[s]))


def test_weights_favour_quality(spark):
    rows = [(i, "plain words here " * 5, "a") for i in range(400)] + [(1000 + i, "### *** $$$ %%% " * 4, "a") for i in range(400)]
    rows += [(5000 + i, "w " * 60, "b") for i in range(100)]
    out = mixing.mix_report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    extra = lambda lo: sum(r["taken"] for r in out if lo <= r["doc_id"] < lo + 400) / sum(r["size"] for r in out if lo <= r["doc_id"] < lo + 400)
    assert extra(0) > extra(1000)


def test_edge_rows(spark, table):
    rows = [(1, None, "a"), (2, "", None), (3, "x y z", None), (4, "one two", "b"), (4, "one two", "b"), (None, "q", "a"), (5, "w " * 100000, "c")]
    df = table(rows)
    out = mixing.mix_report(df).collect()
    assert len(out) == len(rows) and all(r["taken"] <= 3 * r["size"] for r in out)
    staged = mixing.mix(df)
    assert staged.columns == df.columns
    times = {}
    for r in staged.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    want = {}
    for r in out:
        if r["size"]:
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"] // r["size"]
    assert {k: v for k, v in times.items() if k not in (1, 2)} == {k: v for k, v in want.items() if v}
    assert mixing.mix_report(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0
