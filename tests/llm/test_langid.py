import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from fareline.llm import langid

PIECES = ["▁", "▁a", "▁ab", "a", "b", "ab", "aba", "ba", langid.UNKNOWN]


def segmentations(s, vocab):
    if not s:
        yield []
        return
    hit = False
    for j in range(1, len(s) + 1):
        if s[:j] in vocab:
            hit = hit or j == 1
            for rest in segmentations(s[j:], vocab):
                yield [s[:j], *rest]
    if not hit:
        for rest in segmentations(s[1:], vocab):
            yield [langid.UNKNOWN, *rest]


def test_forward_sums_all_segmentations():
    probs = np.random.default_rng(0).random((len(PIECES), 3)) * 0.3
    words = ["a", "b", "ab", "abab", "xaby", "ababababab", "ñ", "aba"]
    got = langid.forward(words, langid.Pieces(PIECES), np.log(probs))
    for w, ll in zip(words, got):
        for lang in range(3):
            want = sum(math.prod(probs[PIECES.index(p), lang] for p in seg) for seg in segmentations("▁" + w, set(PIECES)))
            assert math.isclose(ll[lang], math.log(want), rel_tol=1e-9)


def test_forward_on_long_words():
    logp = np.log(np.array([(1e-8, 1e-3)] * len(PIECES)))
    one, two = langid.forward(["b" * 5000, "b" * 10000], langid.Pieces(PIECES), logp)
    assert np.isfinite(one).all() and np.isfinite(two).all()
    assert math.isclose(two[0] - one[0], 5000 * math.log(1e-8), rel_tol=1e-9)


def test_expected_counts_against_enumeration():
    probs = np.linspace(0.05, 0.4, len(PIECES))
    lookup = langid.Pieces(PIECES)
    for w in ("abab", "axb"):
        into, total, want = {}, 0.0, {}
        langid.expected(lookup.arcs(w), probs, 2.0, into)
        for seg in segmentations("▁" + w, set(PIECES)):
            p = math.prod(probs[PIECES.index(x)] for x in seg)
            total += p
            for x in seg:
                want[PIECES.index(x)] = want.get(PIECES.index(x), 0.0) + 2.0 * p
        assert into.keys() == want.keys()
        assert all(math.isclose(into[k], want[k] / total, rel_tol=1e-9) for k in want)


def test_expected_counts_of_long_words():
    """A word whose likelihood is no plain number teaches like a short one, and both ways of counting agree."""
    lookup = langid.Pieces(PIECES)
    short, long, both = {}, {}, {}
    probs = np.linspace(0.05, 0.4, len(PIECES))
    langid.expected(lookup.arcs("ababxab"), probs, 2.0, short)
    langid._expected_scaled(lookup.arcs("ababxab"), probs, 2.0, both)
    assert short.keys() == both.keys() and all(math.isclose(short[k], both[k], rel_tol=1e-9) for k in short)
    langid.expected(lookup.arcs("b" * 3000), np.full(len(PIECES), 3e-5), 2.0, long)
    assert math.isclose(long[PIECES.index("b")], 6000, rel_tol=1e-6) and math.isclose(long[PIECES.index("▁")], 2, rel_tol=1e-6)


def test_held_out_accuracy(spark, sf, docs):
    from fareline.llm.queries import op2_langid

    rows = op2_langid(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)


def test_label_and_ids_are_no_input(spark, docs):
    """Another label on the held-out rows, another source: the same predictions."""
    small = docs.where("length(text) < 3000").limit(150)
    changed = small.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    a, b = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.lang_report(d).collect()} for d in (small, changed))
    assert a == b


def test_edge_rows(spark, table):
    fr, en = "les maisons étaient très grandes ", "the houses were very large and "
    rows = [(i, (fr if i % 2 else en) * 3, "s", "fr" if i % 2 else "en") for i in range(2, 40)]
    rows += [(100, None, None, "en"), (101, "", None, None), (102, " 12 !? ", None, "en"), (103, en * 4000, None, None), (None, fr, None, None), (5, fr * 3, "s", "fr"), (104, "東京" * 3, None, None)]
    df = table(rows)
    out = langid.lang_report(df).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (100, 101, 102))
    assert by[103]["lang_pred"] == "en" and by[None]["lang_pred"] == "fr" and by[104]["lang_pred"] in ("en", "fr")
    kept = langid.keep_known(df)
    assert kept.columns == df.columns and kept.where("doc_id in (100, 101, 102)").count() == 0 and kept.count() >= 38
    nothing = langid.lang_report(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert langid.lang_report(df.limit(0)).count() == 0 and langid.keep_known(df.limit(0)).count() == 0


def test_more_than_64_languages(spark, table):
    """Every label is learned: one language a letter pair, the last ones rarer than the others."""
    pairs = [a + b for a in "bcdfghjkm" for b in "aeiouyvwx"][:80]
    rows = [(i * 1000 + j, f"{p * 3} {p * 2} {p * 4} " * 3, "s", f"l{i:02d}") for i, p in enumerate(pairs) for j in range(12 if i < 64 else 6)]
    out = langid.lang_report(table(rows)).collect()
    want = {r[0]: r[3] for r in rows}
    assert len(out) == len(rows) and {r["lang_pred"] for r in out} == {r[3] for r in rows}
    assert all(r["lang_pred"] == want[r["doc_id"]] for r in out)


def test_scoring_in_parts_changes_nothing(monkeypatch):
    probs = np.random.default_rng(1).random((len(PIECES), 3)) * 0.3
    texts = ["abab ab b", "xaby ba aba", None, "b ab ñ abab"]
    whole = langid.Scorer(PIECES, probs).likelihoods(texts)
    monkeypatch.setattr(langid, "MAX_WORDS", 20)
    parts = langid.Scorer(PIECES, probs)
    assert parts.step == 2
    for a, b in zip(whole, parts.likelihoods(texts)):
        assert (a is None and b is None) or np.allclose(a, b, rtol=1e-12)
