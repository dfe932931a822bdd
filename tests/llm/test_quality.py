import re
from collections import Counter

from pyspark.sql import functions as F

from fareline.llm import quality
from fareline.llm.common import whole_text


def brute(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    n = Counter(tri)
    cover = {i + k for i, g in enumerate(tri) if n[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover))


TEXTS = [None, "", " \t\x0b\n", "a", "a b", "a b c", "a b c a b c", "x x x x x", "l\nl\nl \nm\n\nl", "#*$%&|<> é\u2028b",
         "the cat sat " * 3000, " ".join(f"w{i % 700} v{i}" for i in range(20000)), "x" * 200000,
         " ".join(f"{i % 40} {i % 40} {i % 40} q{i}" for i in range(400))]


def test_base_features(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = df.select("doc_id", quality.base_features(whole_text(F.col("text"))).alias("b")).collect()
    for r in rows:
        assert tuple(r["b"]) == brute(TEXTS[r["doc_id"]]), r["doc_id"]


def test_order_by_rejection_per_cost():
    a, b, c, d = (quality.Rule(n, None) for n in "abcd")
    ordered = quality.order([(a, 1.0, 0.1), (b, 0.1, 0.1), (c, 0.1, 0.0), (d, 2.0, 0.9)])
    assert [r.name for r in ordered] == ["b", "d", "a", "c"]


def test_measure_sees_selectivity(spark):
    df = spark.createDataFrame([("!" * 9 if i % 4 == 0 else "fine",) for i in range(40)], "text string")
    df = df.withColumn("base", quality.base_features(F.col("text")))
    rules = [quality.Rule("bang", lambda t, b: t.contains("!")), quality.Rule("never", lambda t, b: F.lit(False)),
             quality.Rule("null", lambda t, b: F.lit(None).cast("boolean"))]
    share = {r.name: s for r, sec, s in quality.measure(df, "text", "base", rules)}
    assert share == {"bang": 0.25, "never": 0.0, "null": 0.0}


def test_verdict_does_not_depend_on_order(spark, docs):
    t = F.col("text")
    rows = docs.select(quality.verdict(t, quality.RULES)["kept"].alias("x"), quality.verdict(t, quality.RULES[::-1])["kept"].alias("y"))
    assert rows.where("x <> y or x is null").count() == 0


def test_a_filter_computes_features_once(spark, docs):
    plan = docs.where(quality.verdict(F.col("text"), quality.RULES)["kept"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 4    # words, lines; not once per use


def test_edge_rows(spark, table):
    good = " ".join("w" + chr(97 + i % 26) * (1 + i // 26) for i in range(60))
    df = table([(1, None), (2, ""), (3, good), (3, good), (None, good), (4, "a " * 100)])
    out = quality.quality_report(df).collect()
    assert len(out) == 6
    assert all(r["base_failed"] and not r["kept"] for r in out if r["doc_id"] in (1, 2, 4))
    assert all(r["kept"] for r in out if r["doc_id"] in (3, None))
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == 3
    assert quality.quality_report(df.limit(0)).count() == 0 and quality.keep_good(df.limit(0)).count() == 0


def test_agrees_with_quality_labels(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    r = quality.quality_report(docs).join(labels, "doc_id").where("not base_failed")
    assert r.where("kept <> (quality = 1)").count() <= 0.02 * r.count()
