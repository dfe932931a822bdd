import hashlib

import pytest

import corpus_pipeline
from fareline.llm import bpe, quality

from .brute import brute_components, brute_print


@pytest.fixture(scope="module")
def steps(spark, sf):
    """Rows after each stage, and the last result."""
    from fareline.llm.common import read, written

    df, out = read(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        df = written(stage(spark, df, sf), f"test-{name}")
        out.append((df.columns, df.collect()))
    return out


def test_stages(spark, sf, docs, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_duplicates", "mix_sources", "tokenize"]
    assert all(c == docs.columns for c, _ in steps[:-1])
    rows = [{r["doc_id"]: r for r in s} for _, s in steps[:-1]]
    whole = {r["doc_id"]: r for r in docs.collect()}
    assert all(whole[d] == r for s in rows for d, r in s.items())
    # language: only texts without a letter may go here
    assert all(not any(c.isalpha() for c in whole[d]["text"] or "") for d in whole.keys() - rows[0].keys())
    # quality: the rows that the report keeps
    report = quality.quality_report(spark.createDataFrame(list(rows[0].values()), docs.schema)).collect()
    assert {r["doc_id"] for r in report if r["kept"]} == rows[1].keys()
    # near duplicates: the smallest doc_id of each group
    comp = brute_components([(d, brute_print(r["text"])) for d, r in rows[1].items()], 2)
    assert rows[2].keys() == set(comp.values())
    # mixing takes nobody more than three times
    assert rows[3].keys() <= rows[2].keys() and max(sum(r["doc_id"] == d for r in steps[3][1]) for d in list(rows[3])[:50]) <= 3


def test_tokens(steps):
    with open(bpe.public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        codec = bpe.Codec(f.read(), bpe.public_tokenizers.PATTERN)
    text = {r["doc_id"]: r["text"] for r in steps[3][1]}
    assert len(steps[4][1]) == len(steps[3][1])
    for r in steps[4][1][:100]:
        ids = codec.encode(text[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_edge_rows(spark, table, sf):
    rows = [(1, None, "a"), (2, "", None), (3, "x", "a"), (3, "x", "a")]
    for _, stage in corpus_pipeline.STAGES:
        for df in (table(rows), table(rows).limit(0)):
            assert stage(spark, df, sf).count() >= 0
