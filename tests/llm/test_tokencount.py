import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from fareline.llm import tokencount as tc


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path(tc.VOCABULARY))


@pytest.fixture(scope="module")
def model():
    return tc.read_model()


@pytest.fixture(scope="module")
def counter(model):
    return tc.Counter(model, tc.whole_tokens(model), P.PATTERN)


def by_library(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_table_against_library(spark, sf, docs, library):
    from fareline.llm.queries import op13_token_counts

    got = {r["doc_id"]: r for r in op13_token_counts(spark, sf).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r, n in zip(rows, by_library(library, [r["text"] or "" for r in rows])):
        g = got[r["doc_id"]]
        assert (g["n_bytes"], g["n_tokens"], g["over_limit"]) == (len((r["text"] or "").encode()), n, n > 1024)


def test_proof_is_what_the_library_does(model, library):
    """Every vocabulary string that is text, proven whole exactly if the library gives one token for it, merges alone."""
    letters, whole = tc.byte_letters(), set(tc.whole_tokens(model))
    merges, checked = tc.Merges(model["vocabulary"], model["merges"]), 0
    for string, number in model["vocabulary"].items():
        if not all(c in letters for c in string):
            continue
        try:
            text = bytes(letters[c] for c in string).decode("utf-8")
        except UnicodeDecodeError:
            continue
        ids = [t.id for t in library.model.tokenize(string)]
        assert merges.tokens(text.encode()) == ids
        assert (text in whole) == (ids == [number])
        checked += 1
    assert checked > 45_000 and len(whole) <= checked


def test_random_texts(counter, library):
    rng = random.Random(11)
    alphabets = ["ab ", "aeiou thn", "éèüß ñ", "0123456789.,-", "\t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　 ", "漢字かな한글", "😀👍🏽é'’s'll",
                 "\x00\x7f<|>#", "<|endoftext|>"]
    texts = []
    for _ in range(3000):
        a = "".join(rng.sample(alphabets, rng.randint(1, 4)))
        s = "".join(rng.choice(a) for _ in range(rng.randint(0, 60)))
        texts.append(s[:20] + "<|endoftext|>" * rng.choice([0, 0, 1, 2]) + s[20:])
    assert [counter.count(s) for s in texts] == by_library(library, texts)


def test_letters_of_all_planes(counter, library):
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    texts = [" a".join(chars[i:i + 64]) for i in range(0, len(chars), 64)]
    differing = [t for t, n in zip(texts, by_library(library, texts)) if counter.count(t) != n]
    assert not differing


def test_small_table_gives_the_same(model, library, monkeypatch):
    monkeypatch.setattr(tc, "TABLE_BYTES", 2000)
    whole = tc.whole_tokens(model)
    counter = tc.Counter(model, whole, P.PATTERN)
    s = "Thstinnt thndhain. Onhalyti the in erthst orth it thon tiontiontion éèü " * 5
    assert [counter.count(s)] * 2 == by_library(library, [s]) * 2
    assert len(counter) < len(whole) + 20 and all(counter[w] == 1 for w in whole[:1000])


def test_edge_rows(spark, table, library):
    long = "supercalifragilistic " * 20000 + "ab" * 30000
    texts = {1: None, 2: "", 3: "a b", 4: long, 5: "x<|endoftext|>y", 6: "<|endoftext|>", 7: " \n\t"}
    df = table([*texts.items(), (3, "a b"), (None, "x")], "doc_id long, text string, n_tokens long, n_bytes string, n string, over_limit int")
    rows = tc.token_report(df).collect()
    assert len(rows) == 9
    want = dict(zip(texts, by_library(library, [t or "" for t in texts.values()])))
    for r in rows:
        if r["doc_id"] is not None:
            assert r["n_tokens"] == want[r["doc_id"]] and r["over_limit"] == (want[r["doc_id"]] > 1024)
    assert [r["n_tokens"] for r in rows if r["doc_id"] is None] == [1]
    assert tc.token_report(df.limit(0)).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        tc.read_model(P.path("word_bpe_49k.json"))
