import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from fareline.llm import bpe


@pytest.fixture(scope="module")
def raw():
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def oracle(raw):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_whole_table_against_library(spark, sf, docs, oracle):
    from fareline.llm.queries import op3_bpe

    got = {r["doc_id"]: r for r in op3_bpe(spark, sf).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids, g = oracle.encode_ordinary(r["text"] or ""), got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_random_texts(raw, oracle):
    codec, rng = bpe.Codec(raw, P.PATTERN), random.Random(3)
    alphabets = ["ab ", "aeiou thn", "éèüß ñ", "0123456789.,-", "\t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　 ", "漢字かな한글", "😀👍🏽é'’s'll", "\x00\x7f<|>#"]
    for _ in range(3000):
        a = "".join(rng.sample(alphabets, rng.randint(1, 4)))
        s = "".join(rng.choice(a) for _ in range(rng.randint(0, 60)))
        ids = list(codec.encode(s))
        assert ids == oracle.encode_ordinary(s), s
        assert codec.decoder.decode(ids) == s
    long = "ab" * 3000 + "é" * 500
    assert list(codec.encode(long)) == oracle.encode_ordinary(long)


def test_white_space_and_letters_of_all_planes(raw, oracle):
    codec = bpe.Codec(raw, P.PATTERN)
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c <= 0xDFFF]
    for i in range(0, len(chars), 40):
        s = " a".join(chars[i:i + 40])
        assert list(codec.encode(s)) == oracle.encode_ordinary(s), i


def test_tokens_come_before_the_end(raw):
    enc = bpe.Encoder(bpe.read_ranks(raw))
    longest = max(map(len, enc.ranks))
    seen = []

    def feed():
        for b in (b"international" * 40):
            seen.append(b)
            yield b

    ahead, done = 0, 0
    for t in enc.stream(feed()):
        done += len(enc.bytes_of[t])
        ahead = max(ahead, len(seen) - done)
    assert done == len(seen) and ahead <= 3 * longest


def test_small_tables_give_the_same(raw, oracle, monkeypatch):
    monkeypatch.setattr(bpe, "STATE_BYTES", 3000)
    monkeypatch.setattr(bpe, "STEP_BYTES", 4000)
    monkeypatch.setattr(bpe, "PAIR_BYTES", 500)
    monkeypatch.setattr(bpe, "PIECE_BYTES", 1000)
    codec = bpe.Codec(raw, P.PATTERN)
    s = "Thstinnt thndhain. Onhalyti the in erthst orth it thon tiontiontion éèü " * 5
    assert codec.encode(s) == oracle.encode_ordinary(s)
    assert len(codec.pieces) + len(codec.pieces.older) < 20
    long = "ab" * 500 + "tionth" * 300
    assert codec.encode(long) == oracle.encode_ordinary(long)


def test_texts_share_states(raw):
    """A state is what may come, not what came: on made-up words states are far fewer than the words."""
    enc, rng = bpe.Encoder(bpe.read_ranks(raw)), random.Random(5)
    parts = ["th", "st", "on", "re", "ing", "ed", "an", "tion", "ly", "at", "er", "in"]
    words = {"".join(rng.choices(parts, k=rng.randint(2, 6))) for _ in range(12000)}
    for w in words:
        enc.encode(w.encode())
    assert len(enc.states) < len(words) / 3


def test_one_pass(spark, table, capsys):
    """Ids and decoded text come from one function: the plan encodes a text once."""
    df = bpe.bpe_report(table([(1, "a")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    eval_line = [line for line in plan.splitlines() if "ArrowEvalPython" in line and "run(" in line]
    assert len(eval_line) == 1 and eval_line[0].count("run(") == 1


def test_decoder_replaces_malformed_bytes(raw):
    codec = bpe.Codec(raw, P.PATTERN)
    byte = lambda *bs: [codec.encoder.ranks[bytes([b])] for b in bs]
    for bs in ([0xE2, 0x82, 0xAC], [0xF0, 0x9F, 0x98, 0x80], [0xE2, 0x82], [0x80, 0x41], [0xED, 0xA0, 0x80], [0xF5, 0x41], [0xC3, 0x41], [0xE0, 0x80, 0x80]):
        assert codec.decoder.decode(byte(*bs)) == bytes(bs).decode("utf-8", errors="replace")


def test_edge_rows(spark, table, oracle):
    long = "supercalifragilistic " * 20000
    df = table([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, long)])
    rows = bpe.bpe_report(df).collect()
    assert len(rows) == 6
    empty = hashlib.sha256(b"").hexdigest()
    for r in rows:
        if r["doc_id"] in (1, 2):
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (0, empty, empty)
        if r["doc_id"] == 4:
            assert r["n_tokens"] == len(oracle.encode_ordinary(long))
    assert bpe.bpe_report(df.limit(0)).count() == 0
