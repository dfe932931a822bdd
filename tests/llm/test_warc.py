import base64
import hashlib

from fareline.llm import warc

PAGES = [(1, "http://a/1", "same"), (5, "http://a/5", "same"), (3, None, "same"), (7, "http://a/7", None), (8, "http://a/8", ""), (9, "http://x/\r\nWARC-Type: y", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"),
         (None, "http://a/n", "same"), (None, "u", "only here"), (20, "http://a/20", "x" * 500000), (21, "http://a/21", "twice"), (21, "http://a/21", "twice")]


def make(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, digest string, original string")


def b32(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def brute(rows, least=0):
    latest = {}
    for p, _, h in rows:
        if p is not None:
            latest[h or ""] = max(p, latest.get(h or "", p))
    out = []
    for p, _, h in rows:
        t, size = h or "", len((h or "").encode())
        rev = size >= least and latest.get(t) is not None and p != latest[t]
        out.append((p, size, b32(h), "revisit" if rev else "response", latest[t] if rev else None))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    for least in (0, 5):
        got = sorted((tuple(r) for r in warc.warc_report(make(spark), least).collect()), key=repr)
        assert got == brute(PAGES, least)


def test_archive_files(spark, tmp_path):
    """The files are WARC: records one after another, revisits without payload."""
    path = str(tmp_path / "w")
    warc.write_archives(warc.resolve(make(spark)), path)
    found = {}
    for f in (tmp_path / "w").glob("part-*"):
        raw, at = f.read_bytes(), 0
        while at < len(raw):
            end = raw.index(b"\r\n\r\n", at)
            lines = raw[at:end].split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            head = dict(x.split(b": ", 1) for x in lines[1:])
            n = int(head[b"Content-Length"])
            block = raw[end + 4:end + 4 + n]
            assert raw[end + 4 + n:end + 8 + n] == b"\r\n\r\n"
            found.setdefault(head[b"WARC-Type"], []).append((head, block.split(b"\r\n\r\n", 1)[1]))
            at = end + 8 + n
    assert len(found[b"response"]) + len(found[b"revisit"]) == len(PAGES)
    ids = {h[b"WARC-Record-ID"] for h, _ in found[b"response"]}
    assert all(h[b"WARC-Refers-To"] in ids and p == b"" for h, p in found[b"revisit"])
    assert all(h[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(p).digest()) for h, p in found[b"response"])


def test_empty(spark):
    assert warc.warc_report(make(spark).limit(0)).count() == 0
