from pyspark.sql import functions as F

from fareline.llm import urls
from fareline.llm.components import connected_components


def make(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, node string, verdict string")


def verdicts(spark, rows):
    return {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(make(spark, rows)).collect()}


def test_rules(spark):
    got = verdicts(spark, [
        (1, "http://a.org/x", None), (2, "https://www.EXAMPLE.org/es/1?q", ""), (3, "http://example.org/en/12", ""), (4, "http://b.com/de/x#y", ""),
        (5, "http://b.com/fr/", ""), (6, "http://notorg/", ""), (7, "http://org", ""), (8, None, None), (9, "no scheme", "x"), (10, "http://x.example.org/en/2", ""),
        (11, "http://com.de/de/", ""), (12, "x://org/://b.com/de/", "")])
    assert got == {1: ("org/", "allow"), 2: ("example.org/es/", "block"), 3: ("example.org/en/1", "block"), 4: ("com/de/", "block"),
                   5: ("com/fr/", "allow"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"),
                   10: ("org/", "allow"), 11: (None, "allow"), 12: ("org/", "allow")}


def test_aliases_take_the_block_unless_allowed(spark):
    canon = '<html><LINK  rel="canonical" href="{}">'.format
    refresh = "<meta http-equiv='refresh' content=\"0; url={}\">".format
    got = verdicts(spark, [
        (1, "http://a.net/1", canon("http://b.com/de/1")),              # blocked target that is no page
        (2, "http://a.net/2", refresh("/1")), (3, "http://A.net/3#top", canon("//a.net/2")), (4, "http://a.net/d/4", canon("../x") + refresh("http://a.net/3")),
        (5, "http://c.net/5", canon("http://b.com/de/5")), (6, "http://c.net/6", canon("http://c.net/5") + refresh("http://d.org/ok")),
        (7, "http://b.com/de/7", canon("http://d.org/7")),              # own rule stands
        (8, "http://e.net/8", canon("http://e.net/8")), (9, "http://f.net/9", canon("http://g.net/9?a=1&amp;b=2")), (10, "http://g.net/9?a=1&b=2", refresh("http://com/de/")),
        (3, "http://A.net/3#top", canon("//a.net/2"))])
    assert {k: v for k, (_, v) in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block",
                                                   8: "allow", 9: "block", 10: "block"}


def test_references_resolve_as_rfc_3986(spark):
    from urllib.parse import urldefrag, urljoin

    bases = ["http://a.net/b/c/d;p?q", "http://a.net", "http://a.net/", "http://a.net/x/y/?k=/../z#top", "https://a.net/f?u=http://b.net/"]
    hrefs = ["g", "./g", "g/", "/g", "//h.net/g", "//h.net/a/../g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", ".", "./", "..", "../", "../g", "../..",
             "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/../y", "g?y/../x",
             "http://z.net/a/./b/../c", "/in?next=http://z.net/", "in?next=http://z.net/"]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "base string, href string")
    # urljoin leaves the path of a reference with its own host as it is: joined a second time it is resolved
    def want(b, h):
        full = urldefrag(urljoin(b, h)).url
        rest = full.split("://", 1)[1]
        at = min(i for i in (rest.find("/"), rest.find("?"), len(rest)) if i >= 0)
        origin, rest = full.split("://", 1)[0] + "://" + rest[:at], rest[at:]
        p, mark, q = rest.partition("?")
        return urldefrag(urljoin(origin + "/", p or "/")).url + mark + q
    for r in df.select("*", urls.node(urls._resolved(F.col("base"), F.col("href"))).alias("got")).collect():
        assert r["got"] == want(r["base"], r["href"]), r
    other = spark.createDataFrame([("http://a.net/", h) for h in ("mailto:x@y.net", "javascript:go('http://z.net')", "data:text/html,http://z.net")], "base string, href string")
    assert [r[0] for r in other.select(urls.node(urls._resolved(F.col("base"), F.col("href")))).collect()] == [None] * 3


def test_dot_and_query_links_carry_the_verdict(spark):
    canon = '<link rel="canonical" href="{}">'.format
    refresh = '<meta http-equiv="refresh" content="0; url={}">'.format
    got = verdicts(spark, [
        (1, "http://a.net/d/e/1", canon("../x")), (2, "http://a.net/d/x", canon("http://b.com/de/1")),        # blocked through ../ only
        (3, "http://a.net/d/3", refresh("?p=2")), (4, "http://a.net/d/3?p=2", canon("http://b.com/de/2")),    # blocked through ? only
        (5, "http://c.net/5", canon("http://www.example.org/es/../ok")),                                      # the target's own rule is org/
        (6, "http://c.net/s/6?a", canon("#top")), (7, "http://c.net/s/", canon("http://b.com/de/3")),         # a fragment is the page itself
        (8, "http://e.net/q/../8", canon("http://b.com/de/8")), (9, "http://e.net/9", canon("./8"))])
    assert {k: v for k, (_, v) in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "block"}


def test_spark_and_sql_agree_on_links(spark, tmp_path):
    from urllib.parse import urljoin

    import duckdb

    rows = [(i, f"http://h{i % 9}.net/p{i}", f'<link rel=canonical href="http://h{(i * 7) % 9}.net/p{(i * 5) % 60}">' if i % 3 else
             f'<meta http-equiv="refresh" content="1;url=/p{i + 9}">') for i in range(60)]
    rows += [(100, "http://h1.net/p10", '<link rel="canonical" href="http://z.com/de/1">'), (101, "http://h2.net/p11", '<link rel="canonical" href="http://z.org/">')]
    # references of every kind, each to a page that a block reaches only so; every one on a host of its own
    hrefs = ["g", "./g", "/g", "//h2.net/g", "//h2.net/a/../g", "?y", "g?y", "#s", "g#s", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g",
             "/./g", "/../g", "g.", ".g", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g?y/../x", "mailto:x@y.net", "data:text/html,http://z.com/de/", "in?next=http://z.net/"]
    bases = ["http://h1.net/b/c/d;p?q", "http://h1.net", "http://h1.net/x/y/?k=/../z#top", "http://H1.net/f//g/../q?u=http://b.net/"]
    for i, (base, href) in enumerate((b, h) for b in bases for h in hrefs):
        base, href = base.replace("1.net", f"{i}r.net"), href.replace("h2.net", f"{i}s.net")
        rows += [(200 + 2 * i, base, f'<link rel="canonical" href="{href}">'), (201 + 2 * i, urljoin(base, href), f'<link rel="canonical" href="http://{i}.com/de/../de/1">')]
    make(spark, rows).select("page_id", "url", "html").toPandas().to_parquet(tmp_path / "p.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/p.parquet')")
    want = sorted(con.execute(urls.SQL).fetchall(), key=repr)
    got = sorted((tuple(r) for r in urls.judge_urls(make(spark, rows)).collect()), key=repr)
    assert got == want
    of = {r[0]: r[-1] for r in got}
    assert set(of.values()) == {"allow", "block"} and [of[i] for i in range(200, 440, 2)].count("block") > 80


def test_empty_and_native(spark):
    df = make(spark, [(1, None, None)])
    assert urls.judge_urls(df.limit(0)).count() == 0
    plan = urls.judge_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_components(spark):
    import random

    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(300)] + [(5000 + rng.randint(0, 99), 5000 + rng.randint(0, 99)) for _ in range(70)]
    rng.shuffle(edges)
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
    assert F is not None
