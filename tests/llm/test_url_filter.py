"""Url rules and aliases."""

import random

import pytest
from pyspark.sql import functions as F

from inkledger.llm.url_filter import declared_links, filter_urls, judged, node_of

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/"), ("block", "bad.net", "")]
PAGES = "page_id bigint, url string, html string"


def verdicts(spark, rows, redirects=None, rules=RULES):
    pages = spark.createDataFrame(rows, PAGES)
    return {r["page_id"]: r for r in filter_urls(pages, rules, redirects).collect()}


def brute(url):
    """Host, path and best rule of one url, from the definition."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), v == "allow", h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, None))
    return host, path, best[2], best[3]


URLS = ["https://a.Example.ORG/es/1", "http://example.org/en/1", "http://example.org/en/2?x=/en/1", "http://notexample.org", "//x", None, "",
        "http://x.com/fr/1#a", "http://x.com/de/1", "http://com/de/", "http://x.com", "http://x.bad.net?q", "http://b.net/\n/x", "a://b://c.org/x",
        "http://É.org/", "http://x.com/DE/"]


@pytest.mark.parametrize("joined", [False, True])
def test_rules_as_defined(spark, joined):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string") if joined else RULES
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["ruled"]) for r in judged(rows, rules).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}


def test_many_rules_are_joined(spark):
    rules = RULES + [("block", f"h{i}.net", "/") for i in range(100)]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + ["http://h7.net/"])], "page_id bigint, url string")
    got = {r["page_id"]: r["rule"] for r in judged(rows, rules).collect()}
    assert got[len(URLS)] == "h7.net/" and all(got[i] == brute(u)[2] for i, u in enumerate(URLS))


def test_blocks_reach_aliases_but_not_explicit_allows(spark):
    canonical = '<LINK href="{}" rel="canonical">'
    refresh = '<meta http-equiv="refresh" content="0; url={}">'
    got = verdicts(spark, [
        (1, "http://a.net/1", canonical.format("http://x.com/de/9")),        # its target is blocked, and no page
        (2, "http://b.net/2", refresh.format("http://a.net/1?utm_source=f")),  # alias of an alias
        (3, "https://b.net/2#frag", None),                                   # the same page as 2
        (4, "http://ok.org/x", canonical.format("http://x.com/de/9")),       # allowed by a rule
        (5, "http://c.net/", canonical.format("/other")),                    # a tie without a block
        (6, None, canonical.format("http://x.com/de/9")), (7, "", ""), (8, "http://x.com/de/9", None),
        (9, "http://ok.net/", canonical.format("http://ok.org/x")),          # reaches the block through the allowed one
        (9, "http://ok.net/", canonical.format("http://ok.org/x")),
    ])
    assert {k: v["verdict"] for k, v in got.items()} == {
        1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "block"}
    assert got[1]["aliased"] and not got[4]["aliased"] and got[4]["rule"] == "org/"


def test_redirect_table_and_long_chain(spark):
    chain = spark.createDataFrame([(f"http://n{i}.net/", f"http://n{i + 1}.net/") for i in range(40)] + [("http://n40.net/", "http://bad.net/"), (None, "x")],
                                  "url string, target string")
    got = verdicts(spark, [(i, f"http://n{i}.net/", None) for i in range(41)] + [(99, "http://m.net/", None)], chain)
    assert all(got[i]["verdict"] == "block" for i in range(41)) and got[99]["verdict"] == "allow"


def test_repeated_rows_empty_table_and_other_columns(spark):
    got = filter_urls(spark.createDataFrame([(1, "http://x.com/de/", None)] * 3, PAGES), RULES).collect()
    assert [r["verdict"] for r in got] == ["block"] * 3
    assert filter_urls(spark.createDataFrame([], PAGES), RULES).count() == 0
    extra = spark.createDataFrame([(1, "http://bad.net", None, "z", "y")], PAGES + ", host string, verdict string")
    assert filter_urls(extra, RULES).first()["verdict"] == "block"


def test_node_drops_what_names_the_visit(spark):
    urls = ["http://A.net/p?utm_source=x&id=1#f", "https://a.net/p?id=1", "https://a.net/p?id=1&ref=z", "http://a.net/p"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(node_of(F.col("u")).alias("n"))
    nodes = [r["n"] for r in df.collect()]
    assert nodes[0] == nodes[1] == nodes[2] != nodes[3]


def test_both_forms_break_ties_alike(spark):
    rules = [("block", "a.a", "/xx"), ("block", "a.a.a", "/"), ("allow", "b.b", "/"), ("block", "b.b", "/")]
    rows = spark.createDataFrame([(1, "http://a.a.a/xx"), (2, "http://b.b/")], "page_id bigint, url string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    for form in (rules, rules[::-1], table):
        assert {r["page_id"]: r["rule"] + " " + r["ruled"] for r in judged(rows, form).collect()} == {1: "a.a.a/ block", 2: "b.b/ allow"}


RELATIVE = [("page.html", "http://T.net/dir/page.html"), ("./page.html", "http://T.net/dir/page.html"), ("../x/./y", "http://T.net/x/y"), ("../../../x", "http://T.net/x"),
            ("?id=1&amp;b=2", "http://T.net/dir/main?id=1&b=2"), ("/a/../b", "http://T.net/b"), ("/a/..", "http://T.net/"), ("..", "http://T.net/"), ("sub/.", "http://T.net/dir/sub/"),
            ("//o.net/x", "http://o.net/x"), ("https://o.net/a&amp;b", "https://o.net/a&b"), ("mailto:x@y", None), ("x?u=http://z", "http://T.net/dir/x?u=http://z"), ("a:b/../c", None)]


def test_targets_are_resolved_against_the_page(spark):
    rows = [(i, "http://T.net/dir/main?q#f", f'<link rel="canonical" href="{t}">') for i, (t, _) in enumerate(RELATIVE)]
    rows.append((99, "http://bare.net", '<link rel=canonical href="x.html">'))
    got = {r["page_id"]: r["l"] for r in spark.createDataFrame(rows, PAGES).select("page_id", declared_links(F.col("html"), F.col("url")).alias("l")).collect()}
    assert got == {**{i: [u] if u else [] for i, (_, u) in enumerate(RELATIVE)}, 99: ["http://bare.net/x.html"]}


def test_random_graphs_against_brute_force(spark):
    draw = random.Random(12)
    urls = [f"http://n{i}.net/p" for i in range(120)]
    rules = [("block", f"n{i}.net", "/") for i in range(0, 120, 17)] + [("allow", f"n{i}.net", "/p") for i in range(5, 120, 23)]
    links = [(draw.randrange(120), draw.randrange(120)) for _ in range(90)]
    moved = [(draw.randrange(120), draw.randrange(120)) for _ in range(20)]
    pages = [(k, urls[i], f'<link rel=canonical href="{urls[j]}">') for k, (i, j) in enumerate(links)] + [(1000 + i, u, None) for i, u in enumerate(urls)]
    redirects = spark.createDataFrame([(urls[i], urls[j]) for i, j in moved], "a string, b string")
    part = list(range(120))
    for _ in range(120):
        for i, j in links + moved:
            part[i] = part[j] = min(part[i], part[j])
    ruled = {i: max([(len(h) + len(p), v == "allow", v) for v, h, p in rules if h == f"n{i}.net"], default=(0, 0, None))[2] for i in range(120)}
    bad = {part[i] for i in range(120) if ruled[i] == "block"}
    want = {i: ruled[i] or ("block" if part[i] in bad else "allow") for i in range(120)}
    got = verdicts(spark, pages, redirects, rules)
    assert {k: r["verdict"] for k, r in got.items()} == {**{k: want[i] for k, (i, _) in enumerate(links)}, **{1000 + i: v for i, v in want.items()}}
    assert len({v for v in want.values()}) == 2 and any(want[i] == "block" and ruled[i] is None for i in range(120))
