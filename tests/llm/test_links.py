"""Links between pages: how they are read and resolved, and verdicts over random link graphs."""

import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from salescope.llm import url_rules

BASES = ["https://t.org", "https://t.org/", "https://t.org/a/c", "http://t.org/a/b/?x=1#f", "https://t.org/a/c?z=//q"]
REFERENCES = ["b.html", "/b", "../q", "../../../q", "./r/./s", "?y=2", "//o.org/z", "https://e.org/p?q#f", "x/..", "x/.", "g;x=1/../y", "/a/../b/./c", "d?e=../f"]


def test_references_resolve_as_the_standard_says(spark):
    rows = [(b, r) for b in BASES for r in REFERENCES]
    df = spark.createDataFrame(rows, "b string, r string")
    for row in df.select("b", "r", url_rules.resolved(F.col("b"), F.col("r")).alias("got")).collect():
        want = urljoin(row.b if row.b.count("/") > 2 else row.b + "/", row.r)
        assert row.got == want, (row.b, row.r)


@pytest.mark.parametrize("html, want", [
    ('<link\n  rel="canonical"\n  href="/x">', ["https://t.org/x"]),
    ('<link title="a > b" rel=canonical href=/x>', ["https://t.org/x"]),
    ('<link rel="nofollow Canonical" href=\'/x\'>', ["https://t.org/x"]),
    ('<LINK HREF="/x?a=1&amp;b=2" REL=canonical />', ["https://t.org/x?a=1&b=2"]),
    ('<link rel="canonical" data-href="/no" href="/x">', ["https://t.org/x"]),
    ('<link rel="canonical" title="href=/no" href="/x">', ["https://t.org/x"]),
    ('<!-- <link rel=canonical href=/no> --><p>', []), ('<!-- <link rel=canonical href=/no>', []),
    ('<script>var a = "<link rel=canonical href=/no>";</script>', []),
    ('<link rel="alternate" href="/no"><link rel="canonical-ish" href="/no">', []),
    ('<base href="/deep/er/"><link rel=canonical href=x>', ["https://t.org/deep/er/x"]),
    ('<meta http-equiv="refresh" content="0; url=/x">', ["https://t.org/x"]),
    ("<meta content='5;URL=\"/x;y\"' http-equiv=Refresh>", ["https://t.org/x;y"]),
    ('<meta http-equiv="refresh" content="5">', []), ('<meta name="description" content="url=/no">', []),
    ('<link rel=canonical href="mailto:a@b">', []), ('<link rel=canonical href="">', []), ("", []), (None, []), ('<link rel="canonical href=/no>', []),
    ('<link ' + 'a' * 60_000 + ' rel=canonical href=/x>', ["https://t.org/x"]),
    ('<link rel=canonical ' + 'a="b" ' * 20_000 + 'href=/x>', ["https://t.org/x"]),
])
def test_tags_are_read_as_a_browser_reads_them(spark, html, want):
    df = spark.createDataFrame([("https://t.org/a", html)], "u string, h string")
    assert (df.select(url_rules.link_targets(F.col("u"), F.col("h")).alias("t")).first().t or []) == want


def test_verdicts_over_random_link_graphs(spark):
    """Against a plain union-find, with chains, hubs, loops and targets that are no pages."""
    rng = random.Random(4)
    rules = [("block", "bad.org", "/"), ("allow", "good.org", "/")]
    names = [f"http://h{i}.net/p" for i in range(120)] + [f"http://s{i}.bad.org/p" for i in range(6)] + [f"http://s{i}.good.org/p" for i in range(4)]
    edges = [(rng.choice(names[:120]), rng.choice(names)) for _ in range(70)] + [(f"http://h{i}.net/p", f"http://h{i + 1}.net/p") for i in range(60, 90)]
    edges += [(names[100], names[126]), (names[101], names[121]), (names[102], names[101])]
    tag = {0: '<link rel="canonical" href="{}">', 1: '<meta http-equiv="refresh" content="0;url={}">'}
    html: dict = {n: "" for n in names[:120]}
    for a, b in edges:
        html[a] += tag[rng.randrange(2)].format(b)
    parent = {n: n for n in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    votes: dict = {}
    linked = {x for e in edges for x in e}
    for n in names:
        v = "block" if ".bad.org" in n else "allow" if ".good.org" in n else None
        if v and n in linked:
            votes.setdefault(find(n), set()).add(v)
    df = spark.createDataFrame([(i, n, html[n]) for i, n in enumerate(names[:120])], "page_id long, url string, html string")
    rows = url_rules.judge_urls(df, rules).collect()
    assert {r.page_id: r.verdict for r in rows} == {i: min(votes.get(find(n), {"allow"})) for i, n in enumerate(names[:120])}
    assert {r.page_id for r in rows if r.by_alias} == {i for i, n in enumerate(names[:120]) if find(n) in votes}
    assert any(r.verdict == "block" for r in rows) and any(r.by_alias and r.verdict == "allow" for r in rows)
