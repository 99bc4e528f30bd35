import math
import random

import duckdb
import pytest

from tripmill.llm import url_graph
from tripmill.llm.oracles import urls_sql


@pytest.fixture
def pages(spark):
    def make(*rows):
        return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string, trust double, host string") if rows and len(rows[0]) == 4 else spark.createDataFrame(
            [(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string"
        )

    return make


def test_hosts_paths_and_rules(pages):
    rows = [
        ("https://WWW.A.Net/x?y#z", None), ("http://b.example.net/en/1", None), ("http://example.net?en/", None),
        ("ftp://x.example.com/de/p", ""), ("http://anorg/fr/", None), ("http://s.org/fr/q", None), ("no url", None), (None, None),
        ("a://b://c/d", None), ("http://net/", None), ("http://net", None),
    ]
    found = [tuple(r)[1:5] for r in url_graph.judge_urls(pages(*rows)).orderBy("page_id").collect()]
    assert found == [
        ("www.a.net", "/x", "net/", "block"), ("b.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "", None, "allow"),
        ("x.example.com", "/de/p", "example.com/de/", "block"), ("anorg", "/fr/", None, "allow"), ("s.org", "/fr/q", "org/fr/", "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("b:", "//c/d", None, "allow"), ("net", "/", "net/", "block"), ("net", "", None, "block"),
    ]


def rank(edges, seeds, n):
    scores = dict(seeds)
    out = {a: sum(1 for x, _ in edges if x == a) for a, _ in edges}
    for _ in range(n):
        got = {}
        for a, b in edges:
            got[b] = got.get(b, 0) + scores.get(a, 0) / out[a]
        passed = sum(got.values())
        scores = {h: 0.85 * got.get(h, 0) + seeds.get(h, 0) * (1 - 0.85 * passed) for h in {*got, *seeds}}
    return scores


def test_ranks_equal_brute_force(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "a"), ("c", "e")]
    seeds = {"a": 0.75, "d": 0.25}
    table = spark.createDataFrame([("trust", *e) for e in edges], "walk string, src string, dst string")
    start = spark.createDataFrame([("trust", *s) for s in seeds.items()], "walk string, host string, seed double")
    found = {r.host: r.score for r in url_graph.propagate(table, start, 9).collect()}
    expected = rank(edges, seeds, 9)
    assert found.keys() == expected.keys() and all(abs(found[h] - expected[h]) < 1e-12 for h in found)
    assert abs(sum(found.values()) - 1) < 1e-9


def test_hosts_that_link_to_blocked_ones_are_blocked(pages):
    link = '<a href="{}">'.format
    rows = [
        ("http://bad.net/", ""), ("http://farm.example.io/", link("http://bad.net/x") * 3), ("http://good.org/fr/", link("//fine.example.io/")),
        ("http://fine.example.io/", link("/local")), ("http://far.example.io/", link("https://farm.example.io/")),
    ]
    found = {r.host: r.verdict for r in url_graph.judge_urls(pages(*rows)).collect()}
    assert found == {"bad.net": "block", "farm.example.io": "block", "good.org": "allow", "fine.example.io": "allow", "far.example.io": "block"}


def test_clashing_columns_repeats_and_no_rows(pages):
    row = ("http://x.net/", None, 5.0, "mine")
    df = pages(row, row)
    assert [(r.host, r.verdict) for r in url_graph.judge_urls(df).collect()] == [("x.net", "block")] * 2
    assert url_graph.judge_urls(df.limit(0)).count() == 0


def test_verdicts_depend_neither_on_copies_nor_on_distance(spark):
    """3,000 disjoint copies of a graph with a busy blocked host, and a chain of more hosts than ITERATIONS."""
    copies, chain = 3_000, 16
    link = '<a href="http://{}/">'.format
    rows = [(f"http://bad{c}.net/", "") for c in range(copies)]
    rows += [(f"http://farm{k}of{c}.io/", link(f"bad{c}.net")) for c in range(copies) for k in range(3)]
    rows += [("http://c0.io/", link("bad0.net"))]
    rows += [(f"http://c{k}.io/", link(f"c{k - 1}.io")) for k in range(1, chain)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    hot = spark.range(300_000).selectExpr("-1 - id as page_id", "'http://hot.net/' as url", "cast(null as string) as html")
    found = url_graph.judge_urls(df.union(hot)).where("host like '%.io'").groupBy("verdict").count().collect()
    assert [tuple(r) for r in found] == [("block", 3 * copies + chain)]


def test_a_link_graph_equals_its_sql(spark, pages, monkeypatch):
    """Chains, cycles, hubs and hosts both walks reach; the scores agree but for the order of sums."""
    monkeypatch.setattr(url_graph, "ITERATIONS", 6)
    monkeypatch.setattr(url_graph.propagate, "__defaults__", (6, url_graph.DAMPING))
    rng = random.Random(8)
    hosts = ["bad.net", "worse.net", "good.org", "fine.org"] + [f"h{k}.io" for k in range(36)]
    link = "<a HREF='https://{}/p'>".format
    rows = [(f"http://{h}/{'fr/' if h.endswith('org') else ''}", "".join(link(rng.choice(hosts)) for _ in range(rng.randint(0, 3)))) for h in hosts]
    rows += [(f"http://t{k}.io/", link(f"t{k + 1}.io")) for k in range(4)] + [("http://t4.io/", link("bad.net")), (None, None)]
    df = pages(*rows)
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    expected = {r[0]: r[1:] for r in con.execute(f"SELECT page_id, host, verdict, trust, distrust FROM ({urls_sql()})").fetchall()}
    found = {r.page_id: (r.host, r.verdict, r.trust, r.distrust) for r in url_graph.judge_urls(df).collect()}
    assert found.keys() == expected.keys() and {v for _, v, _, _ in found.values()} == {"allow", "block"}
    for page, row in found.items():
        assert row[:2] == expected[page][:2], page
        assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-15) for x, y in zip(row[2:], expected[page][2:])), page
    assert sum(score > 0 for *_, score in found.values()) > 20


def test_steps_depend_on_the_damping_alone(spark, pages, monkeypatch):
    """A chain far longer than the walk: hosts within reach are blocked, the rest has no score."""
    link = '<a href="http://{}/">'.format
    steps = 6
    rows = [("http://c0.net/", "")] + [(f"http://c{k}.io/", link(f"c{k - 1}.{'net' if k == 1 else 'io'}")) for k in range(1, 15)]
    monkeypatch.setattr(url_graph.propagate, "__defaults__", (steps, url_graph.DAMPING))
    found = {r.page_id: (r.verdict, r.distrust > 0) for r in url_graph.judge_urls(pages(*rows)).collect()}
    assert found == {k: ("block", True) if k <= steps else ("allow", False) for k in range(15)}
    assert url_graph.DAMPING**url_graph.ITERATIONS <= url_graph.SETTLED
