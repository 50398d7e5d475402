"""Rules and propagation against plain loops."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from logweave.llm import hosts, queries

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "bad.org/"), ("block", "bad.org"), ("allow", "good.org/a")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[end:]
    return rest[:end].lower(), path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def rule_for(host, path):
    fits = [(len(r), v == "block", r, v) for v, r in RULES for h in [r.split("/")[0]] if (host == h or host.endswith("." + h)) and path.startswith(r[len(h) :])]
    return max(fits)[2:] if fits else (None, None)


def plain(pages, links):
    ruled = [(p, *split(u), *rule_for(*split(u))) for p, u, _ in pages]
    count, allowed, blocked = Counter(r[1] for r in ruled), Counter(r[1] for r in ruled if r[4] == "allow"), Counter(r[1] for r in ruled if r[4] == "block")
    # the finished ranks solve x = damping * links * x + seeds
    names = sorted({h for h in count if h} | {h for pair in links for h in pair})
    at = {h: i for i, h in enumerate(names)}
    ahead, behind = np.zeros((len(names), len(names))), np.zeros((len(names), len(names)))
    for (a, b), n in links.items():
        ahead[at[b], at[a]] += n
        behind[at[a], at[b]] += n
    trust, distrust = (
        defaultdict(float, zip(names, np.linalg.solve(np.eye(len(names)) - hosts.DAMPING * m / np.maximum(m.sum(axis=0), 1), [seeds[h] for h in names])))
        for m, seeds in ((ahead, allowed), (behind, blocked))
    )
    bad = {h for h in count if distrust[h] > trust[h] and distrust[h] >= hosts.THRESHOLD * count[h]}
    return {r[0]: (*r[1:4], r[4] or ("block" if r[1] in bad else "allow"), trust[r[1]], distrust[r[1]]) for r in ruled}


def graph():
    """Random pages that link to each other, and awkward ones."""
    rng = random.Random(3)
    names = [f"h{i}.com" for i in range(12)] + ["a.net", "www.example.net", "bad.org", "x.bad.org", "good.org"]
    pages, links = [], Counter()
    for page in range(120):
        host = rng.choice(names)
        targets = [rng.choice(names) for _ in range(rng.randrange(4))]
        html = "".join(f'<p><A class="x" HREF={q}{s}//{t.upper()}/p?x={q}>' for t in targets for q, s in [rng.choice([('"', "https:"), ("'", ""), ("", "http:")])])
        pages.append((page, f"http://{host}{rng.choice(['', '/', '/en/1', '/a?b', '/fr#x'])}", html + '<a href="/own">'))
        links.update((host, t) for t in targets if t != host)
    pages += [(900, None, "<a href='http://bad.org/'>"), (901, "no scheme", None), (902, "x://H0.com?q=://b.net/", None), (903, "", "")]
    return pages, links


def test_graph(spark):
    pages, links = graph()
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.trust, r.distrust) for r in hosts.judge(frame, hosts.rules_frame(spark, RULES)).collect()}
    want = plain(pages, links)
    assert got.keys() == want.keys()
    for page in want:
        assert got[page][:4] == want[page][:4]
        assert got[page][4:] == pytest.approx(want[page][4:], abs=1e-5)
    undecided = Counter(v[3] for v in want.values() if v[2] is None)
    assert undecided["block"] and undecided["allow"]


def test_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert hosts.judge(empty, hosts.rules_frame(spark, RULES)).count() == 0


def test_long_chain_is_finished(spark):
    """Distrust falls by the damping at each link, however many links there are."""
    n = 14
    pages = [(i, f"http://h{i}.com/", f'<a href="http://{"h%d.com" % (i - 1) if i > 1 else "bad.org"}/">') for i in range(1, n + 1)] + [(0, "http://bad.org/", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in hosts.judge(frame, hosts.rules_frame(spark, RULES)).collect()}
    for i in range(1, n + 1):
        assert got[i].distrust == pytest.approx(0.85**i, abs=1e-5)
        assert got[i].verdict == ("block" if i <= 4 else "allow")


def test_graph_in_sql(spark):
    """The SQL twin gives the verdicts of the query on a graph that has edges."""
    pages, _ = graph()
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    judged = hosts.judge(frame, hosts.rules_frame(spark, queries.RULES))
    duck = duckdb.connect()
    duck.register("pages", frame.toPandas())
    columns = ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(duck.sql(f"SELECT {', '.join(columns)} FROM ({queries.hosts_sql()})").fetchall())
    assert sorted(tuple(r) for r in judged.select(*columns).collect()) == want
    by_host = Counter(row[4] for row in want if row[3] is None)
    assert by_host["block"] and by_host["allow"]


def test_repeated_pages_and_rules_of_equal_length(spark):
    """Equal rows count and are judged alike; of a blocking and an allowing rule that are equal the blocking one wins."""
    rules = hosts.rules_frame(spark, [("allow", "a.com/x"), ("block", "a.com/x"), ("allow", "b.com/")])
    pages = [(1, "http://a.com/x1", None)] * 2 + [(2, "http://b.com/", "y" * 300_000 + '<a href="//a.com">')]
    got = hosts.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()
    assert sorted((r.page_id, r.verdict, r.distrust) for r in got)[:2] == [(1, "block", 2.0)] * 2
    assert [(r.trust, r.distrust) for r in got if r.page_id == 2] == [(1.0, pytest.approx(0.85 * 2))]
