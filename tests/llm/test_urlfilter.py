import random

import duckdb
import pytest
from compare import differences

from marketloom.llm import urlfilter as U

SMALL = "/root/testdata/sf0.01"


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    end = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:cut]), path[:end]


def rule_of(host, path):
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_urls_and_rules(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    rows += [(None, None, None), (-1, "", ""), (-1, "no scheme", None), (-2, "http://", "x"), (-3, "x://A.COM?q/en/", None),
             (-4, "HTTP://Www.EXAMPLE.com/en/1#a?b", None), (-5, "http://example.com/en", None), (-6, "http://notexample.com/en/", None),
             (-7, "a://b://c.net/es/x", None), (-8, "http://ÉX.net/fr/\nline?z", None), (-9, "http://com/", None)]
    got = U.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = []
    for i, url, _ in rows:
        host, path = parts(url)
        r = rule_of(host, path)
        want.append((str(i), host, path, r and r.name, r.verdict if r else "allow"))
    assert sorted(map(str, want)) == sorted(str((str(r["page_id"]), r["host"], r["path"], r["rule"], r["verdict"])) for r in got)


def test_links_and_verdicts(spark):
    """bad.net is blocked by its pages, a.org links to it and is blocked, c.org is linked from a
    trusted host, d.org names another host in its text, e.org links to a.org only."""
    rows = [(i, f"http://bad.net/es/{i}", "x") for i in range(5)]
    rows += [(10 + i, f"http://good.com/{i}", '<a href="https://C.org/x">c</a><img src="//c.org/y">') for i in range(5)]
    rows += [(20, "http://a.org/1", '<a href="http://bad.net/es/1">x</a>'), (21, "http://c.org/1", '<a href="/own">y</a>'),
             (22, "http://d.org/1", "see bad.net for v1.2.3 and c.org"), (23, "http://e.org/1", '<a href="http://a.org/1">x</a>'),
             (24, "http://f.org/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert differences(U.url_digest(pages), con, U.digest_sql()) is None
    got = {r["page_id"]: r for r in U.filter_urls(pages).collect()}
    assert got[20]["verdict"] == "block" and got[23]["verdict"] == "block"
    assert got[21]["verdict"] == "allow" and got[21]["trust"] > 0 and got[24]["verdict"] == "allow"
    assert got[22]["distrust"] > 0


def test_propagation_against_matrix(spark):
    import numpy as np

    r = random.Random(4)
    n = 30
    links = [(i, j, r.randrange(1, 5)) for i in range(n - 3) for j in range(n) if i != j and r.random() < 0.15]
    links += [(0, j, 1) for j in range(1, n) if not any(x[:2] == (0, j) for x in links)]  # a host that links to all
    seeds = [2, 5, 7]
    df = spark.createDataFrame([("k", f"h{i}", f"h{j}", w) for i, j, w in links], "kind string, src string, dst string, n long")
    s = spark.createDataFrame([("k", f"h{i}") for i in seeds], "kind string, host string")
    got = {x["host"]: x["rank"] for x in U.propagate(df, s, rounds=60).collect()}
    m, seed = np.zeros((n, n)), np.zeros(n)
    for i, j, w in links:
        m[j, i] = w
    out = m.sum(0)
    m[:, out > 0] /= out[out > 0]
    seed[seeds] = 1 / len(seeds)
    rank = seed.copy()
    for _ in range(200):
        passed = m @ rank
        rank = 0.85 * passed + (1 - 0.85 * passed.sum()) * seed
    assert sum(got.values()) == pytest.approx(1, abs=1e-6)
    assert all(got.get(f"h{i}", 0) == pytest.approx(rank[i], abs=1e-5) for i in range(n))


def test_empty(spark):
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
