import re

import pytest

from tallyveil.llm import url_filter
from tallyveil.llm.url_filter import DAMPING, ROUNDS, RULES, THRESHOLD, host_links, judged, op8_sql, propagate

ROWS = [
    (1, "http://WWW.Example.com/en/x?y", '<a href="http://mid.org/p">m</a>'), (2, "https://example.com/en/#a", '<a href="//bad.net/es/">b</a>'), (3, "http://sub.example.com/de/", "<a href='/rel'>r</a>"),
    (4, "http://bad.net/es/1", None), (5, "http://mid.org/a", '<A class="q" HREF=https://good.com/>g</A>'), (6, "http://spam.org/", '<a href="http://bad.net/es/">x</a><a href="http://bad.net/fr/">y</a>'),
    (7, None, None), (8, "no scheme", ""), (8, "no scheme", ""), (9, "x://net/fr/", "z"), (10, "http://good.com", "<p>"), (None, "http://spam.org/q", "<a href=#>"), (11, "http://bad.net/en/" + "p" * 100_000, "h"),
    (12, "a://b://c/d", None), (13, "http://notexample.com/en/", None),
]
SCHEMA = "page_id long, url string, html string"


def plain(rows, rules=RULES):
    """host, path, rule, verdict of each row, and the ranks, in plain Python."""
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)

    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        return low(host), re.match("[^?#]*", rest[len(host) :])[0]

    def best(host, path):
        fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit)[3:] if fit else (None, None)

    sites = [(i, *parts(u)) for i, u, _ in rows]
    ruled = [(i, h, p, *best(h, p)) for i, h, p in sites]
    seeds = {}
    for h in {x[1] for x in ruled if x[4]}:
        of = [x[4] for x in ruled if x[1] == h]
        seeds[h] = (of.count("allow") / len(of), of.count("block") / len(of))
    edges = {}
    for _, u, html in rows:
        for link in re.findall(r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)""", html or ""):
            src, dst = parts(u)[0], parts("http:" + link if link.startswith("//") else link)[0]
            if src and dst and src != dst:
                edges[src, dst] = edges.get((src, dst), 0) + 1
    rank = dict(seeds)
    for _ in range(ROUNDS):
        new = {h: [a * (1 - DAMPING), b * (1 - DAMPING)] for h, (a, b) in seeds.items()}
        for (s, e), n in edges.items():
            out, into = sum(v for (x, _), v in edges.items() if x == s), sum(v for (_, x), v in edges.items() if x == e)
            new.setdefault(e, [0, 0])[0] += DAMPING * rank.get(s, (0, 0))[0] * n / out
            new.setdefault(s, [0, 0])[1] += DAMPING * rank.get(e, (0, 0))[1] * n / into
        rank = new
    over = {h for h, (a, b) in rank.items() if b - a > THRESHOLD * (1 - DAMPING)}
    return [(i, h, p, r, v or ("block" if h in over else "allow")) for i, h, p, r, v in ruled], rank


@pytest.mark.parametrize("most", [url_filter.MOST_BROADCAST, 0])
def test_edge_rows(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MOST_BROADCAST", most)
    pages = spark.createDataFrame(ROWS, SCHEMA)
    want, rank = plain(ROWS)
    got = judged(pages).collect()
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    assert {r.host: (pytest.approx(r.trust), pytest.approx(r.distrust)) for r in got if r.host in rank} == {r.host: tuple(rank[r.host]) for r in got if r.host in rank}
    verdicts = {r.page_id: r.verdict for r in got}
    assert verdicts[6] == "block" and verdicts[5] == "allow" and verdicts[7] == "allow" and verdicts[1] == "allow" and verdicts[2] == "block"


def test_against_sql(spark, same_as_sql):
    same_as_sql(judged(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")), op8_sql())
    pages = spark.createDataFrame(ROWS, SCHEMA)
    same_as_sql(judged(pages), op8_sql(), {"pages": pages})


def test_hub_and_extra_columns(spark):
    hub = [(i, f"http://leaf{i}.org/", '<a href="http://hub.org/">h</a>') for i in range(300)] + [(1000, "http://hub.org/", '<a href="http://bad.net/es/">b</a>'), (1001, "http://bad.net/es/", "")]
    pages = spark.createDataFrame([(*r, "h", "p", "s") for r in hub], SCHEMA + ", host string, path string, salt string")
    want, rank = plain(hub)
    got = judged(pages).collect()
    assert sorted(tuple(r)[:5] for r in got if r.rule) == sorted(w for w in want if w[3])
    assert sorted(r.page_id for r in got if r.verdict == "block") == [w[0] for w in want if w[4] == "block"] == [1000, 1001]
    assert {r.host: pytest.approx(r.distrust) for r in got if r.host in rank} == {h: d for h, (_, d) in rank.items()}


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    want, _ = plain(rows)
    assert sorted(tuple(r)[:5] for r in judged(pages).collect()) == sorted(want) if all(w[3] for w in want) else sorted(map(str, (tuple(r)[:5] for r in judged(pages).collect()))) == sorted(map(str, want))


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert judged(pages).collect() == []
    assert host_links(pages).collect() == []
    assert propagate(host_links(pages), spark.createDataFrame([], "host string, trust double, distrust double")).collect() == []
