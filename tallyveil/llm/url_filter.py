"""URL filters: path rules first, then trust and distrust along host links.

Hosts are trusted and blocked seeds by the share of their pages that rules
allow and block. Personalised PageRank carries trust along the links between
hosts, and the same walk over reversed links carries distrust from the blocked
seeds to the hosts that link to them. Seeds keep their weight whatever their
number, so a host's ranks depend on its neighbourhood only. A host is blocked
when its distrust exceeds its trust by as much as a share of blocked pages of
its own would give it; that verdict holds for urls that no rule fits.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import staged

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Rules up to which their table is broadcast.
MOST_BROADCAST = 100_000
#: Lanes of a host's paths, and salts of a url's pages.
SALTS = 16
DAMPING = 0.85
ROUNDS = 12
#: Share of a host's own pages, all others being neutral, beyond whose distrust it is blocked.
THRESHOLD = 0.25
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lowered; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def fitting_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """For each host with any rule of its own or of a parent domain: host, rules (sorted array, the strongest first).

    The longest rule (host and path together) is the strongest; of equally long
    ones that with the longer host; of equal ones that which blocks.
    """
    known = rules.select(F.col("host").alias("suffix"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")).dropna().distinct()
    if known.count() <= MOST_BROADCAST:
        known = F.broadcast(known)
    each = hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("suffix")).join(known, "suffix")
    rule = F.struct((-F.length("suffix") - F.length("rule_path")).alias("a"), (-F.length("suffix")).alias("b"), (F.col("rule_verdict") != "block").alias("c"), "suffix", "rule_path", "rule_verdict")
    return each.groupBy("host").agg(F.array_sort(F.collect_list(rule)).alias("rules"))


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Links between different hosts: src, dst, n. Relative links stay on their host and don't count."""
    src = host_of(F.col(url_col))
    found = pages.select(src.alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), F.lit(1))).alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    return found.select("src", host_of(full).alias("dst")).filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def _salted(host: str) -> Column:
    return F.pmod(F.xxhash64(host), F.lit(SALTS)).cast("int")


def propagate(links: DataFrame, seeds: DataFrame, *, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """Trust and distrust of hosts: host, trust, distrust.

    links: src, dst, n. seeds: host, trust, distrust (weights, not negative),
    where walks start and restart. A walk at a host without a way on ends
    there. Hosts that no walk reaches are left out. A hub's links are spread
    by a salt of their other end.
    """
    start = staged(seeds.select("host", F.col("trust").cast("double").alias("trust"), F.col("distrust").cast("double").alias("distrust")), "seeds")
    links = staged(links.select("src", "dst", "n", _salted("src").alias("src_salt"), _salted("dst").alias("dst_salt")), "host-links")
    again = start.select("host", (F.col("trust") * (1 - damping)).alias("trust"), (F.col("distrust") * (1 - damping)).alias("distrust"))
    if links.isEmpty():
        return again
    out = links.groupBy("src").agg(F.sum("n").alias("out"), F.collect_set("dst_salt").alias("salts")).select("src", "out", F.explode("salts").alias("dst_salt"))
    into = links.groupBy("dst").agg(F.sum("n").alias("into"), F.collect_set("src_salt").alias("salts")).select("dst", "into", F.explode("salts").alias("src_salt"))
    both = links.join(out, ["src", "dst_salt"]).join(into, ["dst", "src_salt"])
    forward = both.select(F.col("src").alias("host"), F.col("dst").alias("to"), F.col("dst_salt").alias("salt"), (F.col("n") / F.col("out")).alias("trusted"), F.lit(0.0).alias("distrusted"))
    reverse = both.select(F.col("dst").alias("host"), F.col("src").alias("to"), F.col("src_salt").alias("salt"), F.lit(0.0).alias("trusted"), (F.col("n") / F.col("into")).alias("distrusted"))
    arcs = staged(forward.unionByName(reverse), "host-arcs")
    in_use = staged(arcs.groupBy("host").agg(F.collect_set("salt").alias("salts")), "host-salts")
    rank = start
    for done in range(1, rounds + 1):
        spread = rank.join(in_use, "host").withColumn("salt", F.explode("salts"))
        moved = spread.join(arcs, ["host", "salt"]).select(F.col("to").alias("host"), (F.col("trust") * F.col("trusted") * damping).alias("trust"), (F.col("distrust") * F.col("distrusted") * damping).alias("distrust"))
        rank = moved.unionByName(again).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if done % 4 == 0 and done < rounds:
            rank = staged(rank, "host-ranks")
    return rank


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, threshold: float = THRESHOLD, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """One row for each page: id, host, path, rule, verdict, trust, distrust.

    A host is a trusted or blocked seed by the share of all its pages that
    rules allow or block. Pages with a null url, or one without ://, have an empty
    host and path, fit no rule and are allowed. Repeated rows give repeated
    rows; null html has no links; an empty table gives no rows. Other columns
    play no part.
    """
    spark = pages.sparkSession
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), "host string, path string, verdict string")
    path = path_of(F.col(url_col))
    named = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path.alias("path"), F.pmod(F.xxhash64(path), F.lit(SALTS)).alias("lane"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).alias("salt"))

    # A hot host spreads over lanes of its paths, a hot url over salts of its pages: tables of hosts get a row
    # for each lane in use, tables of sites a row for each salt in use.
    lanes = staged(named.select("host", "lane").distinct(), "host-lanes")
    per_host = lanes.join(fitting_rules(lanes.select("host").distinct(), table), "host")
    sites = named.groupBy("host", "lane", "path").agg(F.count(F.lit(1)).alias("pages"), F.collect_set("salt").alias("salts")).join(per_host, ["host", "lane"], "left")
    rule = F.try_element_at(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), F.lit(1))
    sites = sites.select("host", "lane", "path", "pages", "salts", rule.alias("r"))
    sites = staged(sites.select("host", "lane", "path", "pages", "salts", F.concat("r.suffix", "r.rule_path").alias("rule"), F.col("r.rule_verdict").alias("by_rule")), "ruled-sites")
    share = lambda verdict: F.coalesce(F.sum(F.when(F.col("by_rule") == verdict, F.col("pages"))) / F.sum("pages"), F.lit(0.0))
    seeds = sites.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")).filter("trust > 0 OR distrust > 0")
    rank = lanes.join(propagate(host_links(pages, url_col, html_col), seeds, damping=damping, rounds=rounds), "host")
    verdict = F.coalesce("by_rule", F.when(F.coalesce("distrust", F.lit(0.0)) - F.coalesce("trust", F.lit(0.0)) > threshold * (1 - damping), "block").otherwise("allow"))
    decided = sites.join(rank, ["host", "lane"], "left").select("host", "path", F.explode("salts").alias("salt"), "rule", verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    return named.join(decided, ["host", "path", "salt"]).select(F.col("id").alias(id_col), "host", "path", "rule", "verdict", "trust", "distrust")


def op8_sql() -> str:
    """DuckDB SQL for `judged` with its default parameters, a table for each round of the walks."""
    link = LINK.replace("'", "''")
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    lower = lambda x: f"translate(x, '{string.ascii_uppercase}', '{string.ascii_lowercase}')".replace("(x", f"({x}")
    host = lambda x: lower(f"regexp_extract({x}, '(?s)^.*?://([^/?#]*)', 1)")
    rounds = "".join(
        f"""
w{k} AS (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
    SELECT dst AS host, trust * (n / out_n) * {DAMPING} AS trust, distrust * 0 AS distrust FROM w{k - 1} JOIN e ON host = src
    UNION ALL SELECT src, trust * 0, distrust * (n / in_n) * {DAMPING} FROM w{k - 1} JOIN e ON host = dst
    UNION ALL SELECT host, trust * (1 - CAST({DAMPING} AS DOUBLE)), distrust * (1 - CAST({DAMPING} AS DOUBLE)) FROM w0) GROUP BY host),"""
        for k in range(1, ROUNDS + 1)
    )
    return f"""
WITH p AS (SELECT row_number() OVER () AS k, page_id, coalesce(html, '') AS html, {host("coalesce(url, '')")} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
u(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
f AS (SELECT k, rule_host || rule_path AS rule, rule_verdict FROM p JOIN u ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      QUALIFY row_number() OVER (PARTITION BY k ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, rule_verdict = 'block' DESC) = 1),
w0 AS (SELECT host, count(*) FILTER (rule_verdict = 'allow') / count(*) AS trust, count(*) FILTER (rule_verdict = 'block') / count(*) AS distrust
       FROM p LEFT JOIN f USING (k) GROUP BY host HAVING count(rule) > 0),
l AS (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM p),
h AS (SELECT src, {host("CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END")} AS dst FROM l),
g AS (SELECT src, dst, count(*) AS n FROM h WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
e AS (SELECT src, dst, n, sum(n) OVER (PARTITION BY src) AS out_n, sum(n) OVER (PARTITION BY dst) AS in_n FROM g),{rounds}
r AS (SELECT host, trust, distrust FROM w{ROUNDS})
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN coalesce(distrust, 0) - coalesce(trust, 0) > {THRESHOLD} * (1 - CAST({DAMPING} AS DOUBLE)) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM p LEFT JOIN f USING (k) LEFT JOIN r USING (host)"""
