"""URL filters: rules, and for pages without a rule a verdict from the link graph of hosts.

Hosts are linked where a page of one names the other: in a link, or by a word that is the host of
a page. Trust is a personalised PageRank from hosts most of whose pages a rule allows; distrust is
one over the reversed links from hosts most of whose pages a rule blocks, so it reaches hosts that
link to blocked ones. A host is blocked if distrust is above its trust and above the threshold
for its share of the graph.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.sqlwords import ascii_lower
from marketloom.llm.store import stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
DAMPING = 0.85
TOLERANCE = 1e-6
ROUNDS = math.ceil(math.log(TOLERANCE / 2) / math.log(DAMPING))  # after so many, ranks move by less than the tolerance
MIN_DISTRUST = 0.1  # of the mean rank of a host


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for urls without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """(name, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): pages of host src that name host dst. Rows need ``host`` and ``_html``."""
    named = F.regexp_extract_all(F.col("_html"), F.lit(r"((?://)?[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+(?::[0-9]+)?)"), F.lit(1))
    found = pages.select("host", F.explode(F.array_distinct(F.transform(named, ascii_lower))).alias("word"))
    links = found.groupBy("host", "word").agg(F.count(F.lit(1)).alias("n"))
    is_link = F.col("word").startswith("//")
    links = links.select(F.col("host").alias("src"), F.when(is_link, F.substring("word", 3, 1 << 30)).otherwise(F.col("word")).alias("dst"),
                         is_link.alias("link"), "n").filter("src <> dst AND src <> ''")
    hosts = pages.select(F.col("host").alias("dst")).distinct()
    mentions = links.filter("NOT link").join(hosts, "dst", "left_semi")
    return links.filter("link").unionByName(mentions).groupBy("src", "dst").agg(F.max("n").alias("n"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS,
              tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, rank) of personalised PageRanks, one for each ``kind`` of the seeds.

    ``links``: kind, src, dst, n; ``seeds``: kind, host. A host passes its rank on by the shares
    of n; what reaches hosts without links goes back to the seeds. Ranks of one kind add up to 1.
    Every round is written to the shared folder; only the change of the ranks comes to the driver.
    """
    totals = links.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    shares = stored(links.join(totals, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("out")).alias("share")), "shares")
    counts = seeds.distinct().groupBy("kind").agg(F.count(F.lit(1)).alias("seeds"))
    start = stored(seeds.distinct().join(counts, "kind").select("kind", "host", (1 / F.col("seeds")).alias("s")), "seeds")
    ranks = start.withColumnRenamed("s", "rank")
    if shares.isEmpty():
        return ranks
    for _ in range(rounds):
        got = shares.join(ranks, (shares["src"] == ranks["host"]) & (shares["kind"] == ranks["kind"])).groupBy(
            shares["kind"], F.col("dst").alias("host")).agg(F.sum(F.col("share") * F.col("rank")).alias("got"))
        got = stored(got, "got")
        back = got.groupBy("kind").agg(F.sum("got").alias("passed"))
        after = stored(
            got.join(start, ["kind", "host"], "full").join(F.broadcast(back), "kind", "left")  # a row per kind
            .select("kind", "host", (
                damping * F.coalesce("got", F.lit(0.0))
                + (1 - damping * F.coalesce("passed", F.lit(0.0))) * F.coalesce("s", F.lit(0.0))).alias("rank")), "ranks")
        moved = after.join(ranks.withColumnRenamed("rank", "was"), ["kind", "host"], "full").agg(
            F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("was", F.lit(0.0))))).first()[0]
        ranks = after
        if moved is None or moved < tolerance:
            break
    return ranks


def host_scores(pages: DataFrame) -> DataFrame:
    """host, trust, distrust, blocked for the hosts that have a rank. Rows need host, rule, _html."""
    links = host_links(pages)
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    share = lambda v: F.avg((F.coalesce(F.col("rule.verdict"), F.lit("")) == v).cast("int"))
    verdicts = pages.filter("host <> ''").groupBy("host").agg(share("allow").alias("allow"), share("block").alias("block"))
    seeds = verdicts.filter("allow > 0.5").select(F.lit("trust").alias("kind"), "host").unionByName(
        verdicts.filter("block > 0.5").select(F.lit("distrust").alias("kind"), "host"))
    ranks = propagate(stored(both, "host_links"), seeds)
    n_hosts = verdicts.count()
    by_kind = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k)
    return ranks.groupBy("host").agg(by_kind("trust"), by_kind("distrust")).withColumn(
        "blocked", (F.col("distrust") > F.col("trust")) & (F.col("distrust") * max(n_hosts, 1) > MIN_DISTRUST))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "page_id", url: str = "url",
                html: str = "html") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, trust, distrust.

    Null urls and urls without ``://`` have an empty host and path; hosts without any rank, the
    empty one too, are allowed unless a rule says otherwise. Null html has no links. A page's
    verdict is its rule's, else its host's. Rules are few and held in the plan. Repeated rows count
    each for their host; an empty table gives no rows. Other columns are not read.
    """
    raw = pages.select(F.col(id).alias(id), F.col(url).alias("_url"), F.col(html).alias("_html"))
    host, path = url_parts(F.col("_url"))
    parsed = raw.select(id, host.alias("host"), path.alias("path"), "_html").withColumn(
        "rule", matched_rule(F.col("host"), F.col("path"), rules))
    scores = stored(host_scores(parsed), "host_scores")
    return parsed.join(scores, "host", "left").select(
        id, "host", "path", F.col("rule.name").alias("rule"),
        F.coalesce(F.col("rule.verdict"), F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def url_digest(pages: DataFrame) -> DataFrame:
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def digest_sql() -> str:
    """The same in SQL over pages, with all rounds of the propagation."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    longest = sorted(RULES, key=lambda r: (-len(r.name), r.name))
    fits = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
                    for r in longest)
    verdicts = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in RULES)
    return f"""
WITH RECURSIVE rests AS (
  SELECT row_number() OVER () AS r, page_id, html,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT r, page_id, html, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
ruled AS (SELECT *, CASE {fits} END AS rule FROM parsed),
judged AS (SELECT *, CASE rule {verdicts} END AS ruling FROM ruled),
words AS (
  SELECT DISTINCT r, host, {lower.format('word')} AS word FROM (
    SELECT r, host, unnest(regexp_extract_all(html, '((?://)?[A-Za-z0-9_-]+(?:\\.[A-Za-z0-9_-]+)+(?::[0-9]+)?)', 1)) AS word FROM judged)),
named AS (
  SELECT host AS src, CASE WHEN starts_with(word, '//') THEN substr(word, 3) ELSE word END AS dst, starts_with(word, '//') AS link, count(*) AS n
  FROM words GROUP BY ALL),
links AS (
  SELECT src, dst, max(n) AS n FROM named WHERE src <> dst AND src <> '' AND (link OR dst IN (SELECT host FROM judged)) GROUP BY ALL),
edges AS (SELECT 'trust' AS kind, src, dst, n FROM links UNION ALL SELECT 'distrust', dst, src, n FROM links),
shares AS (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS share FROM edges),
hosts AS (
  SELECT host, avg((coalesce(ruling, '') = 'allow')::INT) AS allow, avg((coalesce(ruling, '') = 'block')::INT) AS block
  FROM judged WHERE host <> '' GROUP BY host),
seeds AS (
  SELECT kind, host, 1.0::DOUBLE / count(*) OVER (PARTITION BY kind) AS s FROM (
    SELECT 'trust' AS kind, host FROM hosts WHERE allow > 0.5 UNION ALL SELECT 'distrust', host FROM hosts WHERE block > 0.5)),
ranks AS (
  SELECT 0 AS i, kind, host, s AS rank FROM seeds
  UNION ALL
  SELECT i + 1, kind, host, {DAMPING} * sum(got) + (1 - {DAMPING} * sum(sum(got)) OVER (PARTITION BY kind)) * max(s) FROM (
    SELECT k.i, e.kind, e.dst AS host, k.rank * e.share AS got, 0.0::DOUBLE AS s FROM ranks k JOIN shares e ON e.kind = k.kind AND e.src = k.host
    UNION ALL SELECT k.i, s.kind, s.host, 0.0, s.s FROM (SELECT DISTINCT i FROM ranks) k, seeds s) WHERE i < {ROUNDS} GROUP BY i, kind, host),
scores AS (
  SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0) AS trust, coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0) AS distrust
  FROM ranks WHERE i = {ROUNDS} GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(ruling, CASE WHEN distrust > trust AND distrust * greatest((SELECT count(*) FROM hosts), 1) > {MIN_DISTRUST}
  THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN scores USING (host)"""
