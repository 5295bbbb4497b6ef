"""URL rules and trust over the link graph of hosts.

A url's host and path are cut out as text. Rules are ``host/path`` strings
with a verdict; a rule fits its host and all subdomains if the url's path
starts with the rule's, and the longest fitting rule decides.

Where no rule fits, the graph does. Links of all pages are resolved to hosts
and counted per (from, to) before they move. Trust spreads along the links by
personalised PageRank from the hosts with allowed pages, distrust against them
from the hosts with blocked pages, each seed weighted by the number of such
pages. A host is blocked when its share of distrust exceeds ``RATIO`` times
its share of trust, else allowed. ``ROUNDS`` rounds leave about 1 % of the
mass unsettled (0.7^12); every round is a join and a sum over host edges.

Only DataFrame operations are used. Edges of one host pair are one row and
sums combine before the shuffle, so a host with a third of all pages costs a
row per task; host-keyed joins are skew joins of small rows.

Defined results: a null url or one without ``://`` has an empty host and path,
no rule and the verdict of a host without any score (allow); repeated rows are
judged each; null html has no links; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import pages, written

#: Rules of the query: verdict by ``host/path``.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
DAMPING, ROUNDS, RATIO = 0.7, 12, 1.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and the domains above it."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """rule, domain, prefix and says of each rule."""
    rows = spark.createDataFrame([tuple(r) for r in rules], "rule string, says string")
    at = F.locate("/", F.col("rule"))
    return rows.select("rule", "says", F.substring("rule", F.lit(1), at - 1).alias("domain"),
                       F.expr("substring(rule, locate('/', rule))").alias("prefix"))


def apply_rules(spark: SparkSession, urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path and more) plus rule and says, null where none fits."""
    # rules meet hosts, not urls: each different host once, with every rule that fits it
    hosts = urls.select("host").distinct()
    fit = (hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("domain")).join(rules, "domain")
           .groupBy(F.col("host").alias("_host"))
           .agg(F.array_sort(F.collect_list(F.struct((-F.length("rule")).alias("n"), "rule", "prefix", "says"))).alias("_fit")))
    fit = written(spark, fit, "host-rules")
    first = F.filter("_fit", lambda r: F.startswith(F.col("path"), r["prefix"]))
    best = F.get(first, F.lit(0))
    return (urls.join(fit, F.col("host") == F.col("_host"), "left")
            .select(*urls.columns, best["rule"].alias("rule"), best["says"].alias("says")))


def host_edges(rows: DataFrame) -> DataFrame:
    """from_host, to_host and the number of links, of rows with host and html.
    A link without a host points to its page's own."""
    link = (rows.where("host != ''")
            .select("host", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href")))
    full = F.when(F.col("href").startswith("//"), F.concat(F.lit("x:"), F.col("href"))).otherwise(F.col("href"))
    web = full.rlike(r"^(?i:https?|x)://")
    other = full.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    to = F.when(web, host_of(full)).when(~other, F.col("host"))
    return (link.select(F.col("host").alias("from_host"), to.alias("to_host")).where("to_host != ''")
            .groupBy("from_host", "to_host").agg(F.count("*").alias("links")))


def spread(spark: SparkSession, edges: DataFrame, seeds: DataFrame, damping: float = DAMPING,
           rounds: int = ROUNDS) -> DataFrame:
    """host, trust and distrust: the mass that random walks from the seeds
    (host, good, bad) leave on each host, following ``edges`` (from_host,
    to_host, links) for trust and following them backwards for distrust. Both
    walk at once, told apart by ``bad``."""
    both = (edges.select(F.lit(False).alias("bad"), F.col("from_host").alias("a"), F.col("to_host").alias("b"), "links")
            .unionByName(edges.select(F.lit(True).alias("bad"), F.col("to_host").alias("a"),
                                      F.col("from_host").alias("b"), "links")))
    out = both.groupBy("bad", "a").agg(F.sum("links").alias("n"))
    steps = written(spark, both.join(out, ["bad", "a"]).select("bad", "a", "b", (F.col("links") / F.col("n")).alias("p")),
                    "steps")
    total = seeds.agg(F.sum(F.col("good") + F.col("bad"))).first()[0] or 1
    start = written(spark, seeds.select("host", F.explode(F.array(
        F.struct(F.lit(False).alias("bad"), (F.col("good") / total).alias("score")),
        F.struct(F.lit(True).alias("bad"), (F.col("bad") / total).alias("score")))).alias("x"))
        .select("host", "x.bad", "x.score").where("score > 0"), "seeds")
    again = start.select("host", "bad", (F.col("score") * (1 - damping)).alias("score"))
    score = start
    for i in range(rounds):
        moved = (score.join(steps, (F.col("host") == F.col("a")) & (score["bad"] == steps["bad"]))
                 .select(F.col("b").alias("host"), score["bad"], (F.col("score") * F.col("p") * damping).alias("score")))
        score = moved.unionByName(again).groupBy("host", "bad").agg(F.sum("score").alias("score"))
        if i % 3 == 2:  # short lineage
            score = written(spark, score, "score")
    return score.groupBy("host").agg(F.sum(F.when(~F.col("bad"), F.col("score"))).alias("trust"),
                                     F.sum(F.when(F.col("bad"), F.col("score"))).alias("distrust"))


def judge_urls(spark: SparkSession, rows: DataFrame, rules: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS,
               ratio: float = RATIO) -> DataFrame:
    """page_id, host, path, rule and verdict of ``rows`` (page_id, url, html),
    with trust and distrust of the host."""
    parts = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = written(spark, apply_rules(spark, parts, rules), "ruled")
    count = lambda says: F.sum((F.col("says") == says).cast("long"))
    seeds = (ruled.where(F.col("says").isNotNull()).groupBy("host")
             .agg(count("allow").alias("good"), count("block").alias("bad")))
    edges = written(spark, host_edges(rows.select(host_of(F.col("url")).alias("host"), "html")), "host-edges")
    scores = written(spark, spread(spark, edges, seeds, damping, rounds), "trust").withColumnRenamed("host", "_host")
    blocked = F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0)) * ratio
    by_graph = F.when(blocked, "block").otherwise("allow")
    return (ruled.join(scores, F.col("host") == F.col("_host"), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("says", by_graph).alias("verdict"),
                    "trust", "distrust"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark, pages(spark, sf_dir), rules_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    rules = ", ".join(f"('{r}', '{v}')" for r, v in RULES)
    host = lambda u: (f"translate(coalesce(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}')")
    href = HREF.replace("'", "''")
    walk = "".join(f""", s{i + 1} AS MATERIALIZED (
  SELECT host, bad, sum(score) AS score FROM (
    SELECT b AS host, s{i}.bad, score * p * {DAMPING}::DOUBLE AS score FROM s{i} JOIN steps ON s{i}.host = a AND s{i}.bad = steps.bad
    UNION ALL SELECT host, bad, score * (1 - {DAMPING}::DOUBLE) FROM s0) GROUP BY ALL
)""" for i in range(ROUNDS))
    return rf"""
WITH rules AS (
  SELECT rule, says, substr(rule, 1, strpos(rule, '/') - 1) AS domain, substr(rule, strpos(rule, '/')) AS prefix
  FROM (VALUES {rules}) t(rule, says)
), p AS (
  SELECT row_number() OVER () AS r, page_id, html, {host('url')} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), ruled AS (
  SELECT p.r, any_value(page_id) AS page_id, any_value(host) AS host, any_value(path) AS path,
    first(rule ORDER BY length(rule) DESC, rule) AS rule, first(says ORDER BY length(rule) DESC, rule) AS says
  FROM p LEFT JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix) GROUP BY p.r
), l AS (
  SELECT host, unnest(regexp_extract_all(html, '{href}', 1)) AS href FROM p WHERE host <> ''
), l2 AS (SELECT host, CASE WHEN starts_with(href, '//') THEN 'x:' || href ELSE href END AS href FROM l
), edges AS (
  SELECT host AS a, b, count(*) AS links FROM (
    SELECT host, CASE WHEN regexp_matches(href, '^(?i:https?|x)://') THEN {host('href')}
      WHEN NOT regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN host END AS b FROM l2) WHERE b <> '' GROUP BY ALL
), both_ways AS (SELECT false AS bad, a, b, links FROM edges UNION ALL SELECT true, b, a, links FROM edges
), steps AS MATERIALIZED (SELECT bad, a, b, links / sum(links) OVER (PARTITION BY bad, a) AS p FROM both_ways
), seeds AS (
  SELECT host, says = 'block' AS bad, count(*) AS n FROM ruled WHERE says IS NOT NULL GROUP BY ALL
), s0 AS MATERIALIZED (SELECT host, bad, n / (SELECT sum(n) FROM seeds) AS score FROM seeds){walk}
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN coalesce(distrust, 0) > {RATIO} * coalesce(trust, 0)
  THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN (SELECT host AS h, sum(score) FILTER (NOT bad) AS trust, sum(score) FILTER (bad) AS distrust
  FROM s{ROUNDS} GROUP BY host) ON host = h
"""


OP3_SQL = _oracle()
