r"""URL filters by propagation over the host graph.

Rules decide the urls they fit: a rule (host, path) fits its host and all
subdomains if the url's path starts with the rule's, and the longest rule
wins.  Other urls get the verdict of their host, which comes from the link graph:

* edges: for every page, its host to each host that a link of its html with a host names (``https://host/...`` or
  ``//host/...``), and both ways between a host and its parent domain (hosts under one
  domain vouch for each other), weighted by pages;
* trust is a personalised PageRank from the hosts of allowed pages along the
  edges, distrust one from the hosts of blocked pages against them;
* a host is blocked when its distrust is above ``RATIO`` hundredths of its trust.

Propagation goes on until no more than one part in 10,000 of the mass can still move, whatever the graph
(``ROUNDS``), so chains of that length carry a verdict to their end.

Masses are integers (``MASS`` units in all, divisions round down), so sums do
not depend on their order and the result is exact and repeatable.  Edges are
counted before the shuffle, so a host with a third of all pages is a few rows per
task; the graph's tables are joined by shuffle and never leave Spark.

Defined cases: null urls and urls without ``://`` have an empty host and path,
fit no rule (but one with an empty host) and are no node: they are allowed; null html has no link;
repeated pages count as often as they occur; hosts without any mass, and those whose masses tie, are
allowed; urls and html of any length are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import checkpoint

#: (host, path, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
MASS = 10**15
#: Share of a host's mass that goes on along its edges, in hundredths.
DAMPING = 85
#: Rounds of propagation: ``DAMPING ** ROUNDS`` bounds the share of all mass that still moves, here 1 in 10,000.
ROUNDS = 57
RATIO = 100
#: Edges that one task takes in a round.
EDGES_A_TASK = 100_000
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _parents(hosts: DataFrame) -> DataFrame:
    """``host parent`` for all domains above a host that have two labels at least."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    at = F.when(n > 2, F.sequence(F.lit(0), n - 3)).otherwise(F.expr("cast(array() as array<int>)"))
    steps = hosts.select(F.explode_outer(F.transform(at, lambda i: F.struct(
        F.array_join(F.slice(labels, i + 1, n), ".").alias("host"), F.array_join(F.slice(labels, i + 2, n), ".").alias("parent")))).alias("s"))
    return steps.where("s is not null").select("s.host", "s.parent")


def host_edges(pages: DataFrame) -> DataFrame:
    """``src dst weight`` of ``pages`` (``host html``), without loops."""
    links = pages.where("host <> ''").select("host", F.explode_outer(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("to"))
    links = links.where("to is not null").select(F.col("host").alias("src"), ascii_lower(F.col("to")).alias("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    weights = pages.where("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("weight"))
    above = _parents(weights.select("host")).distinct().join(weights, "host", "left").select("host", "parent", F.coalesce("weight", F.lit(1)).alias("weight"))
    both = above.select(F.col("host").alias("src"), F.col("parent").alias("dst"), "weight").union(
        above.select(F.col("parent").alias("src"), F.col("host").alias("dst"), "weight")
    )
    return links.union(both).where("src <> dst").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``host trust distrust`` from ``seeds`` (``host allowed blocked``: pages), also of the hosts that no mass came to."""
    spark = edges.sparkSession
    ways = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").union(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), "weight")  # distrust runs from a host to those that link to it
    )
    out = ways.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    ways = checkpoint(ways.join(out, ["kind", "src"]), spark)
    kinds = seeds.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), "host", F.col("allowed").alias("n")), F.struct(F.lit("distrust").alias("kind"), "host", F.col("blocked").alias("n")))).alias("s"))
    kinds = kinds.select("s.*").where("n > 0")
    total = kinds.groupBy("kind").agg(F.sum("n").alias("total"))
    start = checkpoint(kinds.join(F.broadcast(total), "kind").select("kind", "host", F.expr(f"cast(cast(n as decimal(20, 0)) * {MASS} div total as bigint)").alias("seed")), spark)  # two rows of totals
    # every task of a round leaves shuffle files of its own, so the tasks follow the graph's size and not the session's partitions
    tasks = 1 + ways.count() // EDGES_A_TASK
    ways, start = ways.coalesce(tasks), start.coalesce(tasks)
    mass = start.select("kind", "host", F.col("seed").alias("mass"))
    stay = start.select("kind", "host", F.expr(f"seed * {100 - DAMPING}L div 100").alias("mass"))
    for r in range(rounds):
        moved = mass.withColumnRenamed("host", "src").join(ways, ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), F.expr(f"(mass * {DAMPING}L) div (100L * out) * weight").alias("mass")
        )
        mass = moved.union(stay).groupBy("kind", "host").agg(F.sum("mass").alias("mass")).coalesce(tasks)
        if r % 3 == 2 and r + 1 < rounds:
            mass = checkpoint(mass, spark)
    pick = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0)).alias(k)
    unreached = ways.select("kind", F.col("dst").alias("host"), F.lit(0).cast("bigint").alias("mass"))  # of a pair of hosts, each is a dst of one kind
    return mass.union(unreached).groupBy("host").agg(pick("trust"), pick("distrust"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id host path rule verdict trust distrust`` of every page (``page_id url html``)."""
    parsed = pages.select("page_id", "html", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"))
    one = lambda v: F.sum(F.when(F.col("ruled") == v, 1).otherwise(0))
    seeds = ruled.where("host <> ''").groupBy("host").agg(one("allow").alias("allowed"), one("block").alias("blocked"))
    masses = propagate(host_edges(parsed), seeds)
    per_host = masses.select("host", "trust", "distrust")
    joined = ruled.join(per_host, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0)), F.coalesce("distrust", F.lit(0))
    own = F.when(distrust * 100 > trust * RATIO, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), trust.alias("trust"), distrust.alias("distrust")
    )


def _sql() -> str:
    rule = verdict = "NULL"
    for h, p, v in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{h + p}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{v}' ELSE {verdict} END"
    link = LINK.replace("'", "''")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = []
    for r in range(ROUNDS):
        steps.append(f"""m{r + 1} AS MATERIALIZED (SELECT kind, host, sum(mass)::BIGINT AS mass FROM (
          SELECT w.kind, w.dst AS host, (m.mass * {DAMPING}) // (100 * w.total) * w.weight AS mass FROM m{r} m JOIN ways w ON w.kind = m.kind AND w.src = m.host
          UNION ALL SELECT kind, host, seed * {100 - DAMPING} // 100 FROM start) GROUP BY kind, host)""")
    return f"""
WITH p AS (SELECT page_id, html, coalesce({lower.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS MATERIALIZED (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled FROM p),
links AS (SELECT host AS src, dst, count(*) AS weight FROM (SELECT host, {lower.format('t')} AS dst FROM (
    SELECT host, unnest(list_distinct(regexp_extract_all(html, '{link}', 1))) AS t FROM p WHERE host <> '')) GROUP BY ALL),
hosts AS (SELECT host, count(*) AS weight, string_split(host, '.') AS l FROM p WHERE host <> '' GROUP BY host),
chain AS (SELECT DISTINCT array_to_string(l[i:], '.') AS host, array_to_string(l[i + 1:], '.') AS parent FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM hosts WHERE len(l) > 2)),
above AS (SELECT chain.host, parent, coalesce(weight, 1) AS weight FROM chain LEFT JOIN hosts USING (host)),
edges AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT src, dst, weight FROM links UNION ALL SELECT host, parent, weight FROM above
    UNION ALL SELECT parent, host, weight FROM above) WHERE src <> dst GROUP BY src, dst),
way AS (SELECT 'trust' AS kind, src, dst, weight FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges),
ways AS MATERIALIZED (SELECT kind, src, dst, weight::BIGINT AS weight, (sum(weight) OVER (PARTITION BY kind, src))::BIGINT AS total FROM way),
s AS (SELECT CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM ruled WHERE host <> '' AND ruled IS NOT NULL GROUP BY ALL),
start AS MATERIALIZED (SELECT kind, host, (n::HUGEINT * {MASS} // (sum(n) OVER (PARTITION BY kind))::HUGEINT)::BIGINT AS seed FROM s),
m0 AS (SELECT kind, host, seed AS mass FROM start),
{', '.join(steps)},
h AS (SELECT host, coalesce(sum(mass) FILTER (WHERE kind = 'trust'), 0)::BIGINT AS trust, coalesce(sum(mass) FILTER (WHERE kind = 'distrust'), 0)::BIGINT AS distrust FROM m{ROUNDS} GROUP BY host)
SELECT page_id, ruled.host, path, rule, coalesce(ruled, CASE WHEN coalesce(distrust, 0) * 100 > coalesce(trust, 0) * {RATIO} THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM ruled LEFT JOIN h ON h.host = ruled.host
"""


SQL = _sql()
