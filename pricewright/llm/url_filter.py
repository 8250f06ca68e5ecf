"""URL filter: rules for hosts and paths, and trust that flows over the link graph for the rest.

Rules are matched per distinct host by joining the suffixes of the host with the rule
table. Hosts whose pages rules allow seed trust, hosts whose pages rules block seed
distrust. Personalised PageRank sends trust along links and distrust against
them; a host is judged by the difference. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.staging import staged

DAMPING = 0.85
#: Most that a host's score may lack, in seeds of one wholly allowed or blocked host.
CLOSE = 1e-4
#: Of the score of a host without links that is blocked as a whole.
THRESHOLD = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)"""


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path: from there up to ``? #``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: str) -> Column:
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules``: the rules for a host or a domain above it, longest first; equal rules: block first."""
    table = rules.where("rule IS NOT NULL").select(
        "rule", "verdict", F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("suffix"),
        F.expr("substring(rule, instr(concat(rule, '/'), '/'))").alias("start")).distinct()
    found = hosts.select("host", F.explode(_suffixes("host")).alias("suffix")).join(table, "suffix")
    entry = F.struct(F.length("rule").alias("size"), (F.col("verdict") == "block").alias("strict"),
                     "rule", "start", "verdict")
    return found.groupBy("host").agg(F.sort_array(F.collect_list(entry), asc=False).alias("rules"))


def links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``source, target, n``: absolute links between different hosts, counted before they move."""
    found = pages.select(F.col("host").alias("source"), F.explode(
        F.regexp_extract_all(F.col(f"`{html_col}`"), F.lit(_LINK), F.lit(1))).alias("target"))
    return (found.withColumn("target", F.translate("target", _UPPER, _LOWER))
            .where("source != '' AND source != target").groupBy("source", "target").agg(F.count("*").alias("n")))


def propagated(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, close: float = CLOSE) -> DataFrame:
    """``host, trust, distrust`` of ``host, trust, distrust`` seeds over ``source, target, n``.

    One personalised PageRank per direction, both in the same passes: a host passes
    ``damping`` of its trust to the hosts it links to, and of its distrust to those that
    link to it, in proportion to the links. Scores are divided by ``1 - damping``, so a
    host without links keeps its seed. Rounds end when all that can still arrive anywhere,
    ``damping / (1 - damping)`` of what moved last, is at most ``close``, so no host lacks
    more than that, whatever other hosts the table has. What moves is at most ``damping`` of
    the round before, so ``log(close * (1 - damping) / linked seeds) / log(damping)`` rounds
    are enough. The largest change of a host would not do: many small ones can meet in one.
    """
    edges = staged(edges, "links")
    if edges.isEmpty():
        return seeds
    out = edges.groupBy(F.col("source").alias("host")).agg(F.sum("n").alias("all"))
    into = edges.groupBy(F.col("target").alias("host")).agg(F.sum("n").alias("all"))
    share = (F.col("n") / F.col("all")).alias("share")
    flows = staged(
        edges.join(out, F.col("source") == F.col("host")).select(
            F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("other"), share)
        .union(edges.join(into, F.col("target") == F.col("host")).select(
            F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("other"), share)),
        "flows")
    start = seeds.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust"))
                         .alias("kind", "seed"))
    start = staged(start.where("seed > 0"), "seeds")
    moving = start.join(flows.select("kind", "host").distinct(), ["kind", "host"], "left_semi").select(
        "kind", "host", F.lit(0.0).alias("gained"), F.col("seed").alias("step"))
    left = moving.agg(F.sum("step")).first()[0] or 0.0
    while left * damping / (1 - damping) > close:
        moved = flows.join(moving.where("step > 0"), ["kind", "host"]).select(
            "kind", F.col("other").alias("host"), (damping * F.col("share") * F.col("step")).alias("step"))
        moving = staged(moving.select("kind", "host", "gained", F.lit(0.0).alias("step"))
                        .union(moved.select("kind", "host", F.col("step").alias("gained"), "step"))
                        .groupBy("kind", "host").agg(F.sum("gained").alias("gained"), F.sum("step").alias("step")),
                        "ranks")
        left = moving.agg(F.sum("step")).first()[0] or 0.0
    rank = start.withColumnRenamed("seed", "score").select("kind", "host", "score").union(
        moving.select("kind", "host", F.col("gained").alias("score")))
    return rank.groupBy("host").agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k)
                                      for k in ("trust", "distrust")))


def judged(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
           html_col: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """Verdict on every url: id, ``host, path, rule, verdict, trust, distrust``.

    ``rules`` has ``rule`` (``host/path``) and ``verdict`` (allow or block). A rule fits its host
    and all subdomains if the path starts with the rule's path; the longest wins.
    Other pages are blocked if the distrust of their host exceeds its trust by
    ``threshold``. A host's seeds are the shares of its pages that rules allow and block.

    A null url, or one without ``://``, has an empty host and path: no rule fits and
    nothing is known, so it is allowed; so is a host that neither rules nor links
    reach. Null html has no links. Repeated rows are judged alike and count twice as
    seeds. Empty tables give no rows or no rules. Other columns are not looked at.
    """
    base = pages.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{url_col}`").alias("__url"))
    host, path = host_and_path("__url")
    urls = base.select("__id", host.alias("host"), path.alias("path"))
    hosts = urls.where("host != ''").select("host").distinct()
    by_host = staged(rules_by_host(hosts, rules), "rules")
    fitting = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["start"])), F.lit(0))
    ruled = urls.join(by_host, "host", "left").withColumn("hit", fitting).drop("rules")
    seeds = ruled.where("host != ''").groupBy("host").agg(
        F.avg(F.when(F.col("hit.verdict") == "allow", 1.0).otherwise(0.0)).alias("trust"),
        F.avg(F.when(F.col("hit.verdict") == "block", 1.0).otherwise(0.0)).alias("distrust"))
    linking = pages.select(F.col(f"`{url_col}`").alias("__url"), F.col(f"`{html_col}`").alias("__html"))
    edges = links(linking.select(host.alias("host"), "__html"), "__html")
    scores = staged(propagated(seeds, edges), "scores")
    unsure = F.when(F.col("distrust") - F.col("trust") >= threshold, "block").otherwise("allow")
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return ruled.join(scores, "host", "left").select(
        F.col("__id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", unsure).alias("verdict"), zero("trust"), zero("distrust"))
