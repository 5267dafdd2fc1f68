"""URL filters: rules first, and for hosts without one, trust carried along the links.

Pages that a rule allows make their host a trusted seed, pages that one blocks a distrusted one,
each with as much weight as it has such pages. Trust is carried by personalised PageRank along
the links between hosts, distrust by the same along the links turned round: who links to a
blocked host shares its distrust. A host is blocked where its distrust is more than a given share
of both together; a host that neither reaches is allowed. Rounds go on until every host that can be
reached is, over however many links (some 4,300 in a row, where 0.85 to that power is too small
for a double), and no score changes any more.

Links are the absolute targets of ``href`` in the html; they are counted per pair of hosts before
anything is shuffled, so a host with a third of all pages or links is a sum over many tasks. What
a host without outgoing links would pass on goes back to the seeds. A null url, or one without
``://``, has empty host and path, fits no rule and is allowed; a null html has no links.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialize

#: Share of its weight that a host passes on in a round.
DAMPING = 0.85
#: Scores are settled when a round adds no more than this share to any of them.
TOLERANCE = 1e-13
#: No limit, but the rounds after which less than the tolerance of all weight is still on its way, in
#: any graph: a fixed number of rounds for a plain version to compare with.
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
#: Most distrust of all that reaches a host.
THRESHOLD = 0.5

LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds host, path, and rule and ruling of the longest rule that fits.

    rules: ``(host + path, "allow" or "block")``. Of two rules of the same length the first wins.
    """
    at = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    best = F.lit(None).cast("struct<rule:string,ruling:string>")
    for text, ruling in sorted(rules, key=lambda r: len(r[0]), reverse=True):
        host, slash, path = text.partition("/")
        fits = (F.col("host") == host) | F.endswith("host", F.lit("." + host))
        fits = fits & F.startswith("path", F.lit(slash + path))
        best = F.coalesce(best, F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(ruling).alias("ruling"))))
    return at.withColumn("best", best).select(*at.columns, F.col("best.rule").alias("rule"), F.col("best.ruling").alias("ruling"))


def host_links(pages: DataFrame) -> DataFrame:
    """``pages(host, html)`` -> from_host, to_host, n; links inside a host are left out."""
    links = pages.where("host <> ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
    absolute = F.when(F.startswith("to", F.lit("//")), F.concat(F.lit("http:"), F.col("to"))).otherwise(F.col("to"))
    pairs = links.select(F.col("host").alias("from_host"), host_of(absolute).alias("to_host"))
    return pairs.where("to_host <> '' AND from_host <> to_host").groupBy("from_host", "to_host").agg(F.count(F.lit(1)).alias("n"))


def carry(links: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank, settled: ``links(a, b, n)``, ``seeds(host, seed)`` with shares that
    sum to one -> host, score of every host that is reached.

    Each round passes on what arrived in the one before. What a round adds to a host, as a share of
    what the host has, is never more than the most that the round before added anywhere, and is all
    of it where a host is new; so the rounds end only when every host is reached and settled.
    Returning weight to the seeds only scales all scores, to a sum of one at the end.
    """
    out = links.groupBy("a").agg(F.sum("n").alias("all"))
    shares = materialize(links.join(out, "a").select("a", "b", (F.col("n") / F.col("all")).alias("share")))
    scores = materialize(seeds.select("host", F.col("seed").alias("score"), F.col("seed").alias("new")))
    change = 1.0
    while change > TOLERANCE:
        passed = scores.where("new > 0").join(shares, scores["host"] == shares["a"])
        arrived = passed.groupBy(F.col("b").alias("host")).agg((damping * F.sum(F.col("new") * F.col("share"))).alias("got"))
        got = F.coalesce("got", F.lit(0.0))
        both = scores.drop("new").join(arrived, "host", "full_outer")
        scores = materialize(both.select("host", (F.coalesce("score", F.lit(0.0)) + got).alias("score"), got.alias("new")))
        # Weight that has become too small for a double is 0, of a score of 0.
        change = scores.where("new > 0").agg(F.max(F.col("new") / F.col("score")).alias("most")).first()["most"] or 0.0
    total = scores.agg(F.sum("score").alias("total")).first()["total"] or 1.0
    return scores.select("host", (F.col("score") / F.lit(total)).alias("score"))


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], threshold: float = THRESHOLD, damping: float = DAMPING
) -> DataFrame:
    """All columns but html, and host, path, rule, verdict, trust, distrust.

    Columns of the table with one of these names are left out.
    """
    made = ["host", "path", "rule", "ruling", "verdict", "trust", "distrust", "html"]
    own = [c for c in pages.columns if c not in made]
    seen = ruled(pages.select(*[F.col(f"`{c}`") for c in own], *["html"] * ("html" in pages.columns)), rules)
    links = materialize(host_links(seen) if "html" in pages.columns else host_links(seen.withColumn("html", F.lit(""))))
    hosts = materialize(seen.where("ruling IS NOT NULL AND host <> ''").groupBy("host").agg(
        F.count_if(F.col("ruling") == "allow").alias("allow"), F.count_if(F.col("ruling") == "block").alias("block")
    ))
    sums = hosts.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    forward = links.select(F.col("from_host").alias("a"), F.col("to_host").alias("b"), "n")
    backward = links.select(F.col("to_host").alias("a"), F.col("from_host").alias("b"), "n")
    found = {}
    for name, edges in (("allow", forward), ("block", backward)):
        total = sums[name] or 1
        seeds = hosts.where(F.col(name) > 0).select("host", (F.col(name) / F.lit(total)).alias("seed"))
        # Back to numbers of pages, so that both sides are on one scale.
        found[name] = carry(edges, seeds, damping).withColumn("score", F.col("score") * F.lit(float(total)))
    scores = found["allow"].withColumnRenamed("score", "trust").join(
        found["block"].withColumnRenamed("score", "distrust"), "host", "full_outer"
    ).fillna(0.0, ["trust", "distrust"])
    placed = seen.drop("html").join(materialize(scores), "host", "left").fillna(0.0, ["trust", "distrust"])
    blocked = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    verdict = F.coalesce("ruling", F.when(blocked, "block").otherwise("allow"))
    return placed.select(*own, "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
