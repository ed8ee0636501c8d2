"""URL filtering by rules that are indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens that any
matching URL must hold. Token frequencies over all URLs pick each rule's rarest token.
URL tokens fetch the candidate rules of those tokens, and only the candidates run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overlace.llm.common import met, stored

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``name`` is what is reported; of several rules that match, higher ``rank`` and then the longer name wins."""

    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int = 0


def host_rule(name: str, verdict: str) -> Rule:
    """A rule ``host/path``: the host and all its subdomains, paths that start with ``/path``."""
    host, slash, path = name.partition("/")
    path = slash + path
    whole = re.findall(TOKEN, host.lower())
    inside = re.findall(TOKEN, path.lower())
    if inside and re.search("[A-Za-z0-9]$", path):  # the last one may go on in the url
        inside.pop()
    return Rule(name, rf"^([^/]*\.)?{re.escape(host)}{re.escape(path)}", verdict, tuple(dict.fromkeys(whole + inside)), 1)


#: The longest rule wins; none of these patterns is ever overruled by the method's own.
HOST_RULES = (host_rule("net/", "block"), host_rule("example.net/en/", "allow"), host_rule("example.com/de/", "block"), host_rule("org/fr/", "allow"))
#: Host labels of advertising, spam and doubtful shops; each is a rule with a hyphen and a rule
#: without one, as their tokens differ.
LABELS = (("spam", "farm"), ("cheap", "pills"), ("ads", "track"), ("free", "casino"), ("adult", "cam"))
PATTERN_RULES = tuple(Rule(join.join(label), rf"^([^/]*[.])?{join.join(label)}[.]", "block", label if join else ("".join(label),)) for label in LABELS for join in ("-", ""))


def split_url(url: str = "url") -> tuple:
    """Host (A-Z lower-cased) and path of a url column, both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def filter_urls(pages: DataFrame, rules=HOST_RULES + PATTERN_RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    ``pages``: page_id, url and any other columns. ``rule`` is the name of the host rule
    that decides, null if none fits; then the method's own patterns decide, ``matched``
    names the one that did, and otherwise the verdict is ``default``.

    A null url, or one without ``://``, has an empty host and path and gets the default.
    Ties between rules of one rank and length go to the smaller name. Repeated rows are
    all returned. A rule without literal tokens is a candidate for every url. The tokens of
    a rule must stand, as whole tokens, in every url that its pattern matches. An empty
    table gives an empty result.
    """
    spark = pages.sparkSession
    host, path = split_url()
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    targets = urls.select(F.concat("host", "path").alias("target")).distinct()
    lowered = F.translate("target", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))
    if not all(r.tokens for r in rules):  # the empty token fetches rules that have none
        own = F.concat(F.array(F.lit("")), own)
    tokens = stored(targets.select("target", F.explode(F.array_distinct(own)).alias("token")))

    listed = spark.createDataFrame([(r.name, r.pattern, r.verdict, r.rank, t) for r in rules for t in r.tokens or ("",)], "name string, pattern string, verdict string, rank int, token string")
    counts = met(tokens, listed.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = listed.join(counts, "token", "left").groupBy("name", "pattern", "verdict", "rank").agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token")).alias("least"))
    index = stored(rarest.select("name", "pattern", "verdict", "rank", F.col("least.token").alias("token")))

    candidates = met(tokens, index, "token").where(F.expr("target RLIKE pattern"))
    order = F.struct("rank", F.length("name").alias("length"), "name", "verdict")
    # Of equal length the smaller name: max over the rest, then min over the names that reach it.
    best = candidates.groupBy("target").agg(F.max(F.struct("rank", F.length("name").alias("length"))).alias("best"), F.collect_set(order).alias("all"))
    won = stored(best.select("target", F.array_min(F.filter("all", lambda x: (x["rank"] == F.col("best.rank")) & (x["length"] == F.col("best.length")))).alias("w")))
    out = met(urls.withColumn("target", F.concat("host", "path")), won, "target", "left")
    return out.select("page_id", "host", "path", F.when(F.col("w.rank") > 0, F.col("w.name")).alias("rule"), F.coalesce("w.verdict", F.lit(default)).alias("verdict"))


SQL = """
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a),
c AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM c)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(host || path, '^([^/]*[.])?(spam-?farm|cheap-?pills|ads-?track|free-?casino|adult-?cam)[.]') THEN 'block' ELSE 'allow' END AS verdict
FROM d
"""
