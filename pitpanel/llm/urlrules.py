"""URL rules fetched by their rarest literal token; DataFrame functions only.

A rule is a pattern over host and path. Its index entry is the one of its literal tokens that the
fewest URLs hold; a URL's tokens fetch candidate rules, and only those run their regular
expressions. A rule without a literal token, of which the built-in ones have none, would be a candidate of every URL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN = "[^0-9A-Za-z]+"
#: Bytes of rules that may be broadcast; beyond this the index is joined by a shuffle.
BROADCAST_BYTES = 8 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` over lower-case host followed by path; ``literals``: tokens that every match holds whole."""

    name: str
    action: str
    pattern: str
    literals: tuple[str, ...] = ()
    listed: bool = True


def site(action: str, name: str) -> Rule:
    """The rule of a host and path such as ``example.net/en/``: the host, all its subdomains, paths that start so."""
    host, _, path = name.partition("/")
    whole = [t for t in re.split(TOKEN, host) if t]
    inner = re.split(TOKEN, "/" + path)[1:-1]  # the last stretch may go on in a URL
    return Rule(name, action, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape('/' + path)}", tuple(whole + [t for t in inner if t]))


SITES = (site("block", "net/"), site("allow", "example.net/en/"), site("block", "example.com/de/"), site("allow", "org/fr/"))


def word(name: str, place: str) -> Rule:
    """A rule that blocks where a word is a whole label of the host or a whole step of the path."""
    pattern = rf"^(?:[^/]*\.)?{name}\.[^/]+/" if place == "host" else rf"/{name}(?:/|$)"
    return Rule(f"{place} {name}", "block", pattern, tuple(t for t in re.split(TOKEN, name) if t), False)


#: Unlisted patterns: they decide where no listed rule fits.
PATTERNS = tuple(word(n, "host") for n in ("track", "tracker", "pixel", "adserver")) + tuple(word(n, "path") for n in ("login", "signin", "cart", "checkout", "wp-admin", "wp-login"))


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    rows = [(k, r.name, r.action, r.pattern, list(r.literals), r.listed) for k, r in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_id int, name string, action string, pattern string, literals array<string>, listed boolean")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = SITES + PATTERNS, otherwise: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages``.

    Among listed rules that fit, the longest name wins (block before allow, then the name, on
    ties) and is shown in ``rule``. Where none fits, a fitting pattern rule decides (block wins),
    else ``otherwise``; ``rule`` is then null. Repeated rows are judged alike; null ids stay null. Urls of any
    length are taken whole. Only the two columns named are read, so others can't clash. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    small = sum(len(r.pattern) + len(r.name) + sum(map(len, r.literals)) + 64 for r in rules) <= BROADCAST_BYTES
    near = F.broadcast if small else (lambda df: df)
    table = rule_table(spark, rules)
    named = rows.where((F.col("host") != "") | (F.col("path") != ""))
    seen = named.select("host", "path").distinct()
    target = F.concat("host", "path")
    tokens = seen.select("host", "path", F.explode(F.array_distinct(F.split(target, TOKEN))).alias("token"))
    literals = table.select("rule_id", F.explode("literals").alias("token"))
    # How many URLs hold each literal, then each rule's rarest one.
    held = tokens.join(near(literals.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counted = literals.join(held, "token", "left").select("rule_id", "token", F.coalesce("n", F.lit(0)).alias("n"))
    index = counted.groupBy("rule_id").agg(F.min(F.struct("n", "token")).alias("key")).select("rule_id", F.col("key.token").alias("token"))
    indexed = table.join(index, "rule_id")

    info = F.struct(F.col("listed"), F.length("name").alias("length"), (F.col("action") == "block").alias("blocks"), F.col("name"), F.col("action"))
    hits = tokens.join(near(indexed), "token").where(F.regexp_like(F.concat("host", "path"), F.col("pattern"))).groupBy("host", "path").agg(F.max(info).alias("best"))
    # Patterns without a literal are constants in the plan: each runs once on each URL.
    free = [F.when(target.rlike(r.pattern), F.struct(F.lit(r.listed).alias("listed"), F.length(F.lit(r.name)).alias("length"), F.lit(r.action == "block").alias("blocks"), F.lit(r.name).alias("name"), F.lit(r.action).alias("action"))) for r in rules if not r.literals]
    outcome = lambda best: (F.when(best["listed"], best["name"]).alias("rule"), F.coalesce(best["action"], F.lit(otherwise)).alias("verdict"))
    verdicts = seen.join(hits, ["host", "path"], "left").select("host", "path", F.array_max(F.array_compact(F.array(F.col("best"), *free))).alias("best"))
    judged = named.join(verdicts.select("host", "path", *outcome(F.col("best"))), ["host", "path"]).select("page_id", "host", "path", "rule", "verdict")
    # Urls without host and path, however many, have no token and stay out of the joins.
    nothing = F.array_max(F.array_compact(F.array(*free))) if free else F.lit(None).cast("struct<listed: boolean, length: int, blocks: boolean, name: string, action: string>")
    bare = rows.where((F.col("host") == "") & (F.col("path") == "")).withColumn("best", nothing).select("page_id", "host", "path", *outcome(F.col("best")))
    return judged.unionByName(bare)


ORACLE = """
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
r(name, h, start, action) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
hit AS (SELECT host, path, arg_max(name, length(name)) AS name, arg_max(action, length(name)) AS action FROM (SELECT DISTINCT host, path FROM p) JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, start) GROUP BY host, path)
SELECT p.page_id, p.host, p.path, hit.name AS rule,
  CASE WHEN hit.action IS NOT NULL THEN hit.action
       WHEN regexp_matches(p.host || p.path, '^(?:[^/]*\\.)?(?:track|tracker|pixel|adserver)\\.[^/]+/') OR regexp_matches(p.host || p.path, '/(?:login|signin|cart|checkout|wp-admin|wp-login)(?:/|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN hit USING (host, path)
""".replace("\\\\", "\\")
