"""URL filter: host-suffix and path-prefix expressions looked up among hashed rules.

A URL is expanded by what it is: its host and every parent domain, and for those that have rules
the prefixes of its path at the lengths that the domain's rules have.  So a rule fits
exactly where its host is the URL's host or a parent domain and the URL's path starts with
its path, and the plan does not depend on how many rules or shapes there are.  Domains and expressions
meet rules in equi-joins on the first ``PREFIX`` hex digits of their SHA-256, full digests
confirm, and of several rules the one with the longest expression decides; of equal ones a block.

Null urls and urls without ``://`` have an empty host and path, which no rule with a host
fits; very long urls are expanded whole.  An empty table gives an empty table.  Repeated rows and
ids stay, each judged alone.  Columns other than page_id and url are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of the digest on which urls and rules are joined.
PREFIX = 8
#: Most bytes of rules that are sent to every executor; a larger set is joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Bytes of a rule besides its text: digests, lengths and what a row takes.
ROW_BYTES = 200

#: The rules in force.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def standing_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "rule_host string, rule_path string, rule_verdict string")


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``; columns of those names are replaced."""
    at = F.instr(F.col(url), "://")
    size = F.coalesce(F.length(url), F.lit(0))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, size)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return pages.withColumn("host", F.translate(host, UPPER, LOWER)).withColumn(
        "path",
        F.regexp_extract(F.substring(rest, F.length("host") + 1, size), "^[^?#]*", 0),
    )


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _short(digest: str) -> Column:
    return F.substring(digest, 1, PREFIX)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    known = rules.where("rule_host is not null and rule_path is not null and rule_verdict in ('allow', 'block')")
    known = known.select("rule_host", "rule_path", "rule_verdict").distinct()
    size = known.agg(F.sum(F.octet_length("rule_host") + F.octet_length("rule_path") + ROW_BYTES)).first()[0] or 0

    def sent(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if size <= BROADCAST_BYTES else table

    # The lengths of the paths that a domain's rules have.
    domains = (
        known.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
        .withColumn("domain_digest", F.sha2("rule_host", 256))
        .select("domain_digest", _short("domain_digest").alias("domain_short"), "lengths")
    )
    expressions = (
        known.withColumn("rule", F.concat("rule_host", "rule_path")).withColumn("rule_digest", F.sha2("rule", 256))
        .select("rule_digest", _short("rule_digest").alias("rule_short"), "rule", "rule_verdict")
    )
    parts = with_parts(pages.select("page_id", "url")).drop("url").withColumn("row", F.monotonically_increasing_id())
    # The host itself comes first; a row that leads to nothing is kept for it alone.
    suffixes = F.transform(F.sequence(_labels(F.col("host")), F.lit(1), F.lit(-1)), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    asked = (
        parts.select("*", F.posexplode(suffixes).alias("at", "domain"))
        .withColumn("asked_digest", F.sha2("domain", 256)).withColumn("domain_short", _short("asked_digest"))
        .join(sent(domains), "domain_short", "left")
        .withColumn("lengths", F.when(F.col("asked_digest") == F.col("domain_digest"), F.col("lengths")))
        .where("lengths is not null or at = 0")
        .withColumn("lengths", F.filter("lengths", lambda n: n <= F.length("path")))
        .select("row", "page_id", "host", "path", "domain", F.explode_outer("lengths").alias("chars"))
        .withColumn("asked_digest", F.sha2(F.concat("domain", F.substring("path", F.lit(1), F.col("chars"))), 256))
        .withColumn("rule_short", _short("asked_digest"))
    )
    met = asked.join(sent(expressions), "rule_short", "left").withColumn(
        "fit",
        F.when(
            F.col("asked_digest") == F.col("rule_digest"),
            F.struct(F.length("rule"), F.col("rule_verdict") == "block", F.col("rule"), F.col("rule_verdict")),
        ),
    )
    best = met.groupBy("row").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"),
        F.first("path").alias("path"), F.max("fit").alias("fit"),
    )
    return best.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.rule_verdict", F.lit(default)).alias("verdict"),
    )


ORACLE = r"""
with rules(rule_host, rule_path, rule_verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rests as (
  select page_id, row_number() over () as r,
         case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id, r,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from rests),
fits as (
  select p.*, rule_host || rule_path as rule, rule_verdict,
         row_number() over (partition by r
           order by length(rule_host || rule_path) desc nulls last, rule_verdict desc) as n
  from parts p left join rules on (host = rule_host or ends_with(host, '.' || rule_host))
    and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict from fits where n = 1
"""
