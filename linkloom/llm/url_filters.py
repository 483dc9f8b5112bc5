"""URL filters: pattern rules found through their rarest literal token.

A rule is fetched only for URLs that hold its token, and only fetched rules run a regular
expression. All of it is column expressions over one scan; no row is shuffled."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in one literal map; more rules take further maps, one after the other.
RULES_PER_MAP = 2000


@dataclass(frozen=True)
class Rule:
    """action: block or allow. pattern, one of:

    - `host/path`: fits the host and its subdomains where the path starts with /path;
    - `*text*text`: fits where the text stands anywhere in host and path; * is any run."""

    action: str
    pattern: str

    @property
    def by_host(self) -> bool:
        return "*" not in self.pattern

    def regex(self) -> str:
        if self.by_host:
            return r"^(?:[^/]*\.)?" + _escaped(self.pattern)
        return ".*?".join(_escaped(x) for x in self.pattern.strip("*").split("*"))

    def tokens(self) -> list[str]:
        """Literal tokens that any fitting URL holds as whole tokens: those with a literal
        delimiter, or the start of the host, on both sides."""
        text = ("." if self.by_host else "") + self.pattern
        return [m[1] for m in re.finditer(r"(?=(?<=[^A-Za-z0-9*])([A-Za-z0-9]+)[^A-Za-z0-9*])", text)]


def _escaped(x: str) -> str:
    return re.sub(r"([^A-Za-z0-9\u0080-\U0010ffff/])", r"\\\1", x)


#: The rules by host and path.
HOST_RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)
#: What is blocked where no rule by host fits.
PATTERN_RULES = (
    Rule("block", "*-farm.*"),
    Rule("block", "*/casino/*"),
    Rule("block", "*.casino.*"),
    Rule("block", "*/porn/*"),
    Rule("block", "*.porn.*"),
    Rule("block", "*/free-download/*"),
)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _tokens(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(subject, F.lit("([A-Za-z0-9]+)"), F.lit(1)))


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """In how many of all URLs (columns host, path) each token of the rules stands.

    What reaches the driver is one count for each token of the rules."""
    wanted = sorted({t for r in rules for t in r.tokens()})
    held = urls.select(F.array_intersect(_tokens(F.concat("host", "path")), F.lit(wanted).cast("array<string>")).alias("t"))
    counts = held.select(F.explode("t").alias("token")).groupBy("token").count().collect()
    return dict.fromkeys(wanted, 0) | {r["token"]: r["count"] for r in counts}


def matching_rules(subject: Column, rules: Sequence[Rule], counts: dict[str, int]) -> Column:
    """The rules that fit subject (host and path): array of (length, rule, action, by_host).

    Each rule stands under its rarest token; one without a usable token is tried on every URL."""
    found = [F.expr("cast(array() as array<struct<length:int,rule:string,action:string,by_host:boolean,regex:string>>)")]
    fits = lambda r: F.regexp_like(subject, r["regex"])
    entry = lambda r: F.struct(
        F.lit(len(r.pattern)).alias("length"), F.lit(r.pattern).alias("rule"), F.lit(r.action).alias("action"),
        F.lit(r.by_host).alias("by_host"), F.lit(r.regex()).alias("regex"),
    )
    loose = [r for r in rules if not r.tokens()]
    index: dict[str, list[Rule]] = {}
    for r in rules:
        if r.tokens():
            index.setdefault(min(r.tokens(), key=lambda t: (counts.get(t, 0), t)), []).append(r)
    for r in loose:
        found.append(F.when(subject.rlike(r.regex()), F.array(entry(r))).otherwise(found[0]))
    keys = sorted(index)
    for i in range(0, len(keys), RULES_PER_MAP):
        part = keys[i : i + RULES_PER_MAP]
        by_token = F.create_map(*[x for k in part for x in (F.lit(k), F.array(*[entry(r) for r in index[k]]))])
        known = F.array_intersect(_tokens(subject), F.array(*[F.lit(k) for k in part]))
        found.append(F.filter(F.flatten(F.transform(known, _fetch(by_token))), fits))
    return F.concat(*found)


def _fetch(by_token: Column):
    return lambda token: F.element_at(by_token, token)


def judge_urls(df: DataFrame, url: str = "url", rules: Sequence[Rule] = HOST_RULES + PATTERN_RULES) -> DataFrame:
    """df with host, path, rule, verdict (columns of these names are replaced).

    Of the rules by host that fit, the longest wins (of equal ones, allow). Where none fits,
    rule is null and the verdict is block if a text rule that blocks fits and none that
    allows, else allow. A null URL, or one without `://`, has an empty host and path, no
    rule and the verdict allow. Repeated rows are judged alike; no row is dropped."""
    df = df.drop("host", "path", "rule", "verdict", "__hits", "__best")
    parts = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    counts = token_counts(parts, rules)
    hits = parts.withColumn("__hits", matching_rules(F.concat("host", "path"), rules, counts))
    best = F.array_max(F.transform(F.filter("__hits", lambda r: r["by_host"]), lambda r: F.struct(r["length"], (r["action"] == "allow").alias("a"), r["rule"], r["action"])))
    hits = hits.withColumn("__best", best)
    texts = F.filter("__hits", lambda r: ~r["by_host"])
    blocked = F.exists(texts, lambda r: r["action"] == "block") & ~F.exists(texts, lambda r: r["action"] == "allow")
    verdict = F.when(F.col("__best").isNotNull(), F.col("__best.action")).when(blocked, "block").otherwise("allow")
    return hits.withColumns({"rule": F.col("__best.rule"), "verdict": verdict}).drop("__hits", "__best")


def op2_url_filters(spark, sf_dir: str) -> DataFrame:
    """Every page's page_id, host, path, rule, verdict."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH u AS (
  SELECT page_id, strpos(coalesce(url, ''), '://') AS pos, coalesce(url, '') AS url FROM pages
), p AS (
  SELECT page_id,
         translate(CASE WHEN pos = 0 THEN '' ELSE regexp_extract(substr(url, pos + 3), '^([^/?#]*)', 1) END,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN pos = 0 THEN '' ELSE regexp_extract(substr(url, pos + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM u
), r AS (
  SELECT * FROM (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                        ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
  ) AS t(rule, rule_host, rule_path, action)
), m AS (
  SELECT p.page_id, p.host, p.path, r.rule, r.action,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS n
  FROM p LEFT JOIN r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, host, path, rule,
       CASE WHEN action IS NOT NULL THEN action
            WHEN contains(host || path, '-farm.') OR contains(host || path, '/casino/') OR contains(host || path, '.casino.')
              OR contains(host || path, '/porn/') OR contains(host || path, '.porn.') OR contains(host || path, '/free-download/')
            THEN 'block' ELSE 'allow' END AS verdict
FROM m WHERE n = 1
"""
