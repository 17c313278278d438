"""URL filters by hashed expressions, DataFrame functions only.

Each site (host and head of the path) is expanded into host suffixes of the label counts times path prefixes of the
lengths that rules have. Expressions and rules meet in an equi-join on the first 8 hex digits of their SHA-256; the
full digests confirm a meeting, and the longest rule wins. Sites are expanded once each, however many pages
they have; those of very many pages find them by broadcast. What no rule fits has the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT, hot_keys, join_unique, lower_ascii, read, spill

#: (host, path, verdict): a rule fits its host and all subdomains where the path starts with its path.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: The verdict on pages that no rule fits.
DEFAULT = "allow"


def split_url(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """pages with host and path, both empty for a null url or one without ``://``."""
    rest = F.regexp_extract(pages[url_col], r"^(?s:.*?)://((?s).*)$", 1)
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """Rules (tuples, or a DataFrame of host, path, verdict) with their digests."""
    if not isinstance(rules, DataFrame):
        rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
        rules = spark.range(1).select(F.inline(F.array(*rows)))
    table = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    return table.withColumn("digest", F.sha2(F.concat("r_host", F.lit("\0"), "r_path"), 256)).withColumn("short", F.substring("digest", 1, 8))


def path_lengths(table: DataFrame) -> list[int]:
    """The lengths that rules' paths have; URLs are short, so there are few, however many rules."""
    return sorted(r[0] for r in table.select(F.length("r_path")).distinct().collect())


def label_counts(table: DataFrame) -> list[int]:
    """The numbers of labels that rules' hosts have; host names have few, however many rules."""
    return sorted(r[0] for r in table.select(labels("r_host")).distinct().collect())


def labels(host: str) -> Column:
    return F.length(host) - F.length(F.replace(F.col(host), F.lit("."), F.lit(""))) + 1


def match(sites: DataFrame, table: DataFrame, lengths: list[int], counts: list[int]) -> DataFrame:
    """(host, head, rule, verdict) of the sites that a rule fits; sites holds distinct (host, head).

    A host has one suffix for each number of labels that rules have, so the work is linear in its length. Expressions
    that very many sites share find their rules by broadcast.
    """
    suffixes = F.array_compact(F.array(*[F.when(labels("host") >= n, F.substring_index("host", ".", -n)) for n in counts]))
    heads = F.array_compact(F.array(*[F.when(F.length("head") >= n, F.substring("head", 1, n)) for n in lengths]))
    expressions = sites.withColumn("e_host", F.explode(suffixes)).withColumn("e_path", F.explode(heads))
    digest = F.sha2(F.concat("e_host", F.lit("\0"), "e_path"), 256)
    expressions = spill(expressions.select("host", "head", digest.alias("e_digest")).withColumn("short", F.substring("e_digest", 1, 8)))
    rules = table.groupBy("short").agg(F.collect_list(F.struct("digest", "r_host", "r_path", "r_verdict")).alias("rules"))  # those of one short hash are few
    met = join_unique(expressions, rules, hot_keys(expressions, ["short"], expressions.count()), ["short"])
    hits = met.select("host", "head", "e_digest", F.inline("rules")).filter("e_digest = digest")
    rule = F.concat("r_host", "r_path")
    best = F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best")
    return hits.groupBy("host", "head").agg(best).select("host", "head", "best.rule", "best.verdict")


def verdicts(pages: DataFrame, rules=RULES, default: str = DEFAULT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict for every row of pages.

    rules: tuples or a DataFrame of (host, path, verdict). rule is the longest one that fits (of equal lengths
    the greater text, of equal rules the greater verdict, so block before allow), else null, and the verdict then ``default``. Null, empty and odd
    urls have an empty host and path, fit no rule and are allowed. Repeated rows get equal rows, null ids
    stay null, an empty table gives no rows; other columns are ignored.
    """
    rows = split_url(pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"))).drop("url")
    table = rule_table(pages.sparkSession, rules)
    lengths, counts = path_lengths(table), label_counts(table)
    rows = rows.withColumn("head", F.substring("path", 1, max([0, *lengths])))
    sites = spill(rows.groupBy("host", "head").agg(F.count("*").alias("n")))
    hot = sites.filter(F.col("n") * HOT > pages.count())
    found = sites.select("host", "head").join(match(sites.select("host", "head"), table, lengths, counts), ["host", "head"], "left")
    out = join_unique(rows, spill(found), hot, ["host", "head"])
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(read(spark, sf_dir, "pages"))


def _values(rules) -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)


ORACLE_SQL = f"""
WITH rules(h, p, v) AS (VALUES {_values(RULES)}),
cut AS (SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN '' ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
sites AS (SELECT DISTINCT host, path FROM parts),
best AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM sites JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(v, '{DEFAULT}') AS verdict FROM parts LEFT JOIN best USING (host, path)
"""
