"""URL filtering with indexed pattern rules, in DataFrame functions only.

Two rule kinds share one candidate scheme, a join on an exact key:

* host rules (host, path prefix, verdict): keyed by host; a url offers the
  trailing labels of its host; the longest fitting rule wins;
* pattern rules (wildcard patterns): each is keyed by its rarest literal token
  (rarity counted over all urls); a url offers its tokens, and only the rules
  so fetched run their regular expression.  A pattern without a usable token
  is keyed by the empty token, which every url offers.

Work is done once per distinct url.  Rules are parameters, so their table is
small and known; the planner broadcasts it by size.

Defined results: a null url, or one without ``://``, has empty host and path
and no host rule; a null url matches no pattern and is allowed.  Repeated
rows are all returned.  Other columns (clashing names included) are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_insights.llm.common import only, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The host rules (host, path, verdict).
HOST_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Pattern rules: ``*`` any text, ``^`` a separator or an end, ``|`` an end of
#: the url; letters are compared in lower case.  Verdict allow beats block.
PATTERN_RULES = [
    ("^spam-farm^", "block"),
    ("^casino^", "block"),
    ("^porn*^", "block"),
    ("^xxx^", "block"),
    ("^adserver^", "block"),
    ("^ads^*^banner^", "block"),
    ("^phishing^", "block"),
    ("^malware^", "block"),
    ("^warez^", "block"),
    ("^free^download^crack^", "block"),
    ("|data:", "block"),
    ("^education^*^casino^", "allow"),
]


def _constant(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A table of literal rows (no RDD)."""
    items = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, r)]) for r in rows]
    kind = "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>"
    return spark.range(1).select(F.inline(F.array(*items).cast(kind)))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://[^/?#]*([^?#]*)", 1)


def _pattern_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, pattern, regex, action): each pattern under its rarest token."""
    # A token counts only where the pattern bounds it on both sides by a literal non-token character.
    tokens = F.regexp_extract_all("pattern", F.lit("(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])"), F.lit(1))
    r = rules.withColumn("tokens", F.array_distinct(tokens))
    wanted = r.select(F.explode("tokens").alias("token")).distinct()
    seen = (urls.select(F.explode("tokens").alias("token"))
            .join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n")))
    rarest = (r.select("pattern", F.explode("tokens").alias("token")).join(seen, "token", "left")
              .groupBy("pattern")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    quoted = F.regexp_replace("pattern", "([.+?()\\[\\]{}$\\\\])", "\\\\$1")
    regex = F.regexp_replace(quoted, "\\*", ".*")
    regex = F.regexp_replace(regex, "\\^", "(?:[^a-z0-9_.%-]|[.-]|^|\\$)")
    regex = F.regexp_replace(regex, "^\\|", "^")
    regex = F.regexp_replace(regex, "\\|$", "\\$")
    return (rules.join(rarest, "pattern", "left")
            .select(F.coalesce("token", F.lit("")).alias("token"), "pattern", "action",
                    F.concat(F.lit("(?s)"), regex).alias("regex")))


def url_verdicts(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES,
                 id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict and ``pattern``
    (the deciding pattern where no host rule fits, else null)."""
    spark = pages.sparkSession
    p = only(pages, id_col, url_col).select(F.col(id_col), F.col(url_col).alias("url"))
    low = F.translate("url", UPPER, LOWER)
    urls = p.select("url").where(F.col("url").isNotNull()).distinct().select(
        "url", low.alias("low"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("tokens", F.array_distinct(
        F.concat(F.array_remove(F.split("low", "[^a-z0-9]+"), ""), F.array(F.lit("")))))

    # Host rules: only as many trailing labels as the deepest rule has.
    deepest = max([h.count(".") + 1 for h, _, _ in host_rules], default=1)
    labels = F.split("host", "\\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))),
        lambda k: F.array_join(F.slice(labels, -k, k), "."))
    hosts = _constant(spark, host_rules, ["rule_host", "rule_path", "action"])
    by_host = (urls.select("url", "path", F.explode(tails).alias("rule_host"))
               .join(hosts, "rule_host")
               .where(F.col("path").startswith(F.col("rule_path")))
               .select("url", F.concat("rule_host", "rule_path").alias("rule"), "action")
               .select("url", F.struct(F.length("rule").alias("len"), "rule", "action").alias("host_hit"),
                       F.lit(None).cast("struct<action:string,pattern:string>").alias("pattern_hit")))

    rules = _constant(spark, pattern_rules, ["pattern", "action"])
    index = _pattern_index(urls, rules)
    by_pattern = (urls.select("url", "low", F.explode("tokens").alias("token"))
                  .join(index, "token")
                  .where(F.expr("low rlike regex"))
                  .select("url", F.lit(None).cast("struct<len:int,rule:string,action:string>").alias("host_hit"),
                          F.struct("action", "pattern").alias("pattern_hit")))
    # 'allow' sorts before 'block', so the least hit is the deciding one.
    hits = by_host.unionByName(by_pattern).groupBy("url").agg(
        F.max("host_hit").alias("host_hit"), F.min("pattern_hit").alias("pattern_hit"))
    verdict = F.coalesce(F.col("host_hit.action"), F.col("pattern_hit.action"), F.lit("allow"))
    return p.join(hits, "url", "left").select(
        F.col(id_col), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("host_hit.rule").alias("rule"), verdict.alias("verdict"),
        F.when(F.col("host_hit").isNull(), F.col("pattern_hit.pattern")).alias("pattern"))


def op5_url_filters(spark, sf_dir):
    return url_verdicts(table(spark, sf_dir, "pages"))
