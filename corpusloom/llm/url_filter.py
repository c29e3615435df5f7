"""URL filters: host-suffix and path-prefix expressions joined to rules on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import table

# Hexadecimal digits of the digest that the join compares first (32 bits).
PREFIX_DIGITS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """The part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _rule_table(rules: DataFrame) -> DataFrame:
    """One row per rule with its digest; of equal rules with both actions, block holds."""
    keyed = rules.select(
        F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"), "action",
    )
    merged = keyed.groupBy("host", "path").agg(F.max(F.col("action") == "block").alias("blocks"))
    rule = F.concat("host", "path")
    return merged.select(
        rule.alias("rule"), F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("digest"), "blocks",
        F.length(rule).alias("rule_length"), F.length("host").alias("host_length"),
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row; ``rules`` are ``(host, path, action)``.

    A rule fits its host and all subdomains if the URL's path starts with the rule's path. The
    longest fitting rule wins, then the one with the longer host, then block. Without one the rule
    is null and the verdict is ``default``.

    Every URL is expanded into host suffixes and path prefixes, as many as the rules have labels
    and slashes, so nothing a rule could fit is left out. Expressions meet rules on the first
    digits of their digests; the whole digests confirm. Spark broadcasts the rules where their
    measured size allows; else it shuffles and splits skewed keys. Repeated rows are judged once
    and returned as often as they came.

    Null URLs and URLs without ``://`` have an empty host and path, which fit no rule but one with
    an empty host and path. Empty tables give empty results or the default; extra columns are ignored.
    """
    # One row of bounds; tails are the numbers of characters after a rule's last slash.
    bounds = rules.select(
        F.max(F.size(F.split(F.coalesce("host", F.lit("")), "\\."))).alias("labels"),
        F.max(F.regexp_count(F.coalesce("path", F.lit("")), F.lit("/"))).alias("slashes"),
        F.collect_set(F.length(F.substring_index(F.coalesce("path", F.lit("")), "/", -1))).alias("tails"),
    ).first()
    labels, slashes = bounds["labels"] or 1, bounds["slashes"] or 0
    tails = sorted(bounds["tails"] or [0])
    # Rows that agree in these have one verdict, whatever follows the path.
    rows = pages.select(
        F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")
    ).groupBy("id", "host", "path").agg(F.count("*").alias("copies"))
    suffixes = F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.lit(labels)), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k)
    ))
    cuts = F.transform(F.sequence(F.lit(0), F.lit(slashes)), lambda k: F.when(
        k == 0, F.lit("")).when(F.regexp_count("path", F.lit("/")) >= k, F.concat(
            F.call_function("substring_index", F.col("path"), F.lit("/"), k), F.lit("/"))))
    ends = F.flatten(F.transform(F.filter(cuts, lambda c: c.isNotNull()), lambda c: F.transform(
        F.array(*[F.lit(t) for t in tails]), lambda t: F.when(
            F.length("path") >= F.length(c) + t, F.call_function("substring", F.col("path"), F.lit(1), F.length(c) + t)))))
    prefixes = F.array_distinct(F.filter(ends, lambda e: e.isNotNull()))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda p: F.sha2(F.concat_ws("\n", s, p), 256))))
    expanded = rows.withColumn("digest", F.explode(keys)).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_DIGITS))
    table_ = _rule_table(rules).withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    table_ = table_.withColumnRenamed("digest", "full")
    met = expanded.join(table_, "prefix", "left")
    best = F.when(F.col("digest") == F.col("full"), F.struct("rule_length", "host_length", "blocks", "rule"))
    judged = met.groupBy("id", "copies", "host", "path").agg(F.max(best).alias("best"))
    judged = judged.select("*", F.explode(F.expr("sequence(1, copies)")))
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.blocks"), "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict")
    )


# The rules of the registered query.
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


_VALUES = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
SQL = f"""
WITH parts AS (
  SELECT row_number() OVER () AS k, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rule_host, rule_path, action) AS (VALUES {_VALUES}),
fits AS (
  SELECT k, rule_host || rule_path AS rule, action,
    row_number() OVER (PARTITION BY k ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (k)
"""
