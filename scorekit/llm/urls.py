"""URL filter by host-suffix and path-prefix expressions.

Every distinct URL is expanded into the expressions that a rule could have: the last ``labels``
labels of its host followed by the first ``length`` characters of its path, for the (labels, length)
pairs that occur among the rules. Expressions meet rules in an equi-join on the first bytes of their
SHA-256; the full digests are compared afterwards and the longest confirmed rule decides. Only
DataFrame functions are used.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekit.llm.common import ascii_lower
from scorekit.session import lookup_join

PREFIX_HEX = 8  # four bytes
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without one."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with digests. Rules with a null are dropped; if one expression
    carries both verdicts, ``block`` holds."""
    return (rules.dropna(subset=["host", "path", "verdict"])
            .withColumn("host", ascii_lower(F.col("host")))
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .select(F.concat("host", "path").alias("rule"), "verdict",
                    F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length"),
                    F.length("host").alias("host_length"))
            .withColumn("digest", _digest(F.col("rule")))
            .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url",
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per distinct URL: url, host, path, rule (null: none fits), verdict.

    A rule fits its host and all subdomains when the path starts with the rule's path. The longest
    expression wins, of equally long ones that with the longer host. A null URL, one without
    ``://`` or an empty table fit no rule. ``url`` names the only column that is read.
    """
    rules = prepare_rules(rules)
    shapes = [{"labels": r["labels"], "length": r["length"]} for r in rules.select("labels", "length").distinct()
              .orderBy("labels", "length").collect()]  # as many as rules have forms
    distinct = (urls.select(F.col(url).alias("url")).distinct()
                .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    distinct = distinct.select("url", F.coalesce("host", F.lit("")).alias("host"),
                               F.coalesce("path", F.lit("")).alias("path"))
    labels, length = F.size(F.split("host", r"\.")), F.length("path")
    forms = F.from_json(F.lit(json.dumps(shapes)), "array<struct<labels int, length int>>")  # a constant, however many there are
    fitting = F.filter(forms, lambda s: (F.col("host") != "") & (s["labels"] <= labels) & (s["length"] <= length))
    expressions = F.transform(fitting, lambda s: F.concat(F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"]),
                                                          F.substring("path", F.lit(1), s["length"])))
    expanded = (distinct.select("url", F.explode(F.array_distinct(expressions)).alias("expression"))
                .withColumn("full", _digest(F.col("expression")))
                .withColumn("prefix", F.substring("full", 1, PREFIX_HEX))
                .drop("expression"))
    near = lookup_join(expanded, rules.drop("labels"), "prefix", "inner")
    best = (near.where(F.col("full") == F.col("digest")).groupBy("url")
            .agg(F.max(F.struct((F.length("rule")).alias("n"), "host_length", "rule", "verdict")).alias("best"))
            .select("url", "best.rule", "best.verdict"))
    return (distinct.join(best, "url", "left")
            .select("url", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
                default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per input row: key, host, path, rule, verdict. Repeated rows stay repeated, a null
    key stays null, other columns are not read. Every distinct URL is judged once; the join back
    splits URLs that many rows share."""
    pages = pages.select(F.col(key).alias("key"), F.col(url).alias("page_url"))
    judged = judge_urls(pages, rules, "page_url", default)
    return (pages.join(judged, pages["page_url"].eqNullSafe(judged["url"]), "left")
            .select(F.col("key").alias(key), "host", "path", "rule", "verdict"))
