"""Judge urls by allow and block rules, found through their rarest literal token.

A rule is a host and the beginning of a path. It fits its host and all subdomains,
if the url's path begins with the rule's. Each rule is a regular expression over
``host || path`` and is filed under the literal token that the fewest urls hold.
A url's own tokens fetch candidate rules, and only those expressions run. Of the
rules that fit, the longest wins; without any, the default verdict holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.llm.base import fold, without

RESULTS = ("host", "path", "rule", "verdict")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path) as a frame; the list is small by nature."""
    fields = F.array(*(F.struct(*(F.lit(x).alias(n) for x, n in zip(rule, ("verdict", "host", "path"), strict=True))) for rule in rules))
    return spark.range(1).select(F.inline(fields))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    whole = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.regexp_extract(F.coalesce(whole, F.lit("")), r"(?s)^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.substring_index(rest, "/", 1), upper, upper.lower())
    return host, rest.substr(F.length(host) + 1, F.length(rest))


def _literal(text: Column) -> Column:
    return F.regexp_replace(text, r"([^\p{L}\p{N}])", r"\\$1")


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, "[./]"), lambda t: t != ""))


def compile_rules(rules: DataFrame) -> DataFrame:
    """Each rule's text, length, expression and whole literal tokens.

    The last piece of a path that does not end in ``/`` or ``.`` may go on in the
    url, so it is no token. Rules without a host fit nothing and are left out.
    """
    host, path = fold("host"), F.coalesce("path", F.lit(""))
    ahead = F.when(path == "", F.lit("(?=/|$)")).otherwise("")
    pieces = F.split(path, "[./]")
    return rules.filter("host <> ''").select(
        F.concat(host, path).alias("__llm_rule"),
        F.col("verdict").alias("__llm_verdict"),
        F.length(F.concat(host, path)).alias("__llm_length"),
        F.concat(F.lit("^(?:[^/]*[.])?"), _literal(host), _literal(path), ahead).alias("__llm_pattern"),
        F.concat(_tokens(host), F.filter(F.slice(pieces, 1, F.size(pieces) - 1), lambda t: t != "")).alias("__llm_tokens"),
    )


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """File each compiled rule under its rarest token; ``tokens`` has a row ``__llm_token`` per url and token."""
    spread = rules.withColumn("__llm_token", F.explode("__llm_tokens"))
    counts = tokens.join(spread.select("__llm_token").distinct(), "__llm_token").groupBy("__llm_token").agg(F.count("*").alias("__llm_urls"))
    rarest = F.min_by("__llm_token", F.struct(F.coalesce("__llm_urls", F.lit(0)), -F.length("__llm_token"), F.col("__llm_token")))
    keys = ["__llm_rule", "__llm_verdict", "__llm_length", "__llm_pattern"]
    return spread.join(counts, "__llm_token", "left").groupBy(keys).agg(rarest.alias("__llm_token"))


def url_filter(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows with ``host``, ``path``, ``rule`` and ``verdict``.

    Every row stays, repeated ones too. A null url, or one without ``://``, has an
    empty host and path and the default verdict. Of equally long rules that fit,
    block goes before allow, then the greater text. Columns of the input that are
    named like a result give way to it. Each distinct url is judged once.
    """
    host, path = url_parts(F.col(f"`{url}`"))
    urls = pages.select(F.col(f"`{url}`").alias("__llm_url")).filter("__llm_url is not null").distinct()
    urls = urls.select("__llm_url", F.concat(*url_parts(F.col("__llm_url"))).alias("__llm_subject"))
    tokens = urls.select("__llm_url", "__llm_subject", F.explode(_tokens(F.col("__llm_subject"))).alias("__llm_token"))
    index = index_rules(compile_rules(rules), tokens.select("__llm_token"))
    best = F.max_by(
        F.struct("__llm_rule", "__llm_verdict"),
        F.struct("__llm_length", F.col("__llm_verdict") == "block", "__llm_rule"),
    )
    judged = (
        tokens.join(index, "__llm_token")
        .filter(F.expr("__llm_subject rlike __llm_pattern"))
        .groupBy("__llm_url")
        .agg(best.alias("__llm_best"))
    )
    rows = without(pages, *(c for c in RESULTS if c != url)).withColumn("__llm_url", F.col(f"`{url}`"))
    return rows.join(judged, "__llm_url", "left").select(
        *(F.col(f"`{c}`") for c in rows.columns if c != "__llm_url"),
        host.alias("host"),
        path.alias("path"),
        F.col("__llm_best.__llm_rule").alias("rule"),
        F.coalesce("__llm_best.__llm_verdict", F.lit(default)).alias("verdict"),
    )
